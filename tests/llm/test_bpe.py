import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from stockloom.llm.bpe import SHORT, TextEncoder
from stockloom.llm.op9_bpe import decoded, encoded, op9_bpe_encode_decode

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  a", "a  ", "a \n b", "a\n\n  b\t c", "x<|endoftext|>y <|endoftext|>", "it's I'LL can't", "a" * 3000, "ab" * 900 + " c", "\x1c\x1d a", "ͅá ²³ Ⅷ 一二", " " * 500]


def test_ids_equal_the_library():
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("ab \n\t　\x85\xa01'sé!.") for _ in range(30)) for _ in range(500)]
    texts += ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 3 * SHORT))) for _ in range(500)]
    encoder, library = TextEncoder(open(FILE).read()), Tokenizer.from_file(FILE)
    flat, ends = encoder.encode(pa.array(texts, pa.large_string()))
    for text, a, b in zip(texts, ends, ends[1:], strict=False):
        assert flat[a:b].tolist() == library.encode(text, add_special_tokens=False).ids


def test_slices_are_whole_texts():
    import pyarrow.compute as pc

    from stockloom.llm.bpe import slices

    texts = [None if i % 7 == 0 else "ÀÉ x Ça " * (i % 50) for i in range(400)]
    for kind in (pa.string(), pa.large_string()):
        runs = list(slices(pa.array(texts, kind), 3000))
        assert len(runs) > 20 and [t for run in runs for t in run.to_pylist()] == [t or "" for t in texts]
        lower = [t for run in runs for t in pc.ascii_lower(run).to_pylist()]
        assert lower == ["".join(c.lower() if c.isascii() else c for c in t or "") for t in texts]
    encoder = TextEncoder(open(FILE).read())
    whole, _ = encoder.encode(pa.array([t or "" for t in texts], pa.large_string()))
    assert np.concatenate([encoder.encode(run)[0] for run in slices(pa.array(texts), 3000)]).tolist() == whole.tolist()


def test_round_trip(spark):
    docs = spark.createDataFrame([*enumerate(ODD), (99, None), (5, ODD[5])], "doc_id long, text string").selectExpr("*", "'x' as decoded")
    found = decoded(encoded(docs, FILE), FILE).collect()
    assert len(found) == len(ODD) + 2 and all(r.decoded == r.text for r in found)
    assert [r.ids for r in found if r.doc_id == 99] == [None]
    assert decoded(encoded(docs.limit(0), FILE), FILE).count() == 0


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    library = Tokenizer.from_file(FILE)
    found = op9_bpe_encode_decode(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
