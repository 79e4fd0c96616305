import math
from collections import Counter

import pytest

from stockloom.llm.op10_language import GRAM, Identifier, Model, fitted, grams_of, held_out, op10_language_id, predicted, words_of

ROWS = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "the man", "en"), (4, None, "en"), (5, "nothing known", None), (5, "nothing known", None)]


def brute_force(rows, text):
    """Scores from counters over the whole rows, in plain Python."""
    counts = {}
    for _, t, lang in rows:
        if t is not None and lang is not None:
            for w in words_of(t):
                counts.setdefault((lang, 0), Counter())[w] += 1
                for n in range(1, GRAM + 1):
                    counts.setdefault((lang, n), Counter()).update(grams_of(w, n))
    langs = sorted({lang for lang, _ in counts})

    def log_share(lang, n, s):
        c = counts.get((lang, n), Counter())
        return math.log((c[s] + 0.5) / (sum(c.values()) + 0.5 * (len(c) + 1)))

    total = dict.fromkeys(langs, 0.0)
    for w in words_of(text):
        for n in (0, *range(GRAM, 0, -1)):
            parts = [g for g in ([w] if n == 0 else grams_of(w, n)) if any(counts.get((lang, n), {}).get(g) for lang in langs)]
            if parts:
                for lang in langs:
                    total[lang] += sum(log_share(lang, n, g) for g in parts) / len(parts)
                break
    return total


@pytest.mark.parametrize("text", ["the katze", "hunde", "Mann und Maus", "zzz qqq the", "THE DOG, der!"])
def test_against_plain_python(spark, text):
    import pyarrow as pa

    model = fitted(spark.createDataFrame(ROWS, "doc_id long, text string, lang string"))
    wanted = brute_force(ROWS, text)
    found = Identifier(model)
    for _ in range(2):
        [(lang, score)] = found.identify(pa.array([text]))
        assert lang == max(sorted(wanted), key=wanted.get)
        n = len(words_of(text))
        low = [x * min(n, 20) / n for x in wanted.values()]
        assert score == pytest.approx(1 / sum(math.exp(x - max(low)) for x in low))


def test_undetermined_and_kept_columns(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "123 !? ²"), (4, "the"), (4, "the"), (None, "der")], "doc_id long, text string").selectExpr("*", "'mine' as lang", "7 as score")
    model = fitted(spark.createDataFrame(ROWS, "doc_id long, text string, lang string"))
    found = predicted(docs, model, score="sure").collect()
    assert [(r.lang_pred, r.lang, r.score) for r in found] == [("und", "mine", 7)] * 3 + [("en", "mine", 7)] * 2 + [("de", "mine", 7)]
    empty = fitted(docs.limit(0).selectExpr("doc_id", "text", "lang"))
    assert {r.lang_pred for r in predicted(docs, empty).collect()} == {"und"}
    assert predicted(docs.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = op10_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 1000
    out = [r for r in found if r.held_out]
    assert 200 < len(out) < 300 and sum(r.lang_pred == r.lang for r in out) / len(out) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_rows(spark):
    from zlib import crc32

    rows = spark.range(50).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def model_of(rows):
    """The model of a few rows, without Spark."""
    counts = Counter((lang, n, g) for _, t, lang in rows if t is not None and lang is not None for w in words_of(t) for n in range(GRAM + 1) for g in ([w] if n == 0 else grams_of(w, n)))
    sizes = {(lang, n): [c for (k, m, _), c in counts.items() if (k, m) == (lang, n)] for lang, n, _ in counts}
    return Model([(*key, c) for key, c in counts.items()], [(lang, n, sum(c), len(c)) for (lang, n), c in sizes.items()])


def known_share(rows, text, lang):
    """Mean over the words of 1 if the language has the word, else the share of its long n-grams that the language has."""
    words = {w for _, t, k in rows if t is not None and k == lang for w in words_of(t)}
    grams = {g for w in words for g in grams_of(w, GRAM)}
    shares = [1.0 if w in words else sum(g in grams for g in grams_of(w, GRAM)) / max(len(w) - GRAM + 1, 1) for w in words_of(text)]
    return sum(shares) / len(shares)


def test_many_words_at_once_against_plain_python(monkeypatch):
    import random

    import pyarrow as pa

    rows = [*ROWS, (6, "abcabcab bcabd straße l'homme", "de"), (7, "abcde cabca İstanbul ΟΔΟΣ 𐐀𐐁𐐂𐐃", "fr")]
    draw = random.Random(7)
    texts = [" ".join("".join(draw.choices("abcdehortß'𐐨𐐩𐐪я\x00１ς", k=draw.randint(1, 9))) for _ in range(draw.randint(1, 6))) for _ in range(300)]
    texts = [t for t in texts if words_of(t)] + ["abcabcab" * 50, "a", "я", "the-cat", "İstanbul"]
    monkeypatch.setattr("stockloom.llm.op10_language.BLOCK", 7)
    identifier = Identifier(model_of(rows))
    for _ in range(2):
        for text, (lang, score, known) in zip(texts, identifier.assess(pa.array(texts)), strict=True):
            wanted = brute_force(rows, text)
            assert wanted[lang] == pytest.approx(max(wanted.values()))
            low = [x * min(n, 20) / n for x in wanted.values() for n in [len(words_of(text))]]
            assert score == pytest.approx(1 / sum(math.exp(x - max(low)) for x in low))
            assert known == pytest.approx(known_share(rows, text, lang))


def test_calls_for_an_unseen_word():
    """Most chunks of a large table are met for the first time; each must not cost a chain of calls of its own."""
    import random
    import sys

    import pyarrow as pa

    draw = random.Random(3)
    words = list({"".join(draw.choices("acdehmnortu", k=9)) for _ in range(3000)})
    identifier, calls = Identifier(model_of(ROWS)), 0

    def count(frame, event, _):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        found = list(identifier.assess(pa.array([" ".join(words)])))
    finally:
        sys.setprofile(None)
    assert len(found) == 1 and calls < 10 * len(words)
