import random

import pytest

from stockloom.llm.op6_lines import deduplicated


def brute_force(rows, min_words):
    """Lines that lie in a run of enough words which also begins earlier, by trying all runs."""
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (float("-inf") if r[0] is None else r[0]))
    lines = {r: [(k, x) for k, x in enumerate(r[1].split("\n")) if x.strip(" ")] for r in docs}
    seen, gone = {}, {r: set() for r in docs}
    for r in docs:
        own = lines[r]
        for a in range(len(own)):
            run, words = [], 0
            for b in range(a, len(own)):
                run.append(own[b][1])
                words += own[b][1].count(" ") + 1
                if words >= min_words and tuple(run) in seen and seen[tuple(run)] != (r, a):
                    gone[r] |= {own[j][0] for j in range(a, b + 1)}
                seen.setdefault(tuple(run), (r, a))
    return {r: "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in gone[r]) for r in docs}


def check(spark, rows, min_words):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as h", "1 as j", "2 as gone")
    found = deduplicated(docs, min_words=min_words).collect()
    assert len(found) == len(rows)
    wanted = brute_force(rows, min_words)
    count = {}
    for r in found:
        assert (r.h, r.j) == ("x", 1)
        count.setdefault(r.doc_id, []).append(r.text)
    expected = {}
    for i, t in rows:
        expected.setdefault(i, []).append(None if t is None else wanted[i, t])
    key = lambda t: (t is None, t)
    assert {i: sorted(v, key=key) for i, v in count.items()} == {i: sorted(v, key=key) for i, v in expected.items()}


@pytest.mark.parametrize("seed", range(4))
def test_against_all_runs(spark, seed):
    rnd = random.Random(seed)
    pool = [" ".join(f"w{rnd.randint(0, 40)}" for _ in range(rnd.randint(1, 4))) for _ in range(6 + 4 * seed)]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14)))) for i in range(25)]
    rows += [(100 + i, t) for i, t in rows[:5]]
    check(spark, rows, 5)


def test_edge_cases(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, long), (5, f"before\n{long}\nafter"), (6, long), (6, long), (7, "\n".join(["same line of text here"] * 40)), (8, f"{long} x"), (None, f"{long}\nnull id")]
    check(spark, rows, 50)
    assert deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_passage_over_several_lines_and_blank_lines(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    rows = [(1, f"intro\n{a}\n{b}\n{c}\nend"), (2, f"other\n{a}\n\n{b}\n{c}"), (3, f"{a}\n{b}"), (4, f"{a}\nx\n{b}\n{c}")]
    found = {r.doc_id: r.text for r in deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[2] == "other\n" and found[1] == rows[0][1] and found[3] == rows[2][1] and found[4] == rows[3][1]
