"""Periodic runs against a search over all periods, and the query against its contract by hand."""

import hashlib
import random
import re
import zlib

import numpy as np

from stagecheck.llm import runs
from stagecheck.llm.registry import op11_periodic_runs

SF = "/root/testdata/sf0.001"


def brute(words, least=6, times=4):
    found, n = set(), len(words)
    for q in range(1, n // times + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            if end > at and end + q - at >= max(least, times * q):
                inside = words[at : end + q]
                if all(inside[d:] != inside[:-d] for d in range(1, q)):
                    found.add((at, end + q, q))
            at = end + 1
    return sorted(found)


def as_rows(found):
    return [tuple(r) for r in found.tolist()]


def some_words(rng):
    n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 5])
    words = [rng.randrange(k) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 9)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def test_random_words():
    rng = random.Random(11)
    for _ in range(1500):
        words, (least, times) = some_words(rng), rng.choice([(6, 4), (8, 4), (2, 2), (5, 3)])
        want = brute(words, least, times)
        assert as_rows(runs.runs_of(words, least, times)) == want
        both = np.array([9, 8, *words, *words, 9], np.int64)
        split = runs.runs_of_texts(both, np.array([2, len(words), len(words), 0, 1]), least, times)
        assert [as_rows(s) for s in split] == [[], want, want, [], []]


def test_extensions():
    rng = random.Random(5)
    for _ in range(100):
        words = [rng.randrange(3) for _ in range(rng.randint(2, 40))]
        extend = runs.Extensions(*runs.tour(runs.suffix_tree([*words, -1])))
        one, two = (np.array(x) for x in zip(*[(i, j) for i in range(len(words) + 1) for j in range(len(words) + 1) if i != j]))
        for i, j, got in zip(one, two, extend(one, two)):
            want = 0
            while max(i, j) + want < len(words) and words[i + want] == words[j + want]:
                want += 1
            assert got == want


def test_long_periodic_text():
    rng = random.Random(3)
    base = [rng.randrange(4000) for _ in range(30_000)]
    words = [base[i if i < 2000 else 2000 + (i - 2000) % 7000] for i in range(30_000)]
    assert as_rows(runs.runs_of_texts(np.array(words), np.array([30_000]))[0]) == [(2000, 30_000, 7000)]
    assert as_rows(runs.runs_of([1] * 5000)) == [(0, 5000, 1)]


def by_hand(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a, period = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % period] for i, w in enumerate(words)]
    found = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < e for s, e, q in found)]
    best = min(found, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    head = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    return (len(found), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op11_periodic_runs(spark, SF).collect()
    assert len(rows) == len(texts)
    short = {i for i, t in texts.items() if len(t or "") < 4000}
    planted = 0
    for row in rows:
        if row.doc_id in short:
            assert tuple(row)[1:] == by_hand(row.doc_id, texts[row.doc_id]), row.doc_id
            planted += row.n_runs > 0
    assert planted > 5


def test_defined_cases(spark):
    rows = [(1, None, "a"), (None, "x x x x x x x", "b"), (2, "", "c"), (3, "a b a b a b a b c", "d"), (3, "a b a b a b a b c", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = runs.find_runs(df, keep=df.columns).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "runs", "n_words", "runs_", "best", "collapsed"}
    assert [(r.text, r.runs) for r in got] == [(r[1], r[2]) for r in rows]
    assert [(r.n_words, [tuple(x) for x in r.runs_], r.collapsed) for r in got] == [
        (0, [], ""), (7, [(0, 7, 1)], "x"), (0, [], ""), (9, [(0, 8, 2)], "a b c"), (9, [(0, 8, 2)], "a b c")]
    assert runs.with_planted_periods(df).where("doc_id IS NULL").first().text == "x x x x x x x"
    assert runs.find_runs(df.where("false")).count() == 0


def test_ties_go_to_the_first():
    assert runs.best_run(np.array([[0, 12, 3], [2, 10, 2], [20, 24, 1]])) == [0, 12, 3]
    assert runs.best_run(np.empty((0, 3))) is None
