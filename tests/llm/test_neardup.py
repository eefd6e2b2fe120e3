"""BagMinHash signatures and near-duplicate groups against brute force."""

import itertools
import random
from collections import defaultdict

import numpy as np

from stagecheck.llm import neardup
from stagecheck.llm.common import mix


def brute(rows, similarity=0.8):
    """Least id of each document's group, by comparing all that share a shingle."""
    hashes = neardup._Hashes()
    bags = [np.sort(neardup.shingles(neardup._words(t or ""), hashes)) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    shared, same = defaultdict(list), {}
    for n, (_, text) in enumerate(rows):
        words = " ".join(neardup._words(text or ""))
        first = same.setdefault((bool(words), words or text or ""), n)
        root[find(n)] = find(first)
        if first == n:
            for value in np.unique(bags[n]).tolist():
                shared[value].append(n)
    pairs = {p for members in shared.values() for p in itertools.combinations(members, 2)}
    for a, b in pairs:
        if find(a) != find(b) and neardup.weighted_jaccard(bags[a], bags[b]) >= similarity:
            root[find(a)] = find(b)
    least = {}
    for n, (key, _) in enumerate(rows):
        if key is not None:
            least[find(n)] = min(least.get(find(n), key), key)
    return [least.get(find(n)) for n in range(len(rows))]


def near_copies(draw, words, base, changes):
    out = list(base)
    for _ in range(changes):
        out[draw.randrange(len(out))] = draw.choice(words)
    return out


def test_signatures_estimate_the_weighted_jaccard():
    draw = np.random.default_rng(0)
    a = np.repeat(draw.integers(0, 2**63, 50).astype(np.uint64), draw.integers(1, 9, 50))
    b = np.repeat(np.unique(a), draw.integers(0, 9, 50))
    agree = [(s[0] == s[1]).mean() for s in (
        neardup.signatures([mix(a + np.uint64(k)), mix(b + np.uint64(k))], 512) for k in range(1, 25))]
    assert abs(np.mean(agree) - neardup.weighted_jaccard(np.sort(a), np.sort(b))) < 0.02


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    got = {r.doc_id: r.group_id for r in neardup.near_duplicates(df).collect()}
    assert [got[key] for key, _ in rows] == brute(rows)


def test_a_large_group_with_stragglers_loses_no_link(spark):
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdefghij", k=5)) for _ in range(500)]
    base = draw.choices(words, k=150)
    chain, rows = base, []
    for i in range(150):
        chain = near_copies(draw, words, chain if i % 10 == 0 else base, 2 if i % 10 == 0 else draw.randint(0, 4))
        rows.append((i, " ".join(chain)))
    rows += [(1000 + i, rows[3][1]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in neardup.near_duplicates(df).collect()}
    assert [got[key] for key, _ in rows] == brute(rows)


def test_defined_cases_and_keeping_one(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, "..."), (4, "..."), (5, "!"), (None, text), (7, text.upper()), (7, text), (7, text), (8, "a b"),
            (9, "a  b"), (10, "a c"), (11, "z " * 3000), (12, "z " * 2900), (13, "z " * 100)]
    df = spark.createDataFrame([(k, t, "s", 1) for k, t in rows], "doc_id long, text string, node string, bucket int")
    found = neardup.near_duplicates(df).collect()
    assert sorted(((r.doc_id or 0), r.group_id) for r in found) == sorted(
        ((k or 0), g) for (k, _), g in zip(rows, brute(rows), strict=True))
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 5, 8, 10, 11, 13]
    assert neardup.near_duplicates(df.where("false")).count() == 0
