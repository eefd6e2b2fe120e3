"""Greedy string tiling against a plain version; both ways of finding candidates."""

import random

import numpy as np
import pytest

from stagecheck.llm import tiling


def brute_tiles(item, doc, least):
    """Words of ``item`` in tiles: again and again the longest unmarked common run."""
    a_marked, b_marked = [False] * len(item), [False] * len(doc)
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not a_marked[i + k] and not b_marked[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return sum(a_marked)
        for k in range(best[0]):
            a_marked[best[1] + k] = b_marked[best[2] + k] = True


def test_tiles():
    draw = random.Random(5)
    for _ in range(120):
        item = draw.choices("abc", k=draw.randint(5, 25))
        doc = draw.choices("abc", k=draw.randint(0, 40))
        if draw.random() < 0.5:
            cut = draw.randint(0, len(item))
            doc += item[cut:] + ["q"] + item[:cut]
        coded = [np.array([ord(c) for c in x], np.uint64) for x in (item, doc)]
        got, want = tiling.tiled(*coded, 5), brute_tiles(item, doc, 5)
        # Runs of one length may be marked in another order, which can change what is left.
        assert abs(got - want) <= 6 and (got == 0) == (want == 0)


ITEM = " ".join(f"w{i}" for i in range(40))
TEXTS = [None, "", "nothing here at all to see", "before " + ITEM.upper() + ", after",
         " ".join(f"w{i}" for i in [*range(25, 40), *range(12), *range(12, 25)]),  # in another order
         " ".join(f"w{i}" for i in range(15)), "x y z", " ".join(f"w{i}" for i in range(40)).replace("w20", "v"), ITEM + " " + ITEM]
BENCHMARK = [(1, ITEM), (2, "x y z"), (3, None), (4, "..."), (5, ITEM), (6, "one of the other items which is not there")]


@pytest.mark.parametrize("limit", [tiling.BROADCAST_WORDS, 0], ids=["broadcast", "join"])
def test_both_ways(spark, limit):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    rows = tiling.find_contamination(docs, items, broadcast_words=limit).collect()
    got = {r.doc_id: (r.contaminated, r.item_id, r.items) for r in rows}
    assert len(rows) == len(TEXTS) + 1
    assert {i: g[0] for i, g in got.items()} == {0: False, 1: False, 2: False, 3: True, 4: True, 5: False, 6: True, 7: True, 8: True}
    assert got[3][1:] == (1, [1, 5]) and got[6][1:] == (2, [2])
    assert tiling.find_contamination(docs.where("false"), items, broadcast_words=limit).count() == 0
    assert tiling.find_contamination(docs, items.where("false"), broadcast_words=limit).where("contaminated").count() == 0


def test_documents_agree_both_ways(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plain = {r.item_id: r.text for r in items.collect()}
    one, two = (sorted(tuple(r) for r in tiling.find_contamination(docs, items, broadcast_words=n).collect()) for n in (10**6, 0))
    assert one == two
    whole = {d.doc_id for d in docs.collect() if any(" ".join(tiling.words(t)) in " ".join(tiling.words(d.text)) for t in plain.values())}
    assert whole <= {r[0] for r in one if r[1]}


@pytest.mark.parametrize("limit", [tiling.BROADCAST_WORDS, 0], ids=["broadcast", "join"])
def test_long_items_word_forms_and_text_ids(spark, limit):
    long_item = " ".join(f"v{i}" for i in range(600))
    docs = [(0, " ".join(f"v{i}" for i in range(100, 400))), (1, "so A\u00b2b C d e it is"), (2, " ".join(f"v{i}" for i in range(40))),
            (3, " ".join(f"v{i}" for k in range(6) for i in range(90 * k, 90 * k + 9)))]
    items = [("long", long_item), ("square", "a\u00b2b c d e"), ("copy", long_item), ("aaa", None)]
    rows = tiling.find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), broadcast_words=limit)
    got = {r.doc_id: (r.contaminated, r.coverage, r.item_id, r["items"]) for r in rows.collect()}
    assert got[0] == (True, 0.5, "copy", ["copy", "long"])  # 300 of 600 words: a passage by itself
    assert got[1] == (True, 1.0, "square", ["square"])
    assert got[2] == (False, 0.0, None, [])
    assert got[3] == (True, 0.09, "copy", ["copy", "long"])  # 54 words in six pieces


def test_repetitive_texts_stay_small():
    """A word said 4,000 and 8,000 times makes 32 million pairs of equal seeds, and 12,000 diagonals."""
    item, doc = np.full(4000, 7, np.uint64), np.full(8000, 7, np.uint64)
    assert tiling.tiled(item, doc, 5) == 4000
    draw = random.Random(2)
    for _ in range(40):
        a, b = (np.array(draw.choices([1, 2], k=draw.randint(5, 60)), np.uint64) for _ in range(2))
        one, two = tiling._maximal(a, b, 5), tiling._along_diagonals(a, b, 5)
        assert sorted(map(tuple, one.tolist())) == sorted(map(tuple, two.tolist()))


def test_usual_seeds_are_left_out_but_lose_nothing(spark):
    """Items that share a phrase: it is not joined, and every contaminated document is still found."""
    phrase = " ".join(f"p{i}" for i in range(9))
    items = [(i, f"{phrase} " + " ".join(f"i{i}x{k}" for k in range(60))) for i in range(40)]
    frame = spark.createDataFrame([(i, t) for i, t in items], "_key long, _text string").selectExpr("cast(cast(_key as string) as binary) AS _key", "_text")
    needed = tiling._needed_seeds(tiling._seeds(frame, True), tiling.COVERAGE)
    held = needed.groupBy("seed").count().where("count > 1").count()
    assert held == 0 and needed.count() == 40 * (65 - 8)
    docs = [(i, "so " + t + " it") for i, t in items[:5]] + [(50, phrase), (51, items[7][1].replace("i7x30", "q"))]
    both = [sorted(tuple(r) for r in tiling.find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
        broadcast_words=n).collect()) for n in (10**6, 0)]
    assert both[0] == both[1] and [r[0] for r in both[0] if r[1]] == [0, 1, 2, 3, 4, 51]


@pytest.mark.parametrize("limit", [tiling.BROADCAST_WORDS, 0], ids=["broadcast", "join"])
def test_kept_columns_of_any_name(spark, limit):
    df = spark.createDataFrame([(ITEM, 1, 2, 3, 4, 5)], "text string, coverage int, items int, item_id int, _key int, _0 int")
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    got = tiling.find_contamination(df, items, keep=df.columns, broadcast_words=limit)
    assert got.columns == [*df.columns, "contaminated", "coverage_", "item_id_", "items_"]
    assert tuple(got.first()) == (ITEM, 1, 2, 3, 4, 5, True, 1.0, 1, [1, 5])
