"""Extendible hashing against a directory split by hand."""

import hashlib
from collections import defaultdict

from stagecheck.llm.sharding import assign_shards, write_shards


def brute(sizes, limit):
    """Shard of each id: split every bucket that is too large on its next bit."""
    bits = {i: f"{int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16):060b}" for i in sizes}
    out, todo = {}, [("", list(sizes))]
    while todo:
        prefix, ids = todo.pop()
        if sum(sizes[i] for i in ids) <= limit:
            out.update((i, "b" + prefix) for i in ids)
        else:
            for bit in "01":
                todo.append((prefix + bit, [i for i in ids if bits[i].startswith(prefix + bit)]))
    return out


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = {r.doc_id: len(r.text.encode()) for r in df.collect()}
    for limit in (40_000, 150_000):
        rows = assign_shards(df, limit).collect()
        assert {r.doc_id: r.shard for r in rows} == brute(sizes, limit)
        assert all(r.shard_bytes <= limit and r.page == 0 for r in rows)


def test_uneven_sizes_need_deeper_rounds(spark):
    df = spark.range(200).selectExpr("id AS doc_id", "repeat('x', if(id < 2, 900, 1)) AS text", "id AS hash")
    sizes = {i: 900 if i < 2 else 1 for i in range(200)}
    assert {r.doc_id: r.shard for r in assign_shards(df, 1000).collect()} == brute(sizes, 1000)


def test_equal_hashes_chain(spark):
    rows = [(7, "x" * 30)] * 50 + [(7, "y" * 90)] * 3 + [(7, "z" * 500)] + [(None, None), (8, "")]
    got = assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 100).collect()
    pages = defaultdict(list)
    for r in got:
        pages[r.shard, r.page].append(r)
    assert len(got) == len(rows)
    for members in pages.values():
        total = sum(r.n_bytes for r in members)
        assert total == members[0].shard_bytes and len(members) == members[0].shard_rows
        assert total <= 100 or len(members) == 1 and members[0].oversized


def test_larger_than_a_shard(spark):
    """Rows that no shard can hold stand alone; their neighbours are split off no further than needed."""
    rows = [(i, "x" * (700 if i in (3, 17) else 5)) for i in range(120)]
    got = {r.doc_id: r for r in assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 100).collect()}
    assert len(got) == 120
    assert {i for i, r in got.items() if r.oversized} == {3, 17} and all(got[i].depth == 60 and got[i].shard_rows == 1 for i in (3, 17))
    bits = {i: f"{int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16):060b}" for i in range(120)}
    for i, r in got.items():
        if not r.oversized:
            size = lambda depth: sum(len(t) for k, t in rows if bits[k][:depth] == bits[i][:depth])
            assert r.shard == "b" + bits[i][: r.depth] and size(r.depth) <= 100 and (r.depth == 0 or size(r.depth - 1) > 100)


def test_empty_and_written(spark, tmp_path):
    df = spark.range(50).selectExpr("id AS doc_id", "repeat('x', 20) AS text")
    assert assign_shards(df.where("false"), 100).count() == 0
    directory = write_shards(df, str(tmp_path / "shards"), 100)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 50 and back.groupBy("_shard").sum().count() == directory.count() >= 10
    assert directory.agg({"shard_rows": "sum"}).first()[0] == 50


def test_written_rows_are_all_there(spark, tmp_path):
    """Null and repeated keys, columns named like our own."""
    rows = [(None, "n" * 40, 1, i) for i in range(30)] + [(7, "s" * 30, 2, i) for i in range(20)] + [(i, "t", 3, i) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, hash int, _shard int")
    write_shards(df, str(tmp_path / "shards"), 100)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(str, (tuple(r) for r in back.select(*df.columns).collect()))) == sorted(map(str, rows))
    sizes = back.groupBy("_shard_").agg({"*": "count"}).count()
    assert sizes >= 80 * 20 // 100
    named = assign_shards(df.withColumnRenamed("_shard", "page"), 100, key=("doc_id", "page"))
    assert named.columns == ["doc_id", "page", "shard", "depth", "page_", "n_bytes", "shard_bytes", "shard_rows", "oversized"]
