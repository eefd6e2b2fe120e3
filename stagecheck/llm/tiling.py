"""Operator 10: benchmark decontamination by greedy string tiling.

Runs of five words (seeds) that a document shares with a benchmark item are found by their rolling
Karp-Rabin hash; neighbouring seeds on one diagonal make maximal matches. The longest match is
marked first; matches that then overlap marked words are cut to what is left of them, as
long as five words remain. An item counts as found if the marked words are ``COVERAGE`` of its words, or
``PASSAGE`` words in all whatever its length; passages that were cut up and put in another order count in full.

A benchmark of at most ``BROADCAST_WORDS`` words is sent to every task (a checked size), and no
document row moves. A larger one is joined on seed hashes instead, with the same results. There each
different text of an item is one, and an item's seeds that most items have are left out of the join as long
as what is left must still meet any document in which the item counts as found: of n words, tiles that
cover enough hold ceil(0.12 n) seeds at least, or ten.

Defined cases: a null or empty text is not contaminated; a null or wordless item matches nothing; an
item of fewer than five words must occur whole; repeated documents are judged alike; repeated items
count once each; equal coverage goes to the smallest item id; item ids may be of any type that can be
ordered; other columns are passed by, and result columns whose names kept columns bear get underscores at
their end.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stagecheck.llm.common import WORD, first_columns, free_names, mix, settle, text_key, texts_of, with_text

SEED = 5
#: Share of an item's words; below 1, for cuts cost the words around them.
COVERAGE = 0.6
#: Words of one item in tiles that count by themselves, however long the item is.
PASSAGE = 50
#: Pairs of equal seeds of two texts that are listed; with more, diagonals are looked at one by one.
LISTED = 1_000_000
BROADCAST_WORDS = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_hash(word: str) -> int:
    """64 bits of a word, never 0."""
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little") | 1


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def seed_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``size`` tokens."""
    if len(tokens) < size:
        return np.empty(0, np.uint64)
    out = np.zeros(len(tokens) - size + 1, np.uint64)
    for k in range(size):
        out = out * _BASE + mix(tokens[k : len(tokens) - size + 1 + k])
    return mix(out + np.uint64(size))


def _maximal(item: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Maximal common runs, one a row: length, start in the item, start in the document."""
    ours, theirs = seed_hashes(item, size), seed_hashes(doc, size)
    order = np.argsort(theirs, kind="stable")
    low, high = np.searchsorted(theirs[order], ours, "left"), np.searchsorted(theirs[order], ours, "right")
    counts = high - low
    if counts.sum() > LISTED:
        return _along_diagonals(item, doc, size)
    i = np.repeat(np.arange(len(ours)), counts)
    j = order[np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)]
    if not len(i):
        return np.empty((0, 3), np.int64)
    by = np.lexsort((i, j - i))
    i, j = i[by], j[by]
    breaks = np.flatnonzero((np.diff(j - i) != 0) | (np.diff(i) != 1)) + 1
    first = np.concatenate([[0], breaks])
    lengths = np.diff(np.append(first, len(i))) + size - 1
    return np.stack([lengths, i[first], j[first]], 1)


def _along_diagonals(item: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """The same for texts that repeat much: one diagonal at a time, so that memory grows with the runs alone."""
    found = []
    for shift in range(size - len(item), len(doc) - size + 1):
        begin, end = max(0, -shift), min(len(item), len(doc) - shift)
        same = np.zeros(end - begin + 2, np.int8)
        same[1:-1] = item[begin:end] == doc[begin + shift : end + shift]
        starts, stops = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        long = stops - starts >= size
        found.append(np.stack([stops[long] - starts[long], starts[long] + begin, starts[long] + begin + shift], 1))
    return np.concatenate(found)


def tiled(item: np.ndarray, doc: np.ndarray, size: int) -> int:
    """Words of the item that non-overlapping tiles cover, the longest marked first."""
    matches = _maximal(item, doc, size)
    matches = matches[np.lexsort((matches[:, 2], matches[:, 1], -matches[:, 0]))]
    cut: list[tuple[int, int, int]] = []
    ours, theirs = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    at = 0
    while (at < len(matches) or cut) and not ours.all():
        ahead = (-int(matches[at, 0]), int(matches[at, 1]), int(matches[at, 2])) if at < len(matches) else None
        if ahead is None or (cut and cut[0] < ahead):
            n, a, b = heapq.heappop(cut)
        else:
            n, a, b = ahead
            at += 1
        free = np.flatnonzero(np.diff(np.concatenate([[True], ours[a : a - n] | theirs[b : b - n], [True]]).astype(np.int8)))
        runs = [(int(s), int(e)) for s, e in free.reshape(-1, 2)]
        if runs == [(0, -n)]:
            ours[a : a - n], theirs[b : b - n] = True, True
        else:
            for s, e in runs:
                if e - s >= size:
                    heapq.heappush(cut, (s - e, a + s, b + s))
    return int(ours.sum())


def counts_as_found(tiled_words: int, item_words: int, coverage: float) -> bool:
    return tiled_words >= coverage * item_words or tiled_words >= PASSAGE


class Items:
    """A benchmark in memory: its words, items, and which items a seed belongs to."""

    def __init__(self, rows: Sequence[tuple[Any, str | None]]):
        self.numbers: dict[str, int] = {}  # of words, from 1; 0 is any word that no item has
        hashes = [0]
        self.tokens: dict[int, np.ndarray] = {}
        self.sizes: dict[int, int] = {}
        self.ids = []
        for item, text in rows:
            found = words(text)
            if found:
                for w in found:
                    if w not in self.numbers:
                        self.numbers[w] = len(hashes)
                        hashes.append(word_hash(w))
                self.tokens[len(self.ids)] = np.array([hashes[self.numbers[w]] for w in found], np.uint64)
                self.sizes[len(self.ids)] = min(SEED, len(found))
                self.ids.append(item)
        self.hashes = np.array(hashes, np.uint64)
        self.seeds = {}
        for size in sorted(set(self.sizes.values())):
            own = [(np.unique(seed_hashes(self.tokens[n], size)), n) for n in self.tokens if self.sizes[n] == size]
            keys = np.concatenate([k for k, _ in own])
            order = np.argsort(keys, kind="stable")
            self.seeds[size] = keys[order], np.repeat([n for _, n in own], [len(k) for k, _ in own])[order]

    def judge(self, text: str, coverage: float) -> tuple[float, Any, list]:
        """Largest coverage of the items that count as found, its item, and all of these; (0.0, None, []) if there is none."""
        found = words(text)
        doc = np.fromiter(map(self.numbers.get, found, itertools.repeat(0)), np.int32, len(found))
        known = doc != 0
        doc = self.hashes[doc]
        near: set[int] = set()
        for size, (keys, items) in self.seeds.items():
            if len(doc) < size:
                continue
            before = np.concatenate([[0], np.cumsum(known)])
            whole = before[size:] - before[:-size] == size
            if not whole.any():
                continue
            seeds = np.unique(seed_hashes(doc, size)[whole])
            low, high = np.searchsorted(keys, seeds, "left"), np.searchsorted(keys, seeds, "right")
            for a, b in zip(low[high > low].tolist(), high[high > low].tolist(), strict=True):
                near.update(items[a:b].tolist())
        found = []
        for n in near:
            marked, whole = tiled(self.tokens[n], doc, self.sizes[n]), len(self.tokens[n])
            if counts_as_found(marked, whole, coverage):
                found.append((-marked / whole, self.ids[n]))
        if not found:
            return 0.0, None, []
        least = min(c for c, _ in found)
        return -least, min(i for c, i in found if c == least), sorted(i for _, i in found)


#: Coverage, item and items as the two ways name them.
_MADE = ("_0", "_1", "_2")


def _result_columns(names: Sequence[str], kind: str) -> str:
    return f"{names[0]} double, {names[1]} {kind}, {names[2]} array<{kind}>"


def _by_broadcast(docs: DataFrame, body: str, items: DataFrame, keep: Sequence[str], coverage: float) -> DataFrame:
    arrow = items.toArrow()
    key = arrow.schema.field(0).type
    shared = docs.sparkSession.sparkContext.broadcast(list(zip(*(c.to_pylist() for c in arrow.columns), strict=True)))
    kept = with_text(docs, keep, body)[2]
    names = free_names(_MADE, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(shared.value)
        for batch in batches:
            made = [items.judge(t, coverage) for t in texts_of(batch, body)]
            columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate((pa.float64(), key, pa.list_(key)))]
            yield pa.RecordBatch.from_arrays([*first_columns(batch, keep), *columns], names=[*keep, *names])

    return docs.mapInArrow(run, f"{kept}, {_result_columns(names, items.schema['item_id'].dataType.simpleString())}")


def _seeds(df: DataFrame, sized: bool) -> DataFrame:
    """(_key, size, seed, n_words) of the texts' different seeds: of one to five words, or if ``sized`` of those an item of that text has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, text in enumerate(texts_of(batch, "_text")):
                tokens = np.array([word_hash(w) for w in words(text)], np.uint64)
                for size in [min(SEED, len(tokens))] if sized else range(1, SEED + 1):
                    found = np.unique(seed_hashes(tokens, size)).view(np.int64) if size else ()
                    if len(found):
                        own = pa.array([batch.column(0)[at].as_py()] * len(found), pa.binary())
                        yield pa.RecordBatch.from_arrays(
                            [own, pa.array(np.full(len(found), size, np.int32)), pa.array(found), pa.array(np.full(len(found), len(tokens)))],
                            names=["_key", "size", "seed", "n_words"])

    return df.select("_key", "_text").mapInArrow(run, "_key binary, size int, seed bigint, n_words bigint")


def _needed_seeds(seeds: DataFrame, coverage: float) -> DataFrame:
    """Each item's seeds but for those that most items have, as far as an item counted as found must meet one of the rest.

    Tiles of five words and more that cover t words begin t / 5 seeds. So if fewer than that are left
    out, one of the others is shared; where a seed repeats inside the item it stands for several and stays.
    """
    least = F.least(F.ceil(F.col("n_words") * coverage / SEED), F.lit(PASSAGE // SEED))
    different = F.count("*").over(Window.partitionBy("_key"))
    spare = F.when((F.col("size") < SEED) | (different < F.col("n_words") - SEED + 1), 0).otherwise(least - 1)
    usual = seeds.groupBy("size", "seed").agg(F.count("*").alias("held"))
    rank = F.row_number().over(Window.partitionBy("_key").orderBy(F.desc("held"), "seed"))
    ranked = seeds.join(usual, ["size", "seed"]).withColumns({"_rank": rank, "_spare": spare})
    return ranked.where(F.col("_rank") > F.col("_spare")).select(F.col("_key").alias("_item"), "size", "seed")


def _by_join(docs: DataFrame, items: DataFrame, keep: Sequence[str], coverage: float) -> DataFrame:
    """The same over a benchmark too large to send: candidate pairs come from a join on seeds."""
    docs = docs.withColumn("_key", text_key("_text"))
    texts = docs.groupBy("_key").agg(F.first("_text").alias("_text"))
    keyed = settle(items.select(text_key("_text").alias("_key"), "_text", "item_id"), "benchmark")
    single = settle(keyed.groupBy("_key").agg(F.first("_text").alias("_text")), "benchmark-texts")
    wanted = settle(_needed_seeds(settle(_seeds(single, True), "benchmark-seeds"), coverage), "benchmark-needed")
    found = _seeds(texts, False).select("_key", "size", "seed").join(wanted, ["size", "seed"]).select("_key", "_item").distinct()
    named = single.select(F.col("_key").alias("_item"), F.col("_text").alias("_of_item"))
    pairs = found.join(texts, "_key").join(named, "_item").select("_key", "_item", "_of_item", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [Items([(0, own)]).judge(text, coverage)[0]
                    for own, text in zip(batch.column(2).to_pylist(), texts_of(batch, "_text"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.float64())], names=["_key", "_item", "_0"])

    judged = pairs.mapInArrow(run, "_key binary, _item binary, _0 double").where("_0 > 0")
    judged = judged.join(keyed.select(F.col("_key").alias("_item"), "item_id"), "_item").groupBy("_key").agg(
        F.max("_0").alias("_0"), F.min(F.struct((-F.col("_0")).alias("least"), "item_id")).alias("_best"),
        F.array_sort(F.collect_list("item_id")).alias("_2"))
    none = F.array().cast(f"array<{items.schema['item_id'].dataType.simpleString()}>")
    return docs.join(judged, "_key", "left").select(
        *keep, F.coalesce("_0", F.lit(0.0)).alias("_0"), F.col("_best.item_id").alias("_1"), F.coalesce("_2", none).alias("_2"))


def find_contamination(df: DataFrame, benchmark: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",),
                       coverage: float = COVERAGE, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """``keep``, contaminated, coverage, item_id and items for every row of ``df``.

    ``items`` are those that count as found in the text, ``coverage`` the largest share of the words of one of
    them, ``item_id`` that item.
    """
    items = benchmark.select("item_id", F.col("text").alias("_text")).where(F.col("_text").isNotNull())
    size = items.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    if size <= 8 * broadcast_words:
        docs, body, _ = with_text(df, keep, text)
        names, found = list(keep), _by_broadcast(docs, body, items, keep, coverage)
    else:
        names = [f"_kept{i}" for i in range(len(keep))]
        docs = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(text).alias("_text"))
        found = _by_join(docs, items, names, coverage)
    made, inner = free_names(("contaminated", "coverage", "item_id", "items"), keep), free_names(_MADE, names)
    return found.select(
        *[F.col(f"`{n}`").alias(c) for n, c in zip(names, keep, strict=True)], (F.size(inner[2]) > 0).alias(made[0]),
        *[F.col(i).alias(m) for i, m in zip(inner, made[1:], strict=True)])
