"""Operator 7: near-duplicates by BagMinHash.

A text is a bag of five-word shingles. Every shingle owns, for each dyadic interval of weights
([0, 1), [1, 2), [2, 4), …), a Poisson process of points whose rate is the interval's length; a
point counts if its place in the interval lies below the shingle's weight, and goes to one of
the signature's components. A component keeps its earliest point, so two texts agree in it with a
probability of exactly their weighted Jaccard similarity. Points are drawn in order of time up to
a horizon at which all components are filled (drawn further for the few texts where they
are not), about 1,300 points for a text of any length.

Bands of the signature give buckets; texts that share one, directly or through others, are a
candidate group. All pairs of a group are compared by the exact overlap of their bags, in
blocks: a group is dealt into blocks of about 256 texts (fewer if they are long), each pair of blocks is one piece of work,
and a matrix product counts the shared shingles of all its pairs at once. No pair becomes a row; a
piece hands on one link for each text it joins to others. With 32 bands of 5 components, texts of
similarity 0.8 share a bucket with probability 1 - 3e-6.

Texts of equal words are one node, so exact copies, however many, cost one text. A group of s
different texts costs s * s / 2 comparisons and s * s / 256 moved texts: exact, but quadratic in
the near copies of one text. Otherwise shuffled are the bands, and the texts of candidates; bitmaps
of fixed size keep most of both where they are.

Defined cases: null counts as the empty text; texts without a word are alike only if equal; texts of
fewer than five words are one shingle; repeated rows are members of one group, each returned; ties
go to the least doc_id; a group whose ids are all null has the group id null; an empty table gives no
rows; other columns are passed by.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from stagecheck.llm.common import WORD, free_names, mix, passes, settle, sieve, text_key, texts_of
from stagecheck.llm.graph import components

SHINGLE = 5
BANDS, ROWS = 32, 5
SIMILARITY = 0.8
BLOCK = 256  # texts of a group that are compared together with those of another block
BLOCK_SHINGLES = 500_000  # they hold together, so that long texts make smaller blocks
COLUMNS = 4096  # shingles that one matrix product takes
REMEMBERED = 150_000
TOGETHER = 1_000_000  # characters whose signatures are drawn together
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD1B54A32D192ED03)


class _Hashes(dict):
    """64 bits for each word, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little", signed=True)
        return found


def shingles(words: list[str], hashes: _Hashes) -> np.ndarray:
    """Hashes of all runs of five words; of all words if there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    tokens = np.fromiter(map(hashes.__getitem__, words), np.int64, len(words)).view(np.uint64)
    size = min(SHINGLE, len(words))
    out = np.zeros(len(tokens) - size + 1, np.uint64)
    for k in range(size):
        out = out * _BASE + tokens[k : len(tokens) - size + 1 + k]
    return mix(out)


def signatures(bags: list[np.ndarray], size: int = BANDS * ROWS) -> np.ndarray:
    """Signature of each bag, a matrix of arrival times; bags are arrays of hashes with repeats, none empty."""
    doc, key, low, length, weight = [], [], [], [], []
    for n, bag in enumerate(bags):
        element, count = np.unique(bag, return_counts=True)
        lower, width, level = 0, 1, 0
        while len(element):
            doc.append(np.full(len(element), n))
            key.append(mix(element + np.uint64(level * int(_SECOND) % 2**64)))
            low.append(np.full(len(element), lower))
            length.append(np.full(len(element), width))
            weight.append(count)
            lower, width, level = lower + width, max(1, 2 * width) if level else 1, level + 1
            element, count = element[count > lower], count[count > lower]
    doc, key = np.concatenate(doc), np.concatenate(key)
    length = np.concatenate(length)
    below = np.minimum(1.0, (np.concatenate(weight) - np.concatenate(low)) / length)
    total = np.array([len(b) for b in bags])
    horizon = size * (math.log(size) + 3) / total
    out = np.full(len(bags) * size, np.inf)
    time, step = np.zeros(len(key)), np.zeros(len(key), np.uint64)
    active = np.arange(len(key))
    waiting = np.zeros(0, np.int64)
    time[active] = _arrivals(key, step, length)
    while True:
        due = time[active] <= horizon[doc[active]]
        waiting = np.concatenate([waiting, active[~due]])
        active = active[due]
        if not len(active):
            open_ = np.flatnonzero(np.isinf(out.reshape(-1, size)).any(1))
            if not len(open_):
                return out.reshape(-1, size)
            horizon[open_] *= 2
            again = np.isin(doc[waiting], open_)
            active, waiting = waiting[again], waiting[~again]
            continue
        draw = mix(mix(key[active] + step[active] * _BASE) ^ _SECOND)
        inside = (draw & np.uint64(0xFFFFFFFF)) / 2.0**32 < below[active]
        at = doc[active] * size + ((draw >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(out, at[inside], time[active[inside]])
        step[active] += np.uint64(1)
        time[active] += _arrivals(key[active], step[active], length[active])


def _arrivals(key: np.ndarray, step: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Waiting times until the next point."""
    uniform = ((mix(key + step * _BASE) >> np.uint64(11)) + np.uint64(1)) / 2.0**53
    return -np.log(uniform) / rate


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One number for each band of each signature."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signature), BANDS)) * _SECOND
    for k in range(ROWS):
        out = mix(out * _BASE + bits[:, :, k])
    return out.view(np.int64)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two bags, given as arrays with repeats."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared = len(np.intersect1d(_told_apart(a), _told_apart(b), assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def _told_apart(bag: np.ndarray) -> np.ndarray:
    """A bag as a set: the second and later copies of a value become values of their own."""
    value = np.sort(bag)
    first = np.flatnonzero(np.diff(value, prepend=value[:1] ^ np.uint64(1)) != 0) if len(value) else np.empty(0, np.int64)
    copy = np.arange(len(value)) - np.repeat(first, np.diff(np.append(first, len(value))))
    return np.where(copy == 0, value, mix(value + copy.astype(np.uint64) * _SECOND))


def _links(sets: list[np.ndarray], left: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links from one member of each set of joined texts to the others; only pairs with one side in ``left`` count if some are not."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    value, column = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(column, minlength=len(value)) > 1
    rank = np.cumsum(often) - 1
    owner, column = owner[often[column]], rank[column[often[column]]]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(often.sum()), COLUMNS):
        part = (column >= low) & (column < low + COLUMNS)
        table = np.zeros((len(sets), COLUMNS), np.float32)
        table[owner[part], column[part] - low] = 1
        shared += table @ table.T
    near = shared >= similarity * (sizes[:, None] + sizes[None, :] - shared) - 1e-3
    near &= np.triu(np.ones_like(near), 1)
    if not left.all():
        near &= left[:, None] != left[None, :]
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in np.argwhere(near).tolist():
        if find(a) != find(b) and int(shared[a, b]) >= similarity * (sizes[a] + sizes[b] - int(shared[a, b])):
            root[find(a)] = find(b)
    return [(find(n), n) for n in range(len(sets)) if find(n) != n]


def _words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def signed(df: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep``, text_key, node (equal for equal words), the numbers of the bands (none without words) and n_shingles."""
    own = df.select(*keep, text_key(text).alias("text_key"), F.col(text).alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            nodes: list[bytes] = []
            bands: list[np.ndarray] = []
            counts: list[int] = []
            bags: list[np.ndarray] = []
            places: list[int] = []
            held = 0
            none = np.empty(0, np.int64)

            def draw() -> None:
                if bags:
                    for place, found in zip(places, band_keys(signatures(bags)), strict=True):
                        bands[place] = found
                bags.clear()
                places.clear()

            for n, value in enumerate(texts_of(batch, "_text")):
                words = _words(value)
                nodes.append(hashlib.md5((" ".join(words) if words else "\0" + value).encode()).digest())
                bands.append(none)
                counts.append(max(len(words) - SHINGLE + 1, int(bool(words))))
                if words:
                    bags.append(shingles(words, hashes))
                    places.append(n)
                    held += len(value)
                if held >= TOGETHER:
                    draw()
                    held = 0
            draw()
            offsets = np.concatenate([[0], np.cumsum([len(b) for b in bands])]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(bands) if bands else none))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(nodes, pa.binary()), listed, pa.array(counts, pa.int64())],
                names=[*keep, "text_key", "node", "bands", "n_shingles"])

    return own.mapInArrow(run, f"{kept}, node binary, bands array<bigint>, n_shingles bigint")


def _rooted(df: DataFrame, text: str, key: str, similarity: float) -> DataFrame:
    """``key``, text_key, rid and root (of the group) for every row."""
    # n64 stands for a node where chance agreement would only bring more texts into one comparison.
    rows = settle(signed(df, text, (key,)).withColumns({"rid": F.xxhash64(key), "n64": F.xxhash64("node")}), "bag-rows")
    buckets = rows.select("n64", F.explode("bands").alias("bucket")).groupBy("bucket").agg(
        F.min("n64").alias("first"), F.max("n64").alias("last"))
    buckets = settle(buckets.where(F.col("first") != F.col("last")).select("bucket", "first"), "bag-buckets")
    members = _members(rows.select("n64", "bands"), sieve(buckets, "bucket"))
    edges = members.join(buckets, "bucket").select(F.col("first").alias("a"), F.col("n64").alias("b"))
    groups = components(edges)
    groups = groups.select(F.col("node").alias("n64"), F.col("root").alias("work"))
    links = settle(_compared(_candidates(df, rows, groups, text, key), similarity), "bag-links")
    roots = components(links)
    own = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return own.select(key, "text_key", "rid", "root")


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """``key``, text_key, rid, root (of the group), group_id (its least key) and group_size for every row."""
    own = _rooted(df, text, key, similarity)
    classes = own.groupBy("root").agg(F.min(key).alias("group_id"), F.count("*").alias("group_size"))
    return own.join(classes, "root").select(key, "text_key", "rid", "root", "group_id", "group_size")


def _members(rows: DataFrame, shared: Broadcast) -> DataFrame:
    """(n64, bucket) for the buckets in the sieve."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column(1)
            flat, sizes = np.array(bands.flatten()), np.diff(np.array(bands.offsets))
            left = passes(shared.value, flat)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(batch.column(0)), sizes)[left]), pa.array(flat[left])], names=["n64", "bucket"])

    return rows.mapInArrow(run, "n64 bigint, bucket bigint")


def _candidates(df: DataFrame, rows: DataFrame, groups: DataFrame, text: str, key: str) -> DataFrame:
    """(node, work, blocks, text) of grouped nodes; one row of each is picked before texts move, so copies do not gather."""
    picked = rows.select("node", "n64", "text_key", "rid", "n_shingles").join(groups, "n64").groupBy("node").agg(F.min(F.struct(
        "text_key", "rid", "work", "n_shingles")).alias("p")).select("node", "p.*")
    picked = settle(picked, "bag-picked")
    only = sieve(picked, "rid")
    need = F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    picked = picked.join(picked.groupBy("work").agg(F.ceil(need).cast("int").alias("blocks")), "work")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(only.value, np.array(batch.column(1)))))

    source = df.select(text_key(text).alias("text_key"), F.xxhash64(key).alias("rid"), F.coalesce(text, F.lit("")).alias("text"))
    source = source.mapInArrow(run, "text_key binary, rid bigint, text string")
    found = source.join(picked, ["text_key", "rid"]).select("node", "work", "blocks", "text")
    return settle(found.dropDuplicates(["node"]), "bag-texts")


def _compared(texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join all similar texts of each group."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = texts.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("work", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "text")
    by = ["work", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        piece, nodes, sets, left = None, [], [], []

        def found() -> pa.RecordBatch:
            pairs = _links(sets, np.array(left), similarity) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([nodes[p[i]] for p in pairs], pa.binary()) for i in range(2)], names=["a", "b"])

        for batch in batches:
            work, low, high, own, node = (c.to_pylist() for c in batch.columns[:5])
            for n, value in enumerate(texts_of(batch, "text")):
                if piece != (work[n], low[n], high[n]):
                    yield found()
                    piece, nodes, sets, left = (work[n], low[n], high[n]), [], [], []
                nodes.append(node[n])
                sets.append(_told_apart(shingles(_words(value), hashes)))
                left.append(own[n] == low[n])
        yield found()

    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a binary, b binary")


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """``df`` with one row of each group of near-duplicates, that of the least key; all its columns stay."""
    # Who is kept follows from the roots; a join with the groups' sizes would gather all copies of a text.
    groups = _rooted(df, text, key, similarity)
    first = groups.groupBy("root", "text_key", "rid").agg(F.min(key).alias("key"), F.count("*").alias("rows"))
    first = first.groupBy("root").agg(F.min(F.struct("key", "text_key", "rid", "rows")).alias("k"))
    own, rid, rows = free_names(("_text_key", "_rid", "_rows"), df.columns)
    kept = settle(first.select(F.col("k.text_key").alias(own), F.col("k.rid").alias(rid), F.col("k.rows").alias(rows)), "bag-kept")
    named = df.select("*", text_key(text).alias(own), F.xxhash64(key).alias(rid))
    # The kept keys are the small side: hashed, so that the texts need no sorting.
    found = named.join(kept.hint("shuffle_hash"), [own, rid])
    once = found.where(F.col(rows) == 1)
    repeated = found.where(F.col(rows) > 1).dropDuplicates([own, rid])
    return once.unionByName(repeated).select(*df.columns)
