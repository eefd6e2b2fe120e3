"""Operator 2: removal of every byte inside a 200-byte string that also starts elsewhere.

After prefix-free parsing: rolling-hash triggers cut each text into phrases that overlap by the
trigger, so that equal strings are cut alike wherever they stand. The trigger of a 200-byte string is
its least window hash, so each string of that length holds one (no stretch is without), and the
starts of one trigger form a phrase: from its first start to 199 bytes after its last.

Only phrases whose trigger occurs again can hold a repeated string. They form the dictionary; the parse
says how often and where each stands. A phrase that occurs twice in the parse is repeated in all its starts at
once, however long the copies are. Of the rest, the phrases that share a trigger with a different
phrase get a suffix array, in the order of bytes, by prefix doubling: ranks of 8 bytes are doubled to 128, and
two of these make 200. Equal neighbours in that order are repeats. Phrases reach 199 bytes beyond their
last start, so the order of the dictionary decides alone, and suffixes of different triggers are never
equal: the corpus order is made trigger by trigger, and the triggers' orders are not merged.

Every step keeps large groups out of single tasks: counts combine before the shuffle, joins have one
side with a row for each key, and triggers with more than ``GROUP`` different phrases are not ordered in
one task: 128-bit fingerprints of all their starts are counted by a shuffle instead, as equal starts have
equal ones and different starts have not. Two bitmaps of fixed size spare the shuffles
most phrases and texts without a repeated trigger. Texts move once.

Defined cases: null counts as empty; texts under 200 bytes are kept whole; repeated rows repeat each
other, so all bytes of both go (from 200 bytes on); texts of any length are cut into pieces that
overlap by 199 bytes; an empty table gives no rows; other columns are passed by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from stagecheck.llm.common import mix, passes, settle, sieve, text_key

LENGTH = 200
TRIGGER = 32  # bytes of the rolling window
PIECE = 1 << 20  # bytes that are parsed together
#: Different phrases of one trigger that a task puts in order; those of larger groups are shuffled start by start.
GROUP = 4096
_BITS = 22  # of a place in a piece, with room for the overlaps
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_RANDOM = np.random.default_rng(20240229)
#: Random weights of the byte values, one table for each hash.
_WEIGHTS = _RANDOM.integers(0, 2**64, (2, 256), dtype=np.uint64)


class Rolling:
    """Two polynomial hashes, modulo 2**64, of every substring of a buffer."""

    _powers: list[tuple[np.ndarray, np.ndarray]] = []

    def __init__(self, buffer: np.ndarray):
        if not self._powers or len(self._powers[0][0]) < len(buffer) + 1:
            size = max(len(buffer) + 1, PIECE + PIECE // 4)
            made = []
            for base in _BASES:
                both = []
                for b in (base, pow(base, -1, 1 << 64)):
                    steps = np.full(size, b, np.uint64)
                    steps[0] = 1
                    both.append(np.multiply.accumulate(steps))
                made.append((both[0], both[1]))
            Rolling._powers = made
        self.sums = []
        for weights, (power, _) in zip(_WEIGHTS, self._powers, strict=True):
            sums = np.zeros(len(buffer) + 1, np.uint64)
            np.cumsum(weights[buffer] * power[: len(buffer)], out=sums[1:])
            self.sums.append(sums)

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice, which: int) -> np.ndarray:
        """Hashes of the bytes from ``start`` to ``end`` (exclusive)."""
        sums, inverse = self.sums[which], self._powers[which][1]
        if isinstance(start, slice):
            return mix((sums[end] - sums[start]) * inverse[: len(sums)][start])
        return mix((sums[end] - sums[start]) * inverse[start])


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` neighbouring values."""
    n = len(values)
    padded = np.full(-(-n // size) * size, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - size + 1], ahead[size - 1 : n])


def phrases(buffer: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, ...]:
    """Phrases of several texts that stand one after another in ``buffer``; ``borders`` are their ends, 0 first.

    Returns first start, number of starts, hash of the trigger, and a second hash, of the phrase.
    """
    rolling = Rolling(buffer)
    window = rolling.of(slice(0, len(buffer) - TRIGGER + 1), slice(TRIGGER, len(buffer) + 1), 0)
    place = np.arange(len(window), dtype=np.uint64)
    low = np.uint64((1 << _BITS) - 1)
    own = (_least((window & ~low) | place, LENGTH - TRIGGER + 1) & low).astype(np.int64)
    valid = np.zeros(len(own) + 1, bool)
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        valid[a : max(a, b - LENGTH + 1)] = True
    changes = np.diff(own, prepend=-1) != 0
    first = np.flatnonzero(valid[:-1] & (changes | ~np.concatenate([[False], valid[:-2]])))
    stops = np.flatnonzero(changes | ~valid[:-1])
    last = np.append(stops, len(own))[np.searchsorted(stops, first, "right")]
    count = last - first
    end = last - 1 + LENGTH
    return first, count, window[own[first]], mix(rolling.of(first, end, 1) + count.astype(np.uint64))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple[bytes, int]], np.ndarray, np.ndarray]]:
    """Keys and offsets of pieces of texts, their bytes together, and the borders between them."""
    held: list[bytes] = []
    names: list[tuple[bytes, int]] = []
    size = 0
    for batch in batches:
        for key, value in zip(batch.column(0), batch.column(1), strict=True):
            raw = (value.as_py() or "").encode()
            for at in range(0, max(0, len(raw) - LENGTH + 1), PIECE):
                held.append(raw[at : at + PIECE + LENGTH - 1])
                names.append((key.as_py(), at))
                size += len(held[-1])
                if size >= PIECE:
                    yield names, np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)])
                    held, names, size = [], [], 0
    if held:
        yield names, np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)])


def parsed(texts: DataFrame, only: Broadcast | None = None) -> DataFrame:
    """Phrases of (key, text): trigger, phrase (a second hash), n (starts), key, at; those in the sieve ``only``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, buffer, borders in _pieces(batches):
            first, count, *hashes = phrases(buffer, borders)
            trigger, phrase = (h.view(np.int64) for h in hashes)
            if only is not None:
                left = passes(only.value, trigger)
                first, count, trigger, phrase = first[left], count[left], trigger[left], phrase[left]
            piece = np.searchsorted(borders, first, "right") - 1
            at = first - borders[piece] + np.array([o for _, o in names])[piece]
            keys = pa.array([k for k, _ in names], pa.binary()).take(pa.array(piece))
            yield pa.RecordBatch.from_arrays(
                [pa.array(trigger), pa.array(phrase), pa.array(count.astype(np.int32)), keys, pa.array(at)],
                names=["trigger", "phrase", "n", "key", "at"])

    return texts.mapInArrow(run, "trigger bigint, phrase bigint, n int, key binary, at bigint")


def _cut(wanted: DataFrame) -> DataFrame:
    """The bytes of the phrases that (key, text, phrases) lists: trigger, different, key, at, n, raw."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, listed in zip(*batch.columns, strict=True):
                raw, rows = text.as_py().encode(), listed.as_py()
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([r[c] for r in rows], kind) for c, kind in (("trigger", pa.int64()), ("different", pa.int64()))],
                     pa.array([key.as_py()] * len(rows), pa.binary()), pa.array([r["at"] for r in rows], pa.int64()),
                     pa.array([r["n"] for r in rows], pa.int32()),
                     pa.array([raw[r["at"] : r["at"] + r["n"] + LENGTH - 1] for r in rows], pa.binary())],
                    names=["trigger", "different", "key", "at", "n", "raw"])

    return wanted.mapInArrow(run, "trigger bigint, different bigint, key binary, at bigint, n int, raw binary")


def _starts(raw: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrase and two fingerprints of every 200-byte string in the phrases ``raw``."""
    borders = np.cumsum([0, *map(len, raw)])
    counts = np.diff(borders) - LENGTH + 1
    phrase = np.repeat(np.arange(len(raw)), counts)
    at = borders[phrase] + np.arange(len(phrase)) - np.repeat(np.cumsum(counts) - counts, counts)
    rolling = Rolling(np.frombuffer(b"".join(raw), np.uint8))
    return phrase, rolling.of(at, at + LENGTH, 0), rolling.of(at, at + LENGTH, 1)


def byte_ranks(buffer: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the ``length`` bytes (eight times a power of two) from each place on; equal bytes have equal ranks.

    A rank is the number of places with smaller bytes. Once ranked by 8 bytes, only places that are still
    tied are ordered again, by their rank and the rank of the place behind what was compared.
    """
    size = len(buffer)
    padded = np.concatenate([buffer, np.zeros(8, np.uint8)])
    key = np.zeros(size, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k : k + size]
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(size), 0))
    tied = order[~(fresh & np.append(fresh[1:], True))]
    width = 8
    while width < length and len(tied):
        behind = tied + width
        second = np.where(behind < size, rank[np.minimum(behind, size - 1)] + 1, 0)
        key = rank[tied] * (size + 1) + second
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        before, at = rank[tied], np.arange(len(tied))
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.concatenate([[True], before[1:] != before[:-1]])
        rank[tied] = before + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        tied = tied[~(fresh & np.append(fresh[1:], True))]
        width *= 2
    return rank


def suffix_array(raw: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrase of every 200-byte string in the phrases ``raw``, their order, and whether each equals the one before it.

    Strings are numbered phrase by phrase, start by start.
    """
    borders = np.cumsum([0, *map(len, raw)])
    counts = np.diff(borders) - LENGTH + 1
    phrase = np.repeat(np.arange(len(raw)), counts)
    at = borders[phrase] + np.arange(len(phrase)) - np.repeat(np.cumsum(counts) - counts, counts)
    half = 128
    rank = byte_ranks(np.frombuffer(b"".join(raw), np.uint8), half)
    key = rank[at] * len(rank) + rank[at + LENGTH - half]
    order = np.argsort(key, kind="stable")
    return phrase, order, key[order][1:] == key[order][:-1]


def _in_order(group: DataFrame) -> DataFrame:
    """Ranges (key, at, n) of repeated starts among the phrases of one trigger, in the task that has them all."""
    def ranges(rows: list[tuple]) -> pa.RecordBatch:
        phrase, order, same = suffix_array([r[3] for r in rows])
        repeated = np.zeros(len(order), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        follows = repeated[1:] & repeated[:-1] & (phrase[1:] == phrase[:-1])
        first = np.flatnonzero(repeated & ~np.concatenate([[False], follows]))
        last = np.flatnonzero(repeated & ~np.concatenate([follows, [False]]))
        of = phrase[first]
        begins = np.searchsorted(phrase, of)
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][1] for i in of.tolist()], pa.binary()), pa.array(np.array([r[2] for r in rows], np.int64)[of] + first - begins),
             pa.array((last - first + 1).astype(np.int32))], names=["key", "at", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size >= PIECE and row[0] != held[-1][0]:
                    yield ranges(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield ranges(held)

    sorted_ = group.select("trigger", "key", "at", "raw").repartition("trigger").sortWithinPartitions("trigger")
    return sorted_.mapInArrow(run, "key binary, at bigint, n int")


def _by_start(group: DataFrame) -> DataFrame:
    """The same for triggers with too many different phrases: their starts are shuffled one by one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                phrase, f1, f2 = _starts(part.column(2).to_pylist())
                at = np.array(part.column(1))[phrase] + np.arange(len(phrase)) - np.searchsorted(phrase, phrase)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(phrase)), pa.array(at), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64))],
                    names=["key", "at", "f1", "f2"])

    starts = group.select("key", "at", "raw").mapInArrow(run, "key binary, at bigint, f1 bigint, f2 bigint")
    equal = starts.groupBy("f1", "f2").agg(F.count("*").alias("times")).where(F.col("times") > 1)
    return starts.join(equal.select("f1", "f2"), ["f1", "f2"]).select("key", "at", F.lit(1).alias("n"))


def _removed(found: DataFrame) -> DataFrame:
    """Per text of (key, text, ranges of repeated starts): n_removed, n_spans and the digest of what is kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, listed in zip(batch.column(1), batch.column(2), strict=True):
                raw = np.frombuffer(text.as_py().encode(), np.uint8)
                change = np.zeros(len(raw) + 1, np.int64)
                for r in listed.as_py():
                    change[r["at"]] += 1
                    change[r["at"] + r["n"] + LENGTH - 1] -= 1
                gone = np.cumsum(change[:-1]) > 0
                spans = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1)
                rows.append((int(gone.sum()), len(spans), hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.string())], names=["key", "removed", "spans", "kept"])

    return found.mapInArrow(run, "key binary, removed bigint, spans bigint, kept string")


def remove_repeats(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, n_bytes, n_removed, n_spans and kept_sha256 for every row of ``df``."""
    key, rid = text_key(text).alias("key"), F.xxhash64(*keep).alias("rid")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = settle(df.select(*keep, key, rid, F.octet_length(body).cast("long").alias("n_bytes"),
                            F.sha2(body.cast("binary"), 256).alias("sha")), "repeat-rows")
    texts = df.select(key, F.col(text).alias("text"))
    again = settle(parsed(texts).groupBy("trigger").agg(F.count("*").alias("times")).where(F.col("times") > 1).select("trigger"), "repeat-triggers")
    found = settle(parsed(texts, sieve(again, "trigger")).join(again, "trigger"), "repeat-phrases")
    same = ["trigger", "phrase", "n"]
    dictionary = settle(found.groupBy(*same).agg(
        F.count("*").alias("copies"), F.min(F.struct("key", "at")).alias("place")), "repeat-dictionary")
    # Of a text that occurs twice all is repeated; its ranges would only come once for each copy.
    copied = rows.groupBy("key").agg(F.count("*").alias("rows"), F.min("rid").alias("rid"))
    single = copied.where(F.col("rows") == 1).select("key")
    whole = found.join(dictionary.where(F.col("copies") > 1).select(*same), same).select("key", "at", "n").join(single, "key")
    # Phrases that share a trigger but not all bytes.
    several = dictionary.groupBy("trigger").agg(F.count("*").alias("different")).where(F.col("different") > 1)
    partly = dictionary.join(several, "trigger").select("place.*", "trigger", "different", "n")
    touched = settle(found.groupBy("key").agg(F.lit(1).alias("_")).join(copied, "key").select("key", "rid", "rows"), "repeat-touched")
    source = settle(_texts(df, touched, text, keep), "repeat-texts")
    listed = partly.groupBy("key").agg(F.collect_list(F.struct("at", "n", "trigger", "different")).alias("phrases"))
    group = settle(_cut(source.join(listed, "key").select("key", "text", "phrases")), "repeat-groups")
    partial = _in_order(group.where(F.col("different") <= GROUP)).unionByName(_by_start(group.where(F.col("different") > GROUP)))
    ranges = whole.unionByName(partial).groupBy("key").agg(F.collect_list(F.struct("at", "n")).alias("ranges"))
    results = _removed(source.where(F.col("rows") == 1).join(ranges, "key").select("key", "text", "ranges"))
    gone = copied.where(F.col("rows") > 1).select("key", F.lit(True).alias("copied"))
    out = rows.join(results, "key", "left").join(gone, "key", "left")
    all_gone = F.coalesce("copied", F.lit(False)) & (F.col("n_bytes") >= LENGTH)
    zero = F.lit(0).cast("long")
    return out.select(
        *keep, "n_bytes", F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("removed", zero)).alias("n_removed"),
        F.when(all_gone, F.lit(1).cast("long")).otherwise(F.coalesce("spans", zero)).alias("n_spans"),
        F.when(all_gone, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"))


def _texts(df: DataFrame, touched: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """(key, text, rows) of the keys ``touched``: of equal texts one row is picked before texts move, so copies do not gather."""
    only = sieve(touched, "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(only.value, np.array(batch.column(1)))))

    source = df.select(text_key(text).alias("key"), F.xxhash64(*keep).alias("rid"), F.col(text).alias("text"))
    source = source.mapInArrow(run, "key binary, rid bigint, text string")
    return source.join(touched, ["key", "rid"]).select("key", "text", "rows").dropDuplicates(["key"])
