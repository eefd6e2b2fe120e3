"""Operator 11: periodic runs of words, by longest common extensions.

A run is a stretch of words with smallest period q that no neighbouring word extends. Asked for are
runs of at least ``LEAST`` words and ``TIMES`` periods.

Per stretch of text: Ukkonen builds the suffix tree of its words and that of their reversal. The
Euler tour of a tree, of which only the valleys between leaves are kept, answers in constant time,
by a table of minima over powers of two, how far two suffixes agree: the depth of the lowest
common ancestor of their leaves. Every run holds a Lyndon word, its root, that is the longest one at its
place in one of the two orders of the alphabet; so the longest Lyndon words of both orders, from each
place to the next smaller suffix, are all candidates. Each is extended to both sides by one
longest common extension of either tree.

Trees stand only over stretches that can hold a run. Behind its first q words every word of a run
has its last occurrence at most q words back, and these words are three periods or more. So a
stretch of n consecutive words can hold the rear of a run only if none of them has its last
occurrence over n / 3 words back; stretches are cut at words that do until none is left. What
remains, and n / 3 words ahead of it, holds every run whole.

A document is worked on by one task; trees take memory in proportion to its longest stretch.

Defined cases: a null or empty text has no words and no runs; ties of the best run go to the least
start, then to the least period; rows are judged one by one, so repeated rows give repeated results; an
empty table gives none; result columns whose names kept columns bear get underscores at their end.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stagecheck.llm.common import free_names, texts_of, with_text

#: Fixed value: what a word is in the contract of this operator.
WORD = r"[^\x20\x09-\x0D]+"
LEAST, TIMES = 6, 4
#: Words of several texts that are looked at together.
BLOCK = 400_000
_END = -1  # closes a string; smaller than every word in both orders


def suffix_tree(word: list[int]) -> tuple[list[int], list[int], list[dict[int, int] | None], list[int]]:
    """Ukkonen's tree of ``word``, which must end in a symbol of its own.

    For each node the ends of its incoming edge in ``word``, its children by first symbol (None
    for a leaf), and the suffix a leaf stands for. Node 0 is the root.
    """
    size = len(word)
    first, last, children, suffix, link = [0], [0], [{}], [-1], [0]
    node = edge = length = open_ = leaves = 0
    for at, symbol in enumerate(word):
        open_ += 1
        waiting = 0  # inner node that still lacks its link
        while open_:
            if not length:
                edge = at
            child = children[node].get(word[edge])
            if child is None:
                children[node][word[edge]] = len(first)
                lower = node
            else:
                span = last[child] - first[child]
                if length >= span:
                    edge, length, node = edge + span, length - span, child
                    continue
                middle = first[child] + length
                if word[middle] == symbol:
                    length += 1
                    if waiting:
                        link[waiting] = node
                    break
                lower = len(first)
                children[node][word[edge]] = lower
                first.append(first[child])
                last.append(middle)
                children.append({word[middle]: child, symbol: lower + 1})
                suffix.append(-1)
                link.append(0)
                first[child] = middle
            first.append(at)
            last.append(size)
            children.append(None)
            suffix.append(leaves)
            link.append(0)
            leaves += 1
            if waiting:
                link[waiting] = lower
            waiting = lower
            open_ -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = at - open_ + 1
    return first, last, children, suffix


def tour(tree: tuple, descending: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of the leaves, and the depth of the valley ahead of each.

    ``descending`` turns the order of the words around; the end of the string stays the smallest.
    """
    first, last, children, suffix = tree
    order, valleys = [], []
    todo = [(0, 0, 0)]
    while todo:
        node, depth, valley = todo.pop()
        below = children[node]
        if below is None:
            order.append(suffix[node])
            valleys.append(valley)
            continue
        symbols = sorted(below, reverse=not descending)  # pushed last is visited first
        if descending and symbols[0] == _END:
            symbols = symbols[1:] + symbols[:1]
        least = symbols[-1]
        for symbol in symbols:
            child = below[symbol]
            todo.append((child, depth + last[child] - first[child], valley if symbol == least else depth))
    return np.array(order), np.array(valleys, np.int32)


class Extensions:
    """How many symbols two suffixes of a string have in common, in constant time."""

    def __init__(self, order: np.ndarray, valleys: np.ndarray):
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.least = [valleys]
        width = 1
        while 2 * width <= len(valleys):
            above = self.least[-1]
            self.least.append(np.minimum(above[:-width], above[width:]))
            width *= 2

    def __call__(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """For pairs of different suffixes."""
        a, b = self.rank[one], self.rank[two]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            here = level == k
            table = self.least[k]
            out[here] = np.minimum(table[low[here]], table[high[here] - (1 << int(k))])
        return out


def _next_smaller(rank: list[int]) -> list[int]:
    """For each suffix but the last, which is the smallest, the next one that is smaller."""
    out, at = [0] * (len(rank) - 1), [len(rank) - 1]
    for i in range(len(rank) - 2, -1, -1):
        while rank[at[-1]] > rank[i]:
            at.pop()
        out[i] = at[-1]
        at.append(i)
    return out


def runs_of(word: Sequence[int], least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, end, period) of every run, one a row, in order; ``word`` holds numbers from 0 on."""
    word = list(word)
    size = len(word)
    if size < least:
        return np.empty((0, 3), np.int64)
    tree = suffix_tree([*word, _END])
    order, valleys = tour(tree)
    onward = Extensions(order, valleys)
    other = np.empty(size + 1, np.int64)
    other[tour(tree, descending=True)[0]] = np.arange(size + 1)
    starts = np.tile(np.arange(size), 2)
    ends = np.array(_next_smaller(onward.rank.tolist()) + _next_smaller(other.tolist()))
    fits = (ends - starts) * times <= size
    starts, ends = starts[fits], ends[fits]
    del tree
    backward = Extensions(*tour(suffix_tree([*reversed(word), _END])))
    period = ends - starts
    begin = starts - backward(size - starts, size - ends)
    end = ends + onward(starts, ends)
    found = (end - begin >= least) & (end - begin >= times * period)
    return np.unique(np.stack([begin, end, period], 1)[found], axis=0)


def stretches(numbers: np.ndarray, texts: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(begin, end) of the stretches that can hold the rear of a run; ``texts`` tells the text of each word."""
    order = np.lexsort((numbers, texts))
    back = np.full(len(numbers), np.iinfo(np.int64).max)
    same = (numbers[order][1:] == numbers[order][:-1]) & (texts[order][1:] == texts[order][:-1])
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    at = np.flatnonzero(back < len(numbers))
    while len(at):
        border = np.flatnonzero((np.diff(at) > 1) | (np.diff(texts[at]) > 0)) + 1
        begin, end = np.concatenate([[0], border]), np.concatenate([border, [len(at)]])
        long = np.repeat(end - begin, end - begin)
        stays = (back[at] * (times - 1) <= long) & (long * times >= least * (times - 1))
        if stays.all():
            return np.stack([at[begin], at[end - 1] + 1], 1)
        at = at[stays]
    return np.empty((0, 2), np.int64)


def runs_of_texts(numbers: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """The runs of each text; ``numbers`` are the words of all texts, one after the other."""
    begins = np.concatenate([[0], np.cumsum(sizes)])
    texts = np.repeat(np.arange(len(sizes)), sizes)
    found: list[list[np.ndarray]] = [[] for _ in sizes]
    for low, high in stretches(numbers, texts, least, times).tolist():
        text = texts[low]
        begin = max(int(begins[text]), low - (high - low) // (times - 1) - 1)
        end = min(int(begins[text + 1]), high + 1)
        runs = runs_of(np.unique(numbers[begin:end], return_inverse=True)[1].tolist(), least, times)
        runs[:, :2] += begin
        rear = runs[:, 0] + runs[:, 2]
        runs = runs[(rear >= low) & (runs[:, 1] <= high)]
        runs[:, :2] -= begins[text]
        found[text].append(runs)
    none = np.empty((0, 3), np.int64)
    return [np.unique(np.concatenate(f), axis=0) if f else none for f in found]


def best_run(runs: np.ndarray) -> list[int] | None:
    """The run with the greatest exact exponent, the first of several."""
    best = None
    for start, end, period in runs.tolist():
        if best is None or (end - start) * best[2] > (best[1] - best[0]) * period:
            best = [start, end, period]
    return best


def kept_words(words: list[str], runs: np.ndarray) -> list[str]:
    """The words that no run contains after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    return list(itertools.compress(words, np.cumsum(change[:-1]) == 0))


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _as_run(row: Sequence[int]) -> dict[str, int]:
    return {"start": row[0], "length": row[1] - row[0], "period": row[2]}


def find_runs(
    df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), least: int = LEAST, times: int = TIMES,
    word: str = WORD,
) -> DataFrame:
    """``keep``, n_words, runs, best (the run of the greatest exponent) and collapsed, for each row.

    ``runs`` are (start, length, period) by start, then period; ``collapsed`` is the text's words, joined
    by spaces, but for those that a run contains after its first period. Runs are of ``least`` words and
    ``times`` periods at least, ``times`` being two or more.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")
    own, body, kept = with_text(df, keep, text)
    names = free_names(("n_words", "runs", "best", "collapsed"), keep)
    pattern = re.compile(word)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for made in _blocks(texts_of(batch, body), pattern, least, times):
                part = batch.slice(done, len(made[0]))
                done += len(made[0])
                kinds = (pa.int64(), pa.list_(_RUN), _RUN, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], *(pa.array(m, k) for m, k in zip(made, kinds, strict=True))], names=[*keep, *names])

    shape = "struct<start: bigint, length: bigint, period: bigint>"
    return own.mapInArrow(run, (f"{kept}, " if kept else "") + f"{names[0]} bigint, {names[1]} array<{shape}>, {names[2]} {shape}, {names[3]} string")


def _blocks(texts: Iterator[str], pattern: re.Pattern, least: int, times: int) -> Iterator[tuple[list, list, list, list]]:
    """The four result columns for as many texts at a time as hold ``BLOCK`` words."""
    block, size = [], 0
    for text in texts:
        block.append(pattern.findall(text))
        size += len(block[-1])
        if size >= BLOCK:
            yield _judged(block, least, times)
            block, size = [], 0
    if block:
        yield _judged(block, least, times)


def _judged(block: list[list[str]], least: int, times: int) -> tuple[list, list, list, list]:
    words = pa.array(itertools.chain.from_iterable(block), pa.string())
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = runs_of_texts(numbers, np.array([len(b) for b in block]), least, times)
    best = [best_run(r) for r in runs]
    return (
        [len(b) for b in block],
        [[_as_run(r) for r in found.tolist()] for found in runs],
        [None if b is None else _as_run(b) for b in best],
        [" ".join(kept_words(b, r)) for b, r in zip(block, runs, strict=True)],
    )


def with_planted_periods(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Make the rear of the texts periodic whose hashed key ends in 0, by the rule of the contract.

    With h the CRC-32 of the key in decimals and g = floor(h / 10), in a text of n words those from
    a = g mod n on repeat the p = 1 + floor((n - a) / (3 + g mod 8)) words there. Rows without key stay.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), F.lit(1))
    g, n = F.floor(h / 10), F.size("_words")
    start = F.col("_g") % n
    period = 1 + F.floor((n - start) / (3 + F.col("_g") % 8))

    def planted(word: Column, i: Column) -> Column:
        moved = F.col("_a") + (i - F.col("_a")) % F.col("_p")
        return F.when(i >= F.col("_a"), F.get("_words", moved.cast("int"))).otherwise(word)

    chosen = df.withColumn("_g", g).withColumn("_words", F.when(h % 10 == 0, words))
    placed = chosen.withColumn("_a", F.when(n > 0, start)).withColumn("_p", F.when(n > 0, period))
    periodic = F.array_join(F.transform("_words", planted), " ")
    return placed.withColumn(text, F.when(n > 0, periodic).otherwise(F.col(text))).select(*df.columns)
