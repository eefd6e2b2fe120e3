"""Operator 5: language of a text by averaged hashed subword embeddings.

A text is the mean of the embeddings of its words' hashed character n-grams; a linear softmax on
that mean gives the language. Both are learned together by stochastic gradient descent in numpy
from a bounded sample of labelled rows (``PER_LANGUAGE``). A part of the sample that the descent
does not see sets the temperature of the softmax and, by its rightly predicted rows, what is rejected: a
text with a lower score than nearly all of these, or one of whose n-grams fewer are usual in the predicted language.
The softmax only compares languages; the share of usual n-grams tells whether it is any of them.

Rows of the sample are chosen by a hash of doc_id, as a share of each language that one narrow
aggregation fixes. Their features go to the driver, ``SAMPLE_BYTES`` at most: a sample that would take more is
drawn thinner, by the sizes measured. Of more than ``MOST_LABELS`` languages the most frequent are learned. So the
model, a table of ``BUCKETS`` by twice the languages, is 64 MB at most where it is broadcast. Prediction moves no rows.

Defined cases: a null text or one without a letter is ``und`` with score 0 and rejected; one in none of
the languages keeps the nearest one's name, has score 0 and is rejected; rows
with a null language are predicted but not learned from; without labelled rows everything is ``und``;
a null doc_id counts as the empty text; repeated rows are predicted alike; languages of equal score
go by name; other columns are passed by.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stagecheck.llm.common import first_columns, free_names, mix, settle, texts_of, with_text

UNKNOWN = "und"
#: Labelled rows that are learned from, for each language, on average; the sample is at most four times that.
PER_LANGUAGE = 600
#: Bytes of features that the driver receives, and languages that a model holds.
SAMPLE_BYTES = 256 << 20
MOST_LABELS = 256
BUCKETS = 1 << 15
SIZES = (2, 3, 4)  # characters of an n-gram, word borders included
WIDTH = 16
EPOCHS, RATE = 4, 0.3
#: Share of the rightly predicted calibration rows below which the limits lie; few wrong labels do not move them.
REJECT = 0.005
#: An n-gram is usual in a language if this share of its rows hold it.
USUAL = 0.01
#: A text is never rejected above this score.
MOST_REJECTED = 0.5
REMEMBERED = 200_000  # words a task keeps
TOGETHER = 1_000_000  # characters whose new words are looked up together
_BASE = np.uint64(0x9E3779B97F4A7C15)
LETTERS = re.compile(r"[^\W\d_]+")


def grams(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of every ``<word>`` and of the words themselves, each with the place of its word."""
    marked = [f"<{w}>" for w in words]
    points = mix(np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.uint64))
    sizes = np.array([len(m) for m in marked])
    word = np.repeat(np.arange(len(words)), sizes)
    first = np.cumsum(sizes) - sizes
    powers = np.full(int(sizes.max(initial=1)) + 1, _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    hashes = [np.add.reduceat(points * powers[np.arange(len(points)) - first[word]], first)]
    owners = [np.arange(len(words))]
    for n in SIZES:
        last = len(points) - n + 1
        if last > 0:
            whole = np.flatnonzero(word[:last] == word[n - 1 :])
            hashes.append(sum(points[whole + k] * powers[k] for k in range(n)) + np.uint64(n))
            owners.append(word[whole])
    return (mix(np.concatenate(hashes)) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owners)


def words_of(text: str) -> Counter:
    """Words with their counts; none if the text has no letter."""
    words = Counter(LETTERS.findall(text.lower()))
    return words if any(any(map(str.isalpha, w)) for w in words) else Counter()


@dataclass
class LanguageModel:
    labels: list[str]
    weights: np.ndarray  # BUCKETS x labels: embeddings times the softmax's matrix
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    usual: np.ndarray | None = None  # BUCKETS x labels: whether the language's rows hold it
    least_usual: float = 0.0  # share of usual n-grams below which a text is in none of the languages, and its score 0

    def scores(self, sums: np.ndarray, count: float) -> np.ndarray:
        """Calibrated probabilities from summed n-gram weights."""
        z = (sums / count + self.bias) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()


def _features(text: str) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(text)
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    found, owner = grams(list(words))
    counts = np.bincount(found, np.fromiter(words.values(), np.float64, len(words))[owner], BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets.astype(np.int32), counts[buckets].astype(np.float32)


def train(rows: Sequence[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> LanguageModel:
    """Learn from (label, buckets, counts) rows; every fifth row is kept for calibration."""
    labels = sorted({r[0] for r in rows})
    number = {label: i for i, label in enumerate(labels)}
    random = np.random.default_rng(seed)
    table = random.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    out = np.zeros((WIDTH, len(labels)), np.float32)
    bias = np.zeros(len(labels), np.float32)
    order = random.permutation(len(rows))
    held, fit = order[::5], np.delete(order, np.s_[::5])
    fit = fit if len(fit) else order
    steps = EPOCHS * len(fit)
    for step in range(steps):
        if step % len(fit) == 0:
            random.shuffle(fit)
        label, buckets, counts = rows[fit[step % len(fit)]]
        share = counts / counts.sum()
        rate = RATE * (1 - step / steps)
        mean = share @ table[buckets]
        z = mean @ out + bias
        error = np.exp(z - z.max())
        error /= error.sum()
        error[number[label]] -= 1
        back = out @ error
        out -= rate * np.outer(mean, error)
        bias -= rate * 0.1 * error
        table[buckets] -= rate * back
    model = LanguageModel(labels, table @ out, bias)
    z = np.array([(rows[i][2] / rows[i][2].sum()) @ model.weights[rows[i][1]] + bias for i in held])
    truth = np.array([number[rows[i][0]] for i in held])

    model.usual = np.zeros((BUCKETS, len(labels)), np.float32)
    for i in fit:
        model.usual[rows[i][1], number[rows[i][0]]] += 1
    model.usual = model.usual > USUAL * np.bincount([number[rows[i][0]] for i in fit], minlength=len(labels))

    def right(temperature: float) -> np.ndarray:
        p = z / temperature
        p = np.exp(p - p.max(1, keepdims=True))
        return (p / p.sum(1, keepdims=True))[np.arange(len(truth)), truth]

    grid = np.geomspace(0.05, 20, 60)
    model.temperature = float(grid[np.argmin([-np.log(right(t) + 1e-12).mean() for t in grid])])
    hits = np.flatnonzero(z.argmax(1) == truth)
    if len(hits):
        model.threshold = float(min(MOST_REJECTED, np.quantile(right(model.temperature)[hits], REJECT)))
        shares = [(rows[i][2] @ model.usual[rows[i][1], number[rows[i][0]]]) / rows[i][2].sum() for i in held[hits]]
        low, middle = np.quantile(shares, (REJECT, 0.5))
        model.least_usual = float(max(0.0, low - (middle - low)))  # as far again, for clean texts unlike those of the sample
    return model


def learn_languages(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
                    per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Learn from rows of ``df`` with a language and a letter; None if there are none."""
    labelled = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    most = labelled.groupBy(lang).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), lang).limit(MOST_LABELS)
    counts = {r[0]: r[1] for r in most.collect()}
    if not counts:
        return None
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))]), F.col(lang))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(11), F.col(key)), 11) / float(1 << 53)
    sample = labelled.withColumn("_place", place / share).where(F.col("_place") < 1).select(
        F.col(lang).alias("label"), "_place", F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_features(t) for t in texts_of(batch, "_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([b.tobytes() for b, _ in made]), pa.array([c.tobytes() for _, c in made])],
                names=["label", "place", "buckets", "counts"])

    found = settle(sample.mapInArrow(run, "label string, place double, buckets binary, counts binary"), "language-sample")
    found = found.where(F.octet_length("buckets") > 0)
    size = found.agg(F.sum(F.octet_length("buckets") + F.octet_length("counts"))).first()[0] or 0
    thin = min(1.0, SAMPLE_BYTES / max(1, size))
    rows = found.where(F.col("place") < thin).limit(4 * per_language * len(counts)).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.label, bytes(r.buckets), bytes(r.counts)))
    return train([(r.label, np.frombuffer(r.buckets, np.int32), np.frombuffer(r.counts, np.float32)) for r in rows])


class Predictor:
    """Predicts texts; remembers the summed weights of words."""

    def __init__(self, model: LanguageModel):
        self.model, self.rows, self.sums = model, {}, np.zeros((0, 2 * len(model.labels) + 1))
        self.columns = np.concatenate([model.weights, model.usual], 1)

    def _learn(self, words: set[str]) -> None:
        """Sum the weights of the words not met before, all at once."""
        new = [w for w in words if w not in self.rows]
        if len(self.rows) + len(new) > REMEMBERED:
            self.rows.clear()
            self.sums = self.sums[:0]
            new = list(words)
        if new:
            buckets, owner = grams(new)
            made = [np.bincount(owner, column, len(new)) for column in self.columns[buckets].T]
            self.sums = np.concatenate([self.sums, np.stack([*made, np.bincount(owner, minlength=len(new))], 1)])
            self.rows.update(zip(new, range(len(self.rows), len(self.sums)), strict=True))

    def predict_all(self, texts: Iterator[str]) -> Iterator[tuple[str, float]]:
        """Language and score of each text; new words are learned for some texts at a time."""
        held, size = [], 0
        for text in itertools.chain(texts, [None]):
            if text is not None:
                held.append(words_of(text))
                size += len(text)
            if held and (text is None or size >= TOGETHER):
                self._learn(set().union(*held))
                yield from map(self._judged, held)
                held, size = [], 0

    def predict(self, text: str) -> tuple[str, float]:
        return next(self.predict_all(iter([text])))

    def _judged(self, words: Counter) -> tuple[str, float]:
        if not words:
            return UNKNOWN, 0.0
        rows = list(map(self.rows.__getitem__, words))
        total = np.fromiter(words.values(), np.float64, len(words)) @ self.sums[rows]
        n = len(self.model.labels)
        p = self.model.scores(total[:n], total[-1])
        best = int(p.argmax())
        if total[n + best] < self.model.least_usual * total[-1]:
            return self.model.labels[best], 0.0
        return self.model.labels[best], float(p[best])


def predict_languages(df: DataFrame, model: LanguageModel | None, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, lang_pred, score and rejected for every row; ``df``'s text only is looked at.

    Result columns whose names kept columns bear get underscores at their end.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    own, body, kept = with_text(df, keep, text)
    names = free_names(("lang_pred", "score", "rejected"), keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        predictor = Predictor(model) if model else None
        for batch in batches:
            texts = texts_of(batch, body)
            made = list(predictor.predict_all(texts)) if predictor else [(UNKNOWN, 0.0) for _ in texts]
            rejected = [label == UNKNOWN or score < model.threshold for label, score in made]
            yield pa.RecordBatch.from_arrays(
                [*first_columns(batch, keep), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64()),
                 pa.array(rejected, pa.bool_())],
                names=[*keep, *names])

    return own.mapInArrow(run, f"{kept}, {names[0]} string, {names[1]} double, {names[2]} boolean")


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is of the fourth that is never learned from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2
