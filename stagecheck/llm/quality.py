"""Operator 3: quality rules and robust multivariate outliers.

Base rules count words, symbols, repeated lines and repeated three-word windows inside each text.
Texts that pass them are described by four statistics; per language and source a minimum
covariance determinant estimate is made of these (concentration steps from two deterministic
starts, medians with quartile scales and plain moments, each until its determinant no longer falls; the
smaller one stands), and texts far off by Mahalanobis distance are rejected.

Only DataFrame operations. One pass over the texts; after it only a few numbers a row move, and
every aggregate combines before its shuffle, so one source may hold any share of the rows. Estimates, a row
for each group, are sent to the tasks if they are few, so that rows do not move to meet them. Quantiles
come from counts of fixed-width bins, which keeps them exact to a bin, mergeable and repeatable.

Defined cases: a null or empty text has no words and fails the base rules; null language or source
count as empty ones; groups of fewer than ``MIN_GROUP`` texts are pooled by language, and those of a
language whose pool is still smaller are judged by an estimate from all texts; constant statistics are held apart by a floor on
each scale; repeated rows are judged alike; an empty table gives no rows; other columns are passed by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stagecheck.llm.common import settle

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
STATISTICS = ("word_length", "symbol_rate", "dup_line_share", "repeat_share")
#: Shares r are described by log(1 + r / unit): a small share counts nearly as it is, a large one by its order.
UNITS = {"symbol_rate": 0.005, "dup_line_share": 0.05, "repeat_share": 0.05}
#: Least scale of each statistic; most texts have no symbols and no repeats at all. Where that is so, one
#: statistic alone rejects from these shares on: 2 % symbols, 38 % repeated lines, 38 % repeated words. A mean of
#: fifty words' lengths varies by 0.3 by itself.
FLOORS = (0.2, 0.37, 0.5, 0.5)
#: Bin widths of the quartiles.
BINS = (0.05, 0.05, 0.05, 0.05)
SHARE = 0.75  # of a group that the estimate rests on
#: A concentration step that lowers no log determinant by this much is the last.
STILL = 1e-6
MIN_GROUP = 50
#: Rows of estimates that are sent to the tasks, about 300 bytes each.
SENT = 100_000
#: Chi-square, four degrees of freedom, tail 0.001.
CUTOFF = 18.47
_MEDIAN = 3.357  # of chi-square with four degrees of freedom
_P = range(len(STATISTICS))
_PAIRS = [(i, j) for i in _P for j in range(i + 1)]
_GROUP = ["_lang", "_source"]


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def base_statistics(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the counts of the base rules, row by row."""
    t = F.col("_text")
    rows = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("_words", F.array_remove(F.split(t, f"{SPACE}+"), ""))
    rows = rows.withColumn("_lines", F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.select(
        *keep, "_words",
        F.size("_words").cast("long").alias("n_words"),
        (F.length(t) - F.octet_length(t) + F.octet_length(_without(t, " \t\n\x0b\f\r"))).cast("long").alias("word_chars"),
        (F.octet_length(t) - F.octet_length(_without(t, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"))
    # Each window as one number: its hash above, its place in the low bits. Sorted, equal windows stand together.
    rows = rows.withColumn("_bits", F.ceil(F.log2(F.greatest(F.size("_words"), F.lit(2)))).cast("int"))
    rows = rows.withColumn("_windows", F.expr(
        "CASE WHEN size(_words) < 3 THEN CAST(array() AS array<bigint>) ELSE sort_array(transform(sequence(0, size(_words) - 3), "
        "i -> shiftleft(xxhash64(_words[i], _words[i + 1], _words[i + 2]), _bits) | CAST(i AS bigint))) END"))
    rows = rows.withColumn("_at", F.expr(
        "sort_array(transform(filter(_windows, (x, k) -> shiftright(x, _bits) <=> shiftright(get(_windows, k - 1), _bits) "
        "OR shiftright(x, _bits) <=> shiftright(get(_windows, k + 1), _bits)), "
        "x -> x & (shiftleft(CAST(1 AS bigint), _bits) - 1)))"))
    return rows.withColumn("n_repeat_words", F.expr(
        "aggregate(_at, named_struct('last', CAST(-3 AS bigint), 'sum', CAST(0 AS bigint)), "
        "(a, x) -> named_struct('last', x, 'sum', a.sum + least(CAST(3 AS bigint), x - a.last)), a -> a.sum)")
    ).drop("_words", "_bits", "_windows", "_at")


def _quantile(counts: DataFrame, by: Sequence[str], share: float, name: str) -> DataFrame:
    """The bin in which the running count reaches ``share`` of the whole, for each ``by``."""
    whole = Window.partitionBy(*by)
    running = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.sum("n").over(running) >= share * F.sum("n").over(whole)
    return counts.withColumn("_reached", reached).where("_reached").groupBy(*by).agg(F.min("bin").alias(name))


def _x(i: int) -> Column:
    return F.col(STATISTICS[i])


def _moments(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Means and covariances, the floors of the scales added to the diagonal."""
    made = rows.groupBy(*by).agg(
        F.count("*").alias("n"), *[F.avg(_x(i)).alias(f"m{i}") for i in _P],
        *[F.covar_pop(STATISTICS[i], STATISTICS[j]).alias(f"c{i}{j}") for i, j in _PAIRS])
    return _factored(made.withColumns({f"c{i}{i}": F.col(f"c{i}{i}") + FLOORS[i] ** 2 for i in _P}))


def _factored(stats: DataFrame) -> DataFrame:
    """Cholesky factor l and log determinant of the covariances c."""
    for i, j in _PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        stats = stats.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    logdet = sum((F.log(f"l{i}{i}") for i in _P[1:]), F.log("l00"))
    return stats.withColumn("logdet", logdet).drop(*[f"c{i}{j}" for i, j in _PAIRS])


def _distances(rows: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """``rows`` with ``d2``, the squared Mahalanobis distance, and its bin; null where a group has no estimate."""
    found = rows.join(_sent(stats), list(by), "left")
    for i in _P:
        z = _x(i) - F.col(f"m{i}")
        for k in range(i):
            z = z - F.col(f"l{i}{k}") * F.col(f"z{k}")
        found = found.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in _P[1:]), F.col("z0") * F.col("z0"))
    return found.withColumn("d2", d2).withColumn("bin", F.floor(16 * F.log2(1 + F.col("d2")))).drop(*[f"z{i}" for i in _P])


def _sent(stats: DataFrame) -> DataFrame:
    return F.broadcast(stats) if stats.count() <= SENT else stats


def _edge(bin_: str) -> Column:
    return F.pow(F.lit(2.0), (F.col(bin_) + 1) / 16) - 1


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Minimum covariance determinant estimate of each group of ``rows``; needs columns _lang, _source and the statistics."""
    by = [*_GROUP, "start"]
    bins = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(_x(i) / BINS[i]).alias("bin")) for i in _P]))
    counts = rows.select(*_GROUP, bins.alias("b")).groupBy(*_GROUP, "b.i", "b.bin").agg(F.count("*").alias("n"))
    counts = settle(counts, "quality-bins")
    quartiles = None
    for name, share in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75)):
        q = _quantile(counts, [*_GROUP, "i"], share, name)
        quartiles = q if quartiles is None else quartiles.join(q, [*_GROUP, "i"])
    of = lambda i, c: F.max(F.when(F.col("i") == i, F.col(c)))
    middle = quartiles.groupBy(*_GROUP).agg(
        *[((of(i, "q2") + 0.5) * BINS[i]).alias(f"m{i}") for i in _P],
        *[(F.pow((of(i, "q3") - of(i, "q1")) * BINS[i] / 1.349, 2) + FLOORS[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _PAIRS])
    medians = _factored(middle).withColumn("start", F.lit("medians")).withColumn("n", F.lit(0).cast("long"))
    plain = _moments(rows, _GROUP).withColumn("start", F.lit("moments"))
    stats = settle(plain.unionByName(medians), "quality-starts")
    twice = rows.withColumn("start", F.explode(F.array(F.lit("medians"), F.lit("moments"))))
    stats, moving = stats.drop("n"), stats.drop("n")
    first = True
    while first or not moving.isEmpty():
        far = _distances(twice, moving, by).where(F.col("d2").isNotNull())
        half = settle(_quantile(far.groupBy(*by, "bin").agg(F.count("*").alias("n")), by, SHARE, "limit"), "quality-limits")
        near = far.select(*by, *STATISTICS, "bin").join(_sent(half), by).where(F.col("bin") <= F.col("limit"))
        made = settle(_moments(near, by).drop("n"), "quality-step")
        before = stats.select(*by, F.col("logdet").alias("_before"))
        # The starts themselves are no concentrated estimates: the first step always takes their place.
        lower = made.join(_sent(before), by).where(F.lit(first) | (F.col("logdet") < F.col("_before") - STILL)).drop("_before")
        moving = settle(lower, "quality-moving")
        stats = settle(stats.join(_sent(moving.select(*by)), by, "left_anti").unionByName(moving), "quality-stats")
        first = False
    best = stats.groupBy(*_GROUP).agg(F.min(F.struct("logdet", "start", *[c for c in stats.columns if c[0] in "ml" and c != "logdet"])).alias("s"))
    return best.select(*_GROUP, *[F.col(f"s.{c}").alias(c) for c in stats.columns if c[0] in "ml" and c != "logdet"])


def judge_quality(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", key: str = "doc_id",
                  cutoff: float = CUTOFF) -> DataFrame:
    """``key``, the base counts, base_failed, distance (null where the base rules fail) and kept for every row."""
    named = df.select(F.col(key).alias("_key"), F.col(text).alias("_body"),
                      F.coalesce(lang, F.lit("")).alias("_lang"), F.coalesce(source, F.lit("")).alias("_source"))
    rows = base_statistics(named, "_body", ("_key", "_lang", "_source"))
    words = F.greatest("n_words", F.lit(1))
    share = lambda name, part, whole: F.log1p(F.col(part) / F.greatest(whole, F.lit(1)) / UNITS[name])
    rows = settle(rows.withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "word_length": F.col("word_chars") / words,
        "symbol_rate": share("symbol_rate", "n_symbols", "word_chars"),
        "dup_line_share": share("dup_line_share", "n_dup_lines", "n_lines"),
        "repeat_share": share("repeat_share", "n_repeat_words", "n_words"),
    }), "quality-rows")
    passed = rows.where(~F.col("base_failed"))
    sizes = settle(passed.groupBy(*_GROUP).agg(F.count("*").alias("size")), "quality-sizes")
    small = sizes.where(F.col("size") < MIN_GROUP).groupBy("_lang").agg(F.sum("size").alias("pooled"))
    pool = F.when(F.col("size") >= MIN_GROUP, F.concat(F.lit("="), "_source")).when(F.col("pooled") >= MIN_GROUP, "small").otherwise("all")
    pools = sizes.join(small, "_lang", "left").withColumn("pool", pool)
    pools = settle(pools.select(*_GROUP, "pool", F.when(F.col("pool") != "all", F.col("_lang")).otherwise("*").alias("pool_lang")), "quality-pools")
    own = pools.where(F.col("pool") != "all")
    pooled = passed.join(_sent(own), _GROUP).withColumns({"_lang": F.col("pool_lang"), "_source": F.col("pool")}).drop("pool", "pool_lang")
    if own.count() < pools.count():
        pooled = pooled.unionByName(passed.withColumns({"_lang": F.lit("*"), "_source": F.lit("all")}))
    stats = robust_estimates(pooled)
    far = _distances(pooled.select("_lang", "_source", *STATISTICS), stats, _GROUP)
    half = _quantile(far.groupBy(*_GROUP, "bin").agg(F.count("*").alias("n")), _GROUP, 0.5, "half")
    # A consistency factor brings the median distance to that of normal vectors, but never shrinks the estimate.
    scaled = stats.join(half, _GROUP).withColumn("scale", F.greatest(F.lit(1.0), _edge("half") / _MEDIAN)).drop("half")
    scaled = scaled.withColumnsRenamed({"_lang": "pool_lang", "_source": "pool"}).join(pools, ["pool_lang", "pool"])
    scaled = settle(scaled.drop("pool_lang", "pool"), "quality-estimates")
    judged = _distances(rows, scaled, _GROUP)
    distance = F.when(~F.col("base_failed"), F.col("d2") / F.col("scale"))
    return judged.select(
        F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        distance.alias("distance"),
        (~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))).alias("kept"))
