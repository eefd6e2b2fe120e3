"""Operator 4: URL rules by a sort-merge range join.

A host is written with its labels reversed (``en.example.net`` as ``net.example.en.``), so that a
domain with all its subdomains is one interval of keys, and a path prefix is one too. Rule
intervals are therefore nested or apart. ``sweep`` sorts interval ends and points together and keeps
the stack of open intervals as running counts: the depth at a point is starts minus ends so far,
and the interval open at each level is the latest start of that level.

The line of keys is cut into ranges (slots) that tasks sort on their own; an interval that
reaches into later slots has its start repeated there, so no slot needs another's state. Points
are distinct hosts and paths, which leaves no hot key. Only DataFrame operations are used.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule; no
rules, or no pages, give no fits; repeated pages are judged alike; of rules that are written alike
``block`` stands; of fitting rules of one length the one with the longer host wins; other columns
are passed by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stagecheck.llm.common import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START, POINT, END = 0, 1, 2


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each ended by a dot, as bytes."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")).cast("binary")


def sweep(points: DataFrame, intervals: DataFrame) -> DataFrame:
    """The stack of prefixes open at each point.

    ``points`` and ``intervals`` hold distinct binary ``key`` values; an interval covers all keys
    that begin with its own. Returns (key, level, prefix): one row for each open prefix, the
    outermost at level 1.
    """
    kind = lambda n: F.lit(n).alias("kind")
    starts = intervals.select("key", kind(START), F.col("key").alias("prefix"))
    # 0xFF occurs in no UTF-8 text, so this key follows all that begin with the prefix.
    ends = intervals.select(F.concat("key", F.lit(b"\xff")).alias("key"), kind(END), F.col("key").alias("prefix"))
    marks = points.select("key", kind(POINT), F.lit(None).cast("binary").alias("prefix"))
    # Range bounds come from a sample: written once, a slot stays what it is.
    events = settle(
        starts.unionByName(ends).unionByName(marks).repartitionByRange("key", "kind").withColumn("slot", F.spark_partition_id()),
        "url-events")
    first = events.where(F.col("kind") == START).select("prefix", F.col("slot").alias("from"))
    last = events.where(F.col("kind") == END).select("prefix", F.col("slot").alias("to"))
    opened = first.join(last, "prefix").select(
        F.explode(F.sequence("from", "to")).alias("slot"), F.col("prefix").alias("key"), kind(START), "prefix")
    line = events.where(F.col("kind") != START).select("slot", "key", "kind", "prefix").unionByName(opened)
    running = Window.partitionBy("slot").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    change = F.when(F.col("kind") == START, 1).when(F.col("kind") == END, -1).otherwise(0)
    deep = line.withColumn("depth", F.sum(change).over(running)).where(F.col("kind") != END)
    # A point looks at every level that is open; a start stands at its own.
    levels = F.when(F.col("kind") == START, F.array("depth")).otherwise(
        F.when(F.col("depth") > 0, F.sequence(F.lit(1).cast("long"), "depth")))
    at_level = Window.partitionBy("slot", "level").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    return (
        deep.withColumn("level", F.explode(levels))
        .withColumn("open", F.last("prefix", ignorenulls=True).over(at_level))
        .where(F.col("kind") == POINT)
        .select("key", F.col("level").cast("int").alias("level"), F.col("open").alias("prefix"))
    )


def apply_rules(pages: DataFrame, rules: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",),
                otherwise: str = "allow") -> DataFrame:
    """``keep``, host, path, the rule that fits each page best, and its verdict.

    ``rules`` holds host, path (a prefix) and verdict. A rule fits its host and all subdomains where
    the page's path begins with the rule's; the longest rule wins; ``otherwise`` is the verdict
    where none fits.
    """
    found = pages.select(*keep, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    known = rules.groupBy(F.col("host").alias("rule_host"), F.col("path").alias("rule_path")).agg(F.max("verdict").alias("verdict"))
    known = known.withColumn("rule_key", host_key(F.col("rule_host")))
    places = found.groupBy("host", "path").agg(F.lit(1).alias("_"))
    hosts = places.groupBy("host").agg(F.lit(1).alias("_")).select("host", host_key(F.col("host")).alias("key"))
    over_host = sweep(hosts.select("key"), known.select(F.col("rule_key").alias("key")).distinct())
    pairs = settle(
        places.join(hosts, "host").join(over_host.drop("level"), "key")
        .select("host", "path", F.concat("prefix", F.lit(b"\0"), F.col("path").cast("binary")).alias("key")),
        "url-points")
    prefixes = known.select(F.concat("rule_key", F.lit(b"\0"), F.col("rule_path").cast("binary")).alias("prefix"),
                            "rule_host", "rule_path", "verdict")
    over_path = sweep(pairs.select("key").distinct(), prefixes.select(F.col("prefix").alias("key")))
    inner = over_path.groupBy("key").agg(F.max_by("prefix", "level").alias("prefix"))
    rule = F.concat("rule_host", "rule_path")
    best = (
        pairs.join(inner, "key").join(prefixes, "prefix")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length(rule).alias("size"), F.length("rule_host").alias("host_size"),
                            rule.alias("rule"), "verdict")).alias("best"))
    )
    return found.join(best, ["host", "path"], "left").select(
        *keep, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))
