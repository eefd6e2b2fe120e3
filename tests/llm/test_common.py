"""The sieve against sets."""

import numpy as np

from stagecheck.llm.common import SIEVE_BITS, passes, settle, sieve


def held(spark, n, partitions):
    values = spark.range(n).selectExpr("xxhash64(id) AS value").repartition(partitions)
    return settle(values, "values")


def test_all_values_pass_and_few_others(spark):
    for n in (0, 1, 50_000):
        values = held(spark, n, 3)
        bits = sieve(values, "value").value
        own = np.array([r.value for r in values.collect()], np.int64)
        assert passes(bits, own).all()
        others = np.random.default_rng(n).integers(-(2**63), 2**63 - 1, 20_000)
        assert passes(bits, others).mean() < 0.03
    none = settle(spark.sql("SELECT CAST(null AS bigint) AS value UNION ALL SELECT 7L"), "values")
    assert passes(sieve(none, "value").value, np.array([7, -7])).tolist() == [True, False]


def test_the_bitmap_follows_the_values_up_to_its_bound(spark, monkeypatch):
    small, large = (len(sieve(held(spark, n, 2), "value").value) for n in (10, 20_000))
    assert small < large < SIEVE_BITS // 8 // 8
    monkeypatch.setattr("stagecheck.llm.common.SIEVE_BITS", 1 << 17)
    assert len(sieve(held(spark, 20_000, 2), "value").value) == 1 << 14


def test_jobs_do_not_follow_the_partitions(spark):
    """A job for each partition filled the driver of a run with 211 partitions."""
    context, keys = spark.sparkContext, ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in keys]
    values = held(spark, 5_000, 4)
    try:
        for key, value in zip(keys, ("40", "false"), strict=True):
            spark.conf.set(key, value)
        context.setJobGroup("sieve", "sieve")
        sieve(values, "value")
        assert 0 < len(context.statusTracker().getJobIdsForGroup("sieve")) <= 6
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description"):
            context.setLocalProperty(key, None)
        for key, value in zip(keys, before, strict=True):
            spark.conf.set(key, value)
