"""The as-of join against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quantloom.operators.asof import asof

LEFT, RIGHT = "k string, g int, t timestamp, id int", "k string, g int, t timestamp, v double, w string, extra int"


def _time(rng):
    return dt.datetime(2020, 1, 1) + dt.timedelta(hours=12 * rng.randrange(500))


def _sides(seed):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot"] * 5 + ["a", "b", "only_left", None])
    left = [(key(), rng.choice([1, 2]), None if i % 37 == 0 else _time(rng), i // 2) for i in range(600)]
    right = [(key(), rng.choice([1, 2]), None if i % 41 == 0 else _time(rng), rng.choice([None, 1.0, 2.0, 3.0]), rng.choice("xyz"), i) for i in range(400)]
    left += left[:20]
    return left, [r for r in right + right[:20] if r[0] != "only_left"]


def _brute(left, right, strict):
    low = lambda v: (v is not None, v)
    for k, g, t, i in left:
        own = [] if None in (k, g, t) else [r for r in right if r[2] is not None and r[:2] == (k, g) and (r[2] < t if strict else r[2] <= t)]
        best = max(own, key=lambda r: (r[2], low(r[3]), r[4]), default=None)
        yield (k, g, t, i, *((best[2], best[3], best[4]) if best else (None, None, None)))


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("bucket", ["month", "day", "all"])
def test_equals_brute_force(spark, strict, bucket):
    """Ties within and between the sides, gaps of whole buckets, null keys, times and values, repeated rows, a hot key."""
    left, right = _sides(len(bucket))
    how = {"month": {}, "day": {"bucket": lambda t: F.unix_date(t.cast("date"))}, "all": {"bucket": lambda t: F.lit(0)}}[bucket]
    got = asof(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k", "g"], "t", ["v", "w"], matched="at", strict=strict, **how)
    assert got.columns == ["k", "g", "t", "id", "at", "v", "w"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(_brute(left, right, strict), key=repr)


def test_empty_sides_and_clashing_names(spark):
    left, right = _sides(1)
    full, other = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    assert asof(full.limit(0), other, ["k", "g"], "t", ["v"]).count() == 0
    alone = asof(full, other.limit(0), ["k", "g"], "t", ["v"])
    assert alone.count() == len(left) and alone.filter("v is not null").count() == 0
    with pytest.raises(ValueError):
        asof(full.withColumn("v", F.lit(1)), other, ["k", "g"], "t", ["v"])


def test_a_hot_key_is_dealt_by_its_buckets_and_rows_are_shuffled_once(spark):
    left, right = (spark.range(1000).select(F.lit("hot").alias("k"), F.expr("date_add(date'2000-01-01', cast(id as int))").alias("t"), F.col("id").alias(n)) for n in ("id", "v"))
    was = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = asof(left, right, ["k"], "t", ["v"])._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # rows by key and bucket; the summary, combined first, by key and bucket, by key for its window, and back
    assert sum("_bucket" in line.split("],")[0].split(", 8)")[0] for line in shuffles) == 3 and len(shuffles) == 4, plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
