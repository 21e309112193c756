"""Exact quantiles against numpy, in one aggregation and narrowed down."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.functions.quantiles import medians, quantiles

AT = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]


def expected(groups):
    return {k: (len(v), [float(np.quantile(v, p)) for p in AT]) for k, v in groups.items() if len(v)}


def close(got, want):
    assert got.keys() == want.keys()
    for k, (n, q) in want.items():
        assert got[k][0] == n and np.allclose(got[k][1], q, rtol=1e-14, atol=0), k


@pytest.mark.parametrize(("limit", "buckets"), [(1 << 16, 1024), (100, 256)])
def test_against_numpy(spark, limit, buckets):
    """Heavy tails, ties, equal values, two-row groups, a null key, huge and tiny values; nulls, NaN and infinite ones left out."""
    rnd = np.random.default_rng(3)
    groups = {
        "normal": rnd.standard_normal(2000), "tail": np.exp(3 * rnd.standard_normal(1500)), "ties": rnd.integers(0, 3, 3000).astype(float), "same": np.full(900, 0.1), "two": np.array([3.0, -1.0]), "one": np.array([7.5]),
        None: rnd.standard_cauchy(700), "ends": np.array([-1.7e308, 1.7e308] * 60 + [0.0, -0.0, 5e-324]), "powers": 2.0 ** -np.arange(40),
    }
    rows = [(k, float(v), 1) for k, vs in groups.items() for v in vs] + [("normal", None, 1), ("normal", math.nan, 1), ("tail", math.inf, 1), ("none", None, 1), ("none", -math.inf, 1)]
    df = spark.createDataFrame(rows, "k string, v double, n int").repartition(4)
    got = {r["k"]: (r["n"], r["q"]) for r in quantiles(df, ["k"], "v", AT, limit, buckets).collect()}
    want = expected(groups)
    want["ends"] = (123, [-1.7e308, -1.7e308, -1.7e308, 0.0, 1.7e308, 1.7e308])
    close(got, want)


def test_one_large_group(spark):
    """Ten million rows of one group, half of them one value: no task holds them, and the plan joins the ranges as a broadcast."""
    n = 10_000_000
    df = spark.range(n).select(F.lit("a").alias("k"), F.when(F.col("id") % 2 == 0, F.lit(0.25)).otherwise((F.col("id") * 7919 % n) / n).alias("v"))
    row = quantiles(df, ["k"], "v", [0.1, 0.5, 0.9], limit=1000).first()
    v = np.where(np.arange(n) % 2 == 0, 0.25, (np.arange(n) * 7919 % n) / n)
    assert row["n"] == n and np.allclose(row["q"], np.quantile(v, [0.1, 0.5, 0.9]), rtol=1e-14)


def test_every_rank_by_itself(spark):
    """A limit of one row: ranges narrow down to single values."""
    v = np.random.default_rng(1).standard_normal(200)
    row = quantiles(spark.createDataFrame([("a", float(x)) for x in v], "k string, v double"), ["k"], "v", AT, limit=1).first()
    assert row["n"] == 200 and np.allclose(row["q"], np.quantile(v, AT), rtol=1e-14)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert quantiles(empty, ["k"], "v", [0.5]).collect() == []
    assert medians(empty, ["k"], ["v"]).collect() == []


def test_medians_of_several_columns(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 2.0, 5.0), ("a", 4.0, 6.0), (None, None, 8.0)], "k string, x double, y double")
    for limit in (100, 1):
        assert {(r["k"], r["x"], r["y"]) for r in medians(df, ["k"], ["x", "y"], limit).collect()} == {("a", 2.0, 5.5), (None, None, 8.0)}
