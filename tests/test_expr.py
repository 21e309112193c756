import duckdb
import numpy as np
import pandas as pd
import pytest

from quantloom.functions.expr import ewm, ewms, fixed, full, rounded
from pyspark.sql import functions as F


def series(spark, values, ticker="A"):
    days = pd.date_range("2024-01-01", periods=len(values)).date
    rows = [(ticker, d, None if v is None or np.isnan(v) else float(v)) for d, v in zip(days, values)]
    return spark.createDataFrame(rows, "ticker string, date date, close double")


def column(df, name):
    return np.array([np.nan if r[0] is None else r[0] for r in df.orderBy("date").select(name).collect()])


@pytest.mark.parametrize("alpha", [2 / 13, 0.2, 1 / 14])
def test_ewm_equals_pandas_over_blocks_and_gaps(spark, alpha):
    rng = np.random.default_rng(3)
    x = 100 + rng.normal(size=1500).cumsum()
    x[rng.random(1500) < 0.1] = np.nan
    x[:3] = np.nan
    got = column(ewm(series(spark, x), "close", alpha, "y"), "y")
    want = pd.Series(x).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    assert (np.isnan(got) == np.isnan(want)).all()
    np.testing.assert_allclose(got, want, rtol=1e-10)


def test_full_frame_is_null_until_so_many_values(spark):
    got = column(series(spark, [1, 2, np.nan, 4, 5, 6]).withColumn("m", full(F.avg("close"), F.col("close"), 3)), "m")
    assert np.isnan(got[:5]).all() and got[5] == 5


def test_rounding_is_half_up(spark):
    row = spark.range(1).select(rounded(F.lit(1.005), 2).alias("a"), rounded(F.lit(-2.675), 2).alias("b"), fixed(F.lit(0.475 * 2), 2).alias("c")).first()
    assert (row.a, row.b, row.c) == (1.01, -2.68, "0.95")


def test_large_numbers_are_rounded_as_in_sql(spark):
    """As another engine rounds them: 5639017.895 as a double is under the half."""
    rng = np.random.default_rng(6)
    values = [5639017.895, -5639017.895, 1623501.515, 0.0, 1.005, 99999999999.99]
    values += [float(np.round(v, d)) for e in range(-6, 12) for v in rng.uniform(-1, 1, 60) * 10.0**e for d in (3, 5, 12)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None, float("nan")])], "i int, v double")
    got = df.select("i", *[rounded(F.col("v"), d).alias(f"r{d}") for d in (4, 6)], fixed(F.col("v")).alias("t")).orderBy("i").collect()
    con = duckdb.connect()
    con.execute("create table x(i int, v double)")
    con.executemany("insert into x values (?, ?)", list(enumerate(values)))
    r = lambda d, to: f"cast(cast(cast(v as decimal(28,10)) as decimal(18,{d})) as {to})"
    want = con.execute(f"select i, {r(4, 'double')}, {r(6, 'double')}, {r(2, 'varchar')} from x order by i").fetchall()
    assert [tuple(g) for g in got[: len(values)]] == want
    assert want[0][3] == "5639017.89" and all(tuple(g)[1:] == (None, None, None) for g in got[len(values) :])


def test_averages_of_one_call_share_blocks_over_sparse_values(spark):
    rng = np.random.default_rng(4)
    x = 50 + rng.normal(size=3000).cumsum()
    gaps = x.copy()
    gaps[rng.random(3000) < 0.4] = np.nan
    gaps[1000:1100] = np.nan
    days = pd.date_range("2010-01-01", periods=3000).date
    df = spark.createDataFrame([("A", d, float(a), None if np.isnan(b) else float(b)) for d, a, b in zip(days, x, gaps)], "ticker string, date date, x double, g double")
    first = ewms(df, {"fast": ("x", 0.2), "slow": ("g", 1 / 14)})
    got = ewms(first, {"again": ("fast", 0.2)}).orderBy("date").toPandas()
    want = {"fast": pd.Series(x).ewm(alpha=0.2, adjust=False).mean(), "slow": pd.Series(gaps).ewm(alpha=1 / 14, adjust=False).mean()}
    want["again"] = want["fast"].ewm(alpha=0.2, adjust=False).mean()
    for name, w in want.items():
        np.testing.assert_allclose(got[name].astype(float), w, rtol=1e-9)


def test_an_average_is_the_same_alone_and_beside_others_and_forgets_nothing(spark):
    """Prices that fall from 1e60 to 1e-20 and gaps of whole blocks: what is far back outweighs what is near."""
    x = 10.0 ** np.concatenate([np.linspace(60, -20, 900), np.full(700, -20.0), np.linspace(-20, 8, 900)]) * np.random.default_rng(5).uniform(0.5, 2, 2500)
    gaps = x.copy()
    gaps[300:1000:3] = np.nan
    days = pd.date_range("2010-01-01", periods=2500).date
    df = spark.createDataFrame([("A", d, float(a), None if np.isnan(b) else float(b)) for d, a, b in zip(days, x, gaps)], "ticker string, date date, x double, g double")
    both = ewms(df, {"fast": ("x", 2 / 13), "slow": ("g", 1 / 14)}).orderBy("date").toPandas()
    alone = {"fast": ewm(df, "x", 2 / 13, "y"), "slow": ewm(df, "g", 1 / 14, "y")}
    for name, values, alpha in (("fast", x, 2 / 13), ("slow", gaps, 1 / 14)):
        got = both[name].astype(float).to_numpy()
        assert (got == column(alone[name], "y")).all()
        np.testing.assert_allclose(got, pd.Series(values).ewm(alpha=alpha, adjust=False).mean(), rtol=1e-9)
