"""Averages stepped on from a stored state against those of the whole history."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantloom.config import load
from quantloom.functions.shared import checkpointed
from quantloom.operators import averages, features, indicators

START = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def walks(spark):
    """Three walks with gaps: unknown closes and highs, a constant stretch, one ticker of three bars."""
    rnd, rows = np.random.default_rng(4), []
    for ticker, n in (("A", 160), ("B", 90), ("C", 3), ("D", 60)):
        close = 100 * np.exp(np.cumsum(rnd.normal(0, 0.02, n))) if ticker != "D" else np.full(n, 50.0)
        for i in range(n):
            c = None if ticker == "B" and i % 11 in (3, 4) else float(close[i])
            rows.append((ticker, START + dt.timedelta(i), c, None if ticker == "A" and i == 40 else float(close[i] * 1.01), float(close[i] * 0.98)))
    return spark.createDataFrame(rows, "ticker string, date date, close double, high double, low double").cache()


def by_windows(bars, cfg):
    return features.with_adx(indicators.with_rsi(indicators.with_macd(bars, cfg), cfg), cfg).select("ticker", "date", *averages.OUT)


def same(a, b):
    x, y = (df.select("ticker", "date", *averages.OUT).toPandas().sort_values(["ticker", "date"], ignore_index=True) for df in (a, b))
    pd.testing.assert_frame_equal(x, y, rtol=1e-9, atol=1e-9)
    return len(x)


@pytest.mark.parametrize("cuts", [[], [70], [10, 11, 86]])
def test_nights_equal_the_backfill(spark, walks, cuts):
    cfg, states, made, since = load({"macd": [3, 6, 4], "rsi_window": 5, "adx_window": 6}), None, None, START - dt.timedelta(1)
    for until in [*(START + dt.timedelta(c) for c in cuts), START + dt.timedelta(500)]:
        done = checkpointed(averages.stepped(walks.filter(F.col("date") <= F.lit(until)), states, cfg))
        new, old = averages.states(done), states
        states = checkpointed(new if old is None else new.unionByName(old.join(new, "ticker", "left_anti")))
        own = averages.indicators(done)
        assert own.filter(F.col("date") <= F.lit(since)).count() == 0
        made = own if made is None else made.unionByName(own)
        since = until
    assert same(made, by_windows(walks, cfg)) == walks.count()
    assert {r.ticker: r.n_bars for r in states.collect()} == {"A": 160, "B": 90, "C": 3, "D": 60}


def test_a_late_correction_steps_on_from_the_state_before_it(spark, walks):
    cfg = load({"macd": [3, 6, 4], "rsi_window": 5, "adx_window": 6})
    nights = None
    for day in (50, 60, 70):
        own = averages.states(averages.stepped(walks.filter(F.col("date") <= F.lit(START + dt.timedelta(day))), None, cfg, outputs=False))
        nights = own if nights is None else nights.unionByName(own)
    fixed = START + dt.timedelta(65)
    corrected = walks.withColumn("close", F.when((F.col("ticker") == "A") & (F.col("date") == F.lit(fixed)), F.col("close") * 1.2).otherwise(F.col("close")))
    before = averages.newest(nights, F.lit(fixed))
    assert {(r.ticker, r.date) for r in before.collect()} == {("A", START + dt.timedelta(60)), ("B", START + dt.timedelta(60)), ("C", START + dt.timedelta(2)), ("D", START + dt.timedelta(59))}
    done = averages.indicators(averages.stepped(corrected, before, cfg))
    assert same(done, by_windows(corrected, cfg).join(before.select("ticker", F.col("date").alias("_d")), "ticker").filter("date > _d")) == 99 + 29


def test_no_bars(spark, walks):
    assert averages.stepped(walks.limit(0)).count() == 0
    assert averages.stepped(walks, averages.states(averages.stepped(walks, outputs=False))).count() == 0
