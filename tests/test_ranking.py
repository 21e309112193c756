"""The rank model against plain numpy and brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.config import load
from quantloom.functions.shared import checkpointed
from quantloom.operators import ranking

INPUTS = ("a", "b", "c")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    out = []
    for i in range(3000):
        day = dt.date(2018, 1, 1) + dt.timedelta(days=i // 2)
        x = rng.normal(size=3)
        excess = float(0.05 * x[0] - 0.02 * x[1] + 0.1 * rng.normal() - 0.03)
        until = day + dt.timedelta(days=90) if i < 2800 else None
        out.append((f"T{i % 2}", day, until, ["up", "down", None][i % 3], "low", False, i % 6 == 0, excess, int(excess > 0), *map(float, x)))
    return checkpointed(spark.createDataFrame(out, "ticker string, date date, until date, trend_direction string, vix_regime string, deep boolean, is_head boolean, excess double, label int, x_a double, x_b double, x_c double").repartition(7))


def _plain(data, l2):
    """Minimum of the penalised loss by damped Newton steps on whole arrays."""
    x = np.column_stack([np.ones(len(data)), data[["x_a", "x_b", "x_c"]].to_numpy()])
    y = data["label"].to_numpy()
    w = np.where(data["is_head"], 1.0, 0.25)
    w = w * np.where(y == 1, w.sum() / (2 * w[y == 1].sum()), w.sum() / (2 * w[y == 0].sum()))
    beta, pen = np.zeros(4), np.array([0, l2, l2, l2])
    for _ in range(400):
        p = 1 / (1 + np.exp(-x @ beta))
        beta = beta + 0.5 * np.linalg.solve((x.T * (w * p * (1 - p))) @ x + np.diag(pen), x.T @ (w * (y - p)) - pen * beta)
    p = 1 / (1 + np.exp(-x @ beta))
    assert np.abs(x.T @ (w * (y - p)) - pen * beta).max() < 1e-8
    return beta


def test_coefficients_of_all_folds(rows):
    cfg = load({"rank_l2": 3.0})
    models = ranking.fit(rows, [2018, 2019, 2020, 2021, 2030], cfg, INPUTS)
    data = rows.toPandas()
    assert sorted(models) == [2019, 2020, 2021, 2030]  # nothing is settled before 2018
    for fold, got in models.items():
        known = data[[u is not None and u.year < fold for u in data["until"]]]
        assert np.abs(got - _plain(known, 3.0)).max() < 1e-6
    assert not np.allclose(models[2019], models[2020])


def test_no_classes_no_model(rows):
    assert ranking.fit(rows.filter("label = 1"), [2020], inputs=INPUTS) == {}
    assert ranking.fit(rows.limit(0), [2020], inputs=INPUTS) == {}


def test_no_training_row_reaches_into_its_test_year(spark):
    """A ticker that trades every day and one that trades each ninth day: the embargo counts a ticker's own rows."""
    days = [dt.date(2018, 1, 1) + dt.timedelta(days=i) for i in range(1400)]
    names = [f"{c} double" for c in ("close", *ranking.STATES)]
    feats = spark.createDataFrame([(t, d, "up", "low", *[float(i + n + 1) for n in range(len(names))]) for t, step in (("A", 1), ("B", 9)) for i, d in enumerate(days[::step])], "ticker string, date date, trend_direction string, vix_regime string, " + ", ".join(names))
    excess = feats.select("ticker", "date", F.lit(0.1).alias("excess_42"))
    cfg = load({"year": 10, "ret_windows": [2, 3]})
    got = ranking.frame(feats, excess, cfg).select("ticker", "date", "until", ranking.trains(2020).alias("t")).collect()
    own = {"A": days, "B": days[::9]}
    assert len(got) > 1400
    for r in got:
        at = own[r.ticker].index(r.date)
        end = own[r.ticker][at + 63] if at + 63 < len(own[r.ticker]) else None
        assert r.until == end and bool(r.t) == (end is not None and end < dt.date(2020, 1, 1))
    last = max(r.date for r in got if r.t and r.ticker == "A")
    assert sum(last < d < dt.date(2020, 1, 1) for d in days) >= 63


def _pav(n, h):
    """Pool adjacent violators."""
    blocks = []
    for d in range(10):
        if n[d]:
            blocks.append([n[d], h[d], [d]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            m, k, ds = blocks.pop()
            blocks[-1] = [blocks[-1][0] + m, blocks[-1][1] + k, blocks[-1][2] + ds]
    return {d: k / m for m, k, ds in blocks for d in ds}


def test_confidence_is_the_isotonic_fit(spark):
    rng = np.random.default_rng(1)
    counts, want = [], {}
    for c in range(30):
        n = rng.integers(0, 40, 10) * (rng.random(10) > 0.2)
        n[0] += 30
        h = [int(rng.integers(0, v + 1)) for v in n]
        counts += [(f"c{c}", d + 1, int(n[d]), h[d]) for d in range(10) if n[d]]
        want[f"c{c}"] = _pav(n, h)
    counts.append(("few", 3, 2, 1))
    got = ranking.isotonic(spark.createDataFrame(counts, "cell string, decile int, n long, hits long"), ["cell"]).orderBy("cell", "decile").collect()
    assert len(got) == 310 and all(r.confidence is None for r in got if r.cell == "few")
    for cell, fit in want.items():
        own = [r for r in got if r.cell == cell]
        assert all(abs(r.confidence - fit[r.decile - 1]) < 1e-6 for r in own if r.n)
        assert all(a.confidence <= b.confidence for a, b in zip(own, own[1:]))


def test_deciles_spread_and_confidence_by_hand(rows):
    walked = checkpointed(ranking.deciles(ranking.scored(rows, {"a": 1.0, "intercept": 0.5}).withColumn("fold", F.year("date"))))
    data = walked.toPandas()
    assert set(data["decile"]) == {1, 2}  # two tickers a date
    for r in ranking.spreads(walked.withColumn("decile", F.when(F.col("decile") == 2, 10).otherwise(F.col("decile")))).collect():
        own = data[data["fold"] == r.fold]
        cut = own["excess"].clip(*own["excess"].quantile([0.01, 0.99]))
        assert r.n == len(own) and abs(r.spread - (cut[own["decile"] == 2].mean() - cut[own["decile"] == 1].mean())) < 2e-6
    table = ranking.calibration(walked, load({"min_sample": 1}))
    looked = ranking.confident(walked, table)
    assert looked.count() == 3000  # heads are in rising trends alone here
    assert looked.filter("confidence is null").count() == looked.filter("trend_direction is distinct from 'up'").count() == 2000
    heads = data[data["is_head"]].groupby("decile")["label"].mean()
    assert heads[1] <= heads[2] and {(r.decile, round(r.confidence, 5)) for r in looked.filter("is_head").select("decile", "confidence").distinct().collect()} == {(d, round(v, 5)) for d, v in heads.items()}


def test_each_year_is_scored_by_the_model_that_saw_nothing_of_it(rows):
    models = ranking.fit(rows, [2018, 2019, 2020, 2021], inputs=INPUTS)
    renamed = {f: dict(zip(("intercept", *INPUTS), m)) for f, m in models.items()}
    got = ranking.walked(rows, renamed).toPandas()
    data = rows.toPandas()
    assert set(got["fold"]) == {2019, 2020, 2021} and len(got) == sum(d.year in models for d in data["date"])
    for r in got.itertuples():
        beta = models[r.date.year]
        assert r.fold == r.date.year and abs(r.score - 1 / (1 + np.exp(-(beta @ [1, r.x_a, r.x_b, r.x_c])))) < 1e-8
    assert ranking.walked(rows, {}).count() == 0
