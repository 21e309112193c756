"""Cross-sectional rank model: its frame, walk-forward folds, fit, deciles, picks and calibrated confidence.

A row is a ticker on a date; its label is whether the excess return at ``rank_horizon`` is above 0. Inputs are standardised within the date.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.expr import by_ticker, exceeds, ratio, rounded
from ..functions.quantiles import quantiles

STATES = ("dist_52w_high", "dist_52w_low", "dist_sma50", "dist_sma200", "dist_sma200_z", "sma200_slope", "adx_14", "rsi_centered", "bb_pctb", "macd_hist_norm", "vol_ratio", "ret_21d", "ret_63d")
INPUTS = (*STATES, "mom_12_1", "vol_63d", "above_sma200", "trend_up", "trend_down", "stretch_down")
DEEP = -0.15  # a close so far below its long average, while the trend is down, is no candidate
DECILES = 10
# a model as it would be reviewed and published: coefficients of standardised inputs
COEFFICIENTS = {"intercept": 0.02, "dist_52w_high": 0.3, "sma200_slope": 0.2, "mom_12_1": 0.2, "vol_ratio": -0.1, "vol_63d": -0.1, "ret_21d": -0.1, "trend_up": 0.1, "stretch_down": -0.1, "above_sma200": 0.05}


def frame(feats: DataFrame, excess: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(ticker, date, until, trend_direction, vix_regime, deep, is_head, excess, label, x_...): all states whose inputs are known and whose horizon is reached.

    ``until`` is the date of the ticker's own bar ``rank_embargo`` rows ahead, before which no label of the row is settled; NULL near the end.
    Every ``episode_gap + 1``-th row of a ticker heads an episode.
    """
    w = by_ticker()
    past = lambda n: ratio(F.col("close"), F.lag("close", n).over(w)) - 1.0
    df = feats.select("ticker", "date", "close", "trend_direction", "vix_regime", *STATES)
    df = df.withColumns({
        "mom_12_1": past(cfg.year) - past(cfg.ret_windows[0]), "_r": past(1), "until": F.lead("date", cfg.rank_embargo).over(w),
        "is_head": (F.row_number().over(w) - 1) % (cfg.episode_gap + 1) == 0, "deep": (F.col("dist_sma200") < DEEP) & F.coalesce(F.col("trend_direction") == "down", F.lit(False)),
    })
    down = F.coalesce((F.col("trend_direction") == "down").cast("double"), F.lit(0.0))
    up = F.coalesce((F.col("trend_direction") == "up").cast("double"), F.lit(0.0))
    df = df.withColumns({"vol_63d": F.stddev_samp("_r").over(w.rowsBetween(1 - cfg.ret_windows[1], 0)), "above_sma200": (F.col("dist_sma200") > 0).cast("double"), "trend_up": up, "trend_down": down, "stretch_down": F.col("dist_sma200_z") * down})
    df = df.join(excess.select("ticker", "date", F.col(f"excess_{cfg.rank_horizon}").alias("excess")), ["ticker", "date"])
    df = df.dropna(subset=[*INPUTS, "excess"]).withColumn("label", exceeds(F.col("excess"), F.lit(0.0)).cast("int"))
    day = Window.partitionBy("date")  # the tickers of one date
    spread = {c: F.stddev_pop(c).over(day) for c in INPUTS}
    scaled = {f"x_{c}": F.when(spread[c] > 1e-12, (F.col(c) - F.avg(c).over(day)) / spread[c]).otherwise(0.0) for c in INPUTS}
    return df.select("ticker", "date", "until", "trend_direction", "vix_regime", "deep", "is_head", "excess", "label", *[v.alias(k) for k, v in scaled.items()])


def trains(fold: int) -> Column:
    """Rows that the model of a test year may learn from: what they look ahead at, embargo included, lies in years before it."""
    return F.year("until") < fold


def tests(fold: int) -> Column:
    return F.year("date") == fold


def fit(rows: DataFrame, folds: Sequence[int], cfg: Config = DEFAULT, inputs: Sequence[str] = INPUTS, tol: float = 1e-9, rounds: int = 50) -> dict[int, np.ndarray]:
    """Coefficients by fold, the intercept first: logistic regression with both classes of equal weight and an L2 penalty (not on the intercept).

    All folds take their Newton steps together. A step is one pass over ``rows``, so pass it cheap to read again: a task gives, for each fold, one row of
    sums (gradient and Hessian, as large as the model), added up by fold and place before the driver solves them. Folds without rows of both classes have no model.
    Continued episodes weigh ``episode_weight``.
    """
    names = [f"x_{c}" for c in inputs]
    weight = F.when(F.col("is_head"), 1.0).otherwise(cfg.episode_weight)
    data = rows.filter("until is not null").select(F.year("until").alias("_until"), "label", weight.alias("_w"), *names)
    held = data.groupBy("_until", "label").agg(F.sum("_w").alias("w")).collect()  # two rows a year
    balance = {}
    for fold in folds:
        total = [sum(r["w"] for r in held if r["_until"] < fold and r["label"] == c) for c in (0, 1)]
        if min(total, default=0) > 0:
            balance[fold] = [sum(total) / (2 * t) for t in total]
    models = {fold: np.zeros(len(names) + 1) for fold in balance}
    ridge = np.diag([0.0, *[cfg.rank_l2] * len(names)])
    moving = set(models)
    for _ in range(rounds):
        if not moving:
            return models
        sums = _sums(data, names, {f: (models[f], balance[f]) for f in moving})
        for fold in sorted(moving):
            k = len(names) + 1
            gradient, hessian = sums[fold][:k] - ridge @ models[fold], sums[fold][k:].reshape(k, k) + ridge
            step = np.linalg.solve(hessian, gradient)
            models[fold] = models[fold] + step
            if np.abs(step).max() < tol:
                moving.discard(fold)
    if moving:
        raise ArithmeticError(f"no convergence in {rounds} steps: folds {sorted(moving)}")
    return models


def _sums(data: DataFrame, names: list[str], models: Mapping[int, tuple[np.ndarray, list[float]]]) -> dict[int, np.ndarray]:
    k = len(names) + 1

    def part(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = {fold: np.zeros(k + k * k) for fold in models}
        for chunk in chunks:
            x = np.column_stack([np.ones(len(chunk)), chunk[names].to_numpy(float)])
            until, y, w = chunk["_until"].to_numpy(), chunk["label"].to_numpy(), chunk["_w"].to_numpy(float)
            for fold, (beta, balance) in models.items():
                at = until < fold
                xs, ys = x[at], y[at]
                ws = w[at] * np.where(ys == 1, balance[1], balance[0])
                p = 1 / (1 + np.exp(-np.clip(xs @ beta, -500, 500)))
                own[fold][:k] += xs.T @ (ws * (ys - p))
                own[fold][k:] += (xs.T @ (xs * (ws * p * (1 - p))[:, None])).ravel()
        yield pd.DataFrame({"fold": list(own), "sums": [s.tolist() for s in own.values()]})

    added = data.mapInPandas(part, "fold int, sums array<double>").select("fold", F.posexplode("sums").alias("place", "value")).groupBy("fold", "place").agg(F.sum("value").alias("value"))
    out = {fold: np.zeros(k + k * k) for fold in models}
    for fold, place, value in added.select("fold", "place", "value").collect():  # as large as the models
        out[fold][place] = value
    return out


def scored(rows: DataFrame, model: Mapping[str, float] | Sequence[float], inputs: Sequence[str] = INPUTS) -> DataFrame:
    """Probability by one model: coefficients by input name (``intercept`` among them, others 0) or in the order of ``fit``."""
    named = dict(model) if isinstance(model, Mapping) else dict(zip(("intercept", *inputs), map(float, model)))
    at = F.lit(float(named.pop("intercept", 0.0)))
    for name, value in named.items():
        at = at + F.lit(float(value)) * F.col(f"x_{name}")
    return rows.withColumn("score", rounded(1 / (1 + F.exp(-at)), 9))


def walked(rows: DataFrame, models: Mapping[int, Sequence[float]]) -> DataFrame:
    """Each test year by the model that saw nothing of it: score and fold; years without a model are left out."""
    out = None
    for fold, model in sorted(models.items()):
        own = scored(rows.filter(tests(fold)), model).withColumn("fold", F.lit(fold))
        out = own if out is None else out.unionByName(own)
    return out if out is not None else rows.limit(0).withColumns({"score": F.lit(0.0), "fold": F.lit(0)})


def deciles(rows: DataFrame) -> DataFrame:
    """``decile`` 1 to 10 by score within the date, ties by ticker, and ``place`` from the top."""
    day = Window.partitionBy("date")
    return rows.withColumns({"decile": F.ntile(DECILES).over(day.orderBy("score", "ticker")), "place": F.row_number().over(day.orderBy(F.desc("score"), "ticker"))})


def spreads(ranked: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(fold, n, top, bottom, spread): winsorised mean excess of the outer deciles by fold. ``ranked`` is read twice."""
    lo, hi = cfg.winsor
    cuts = quantiles(ranked, ["fold"], "excess", [lo, hi]).select("fold", F.col("q").alias("_cut"))
    clipped = F.least(F.greatest("excess", F.col("_cut")[0]), F.col("_cut")[1])
    mean = lambda d: F.avg(F.when(F.col("decile") == d, clipped))
    out = ranked.join(cuts, "fold").groupBy("fold").agg(F.count("*").alias("n"), mean(DECILES).alias("_top"), mean(1).alias("_bottom"))
    return out.select("fold", "n", rounded(F.col("_top"), 6).alias("top"), rounded(F.col("_bottom"), 6).alias("bottom"), rounded(F.col("_top") - F.col("_bottom"), 6).alias("spread"))


def picks(ranked: DataFrame, size: int) -> DataFrame:
    """The ``size`` best of each date, those deep below a falling average left out first."""
    best = Window.partitionBy("date").orderBy("place")
    return ranked.filter(~F.col("deep")).withColumn("pick", F.row_number().over(best)).filter(F.col("pick") <= size)


def calibration(ranked: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(trend_direction, vix_regime, decile, n, hits, confidence): hit rates of episode heads, made non-decreasing over the deciles of a cell.

    ``ranked`` must be scored out of sample (``walked``). Counts add up, so parts may be counted apart. The isotonic fit of a cell is the greatest, over
    starts up to a decile, of the least rate, over ends from it on; deciles without heads lie between their neighbours. Cells with fewer than ``min_sample`` heads have no confidence.
    """
    cell = [F.coalesce(c, F.lit("none")).alias(c) for c in ("trend_direction", "vix_regime")]
    counts = ranked.filter("is_head").groupBy(*cell, "decile").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    return isotonic(counts, ["trend_direction", "vix_regime"], cfg)


def isotonic(counts: DataFrame, keys: list[str], cfg: Config = DEFAULT) -> DataFrame:
    one = lambda c: F.array(*[F.coalesce(F.sum(F.when(F.col("decile") == d, F.col(c))), F.lit(0)) for d in range(1, DECILES + 1)])
    cells = counts.groupBy(*keys).agg(one("n").alias("_n"), one("hits").alias("_h"))
    total = lambda c, a, b: F.aggregate(F.slice(c, a, b - a + 1), F.lit(0).cast("long"), lambda s, v: s + v)
    rate = lambda a, b: total("_h", a, b) / F.nullif(total("_n", a, b), F.lit(0).cast("long"))
    least = lambda k: lambda a: F.array_min(F.transform(F.sequence(k, F.lit(DECILES)), lambda b: rate(a, b)))
    fitted = F.transform(F.sequence(F.lit(1), F.lit(DECILES)), lambda k: F.struct(k.alias("decile"), F.get("_n", k - 1).alias("n"), F.get("_h", k - 1).alias("hits"), F.array_max(F.transform(F.sequence(F.lit(1), k), least(k))).alias("_fit")))
    enough = total("_n", F.lit(1), F.lit(DECILES)) >= cfg.min_sample
    return cells.select(*keys, enough.alias("_enough"), F.inline(fitted)).select(*keys, "decile", "n", "hits", F.when(F.col("_enough"), rounded(F.col("_fit"), 6)).alias("confidence"))


def confident(ranked: DataFrame, table: DataFrame) -> DataFrame:
    """``confidence`` of each row from a calibration table (ten rows a cell of trend and regime: a few hundred at most)."""
    keys = ["trend_direction", "vix_regime"]
    named = table.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("decile").alias("_decile"), "confidence")
    on = F.col("decile") == F.col("_decile")
    for k in keys:
        on &= F.coalesce(k, F.lit("none")) == F.col(f"_{k}")
    return ranked.join(F.broadcast(named), on, "left").drop("_decile", *[f"_{k}" for k in keys])
