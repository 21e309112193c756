"""Predictions, their outcomes by trading-day offset, episodes and accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.expr import by_ticker, exceeds, ratio, rounded
from .relatedness import shrunk


def predictions(analysed: DataFrame, version: str = "v1.0", cfg: Config = DEFAULT) -> DataFrame:
    """The snapshot of each strong signal; rows by ticker, signal_date and version."""
    strong = analysed.filter((F.abs("composite_vix_adj") >= cfg.signal_threshold) & (F.col("bias") != "neutral"))
    return strong.select(
        "ticker", F.col("date").alias("signal_date"), F.lit(version).alias("signal_version"), "bias", "composite_vix_adj", "confidence", "vix_regime", "vix_trend", "vol_environment", F.col("close").alias("price_at_signal")
    )


def fractional(future: Column, price: Column) -> Column:
    return ratio(future - price, price)


def correct(r: Column, side: Column, cfg: Config = DEFAULT) -> Column:
    """Beyond the fixed move on the predicted side, strictly; NULL for neutral or unknown."""
    return F.when(side == "bullish", r > cfg.correct_move).when(side == "bearish", r < -cfg.correct_move)


def forward(bars: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row a bar: closes at every horizon ahead, seam flags over them and the trailing volatility.

    Everything an outcome needs of a ticker, by one window key; predictions then join it once.
    """
    w = by_ticker()
    step = ratio(F.col("close"), F.lag("close").over(w))
    df = bars.select("ticker", "date", "close").withColumn("_ratio", step)
    torn = F.when(F.col("_ratio").isNull() | (F.col("_ratio") > cfg.max_ratio) | (F.col("_ratio") < 1 / cfg.max_ratio), 1).otherwise(0)
    df = df.withColumn("_torn", torn).withColumn("_ret", F.col("_ratio") - 1.0)
    past = w.rowsBetween(-(cfg.vol_lookback - 1), 0)
    horizons = sorted({*cfg.horizons_v1, *cfg.horizons_v2})
    df = df.withColumn("vol_at_signal", F.when(F.count("_ret").over(past) >= 2, F.stddev_samp("_ret").over(past)))
    df = df.withColumns({f"close_{h}": F.lead("close", h).over(w) for h in horizons})
    # pairs of consecutive future bars, the first from day 1 to day 2
    return df.withColumns({f"seam_{h}": F.max("_torn").over(w.rowsBetween(2, h)) == 1 for h in horizons}).drop("_ratio", "_torn", "_ret")


def resolve_v1(preds: DataFrame, ahead: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Returns and correctness at the fixed horizons, of predictions that have the longest one behind them."""
    last = max(cfg.horizons_v1)
    f = ahead.select("ticker", F.col("date").alias("signal_date"), *[f"close_{h}" for h in cfg.horizons_v1])
    df = preds.join(f, ["ticker", "signal_date"]).filter(F.col(f"close_{last}").isNotNull())
    df = df.withColumns({f"return_{h}d": fractional(F.col(f"close_{h}"), F.col("price_at_signal")) for h in cfg.horizons_v1})
    return df.withColumns({f"correct_{h}d": correct(F.col(f"return_{h}d"), F.col("bias"), cfg) for h in cfg.horizons_v1})


def long_v1(resolved: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row a prediction and horizon: horizon_days, ret, hit."""
    cells = F.array(*[F.struct(F.lit(h).alias("horizon_days"), F.col(f"return_{h}d").alias("ret"), F.col(f"correct_{h}d").alias("hit")) for h in cfg.horizons_v1])
    drop = [c for h in cfg.horizons_v1 for c in (f"return_{h}d", f"correct_{h}d", f"close_{h}")]
    return resolved.select("*", F.inline(cells)).drop(*drop)


def accuracy_rollup(resolved: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Accuracy and mean returns by version, regime, environment, bias and horizon; groups of ``min_sample`` or more."""
    rows = long_v1(resolved, cfg).filter("ret is not null and hit is not null")
    keys = ["signal_version", *[F.coalesce(c, F.lit("")).alias(c) for c in ("vix_regime", "vol_environment")], "bias", "horizon_days"]
    out = rows.groupBy(*keys).agg(
        F.count("*").alias("total_signals"),
        F.sum(F.col("hit").cast("int")).alias("correct_signals"),
        rounded(F.avg(F.col("hit").cast("int")), 4).alias("accuracy_rate"),
        rounded(F.avg("ret"), 4).alias("avg_return"),
        rounded(F.avg(F.when(F.col("hit"), F.col("ret"))), 4).alias("avg_return_correct"),
        rounded(F.avg(F.when(~F.col("hit"), F.col("ret"))), 4).alias("avg_return_wrong"),
    )
    return out.filter(F.col("total_signals") >= cfg.min_sample)


def _waiting(preds: DataFrame, ahead: DataFrame, cfg: Config) -> DataFrame:
    """One row a prediction and horizon: horizon_days, future_price, seam, and the threshold. Where versions overlap the highest one speaks."""
    newest = Window.partitionBy("ticker", "signal_date").orderBy(F.desc("signal_version"))
    preds = preds.filter(F.col("price_at_signal") >= cfg.price_floor).withColumn("_v", F.row_number().over(newest)).filter("_v = 1")
    f = ahead.select("ticker", F.col("date").alias("signal_date"), "vol_at_signal", *[f"{n}_{h}" for h in cfg.horizons_v2 for n in ("close", "seam")])
    cells = F.array(*[F.struct(F.lit(h).alias("horizon_days"), F.col(f"close_{h}").alias("future_price"), F.coalesce(F.col(f"seam_{h}"), F.lit(False)).alias("seam")) for h in cfg.horizons_v2])
    df = preds.join(f, ["ticker", "signal_date"]).select("ticker", "signal_date", "bias", "price_at_signal", "vol_at_signal", F.inline(cells))
    return df.withColumn("threshold_used", threshold(cfg))


def threshold(cfg: Config = DEFAULT) -> Column:
    return cfg.threshold_k * F.col("vol_at_signal") * F.sqrt(F.col("horizon_days").cast("double"))


def seeds(preds: DataFrame, ahead: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Rows for horizons that can't be resolved: not reached yet, or torn by a seam. They wait without an outcome."""
    df = _waiting(preds, ahead, cfg).filter("future_price is null or seam")
    return df.select("ticker", "signal_date", "horizon_days", "price_at_signal", "vol_at_signal", "threshold_used")


def outcomes_v2(preds: DataFrame, ahead: DataFrame, bench: DataFrame, betas: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row a prediction and horizon: excess over beta times the benchmark, volatility-scaled threshold, seams set aside.

    Each horizon is resolved by itself.
    """
    return judged(_waiting(preds, ahead, cfg).filter("future_price is not null and not seam").drop("seam"), bench, betas, cfg)


def judged(df: DataFrame, bench: DataFrame, betas: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Excess and correctness of predictions with their future price and threshold.

    ``bench`` is (date, close) of the benchmark, counted on its own rows; ``betas`` is (ticker, beta).
    """
    one = Window.partitionBy("ticker").orderBy("date")
    market = bench.withColumns({f"bench_{h}": ratio(F.lead("close", h).over(one), F.col("close")) - 1.0 for h in cfg.horizons_v2})
    cells = F.array(*[F.struct(F.lit(h).alias("horizon_days"), F.col(f"bench_{h}").alias("benchmark_return")) for h in cfg.horizons_v2])
    market = market.select(F.col("date").alias("signal_date"), F.inline(cells))
    df = df.join(market, ["signal_date", "horizon_days"], "left").join(betas.select("ticker", "beta"), "ticker", "left")
    df = df.withColumn("beta_used", shrunk(F.col("beta"), cfg)).drop("beta").withColumn("raw_return", fractional(F.col("future_price"), F.col("price_at_signal")))
    df = df.withColumn("excess_return", F.col("raw_return") - F.col("beta_used") * F.col("benchmark_return"))
    right = F.when(F.col("bias") == "bullish", exceeds(F.col("excess_return"), F.lit(0.0))).when(F.col("bias") == "bearish", exceeds(F.lit(0.0), F.col("excess_return")))
    df = df.withColumn("direction_correct", F.when(F.col("threshold_used").isNotNull(), right))
    return df.withColumn("threshold_correct", F.col("direction_correct") & ~exceeds(F.col("threshold_used"), F.abs("excess_return")))


def episodes(preds: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Every ``episode_gap + 1``-th signal of a ticker and bias heads an episode, named by its first date."""
    w = Window.partitionBy("ticker", "bias").orderBy("signal_date")
    df = preds.filter("bias <> 'neutral'").select("ticker", "signal_date", "bias").withColumn("_at", F.row_number().over(w) - 1)
    df = df.withColumn("_episode", F.floor(F.col("_at") / (cfg.episode_gap + 1)))
    first = F.min("signal_date").over(Window.partitionBy("ticker", "bias", "_episode"))
    return df.select(
        "ticker", "signal_date", "bias", F.concat("ticker", F.lit(":"), F.date_format(first, "yyyy-MM-dd")).alias("episode_id"), (F.col("_at") % (cfg.episode_gap + 1) == 0).alias("is_episode_head")
    )


def unresolved(preds: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Predictions without any outcome."""
    return preds.join(outcomes.select("ticker", "signal_date"), ["ticker", "signal_date"], "left_anti")
