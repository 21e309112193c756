"""Technical indicators per ticker, market volatility context and the weighted composite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.expr import BLOCK, band, by_ticker, ewms, exceeds, full, ratio, rounded


def sma(column: str, rows: int) -> Column:
    return full(F.avg(column), F.col(column), rows)


def with_sma(bars: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return bars.withColumns({"sma_50": sma("close", cfg.sma_short), "sma_200": sma("close", cfg.sma_long)})


def _steps(bars: DataFrame) -> DataFrame:
    step = F.col("close") - F.lag("close").over(by_ticker())
    df = bars.withColumn("_step", step)
    move = lambda c: F.when(F.col("_step").isNotNull(), F.greatest(c, F.lit(0.0)))
    return df.withColumns({"_up": move(F.col("_step")), "_down": move(-F.col("_step"))}).drop("_step")


def _macd_averages(cfg: Config) -> dict[str, tuple[str, float]]:
    return {"_fast": ("close", 2 / (cfg.macd[0] + 1)), "_slow": ("close", 2 / (cfg.macd[1] + 1))}


def _rsi_averages(cfg: Config) -> dict[str, tuple[str, float]]:
    return {"_gain": ("_up", 1 / cfg.rsi_window), "_loss": ("_down", 1 / cfg.rsi_window)}


def _macd(averaged: DataFrame, cfg: Config) -> DataFrame:
    df = averaged.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    return ewms(df, {"macd_signal": ("macd", 2 / (cfg.macd[2] + 1))}).withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))


def _rsi(averaged: DataFrame) -> DataFrame:
    gain, loss = F.col("_gain"), F.col("_loss")
    rsi = F.when(loss > 0, 100.0 - 100.0 / (1.0 + ratio(gain, loss))).when(gain > 0, F.lit(100.0))
    return averaged.withColumn("rsi_14", rsi).drop("_up", "_down", "_gain", "_loss")


def with_macd(bars: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return _macd(ewms(bars, _macd_averages(cfg)), cfg).drop(BLOCK)


def with_rsi(bars: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Wilder's RSI: 100 where nothing was lost, NULL where nothing moved at all."""
    return _rsi(ewms(_steps(bars), _rsi_averages(cfg))).drop(BLOCK)


def with_bollinger(bars: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    rows, width = cfg.bollinger
    middle, deviation = sma("close", rows), full(F.stddev_samp("close"), F.col("close"), rows)
    return bars.withColumns({"bb_upper": middle + width * deviation, "bb_lower": middle - width * deviation})


def indicators(bars: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """All indicators; the averages share their blocks, and so two sorts serve every window."""
    df = _steps(with_bollinger(with_sma(bars, cfg), cfg))
    df = ewms(df, {**_macd_averages(cfg), **_rsi_averages(cfg)})
    return _macd(_rsi(df), cfg).drop(BLOCK)


def vix_context(index: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row a date: vix, vvix, regime and its multiplier, trend against the 20-day average, environment.

    The index is one series; its window runs in one task over one row a day.
    """
    series = index.withColumn("ticker", F.lit("VIX"))
    low, high = cfg.vix_trend
    df = series.withColumn("_sma", full(F.avg("vix"), F.col("vix"), cfg.vix_sma))
    change = ratio(F.col("vix"), F.col("_sma"))
    last = cfg.vix_bands[-1]
    return df.select(
        "date",
        F.col("vix").alias("vix_close"),
        F.col("vvix").alias("vvix_close"),
        band(F.col("vix"), cfg.vix_bands, last[1]).alias("vix_regime"),
        band(F.col("vix"), cfg.vix_bands, last[2], take=2).alias("vix_mult"),
        F.when(change > high, "expanding").when(change < low, "contracting").when(change.isNotNull(), "stable").alias("vix_trend"),
        band(F.col("vvix"), cfg.vvix_bands, cfg.vvix_top).alias("vol_environment"),
    )


def rsi_score(rsi: Column, cfg: Config = DEFAULT) -> Column:
    out = F.when(rsi < cfg.rsi_bands[0][0], F.lit(cfg.rsi_bands[0][1]))
    for upper, score in cfg.rsi_bands[1:]:
        out = out.when(rsi < upper, F.lit(score))
    return out.when(rsi <= cfg.rsi_overbought, F.lit(0.0)).when(rsi > cfg.rsi_overbought, F.lit(-1.0))


def above(a: str, b: str) -> Column:
    """1 above, -1 at or below, NULL if either is unknown."""
    return F.when(exceeds(F.col(a), F.col(b)), F.lit(1.0)).when(~exceeds(F.col(a), F.col(b)), F.lit(-1.0))


def score_parts(cfg: Config = DEFAULT) -> list[Column]:
    return [above("close", "sma_200"), above("close", "sma_50"), above("macd", "macd_signal"), rsi_score(F.col("rsi_14"), cfg)]


def weighted(parts: list[Column], weights: list[Column]) -> Column:
    """Weighted mean of the parts that are known, rounded to 4; NULL if none is."""
    total = sum((F.coalesce(w * p, F.lit(0.0)) for p, w in zip(parts, weights, strict=True)), F.lit(0.0))
    weight = sum((F.when(p.isNotNull(), w).otherwise(0.0) for p, w in zip(parts, weights, strict=True)), F.lit(0.0))
    return rounded(ratio(total, weight), 4)


def signals(indicated: DataFrame, context: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Indicators with their date's context, composite_score and composite_vix_adj.

    The context has one row a day; whether it is small enough to broadcast is left to the planner.
    """
    score = weighted(score_parts(cfg), [F.lit(w) for w in cfg.weights])
    df = indicated.withColumn("composite_score", score).join(context, "date", "left")
    return df.withColumn("composite_vix_adj", rounded(F.col("composite_score") * F.col("vix_mult"), 4))
