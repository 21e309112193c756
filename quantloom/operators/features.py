"""Displacement and momentum features, ADX and the trend regime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.expr import by_ticker, ewms, full, in_blocks, ratio


def change(column: str, rows: int) -> Column:
    """Relative change against so many rows before."""
    return ratio(F.col(column), F.lag(column, rows).over(by_ticker())) - 1.0


def displacement(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Needs bars with indicators; adds the eleven scale-free features."""
    c = F.col
    df = df.withColumns({f"dist_sma{n}": ratio(c("close") - c(f"sma_{n}"), c(f"sma_{n}")) for n in (50, 200)})
    mean, deviation = full(F.avg("dist_sma200"), c("dist_sma200"), cfg.year), full(F.stddev_samp("dist_sma200"), c("dist_sma200"), cfg.year)
    return df.withColumns(
        {
            "dist_sma200_z": ratio(c("dist_sma200") - mean, deviation),
            "rsi_centered": (c("rsi_14") - 50.0) / 50.0,
            "bb_pctb": ratio(c("close") - c("bb_lower"), c("bb_upper") - c("bb_lower")),
            "macd_hist_norm": ratio(c("macd_hist"), c("close")),
            "dist_52w_high": ratio(c("close"), full(F.max("high"), c("high"), cfg.year)) - 1.0,
            "dist_52w_low": ratio(c("close"), full(F.min("low"), c("low"), cfg.year)) - 1.0,
            "vol_ratio": ratio(c("volume").cast("double"), full(F.avg("volume"), c("volume"), cfg.volume_sma)),
            "ret_21d": change("close", cfg.ret_windows[0]),
            "ret_63d": change("close", cfg.ret_windows[1]),
            "sma200_slope": change("sma_200", cfg.slope_window),
        }
    )


def with_adx(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Average directional index; NULL for the first two windows of rows and where nothing has moved in a direction."""
    keep, w, alpha = df.columns, by_ticker(), 1 / cfg.adx_window
    high, low = F.col("high"), F.col("low")
    close, up, down = F.lag("close").over(w), high - F.lag("high").over(w), F.lag("low").over(w) - low
    df = df.withColumns({"_tr": F.greatest(high - low, F.abs(high - close), F.abs(low - close)), "_u": up, "_d": down})
    plus = F.when((F.col("_u") > F.col("_d")) & (F.col("_u") > 0), F.col("_u")).otherwise(0.0)
    minus = F.when((F.col("_d") > F.col("_u")) & (F.col("_d") > 0), F.col("_d")).otherwise(0.0)
    df = df.withColumns({"_plus": plus, "_minus": minus})
    df = ewms(df, {f"{name}_avg": (name, alpha) for name in ("_tr", "_plus", "_minus")})
    df = df.withColumns({n: 100.0 * ratio(F.col(f"{side}_avg"), F.col("_tr_avg")) for n, side in (("_pdi", "_plus"), ("_mdi", "_minus"))})
    df = df.withColumn("_dx", 100.0 * ratio(F.abs(F.col("_pdi") - F.col("_mdi")), F.col("_pdi") + F.col("_mdi")))
    df = ewms(df, {"_adx": ("_dx", alpha)}).withColumn("_row", F.row_number().over(in_blocks()))
    return df.select(*keep, F.when(F.col("_row") > 2 * cfg.adx_window, F.col("_adx")).alias("adx_14"))


def with_regime(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """trending or ranging, unknown if either input is; a direction by the slope's sign while trending."""
    adx, slope = F.col("adx_14"), F.col("sma200_slope")
    trending = (adx >= cfg.adx_trend_min) | (F.abs(slope) >= cfg.slope_trend_min)
    regime = F.when(adx.isNotNull() & slope.isNotNull(), F.when(trending, "trending").otherwise("ranging"))
    df = df.withColumn("ticker_regime", regime)
    return df.withColumn("trend_direction", F.when(F.col("ticker_regime") == "trending", F.when(slope > 0, "up").when(slope < 0, "down")))


def features(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return with_regime(with_adx(displacement(df, cfg), cfg), cfg)


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of NULLs in each column, one row a column."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("null_rate")) for c in columns])))
