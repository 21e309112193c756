"""Bias, confidence, key levels, reasoning and the brief."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.expr import by_ticker, fixed, rounded, trailing

# How much a level counts, and what is said of it on either side. {p} is its price.
SIGNIFICANCE = {"sma_200": "high", "sma_50": "medium", "bb_upper": "medium", "bb_lower": "medium", "52w_high": "high", "52w_low": "high", "20d_high": "low", "20d_low": "low"}
NOTES = {
    ("sma_200", "support"): "Long-term uptrend intact; SMA-200 at {p} is floor",
    ("sma_200", "resistance"): "Below SMA-200 at {p}; long-term trend bearish",
    ("sma_50", "support"): "Short-term momentum supported above SMA-50 at {p}",
    ("sma_50", "resistance"): "SMA-50 at {p} capping near-term recovery",
    ("bb_upper", "resistance"): "Approaching upper band at {p}; overbought risk",
    ("bb_upper", "support"): "Above upper band at {p}; momentum breakout",
    ("bb_lower", "support"): "Near lower band at {p}; oversold support zone",
    ("bb_lower", "resistance"): "Below lower band at {p}; breakdown confirmed",
    ("52w_high", "resistance"): "52-week high at {p} is key overhead resistance",
    ("52w_high", "support"): "Holding above 52-week high at {p}; breakout confirmed",
    ("52w_low", "support"): "52-week low at {p}; long-term support",
    ("52w_low", "resistance"): "Below 52-week low at {p}; multi-year breakdown",
    ("20d_high", "resistance"): "Recent swing high at {p}",
    ("20d_high", "support"): "Holding above recent swing high at {p}",
    ("20d_low", "support"): "Recent swing low at {p}",
    ("20d_low", "resistance"): "Below recent swing low at {p}; near-term weak",
}


def bias(score: Column) -> Column:
    return F.when(score > 0, "bullish").when(score < 0, "bearish").otherwise("neutral")


def signal_trend(score: str, cfg: Config = DEFAULT, rows: int | None = 4) -> Column:
    """How the score moved from the first to the last known value: over the last ``rows`` rows, or 14 days if None."""
    if rows is None:
        frame = Window.partitionBy("ticker").orderBy(F.unix_date("date")).rangeBetween(-14, 0)
    else:
        frame = trailing(rows)
    move = F.last(score, ignorenulls=True).over(frame) - F.first(score, ignorenulls=True).over(frame)
    known = F.count(score).over(frame) >= 2
    return F.when(known & (move > cfg.trend_delta), "improving").when(known & (move < -cfg.trend_delta), "deteriorating").otherwise("flat")


def confidence(score: Column, trend: Column) -> Column:
    base = F.least(F.abs(score), F.lit(1.0))
    with_it = ((score > 0) & (trend == "improving")) | ((score < 0) & (trend == "deteriorating"))
    against = ((score > 0) & (trend == "deteriorating")) | ((score < 0) & (trend == "improving"))
    out = F.when(with_it, F.least(base + 0.10, F.lit(1.0))).when(against, F.greatest(base - 0.10, F.lit(0.0))).otherwise(base)
    return F.when(score.isNull(), F.lit(0.0)).otherwise(rounded(out, 2))


def key_levels(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Adds ``key_levels``: an array of (price, type, role, significance, note), unknown levels left out."""
    year = F.row_number().over(by_ticker()) >= cfg.year
    df = df.withColumns(
        {
            "20d_high": F.max("high").over(trailing(20)),
            "20d_low": F.min("low").over(trailing(20)),
            "52w_high": F.when(year, F.max("high").over(trailing(cfg.year))),
            "52w_low": F.when(year, F.min("low").over(trailing(cfg.year))),
        }
    )
    kinds = ["sma_50", "sma_200", "bb_upper", "bb_lower", "20d_high", "20d_low", "52w_high", "52w_low"]

    def level(kind: str) -> Column:
        price = F.col(f"_{kind}")
        role = F.when(F.col("close") >= price, "support").otherwise("resistance")
        said = lambda side: F.concat(*[x for part in _parts(NOTES[kind, side]) for x in [F.lit(part) if part != "{p}" else fixed(price)]])
        note = F.when(role == "support", said("support")).otherwise(said("resistance"))
        return F.struct(price.alias("price"), F.lit(kind).alias("type"), role.alias("role"), F.lit(SIGNIFICANCE[kind]).alias("significance"), note.alias("note"))

    df = df.withColumns({f"_{k}": rounded(F.col(k), 4) for k in kinds})
    levels = F.filter(F.array(*[level(k) for k in kinds]), lambda x: x["price"].isNotNull())
    return df.withColumn("key_levels", levels).drop("20d_high", "20d_low", "52w_high", "52w_low", *[f"_{k}" for k in kinds])


def _parts(template: str) -> list[str]:
    before, after = template.split("{p}")
    return [x for x in (before, "{p}", after) if x]


def reasoning(score: Column, trend: Column, rsi: Column, regime: Column) -> Column:
    word = F.when(trend == "improving", "Strengthening").when(trend == "deteriorating", "Weakening").otherwise("Stable")
    first = F.concat(word, F.lit(" "), F.when(score > 0, "bullish").otherwise("bearish"), F.lit(" signal ("), fixed(F.abs(score)), F.lit(")"))
    second = F.when(rsi < 30, "RSI oversold").when(rsi > 70, "RSI overbought").when(rsi < 40, "RSI recovering")
    third = F.when(regime.isin("high", "extreme"), F.concat(F.lit("VIX "), regime, F.lit(" — macro risk elevated"))).when(regime == "low", "VIX low — complacent conditions")
    return F.when(score.isNull(), "Insufficient signal data.").otherwise(F.concat(F.concat_ws("; ", first, second, third), F.lit(".")))


def analyse(signals: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Signals with trend, bias, confidence and reasoning."""
    score = F.col("composite_vix_adj")
    df = signals.withColumn("signal_trend", signal_trend("composite_vix_adj", cfg)).withColumn("bias", bias(score))
    df = df.withColumn("confidence", confidence(score, F.col("signal_trend")))
    return df.withColumn("reasoning", reasoning(score, F.col("signal_trend"), F.col("rsi_14"), F.col("vix_regime")))


def selected(analysed: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Rows whose adjusted score is strong enough."""
    return analysed.filter(F.abs("composite_vix_adj") >= cfg.signal_threshold)


def top_brief(chosen: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Of the selected rows of the last day those with a side, the most confident first, ties by ticker."""
    last = chosen.agg(F.max("date").alias("_last"))  # one row
    rows = chosen.join(F.broadcast(last), F.col("date") == F.col("_last")).drop("_last").filter("bias <> 'neutral'")
    return rows.orderBy(F.desc("confidence"), "ticker").limit(cfg.brief_size)


def strongest(chosen: DataFrame) -> DataFrame:
    """Selected rows in the order in which they are worked on: the strongest first, ties by ticker."""
    return chosen.orderBy(F.desc(F.abs("composite_vix_adj")), "ticker")


def brief_text(rows: list[Row]) -> str:
    """The message of a brief, from the dozen rows of ``top_brief``."""
    lines = [f"VIX {rows[0]['vix_regime']}, {rows[0]['vix_trend']}; volatility {rows[0]['vol_environment']}"] if rows else ["No signals."]
    for side in ("bullish", "bearish"):
        own = [f"- {r['ticker']} ({r['confidence']:.2f}): {r['reasoning']}" for r in rows if r["bias"] == side]
        lines += [side.capitalize(), *own] if own else []
    return "\n".join(lines)
