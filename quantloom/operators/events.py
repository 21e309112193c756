"""Crossing events, their forward excess returns and robust statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.expr import by_ticker, exceeds, full, ratio, rounded
from ..functions.quantiles import quantiles
from .relatedness import shrunk

# The events in their order; the first eight are bullish.
EVENTS = {
    "E1": "golden_cross", "E2": "price_x_sma200_up", "E3": "macd_cross_up", "E4": "macd_cross_up_sub0", "E5": "rsi_exit_oversold", "E6": "bb_reentry_low",
    "E7": "high_52w_breakout", "E8": "rsi_cross_50_up", "E9": "death_cross", "E10": "price_x_sma200_dn", "E11": "low_52w_breakdown",
}
BULLISH = list(EVENTS)[:8]


def crossings(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Adds a boolean for each event: it holds today and did not the row before; unknown is false."""
    w = by_ticker()
    was = lambda c: F.lag(c).over(w)
    keep = df.columns
    df = df.withColumn("_high", full(F.max("high"), F.col("high"), cfg.year)).withColumn("_low", full(F.min("low"), F.col("low"), cfg.year))
    df = df.withColumn("_high", was("_high")).withColumn("_low", was("_low"))

    def up(a: Column, b: Column, before_a: Column, before_b: Column) -> Column:
        return ~exceeds(before_a, before_b) & exceeds(a, b)

    c = {n: F.col(n) for n in ("close", "sma_50", "sma_200", "macd", "macd_signal", "rsi_14", "bb_lower")}
    macd_up = up(c["macd"], c["macd_signal"], was("macd"), was("macd_signal"))
    thirty, fifty = F.lit(30.0), F.lit(50.0)
    found = {
        "E1": up(c["sma_50"], c["sma_200"], was("sma_50"), was("sma_200")),
        "E2": up(c["close"], c["sma_200"], was("close"), was("sma_200")),
        "E3": macd_up,
        "E4": macd_up & (c["macd"] < 0),
        "E5": up(c["rsi_14"], thirty, was("rsi_14"), thirty),
        "E6": exceeds(was("bb_lower"), was("close")) & ~exceeds(c["bb_lower"], c["close"]),
        "E7": up(c["close"], F.col("_high"), was("close"), F.col("_high")),
        "E8": up(c["rsi_14"], fifty, was("rsi_14"), fifty),
        "E9": up(c["sma_200"], c["sma_50"], was("sma_200"), was("sma_50")),
        "E10": up(c["sma_200"], c["close"], was("sma_200"), was("close")),
        "E11": up(F.col("_low"), c["close"], F.col("_low"), was("close")),
    }
    return df.select(*keep, *[F.coalesce(hit, F.lit(False)).alias(name) for name, hit in found.items()])


def fires(crossed: DataFrame) -> DataFrame:
    """(ticker, event, position, date) of every event; position is the row's number in its ticker."""
    numbered = crossed.withColumn("position", F.row_number().over(by_ticker()) - 1)
    cells = F.array(*[F.struct(F.lit(e).alias("event"), F.col(e).alias("hit")) for e in EVENTS])
    return numbered.select("ticker", "date", "position", F.inline(cells)).filter("hit").drop("hit")


def dedup(fired: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Keeps a fire if it is more than ``dedup_rows`` rows after the last one kept of its ticker and event.

    Which one is kept depends on the one before: a fold over the positions of one ticker's one event,
    a few hundred numbers at most, inside the engine.
    """
    gap = cfg.dedup_rows
    lists = fired.groupBy("ticker", "event").agg(F.array_sort(F.collect_list(F.struct("position", "date"))).alias("_fires"))
    start = F.slice("_fires", 1, 1)
    kept = F.aggregate("_fires", start, lambda acc, x: F.when(x["position"] - F.element_at(acc, -1)["position"] > gap, F.concat(acc, F.array(x))).otherwise(acc))
    return lists.select("ticker", "event", F.inline(kept))


def forward_excess(bars: DataFrame, bench: DataFrame, betas: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(ticker, date, excess_h ...): return ahead less beta times the benchmark's between the same two dates, as of each.

    As-of: the benchmark's last close at or before a date, found on the calendar of distinct dates (a row a
    day), then joined by date. A jump beyond the seam ratio anywhere ahead voids the horizon.
    """
    w = by_ticker()
    days = bars.select("date").distinct().join(bench.select("date", F.col("close").alias("_b")), "date", "full")
    asof = days.select("date", F.last("_b", ignorenulls=True).over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)).alias("_b"))
    df = bars.select("ticker", "date", "close").withColumn("_ratio", ratio(F.col("close"), F.lag("close").over(w)))
    hs = cfg.horizons_events
    df = df.withColumns({f"_c{h}": F.lead("close", h).over(w) for h in hs} | {f"_d{h}": F.lead("date", h).over(w) for h in hs} | {f"_m{h}": F.max("_ratio").over(w.rowsBetween(1, h)) for h in hs})
    df = df.join(asof.withColumnRenamed("_b", "_b0"), "date", "left").join(betas.select("ticker", "beta"), "ticker", "left")
    beta = shrunk(F.col("beta"), cfg)
    out = {}
    for h in hs:
        df = df.join(asof.select(F.col("date").alias(f"_d{h}"), F.col("_b").alias(f"_b{h}")), f"_d{h}", "left")
        torn = (F.col(f"_m{h}") > cfg.max_ratio) | (F.col(f"_m{h}") < 1 / cfg.max_ratio)
        excess = ratio(F.col(f"_c{h}"), F.col("close")) - 1.0 - beta * (ratio(F.col(f"_b{h}"), F.col("_b0")) - 1.0)
        out[f"excess_{h}"] = F.when(~F.coalesce(torn, F.lit(False)), excess)
    return df.select("ticker", "date", *[e.alias(n) for n, e in out.items()])


def long_excess(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row a horizon: horizon, excess; unknown ones left out."""
    cells = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"excess_{h}").alias("excess")) for h in cfg.horizons_events])
    return df.select("*", F.inline(cells)).drop(*[f"excess_{h}" for h in cfg.horizons_events]).filter("excess is not null")


def robust(rows: DataFrame, keys: list[str], value: str = "excess", cfg: Config = DEFAULT) -> DataFrame:
    """n, median, winsorised mean and the share above 0 by group: quantiles first, then the clipped mean against them.

    ``rows`` is read for each, so pass it cheap to read again.
    """
    lo, hi = cfg.winsor
    cuts = quantiles(rows, keys, value, [lo, 0.5, hi]).select(*keys, F.col("q").alias("_cut"))
    clipped = F.least(F.greatest(F.col(value), F.col("_cut")[0]), F.col("_cut")[2])
    return rows.join(cuts, keys).groupBy(*keys).agg(
        F.count(value).alias("n"), rounded(F.max(F.col("_cut")[1]), 6).alias("median"), rounded(F.avg(clipped), 6).alias("wmean"), rounded(F.avg(exceeds(F.col(value), F.lit(0.0)).cast("int")), 6).alias("frac_gt0")
    )


SPLITS = ("all", "slope", "volume", "year")


def priced(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Rows at or above the price floor; the study's windows count these alone."""
    return df.filter(F.col("close") >= cfg.price_floor)


def splits(kept: DataFrame, feats: DataFrame, excess: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row a kept fire, horizon and group that it is graded in: (event, horizon, split, value, excess).

    Groups: all; the long average's slope above 0 or not (unknown is not); volume confirmed or not (unknown is not); the year, at 42 days.
    """
    f = feats.select("ticker", "date", "sma200_slope", "vol_ratio")
    rows = kept.join(long_excess(excess, cfg), ["ticker", "date"]).join(f, ["ticker", "date"], "left")
    up = F.coalesce(F.col("sma200_slope") > 0, F.lit(False))
    loud = F.coalesce(F.col("vol_ratio") >= cfg.volume_confirm, F.lit(False))
    cell = lambda split, value: F.struct(F.lit(split).alias("split"), value.alias("value"))
    own = [cell("all", F.lit("all")), cell("slope", F.when(up, "up").otherwise("not_up")), cell("volume", F.when(loud, "confirmed").otherwise("unconfirmed"))]
    year = F.when(F.col("horizon") == 42, cell("year", F.year("date").cast("string")))
    return rows.select("event", "horizon", "excess", F.inline(F.array_compact(F.array(*own, year))))


def base_rows(feats: DataFrame, excess: DataFrame, cfg: Config = DEFAULT, by_date: bool = False) -> DataFrame:
    """(horizon, slope, excess) of every date, once as ``all`` and once by the slope where it is known; with ticker and date if asked."""
    rows = long_excess(excess, cfg).join(feats.select("ticker", "date", "sma200_slope"), ["ticker", "date"], "left")
    slope = F.when(F.col("sma200_slope") > 0, "up").when(F.col("sma200_slope").isNotNull(), "flat_down")
    return rows.select(*(["ticker", "date"] if by_date else []), "horizon", "excess", F.explode(F.array_compact(F.array(F.lit("all"), slope))).alias("slope"))


def summary(graded: DataFrame, base: DataFrame) -> DataFrame:
    """Each event and horizon against all dates, in percent. ``graded`` and ``base`` are ``robust`` over ``splits`` and ``base_rows``."""
    own = graded.filter("split = 'all'").drop("split", "value")
    all_ = base.filter("slope = 'all'").select("horizon", F.col("median").alias("_base"))
    names = F.create_map(*[F.lit(x) for pair in EVENTS.items() for x in pair])
    percent = lambda c: rounded(c * 100.0, 4)
    return own.join(all_, "horizon").select(
        F.col("event").alias("event_type"), names[F.col("event")].alias("event_name"), F.when(F.col("event").isin(BULLISH), "bullish").otherwise("bearish").alias("bias"), F.col("horizon").alias("horizon_days"), "n",
        percent(F.col("median")).alias("median_excess_pct"), percent(F.col("wmean")).alias("wmean_excess_pct"), rounded(F.col("frac_gt0"), 4).alias("frac_gt0"),
        percent(F.col("_base")).alias("base_median_pct"), percent(F.col("median") - F.col("_base")).alias("vs_base_pct"),
    )


def verdict(graded: DataFrame, base: DataFrame, horizon: int = 42, least: int = 30, share: float = 0.6) -> DataFrame:
    """Which events have an edge: better than all dates over all years, and in ``share`` of the years that have ``least`` fires."""
    all_ = base.filter((F.col("slope") == "all") & (F.col("horizon") == horizon)).select(F.col("median").alias("_base"))  # one row
    own = graded.filter(F.col("horizon") == horizon).crossJoin(F.broadcast(all_))
    pooled, yearly = F.col("split") == "all", (F.col("split") == "year") & (F.col("n") >= least)
    out = own.groupBy("event").agg(
        F.max(F.when(pooled, F.col("n"))).alias("n"),
        F.max(F.when(pooled, F.col("median"))).alias("median"),
        F.max("_base").alias("base_median"),
        F.count(F.when(yearly & (F.col("median") > F.col("_base")), 1)).alias("years_better"),
        F.count(F.when(yearly, 1)).alias("years"),
    )
    edge = (F.col("years") > 0) & (F.col("years_better") >= share * F.col("years")) & (F.col("median") > F.col("base_median"))
    return out.filter("n is not null").withColumn("edge", F.coalesce(edge, F.lit(False)))


def monotonic(confluent: DataFrame, horizon: int = 42) -> DataFrame:
    """(slope, buckets, monotonic): whether the median never falls from a bucket to the next. ``confluent`` is ``robust`` by n_bull, horizon and slope."""
    own = confluent.filter(F.col("horizon") == horizon)
    fell = F.col("median") < F.lag("median").over(Window.partitionBy("slope").orderBy("n_bull"))  # at most four rows each
    return own.withColumn("_fell", F.coalesce(fell, F.lit(False))).groupBy("slope").agg(F.count("*").alias("buckets"), (~F.bool_or("_fell")).alias("monotonic"))


def equivalence(bars: DataFrame, bench: DataFrame, betas: DataFrame, excess: DataFrame, anchors: int = 20, cfg: Config = DEFAULT) -> DataFrame:
    """One row: excess returns of a few anchors (those whose md5 is the lowest) worked out again by plain lookups, and how many differ."""
    order = F.md5(F.concat_ws("|", "ticker", F.col("date").cast("string")))
    some = excess.filter("excess_42 is not null").orderBy(order).limit(anchors)
    numbered = bars.select("ticker", "date", "close", F.row_number().over(by_ticker()).alias("_at"))
    here = long_excess(some, cfg).join(numbered, ["ticker", "date"])
    there = numbered.select("ticker", F.col("date").alias("_then"), F.col("close").alias("_c"), F.col("_at").alias("_to"))
    both = here.join(there, (here["ticker"] == there["ticker"]) & (F.col("_to") == F.col("_at") + F.col("horizon"))).drop(there["ticker"])

    def market(df: DataFrame, day: str, out: str) -> DataFrame:
        seen = df.join(bench.select(F.col("date").alias("_b"), F.col("close").alias("_m")), F.col("_b") <= F.col(day))
        return seen.groupBy(*df.columns).agg(F.max_by("_m", "_b").alias(out))

    both = market(market(both, "date", "_m0"), "_then", "_m1").join(betas.select("ticker", "beta"), "ticker", "left")
    again = F.col("_c") / F.col("close") - 1 - shrunk(F.col("beta"), cfg) * (F.col("_m1") / F.col("_m0") - 1)
    return both.agg(F.countDistinct("ticker", "date").alias("anchors"), F.count("*").alias("checked"), F.count(F.when(F.abs(again - F.col("excess")) > 1e-6, 1)).alias("failed"))


def confluence(crossed: DataFrame, kept: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(ticker, date, n_bull): how many kinds of bullish events were kept in the last ``dedup_rows + 1`` rows, three at most."""
    wide = kept.filter(F.col("event").isin(BULLISH)).groupBy("ticker", "date").pivot("event", BULLISH).agg(F.lit(1))
    df = crossed.select("ticker", "date").join(wide, ["ticker", "date"], "left")
    frame = by_ticker().rowsBetween(-cfg.dedup_rows, 0)
    total = sum((F.coalesce(F.max(e).over(frame), F.lit(0)) for e in BULLISH), F.lit(0))
    return df.select("ticker", "date", F.least(total, F.lit(3)).alias("n_bull"))
