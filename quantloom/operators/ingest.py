"""Bars on their way in: adjustment, hygiene, the circuit breaker and corporate actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.expr import ratio, rounded

INDEX_TICKERS = ("VIX.INDX", "VVIX.INDX")


def adjusted(raw: DataFrame) -> DataFrame:
    """Open, high and low scaled by adjusted over raw close; bars whose adjusted close is not positive go."""
    factor = F.when(F.col("close") != 0, ratio(F.col("adjusted_close"), F.col("close"))).otherwise(1.0)
    df = raw.filter("adjusted_close > 0").withColumn("_f", factor)
    scaled = {c: rounded(F.col(c) * F.col("_f"), 6) for c in ("open", "high", "low")}
    return df.withColumns(scaled | {"volume": F.coalesce("volume", F.lit(0)), "currency": currency(F.col("ticker"))}).withColumn("close", F.col("adjusted_close")).drop("_f", "adjusted_close")


def currency(ticker: Column) -> Column:
    return F.when(ticker.endswith(".TO") | ticker.endswith(".V"), "CAD").otherwise("USD")


def provider_symbol(ticker: Column) -> Column:
    return F.when(ticker.rlike(r"\.(TO|V|INDX)$"), ticker).otherwise(F.concat(ticker, F.lit(".US")))


def is_index(ticker: Column) -> Column:
    return ticker.isin(*INDEX_TICKERS)


def valid(bars: DataFrame) -> DataFrame:
    return bars.filter("close > 0 and volume >= 0")


def missing(requested: DataFrame, bars: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row: requested, missing and whether so many are missing that nothing should go on.

    ``bars`` is all that was fetched, valid or not: a bar that is not valid is there. Nothing fetched at all is a holiday; bars of others
    alone are not.
    """
    have = bars.select("ticker").distinct().withColumn("_in", F.lit(1))
    own = requested.select("ticker").distinct().withColumn("_asked", F.lit(1))
    counts = own.join(have, "ticker", "full").agg(
        F.count("_asked").alias("requested"), F.count(F.when(F.col("_in").isNull(), 1)).alias("missing"), F.count("_in").alias("_fetched")
    )
    stop = (F.col("_fetched") > 0) & (F.col("missing") > cfg.max_missing_share * F.col("requested"))
    return counts.select("requested", "missing", stop.alias("stop"))


def check(requested: DataFrame, bars: DataFrame, cfg: Config = DEFAULT) -> bool:
    """Raises if the circuit breaker trips; false on a holiday. Reads one row."""
    row = missing(requested, bars, cfg).first()
    if row["stop"]:
        raise RuntimeError(f"{row['missing']} of {row['requested']} tickers have no bar")
    return row["missing"] < row["requested"]


def rebased(bars: DataFrame, splits: DataFrame) -> DataFrame:
    """History restated for later splits (ticker, date, factor): of bars before a split's date prices are divided by its factor and the volume multiplied."""
    hits = bars.select("ticker", "date").join(splits.select("ticker", F.col("date").alias("_on"), "factor"), "ticker").filter("date < _on")
    factor = hits.groupBy("ticker", "date").agg(F.exp(F.sum(F.ln("factor"))).alias("_f"))
    df = bars.join(factor, ["ticker", "date"], "left").withColumn("_f", F.coalesce("_f", F.lit(1.0)))
    prices = {c: F.col(c) / F.col("_f") for c in ("open", "high", "low", "close")}
    return df.withColumns(prices | ({"volume": F.round(F.col("volume") * F.col("_f")).cast("long")} if "volume" in df.columns else {})).drop("_f")


def acted(splits: DataFrame, dividends: DataFrame, since: Column, until: Column) -> DataFrame:
    """Tickers with a split or a dividend dated from ``since`` to ``until``; indexes have none."""
    both = splits.select("ticker", "date").unionByName(dividends.select("ticker", "date"))
    return both.filter(F.col("date").between(since, until) & ~is_index(F.col("ticker"))).select("ticker").distinct()


def shifted(stored: DataFrame, fetched: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Tickers whose stored closes are of another adjustment than what was fetched for the same dates."""
    both = stored.select("ticker", "date", "close").join(fetched.select("ticker", "date", F.col("close").alias("_new")), ["ticker", "date"])
    return both.filter(F.abs(ratio(F.col("close"), F.col("_new")) - 1.0) > tolerance).select("ticker").distinct()


def refreshed(stored: DataFrame, history: DataFrame) -> DataFrame:
    """The stored bars, those of tickers that ``history`` has replaced by it as a whole, so that all rows of a ticker are of one adjustment."""
    return stored.join(history.select("ticker").distinct(), "ticker", "left_anti").unionByName(history.select(stored.columns))


def stale(metadata: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Metadata to fetch again: never fetched, or so many whole days of 24 hours ago."""
    elapsed = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("updated_at").cast("timestamp"))
    return metadata.filter(F.col("updated_at").isNull() | (elapsed >= days * 86_400_000_000))


def due(tickers: DataFrame, metadata: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Of the tickers those whose metadata is stale or was never stored; indexes have none."""
    fresh = metadata.join(stale(metadata.select("ticker", "updated_at"), now, days).select("ticker"), "ticker", "left_anti")
    return tickers.select("ticker").distinct().filter(~is_index(F.col("ticker"))).join(fresh.select("ticker"), "ticker", "left_anti")
