"""Curation of the ticker universe by symbol rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks of instruments that are no common stock.
TEST_SYMBOL = "^Z[A-Z]ZZT$"
HYPHENATED = ("-WT", "-WS", "-RT", "-UN")
DOTTED_US = (".WT", ".WS", ".RT")
DOTTED = (".WT", ".WA", ".WB", ".WS", ".RT", ".RH", ".PR", ".PRA", ".PRB", ".PRC", ".PRD", ".PRE", ".U")
FIFTH = ("W", "R", "U")
EQUITY_TYPES = ("Common Stock", "Ordinary Shares")
NAMES = ("Warrant", " Rights", " Units", " Unit Trust", "Acquisition Corp", "Acquisition Co ", "SPAC")
# exchange: (internal name, currency, venues or None)
EXCHANGES = {"US": ("us", "USD", ("NYSE", "NASDAQ")), "TO": ("tsx", "CAD", None), "V": ("tsx_venture", "CAD", None)}


def ends(c: Column, suffixes: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [c.endswith(s) for s in suffixes])


def _rooted(df: DataFrame, roots: DataFrame, code: str) -> DataFrame:
    """Adds ``_rooted``: five characters, the last a warrant's, a right's or a unit's, and the first four a code of ``roots``."""
    known = roots.select(F.col(code).alias("_root")).distinct().withColumn("_rooted", F.lit(True))
    fifth = (F.length(code) == 5) & ~F.col(code).contains("-") & F.substring(code, 5, 1).isin(*FIFTH)
    keyed = df.withColumn("_key", F.when(fifth, F.substring(code, 1, 4)))
    return keyed.join(known, F.col("_key") == F.col("_root"), "left").withColumn("_rooted", F.coalesce("_rooted", F.lit(False))).drop("_key", "_root")


def audit(universe: DataFrame) -> DataFrame:
    """(ticker, exchange, reason) of listed tickers that are no stock; rules apply to US listings alone."""
    us = universe.filter("exchange = 'us'")
    t = F.col("ticker")
    last = F.substring("ticker", 5, 1)
    reason = (
        F.when(t.rlike(TEST_SYMBOL), "nasdaq_test_symbol")
        .when(ends(t, HYPHENATED), "hyphenated_suffix")
        .when(ends(t, DOTTED_US), "dotted_suffix")
        .when(F.col("_rooted"), F.when(last == "W", "nasdaq5_warrant").when(last == "R", "nasdaq5_rights").otherwise("nasdaq5_unit"))
    )
    return _rooted(us, us, "ticker").withColumn("reason", reason).filter("reason is not null").select("ticker", "exchange", "reason")


def quality_listing(symbols: DataFrame, exchange: str, accepted: DataFrame | None = None) -> DataFrame:
    """Symbols (code, name, type, currency, venue) that are common stock of the exchange.

    ``accepted`` (code) is the universe so far: a US code of five letters goes as a warrant, right or unit if its root is in there.
    """
    internal, money, venues = EXCHANGES[exchange]
    upper, name = F.upper("code"), F.lower("name")
    keep = F.col("type").isin(*EQUITY_TYPES) & (F.col("currency") == money) & (F.coalesce("code", F.lit("")) != "") & ~ends(upper, DOTTED)
    for part in NAMES:
        keep = keep & ~F.coalesce(name, F.lit("")).contains(part.lower())
    if venues:
        keep = keep & F.col("venue").isin(*venues)
    df = symbols.filter(keep)
    if internal == "us":
        df = df.filter(~F.col("code").rlike(TEST_SYMBOL) & ~ends(upper, HYPHENATED))
        if accepted is not None:
            df = _rooted(df, accepted, "code").filter(~F.col("_rooted")).drop("_rooted")
    return df


def merged(existing: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """Universe entries with gaps filled: what is there stays, what is NULL is taken from ``new``, what is new is added."""
    b = new.select(F.col("ticker").alias("_t"), *[F.col(c).alias(f"_{c}") for c in columns])
    both = existing.join(b, F.col("ticker") == F.col("_t"), "full")
    return both.select(F.coalesce("ticker", "_t").alias("ticker"), *[F.coalesce(c, f"_{c}").alias(c) for c in columns])


def migrated(entries: DataFrame) -> DataFrame:
    """Universe entries of the older form, which says ``categories`` for signal_categories, in the newer one; lists that nobody gave are empty."""
    none = F.array().cast("array<string>")
    given = [F.col(c) for c in ("signal_categories", "categories") if c in entries.columns]
    df = entries.withColumn("signal_categories", F.coalesce(*given, none)).drop("categories")
    return df.withColumns({c: F.lit(None).cast("string") for c in ("cap_tier", "provider_sector", "provider_industry") if c not in df.columns})


def counts(entries: DataFrame) -> DataFrame:
    """One row: tickers in all, by exchange, and those without data."""
    where = lambda c: F.count(F.when(c, 1))
    listed = {f"{name}_listed": where(F.col("exchange") == name) for name, *_ in EXCHANGES.values()}
    return entries.agg(F.count("*").alias("total_unique_tickers"), *[c.alias(n) for n, c in listed.items()], where(~F.col("has_data")).alias("no_data_tickers"))
