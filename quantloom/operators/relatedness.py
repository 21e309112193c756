"""Windowed correlations of all pairs of tickers and betas against proxies."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.expr import by_ticker, ratio, rounded


def calendar_returns(bars: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """(ticker, date, r): the daily return on the calendar of all tickers; after a gap there is none.

    The calendar is one row a day whatever the number of tickers; ``calendar`` has the dates where ``bars`` are of some tickers only.
    """
    days = (bars if calendar is None else calendar).select("date").distinct().withColumn("_day", F.row_number().over(Window.orderBy("date")))
    df = bars.select("ticker", "date", "close").join(days, "date")
    w = by_ticker()
    r = F.when(F.lag("_day").over(w) == F.col("_day") - 1, ratio(F.col("close"), F.lag("close").over(w)) - 1.0)
    return df.select("ticker", "date", r.alias("r"))


def masked(r: Column, cfg: Config = DEFAULT) -> Column:
    """Returns that a split or a data error makes, NULL; the bounds themselves stay."""
    return F.when((1.0 + r).between(1 / cfg.max_ratio, cfg.max_ratio), r)


def eligible(bars: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(ticker, median_close) of tickers at or above the price floor."""
    return bars.groupBy("ticker").agg(F.median("close").alias("median_close")).filter(F.col("median_close") >= cfg.price_floor)


def last_days(returns: DataFrame, days: int) -> DataFrame:
    """Rows of the last so many calendar days, the cut day left out."""
    end = returns.agg(F.max("date").alias("_end"))  # one row
    return returns.join(F.broadcast(end), F.col("date") > F.date_sub("_end", days)).drop("_end")


def _centred(returns: DataFrame) -> DataFrame:
    """Each series less its own mean: r is the same and the sums don't cancel."""
    return returns.filter("r is not null").withColumn("r", F.col("r") - F.avg("r").over(Window.partitionBy("ticker")))


def _pearson() -> Column:
    n, x, y, xy, xx, yy = (F.col(c) for c in ("n", "sx", "sy", "sxy", "sxx", "syy"))
    return ratio(n * xy - x * y, F.sqrt(F.greatest((n * xx - x * x) * (n * yy - y * y), F.lit(0.0))))


def correlation_pairs(returns: DataFrame, window_days: int, cfg: Config = DEFAULT) -> DataFrame:
    """(ticker_a, ticker_b, window_days, pearson_r, n_obs) with a < b, pairwise complete, |r| at least ``min_abs_r``.

    A join on the date: for up to a few hundred tickers. ``correlation_blocks`` is for thousands.
    """
    x = _centred(last_days(returns, window_days))
    a, b = x.select("date", F.col("ticker").alias("ticker_a"), F.col("r").alias("x")), x.select("date", F.col("ticker").alias("ticker_b"), F.col("r").alias("y"))
    sums = a.join(b, "date").filter("ticker_a < ticker_b").groupBy("ticker_a", "ticker_b").agg(
        F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.sum(F.expr("x * y")).alias("sxy"), F.sum(F.expr("x * x")).alias("sxx"), F.sum(F.expr("y * y")).alias("syy")
    )
    return _kept(sums, window_days, cfg)


def _kept(sums: DataFrame, window_days: int, cfg: Config) -> DataFrame:
    out = sums.filter(F.col("n") >= cfg.min_overlap).withColumn("r", _pearson())
    out = out.filter(F.abs("r") >= cfg.min_abs_r)
    return out.select("ticker_a", "ticker_b", F.lit(window_days).alias("window_days"), rounded(F.col("r"), 6).alias("pearson_r"), F.col("n").alias("n_obs"))


def correlation_blocks(returns: DataFrame, window_days: int, cfg: Config = DEFAULT, block: int = 500) -> DataFrame:
    """The same pairs for thousands of tickers: tickers in blocks, a task for each pair of blocks, six masked matrix products in it.

    A block holds at most about ``block`` tickers for the days of one window; each block is sent to as many
    tasks as there are blocks.
    """
    x = _centred(last_days(returns, window_days))
    tickers = x.select("ticker").distinct().count()
    blocks = max(1, -(-tickers // block))
    x = x.withColumn("_own", F.pmod(F.xxhash64("ticker"), F.lit(blocks)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    sent = x.withColumn("_other", other).withColumn("_i", F.least("_own", "_other")).withColumn("_j", F.greatest("_own", "_other"))

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["_i"].iloc[0]), int(pdf["_j"].iloc[0])
        wide = pdf.drop_duplicates(["ticker", "date"]).pivot(index="date", columns="ticker", values="r")
        own = pdf.drop_duplicates("ticker").set_index("ticker")["_own"].reindex(wide.columns).to_numpy()
        left, right = wide.loc[:, own == i], wide.loc[:, own == j]
        a, b = left.to_numpy(), right.to_numpy()
        ma, mb = (~np.isnan(a)).astype(float), (~np.isnan(b)).astype(float)
        a, b = np.nan_to_num(a), np.nan_to_num(b)
        parts = {"n": ma.T @ mb, "sx": a.T @ mb, "sy": ma.T @ b, "sxy": a.T @ b, "sxx": (a * a).T @ mb, "syy": ma.T @ (b * b)}
        names = pd.MultiIndex.from_product([left.columns, right.columns], names=["p", "q"]).to_frame(index=False)
        out = pd.concat([names, pd.DataFrame({k: v.ravel() for k, v in parts.items()})], axis=1)
        out = out[(out.p < out.q) if i == j else (out.p != out.q)]
        flip = out.p > out.q
        out.loc[flip, ["p", "q", "sx", "sy", "sxx", "syy"]] = out.loc[flip, ["q", "p", "sy", "sx", "syy", "sxx"]].to_numpy()
        out["n"] = out["n"].round().astype("int64")
        out = out[out["n"] >= cfg.min_overlap].rename(columns={"p": "ticker_a", "q": "ticker_b"})
        return out[["ticker_a", "ticker_b", "n", "sx", "sy", "sxy", "sxx", "syy"]].infer_objects()

    schema = "ticker_a string, ticker_b string, n long, sx double, sy double, sxy double, sxx double, syy double"
    return _kept(sent.groupBy("_i", "_j").applyInPandas(products, schema), window_days, cfg)


def peers(pairs: DataFrame, k: int = 5, least: float = 0.60) -> DataFrame:
    """(ticker, window_days, rank, peer, pearson_r): each ticker's ``k`` most correlated others with at least ``least``, ties by ticker.

    ``pairs`` has each pair once; both directions count. A ticker's others are dealt into 16 groups, of each of which the best ``k`` go on, so that
    the list of a ticker that is like all others isn't sorted in one piece.
    """
    known = pairs.filter(F.col("pearson_r") >= least)
    cells = [F.struct(F.col(a).alias("ticker"), F.col(b).alias("peer")) for a, b in (("ticker_a", "ticker_b"), ("ticker_b", "ticker_a"))]
    both = known.select("window_days", "pearson_r", F.inline(F.array(*cells)))
    own = Window.partitionBy("ticker", "window_days").orderBy(F.desc("pearson_r"), "peer")
    dealt = Window.partitionBy("ticker", "window_days", "_deal").orderBy(F.desc("pearson_r"), "peer")
    best = both.withColumn("_deal", F.pmod(F.xxhash64("peer"), F.lit(16))).withColumn("_own", F.row_number().over(dealt)).filter(F.col("_own") <= k)
    return best.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k).select("ticker", "window_days", "rank", "peer", "pearson_r")


def betas(returns: DataFrame, proxies: DataFrame, window_days: int, cfg: Config = DEFAULT) -> DataFrame:
    """(ticker, etf_proxy, window_days, beta, n_obs): covariance over common days by the proxy's own variance.

    Proxies are a handful of series; the join on the date is left to the planner.
    """
    x = last_days(returns, window_days).filter("r is not null")
    y = last_days(proxies, window_days).filter("r is not null").select("date", F.col("ticker").alias("etf_proxy"), F.col("r").alias("m"))
    own = y.groupBy("etf_proxy").agg(F.var_samp("m").alias("v"), F.count("*").alias("k")).filter((F.col("k") >= cfg.min_overlap) & (F.col("v") != 0))
    both = x.join(y, "date").groupBy("ticker", "etf_proxy").agg(F.covar_samp("r", "m").alias("c"), F.count("*").alias("n_obs"))
    out = both.filter(F.col("n_obs") >= cfg.min_overlap).join(own, "etf_proxy")
    return out.select("ticker", "etf_proxy", F.lit(window_days).alias("window_days"), rounded(ratio(F.col("c"), F.col("v")), 6).alias("beta"), "n_obs")


def fallbacks(rows: DataFrame, betas: DataFrame) -> DataFrame:
    """One row: how many tickers there are, and how many have no beta and fall back to 1."""
    own = betas.filter("beta is not null").select("ticker").distinct().withColumn("_in", F.lit(1))
    return rows.select("ticker").distinct().join(own, "ticker", "left").agg(F.count("*").alias("tickers"), F.count(F.when(F.col("_in").isNull(), 1)).alias("fallbacks"))


def shrunk(beta: Column, cfg: Config = DEFAULT) -> Column:
    a, b = cfg.beta_shrink
    return F.coalesce(a * beta + b, F.lit(1.0))
