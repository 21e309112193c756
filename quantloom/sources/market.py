"""Market tables derived from an order-line star schema: prices walk by the discounts of a brand's lines.

Steps are whole numbers, so that a price is one ``exp`` of an exact sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STEP = "cast(sum(cast(round(l_discount * 100) as bigint) - 5) as bigint)"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    part = load(spark, sf_dir, "part").selectExpr("p_partkey as l_partkey", f"{key} as ticker")
    lines = load(spark, sf_dir, "lineitem").selectExpr("l_partkey", "cast(l_shipdate as date) as date", "l_discount", "l_tax", "l_quantity")
    daily = lines.join(part, "l_partkey").groupBy("ticker", "date")
    return daily.agg(
        F.expr(_STEP).alias("step"), F.expr("cast(max(cast(round(l_tax * 100) as bigint)) as bigint)").alias("hi"), F.expr("cast(sum(l_quantity) as bigint)").alias("volume")
    ).selectExpr("*", "sum(step) over (partition by ticker order by date rows between unbounded preceding and current row) as cum")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, date, open, high, low, close, volume) of 25 brands."""
    df = _lines(spark, sf_dir, "p_brand").selectExpr("ticker", "date", "hi", "volume", "100 * exp(0.002 * cum) as close", "100 * exp(0.002 * (cum - step)) as open")
    return df.selectExpr("ticker", "date", "open", "greatest(open, close) * (1 + cast(hi as double) / 1000) as high", "least(open, close) * (1 - cast(hi as double) / 1000) as low", "close", "volume")


def etf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, date, close) of six proxies, by part type."""
    return _lines(spark, sf_dir, "p_type").selectExpr("ticker", "date", "100 * exp(0.002 * cum) as close")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, date, close) of the benchmark, one row a day."""
    daily = load(spark, sf_dir, "lineitem").groupBy(F.expr("cast(l_shipdate as date)").alias("date")).agg(F.expr(_STEP).alias("step"))
    summed = daily.selectExpr("date", "sum(step) over (order by date rows between unbounded preceding and current row) as cum")
    return summed.selectExpr("'SPY' as ticker", "date", "100 * exp(0.0002 * cum) as close")


def index_vol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, vix, vvix), one row a day."""
    daily = load(spark, sf_dir, "lineitem").groupBy(F.expr("cast(l_shipdate as date)").alias("date"))
    return daily.agg(
        F.expr("cast(10 + 4 * (count(*) % 9) as double)").alias("vix"), F.expr("cast(80 + (sum(l_linenumber) % 45) as double)").alias("vvix")
    )
