"""File sources and sinks: landed provider files, the universe document, event files and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROVIDER_BARS = "date date, open double, high double, low double, close double, adjusted_close double, volume bigint"
COMPANY = "ticker string, Name string, Sector string, Industry string, MarketCapitalization bigint, Exchange string"
PROVIDER_SYMBOLS = "Code string, Name string, Exchange string, Currency string, Type string"
ENTRY = "struct<exchange:string,has_data:boolean,cap_tier:string,provider_sector:string,provider_industry:string,signal_categories:array<string>>"


def bars(spark: SparkSession, path: str) -> DataFrame:
    """Daily bars as a provider gives them, one folder a ticker: ``ticker=XYZ/*.json``."""
    return spark.read.schema(f"{PROVIDER_BARS}, ticker string").json(path)


def actions(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Splits or dividends: (ticker, date, factor or amount); none landed is none."""
    value = "factor" if kind == "split" else "amount"
    return spark.read.schema(f"ticker string, date date, kind string, {value} double").json(path).filter(F.col("kind") == kind).drop("kind")


def symbols(spark: SparkSession, path: str) -> DataFrame:
    named = {"Code": "code", "Name": "name", "Exchange": "venue", "Currency": "currency", "Type": "type"}
    return spark.read.schema(PROVIDER_SYMBOLS).json(path).withColumnsRenamed(named)


def universe(spark: SparkSession, path: str) -> DataFrame:
    """The universe document, one JSON object of ticker -> entry, as rows."""
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", f"map<string,{ENTRY}>")).alias("ticker", "entry"))
    return entries.select("ticker", "entry.*")


def tickers(universe: DataFrame, exchanges: list[str] | None = None, extra: DataFrame | None = None) -> DataFrame:
    """Tickers with data, of some exchanges; ``extra`` (proxies, indexes) is added as it is."""
    own = universe.filter("has_data")
    own = own.filter(F.col("exchange").isin(*exchanges)) if exchanges else own
    own = own.select("ticker")
    return own.unionAll(extra.select("ticker")) if extra is not None else own


def metadata(spark: SparkSession, path: str) -> DataFrame:
    return company(spark.read.schema(COMPANY).json(path))


def company(raw: DataFrame) -> DataFrame:
    """Company data as a provider gives them, as rows of ``ticker_metadata``."""
    named = {"Name": "name", "Sector": "sector", "Industry": "industry", "MarketCapitalization": "market_cap", "Exchange": "exchange"}
    df = raw.withColumnsRenamed(named)
    return df.withColumns({"provider_sector": F.col("sector"), "provider_industry": F.col("industry"), "updated_at": F.current_timestamp()})


def write_universe(df: DataFrame, path: str, backup: bool = False) -> None:
    """Overwrites the document; with ``backup`` what was there is copied to ``path.bak`` first."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    at, conf = hadoop.Path(path), spark._jsc.hadoopConfiguration()
    fs = at.getFileSystem(conf)
    if backup and fs.exists(at):
        hadoop.FileUtil.copy(fs, at, fs, hadoop.Path(f"{path}.bak"), False, True, conf)
    df.write.mode("overwrite").json(path)


def write_events(fires: DataFrame, folder: str) -> None:
    """All fires as Parquet, and CSV with a header, a folder for each event."""
    fires.write.mode("overwrite").parquet(f"{folder}/events")
    fires.write.mode("overwrite").partitionBy("event").option("header", True).csv(f"{folder}/events_csv")


def write_summary(df: DataFrame, folder: str, name: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")  # a report: a few rows
