"""Landed bar files, adjusted and upserted by a stream that stops when it has seen all there is."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.shared import checkpointed
from ..operators import ingest, tables
from ..schemas import given, key, part, schema

RAW = "ticker string, date date, open double, high double, low double, close double, adjusted_close double, volume bigint"


def take(spark: SparkSession, landing: str, root: str, checkpoint: str, fmt: str = "json", source: str = "landed") -> None:
    """Upserts files not seen before into ``raw_prices``, in the years that they have bars of; running it again changes nothing.

    A bar is as old as its file: of several versions of it, in one batch or in different ones, the last file's is kept.
    """
    path = f"{root}/raw_prices"

    def batch(rows, _) -> None:
        new = checkpointed(given(ingest.valid(ingest.adjusted(rows)).withColumn("source", F.lit(source)), "raw_prices"))
        tables.merge(spark, path, schema("raw_prices"), new, key("raw_prices"), part("raw_prices"), latest="fetched_at")

    stream = spark.readStream.schema(RAW).format(fmt).load(landing).select("*", F.col("_metadata.file_modification_time").alias("fetched_at"))
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
