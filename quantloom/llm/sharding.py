"""Hilbert-curve sharding.

Metadata dimensions are quantised to ``bits`` bits, a row's cell is placed on the Hilbert curve
through them, rows are ordered by curve index and the order is cut into runs of equal length.
Neighbours on the curve are neighbours in every dimension, so that a file of a shard has narrow
ranges in all of them and a filter on any can skip files.

No step sorts all rows in one task: cells are counted, the at most ``2**(bits * dims)`` counts are
summed along the curve, and a row's place is its cell's start plus its number within the cell.

Nulls: a null dimension is quantised as 0, a null text has no bytes, a null id is an id like any
other. Rows that tie in their cell follow by id and checksum; repeated rows get places of their own. Of a text, long or empty,
only the size and the checksum are taken. Columns with the names of added ones give way. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, ranked, table


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of each row of integer coordinates ``axes`` (n x dims), each below ``2**bits``."""
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        high, low = 1 << level, (1 << level) - 1
        for d in range(dims):
            flip = (x[d] & high) != 0
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where(x[-1] & (1 << level), turn ^ ((1 << level) - 1), turn)
    x ^= turn
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << 1) | ((x[d] >> level) & 1)
    return index


def curve(spark: SparkSession, dims: int, bits: int) -> DataFrame:
    """(cell, hilbert) for every cell; ``2**(bits * dims)`` rows whatever the input."""
    cells = np.arange(1 << (bits * dims))
    axes = np.stack([(cells >> (bits * (dims - 1 - d))) & ((1 << bits) - 1) for d in range(dims)], axis=1)
    return spark.createDataFrame([(int(c), int(h)) for c, h in zip(cells, hilbert_index(axes, bits), strict=True)], "cell long, hilbert long")


VALUES = 100_000


def steps_of(df: DataFrame, column: str, steps: int, values: int = VALUES) -> list[str]:
    """At most ``steps - 1`` values that cut the rows, in the order of the whole text, into ``steps`` groups of about equally many.

    Distinct values are counted, dealt by ranges of about ``values`` of them and summed along each range, the ranges' totals in front; only the cuts come
    to the driver.
    """
    counts = checkpointed(df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("_n")))
    distinct, total = counts.agg(F.count("*"), F.sum("_n")).first()
    if not total:
        return []
    ranged = counts.repartitionByRange(-(-distinct // values), "_value").withColumn("_range", F.spark_partition_id())
    ranged = checkpointed(ranged)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    shifts = ranged.groupBy("_range").agg(F.sum("_n").alias("_all")).select("_range", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_shift"))
    along = Window.partitionBy("_range").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_shift") + F.col("_own")
    cell = lambda rows: F.floor(rows.cast("decimal(38,0)") * steps / F.lit(total).cast("decimal(38,0)"))
    found = ranged.withColumn("_own", F.sum("_n").over(along)).join(shifts, "_range").filter((cell(upto) > cell(upto - F.col("_n"))) & (upto < total))
    return sorted((r[0] for r in found.select("_value").collect()), key=str.encode)


def ordered(df: DataFrame, columns: list[str], bits: int) -> dict[str, Column]:
    """Texts quantised in their order, into steps of about equally many rows: a step is how many of the cuts lie below. Null is 0.

    Whole texts are compared, by bytes, however long their beginnings agree. A value is never cut, so that a very frequent one has a step of its own.
    """
    below = lambda c: sum((F.when(F.col(c) > q, 1).otherwise(0) for q in steps_of(df, c, 1 << bits)), F.lit(0))
    return {c: F.coalesce(below(c), F.lit(0)).cast("long") for c in columns}


def log_size(column: Column, bits: int) -> Column:
    """A size, quantised by its binary logarithm; sizes under 8 share a step."""
    return F.least(F.lit((1 << bits) - 1), F.greatest(F.lit(0), F.floor(F.log2(F.greatest(column, F.lit(1)).cast("double"))) - 2)).cast("long")


def hilbert_shards(df: DataFrame, dims: dict[str, Column], tie: list[str], shards: int, bits: int = 4) -> DataFrame:
    """Adds the quantised ``dims``, ``hilbert``, ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0).

    ``df`` is checkpointed with its dims first: pass the columns that are wanted and no text.
    Shards are runs of the curve order and differ by one row at most (law ``rows``).
    """
    n_dims = len(dims)
    assert bits * n_dims <= 16, "the table of cells is broadcast: at most 65,536 cells"
    df = df.drop("hilbert", "shard", "slot")
    cell = sum((F.col(name) * (1 << (bits * (n_dims - 1 - i))) for i, name in enumerate(dims)), F.lit(0))
    base = df.withColumns(dims)
    base = base.join(F.broadcast(curve(df.sparkSession, n_dims, bits)), cell == F.col("cell"))
    base = checkpointed(base.drop("cell"))
    cells = base.groupBy("hilbert").agg(F.count("*").alias("_n"))
    along = Window.orderBy("hilbert").rowsBetween(Window.unboundedPreceding, -1)  # at most 65,536 rows
    starts = cells.select(F.col("hilbert").alias("_cell"), F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_start"))
    n = base.count()
    out = ranked(base, ["hilbert"], tie, "_rank").join(F.broadcast(starts), F.col("hilbert") == F.col("_cell"))
    out = out.withColumn("_place", F.col("_start") + F.col("_rank"))
    out = out.withColumn("shard", F.expr(f"_place * {shards} div {max(n, 1)}").cast("int"))
    return out.withColumn("slot", F.col("_place") - F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")).drop("_cell", "_start", "_rank", "_place")


def manifest(sharded: DataFrame, columns: list[str], rows: int = 1 << 20) -> DataFrame:
    """Per run of ``rows`` slots of a shard: how many rows, and the range of each of the columns, for skipping files."""
    run = F.expr(f"slot div {rows}L").alias("run")
    return sharded.groupBy("shard", run).agg(F.count("*").alias("n_rows"), *[f(d).alias(f"{n}_{d}") for d in columns for n, f in (("min", F.min), ("max", F.max))])


def matching(runs: DataFrame, **wanted: object) -> DataFrame:
    """The runs of a manifest that may hold rows with these values."""
    for column, value in wanted.items():
        runs = runs.filter(F.lit(value).between(F.col(f"min_{column}"), F.col(f"max_{column}")))
    return runs


def write_shards(sharded: DataFrame, path: str, files: int) -> None:
    """One folder a shard and about ``files`` files in all, each a range of the curve, so that Parquet's statistics are narrow and no task writes a whole shard."""
    sharded.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)


def shard_documents(docs: DataFrame, shards: int = 16, bits: int = 4) -> DataFrame:
    """Documents by source, language and size on the curve: doc_id, size, text_crc32 and the columns of ``hilbert_shards``."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    cells = ordered(docs, ["source", "lang"], bits)
    dims = {"source_cell": cells["source"], "lang_cell": cells["lang"], "size_cell": log_size(F.col("size"), bits)}
    own = docs.select("doc_id", "source", "lang", size.alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    return hilbert_shards(own, dims, ["doc_id", "text_crc32"], shards, bits)


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")
