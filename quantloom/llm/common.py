"""Shared Spark pieces of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import math
import os
import time
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import shared
from .buffers import forget_powers


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where the driver has it; on a cluster ship it with --py-files.

    Arrow batches of texts are bounded by bytes too (4 MB), where the session doesn't say otherwise: ten thousand long texts would be gigabytes.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(4 << 20))
    root, env = str(Path(__file__).parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    importable(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: it cuts the lineage and outlives executors."""
    importable(df.sparkSession)
    return shared.checkpointed(df)


def ranked(df: DataFrame, keys: list[str], tie: list[str], out: str, ways: int = 64) -> DataFrame:
    """Adds ``out``: a gapless number from 0 within each group of ``keys``.

    A group is dealt over ``ways`` sub-groups by a hash of ``tie``, each numbered by itself and
    shifted by the sizes of those before it, so a group with a third of all rows is not one task's work.
    ``df`` is read twice and should be cheap to read again (checkpointed).
    """
    df = df.withColumn("_way", F.pmod(F.xxhash64(*tie), F.lit(ways)))
    sizes = df.groupBy(*keys, "_way").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_way").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_way").alias("_w"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    own = Window.partitionBy(*keys, "_way").orderBy(*tie)
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_way") == F.col("_w")]
    numbered = df.withColumn("_own", F.row_number().over(own) - 1)
    return numbered.join(shifts, on).withColumn(out, F.col("_before") + F.col("_own")).drop("_way", "_w", "_own", "_before", *[f"_k{i}" for i in range(len(keys))])


SIEVE_BITS = 24


def sieved(df: DataFrame, column: str, members: DataFrame, out: str) -> DataFrame:
    """Adds ``out``: false for rows whose ``column`` is surely not among the values of ``members``' first column.

    A bitmap of ``2**SIEVE_BITS`` bits, as at most 262,144 rows of 64, is broadcast whatever the input; where it fills up
    more rows pass that an exact join then settles. Big rows that a join would drop are so kept from being shuffled.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << SIEVE_BITS))
    marks = members.select(bit(members.columns[0]).alias("_bit")).withColumn("_word", F.expr("_bit div 64"))
    words = marks.groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, cast(_bit % 64 as int)))").alias("_mask"))
    own = df.withColumn("_bit", bit(column)).withColumn("_at", F.expr("_bit div 64"))
    met = own.join(F.broadcast(words), F.col("_at") == F.col("_word"), "left")
    return met.withColumn(out, F.coalesce(F.expr("shiftright(_mask, cast(_bit % 64 as int)) & 1L = 1L"), F.lit(False))).drop("_bit", "_at", "_word", "_mask")


def parts_for(df: DataFrame, column: str, mb: int = 16) -> int:
    """How many groups of about ``mb`` MB of UTF-8 the column fills; it grows with the input."""
    total = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(1, math.ceil(total / (mb << 20)))


_libc = ctypes.CDLL(None)
_leaned = 0.0


def lean() -> None:
    """In a task, before its work and after it: hands what the worker process no longer uses back to the machine.

    Python workers are used again and otherwise keep the most that any task ever made them take. Large blocks are
    mapped by themselves (``mallopt``, where the C library has it), so that they go back when they are freed.
    Where groups are many and small it acts every half second at most.
    """
    global _leaned
    now = time.monotonic()
    if now < _leaned + 0.5:
        return
    if not _leaned and hasattr(_libc, "mallopt"):
        _libc.mallopt(-3, 1 << 18)  # M_MMAP_THRESHOLD
        _libc.mallopt(-1, 1 << 20)  # M_TRIM_THRESHOLD
    _leaned = now
    forget_powers()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = 4 << 20, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that a slice has at most ``rows`` rows and, but for one long text, ``limit`` bytes."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        at = size = 0
        for i, n in enumerate(sizes):
            if i > at and (size + n > limit or i - at >= rows):
                yield batch.slice(at, i - at)
                at, size = i, 0
            size += n
        if at < len(sizes):
            yield batch.slice(at)
