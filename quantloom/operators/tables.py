"""Writes to tables of Parquet files: upsert, insert where absent, replace a window, purge.

A table is a folder of partitions (years, windows, or one for all), a partition one of versions. What is there is never
overwritten or moved: new content is written beside and published by renaming it to the next version, through Spark's own
file system. A night touches the partitions that it has rows of, however much history there is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def upserted(target: DataFrame, source: DataFrame, key: list[str], keep: tuple[str, ...] = (), latest: str | None = None) -> DataFrame:
    """The target's rows with the source's in their place or beside them. Columns in ``keep``, and those that the source lacks, stay as the target has them.

    The source wins by key; of several rows of a key in the source the greatest. With ``latest``, a column that both have, the row that has
    the greatest value there wins, be it the target's: what arrived late never gives way to what arrived before it.
    """
    columns = target.columns
    by = [F.desc_nulls_last(latest)] if latest and latest in source.columns else []
    keep = (*keep, *(c for c in columns if c not in source.columns))
    rows = target.withColumn("_new", F.lit(0)).unionByName(_filled(source, target).withColumn("_new", F.lit(1)))
    comparable = [c for c in columns if c not in key]
    w = Window.partitionBy(*key).orderBy(*by, F.desc("_new"), *[F.desc_nulls_last(c) for c in comparable])
    old = Window.partitionBy(*key)
    out = rows.withColumns({c: F.coalesce(F.max(F.when(F.col("_new") == 0, F.col(c))).over(old), F.col(c)) for c in keep}) if keep else rows
    return out.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").select(columns)


def _filled(source: DataFrame, target: DataFrame) -> DataFrame:
    """The target's columns; those that the source lacks are NULL."""
    return source.select(*[F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns])


def inserted(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """The target and those source rows whose key it lacks; a key that the source has twice, its least row."""
    own = Window.partitionBy(*key).orderBy(*[F.col(c) for c in target.columns if c not in key])
    new = _filled(source, target).join(target.select(*key), key, "left_anti").select(target.columns)
    return target.unionByName(new.withColumn("_rank", F.row_number().over(own)).filter("_rank = 1").drop("_rank"))


def replaced(target: DataFrame, source: DataFrame, column: str, values: list) -> DataFrame:
    """The target with everything of these values of ``column`` taken out and the source put in, be it empty."""
    return target.filter(~F.col(column).isin(*values)).unionByName(source.select(target.columns))


def purged(target: DataFrame, where: Column) -> DataFrame:
    """The target without rows for which ``where`` is true."""
    return target.filter(~F.coalesce(where, F.lit(False)))


def without(target: DataFrame, listed: DataFrame, key: list[str]) -> DataFrame:
    return target.join(listed.select(*key), key, "left_anti").select(target.columns)


PART, VERSION = "part", "v"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def versions(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """The partitions of a table and their versions, the oldest first."""
    fs, at = _fs(spark, path)
    found: dict[str, list[int]] = {}
    for f in fs.globStatus(at(f"{path}/{PART}=*/{VERSION}=*")) or []:
        folder = f.getPath()
        found.setdefault(folder.getParent().getName()[len(PART) + 1 :], []).append(int(folder.getName()[len(VERSION) + 1 :]))
    return {part: sorted(v) for part, v in found.items()}


def read(spark: SparkSession, path: str, schema, only: Iterable[str] | Callable[[str], bool] | None = None) -> DataFrame:
    """The table at ``path``, or the partitions in ``only`` or for which it is true: the newest version of each. Columns that files lack are NULL; empty if nothing was ever published."""
    wanted = (lambda _: True) if only is None else only if callable(only) else set(only).__contains__
    paths = [f"{path}/{PART}={part}/{VERSION}={v[-1]}" for part, v in versions(spark, path).items() if wanted(part)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def publish(df: DataFrame, path: str, part: Column | None = None, empty: Iterable[str] = (), order: Iterable[str] = ()) -> list[str]:
    """Writes the partitions that ``df`` has rows of, and those named in ``empty`` without rows, each as a new version; gives their names.

    All is written beside first (``_new-``, which no reader looks at). Then each partition's folder is renamed to a
    version's name that isn't there yet: a reader sees a partition's old version or its new one. A run that
    stops on the way leaves some partitions old and none missing, and can be done again. A rename that does not happen, for one because another
    writer took the name, is an error. The version before stays for readers that have begun; older ones go.
    Rows are rebalanced by partition, large partitions over as many tasks as their bytes ask for, and sorted by ``order`` in each.
    """
    spark = df.sparkSession
    fs, at = _fs(spark, path)
    new = f"{path}/_new-{uuid.uuid4().hex}"
    named = df.withColumn(PART, F.coalesce(part.cast("string"), F.lit("none")) if part is not None else F.lit("all"))
    dealt = named.hint("rebalance", PART).sortWithinPartitions(PART, *order) if part is not None else named
    dealt.write.partitionBy(PART).parquet(new)
    before, done = versions(spark, path), []
    staged = {f.getPath().getName()[len(PART) + 1 :]: f.getPath() for f in fs.globStatus(at(f"{new}/{PART}=*")) or []}
    for name in empty if part is not None else ["all"]:
        if name not in staged:
            spark.createDataFrame([], df.schema).write.parquet(f"{new}/{PART}={name}")
            staged[name] = at(f"{new}/{PART}={name}")
    for name, folder in staged.items():
        target = at(f"{path}/{PART}={name}/{VERSION}={max(before.get(name, [0])) + 1}")
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(folder, target):
            raise OSError(f"{target} could not be published")
        done.append(name)
    for name in done:
        for old in before.get(name, [])[:-1]:
            fs.delete(at(f"{path}/{PART}={name}/{VERSION}={old}"), True)
    fs.delete(at(new), True)
    return done


def parts_of(rows: DataFrame, part: Column | None) -> list[str]:
    """Partitions that the rows belong to: a value for each, years or window lengths."""
    if part is None:
        return ["all"]
    return [r[0] for r in rows.select(F.coalesce(part.cast("string"), F.lit("none"))).distinct().collect()]


def merge(
    spark: SparkSession, path: str, schema, source: DataFrame, key: list[str], part: Column | None = None, ignore: bool = False, keep: tuple[str, ...] = (), latest: str | None = None
) -> list[str]:
    """Upserts (or inserts where absent) into a table: only partitions that the source has rows of are read and written.

    ``part`` is made of key columns, so that a key stays in its partition. The source is computed twice, so pass it cheap to read.
    """
    target = read(spark, path, schema, parts_of(source, part))
    return publish(inserted(target, source, key) if ignore else upserted(target, source, key, keep, latest), path, part, order=key)


def replace_rows(spark: SparkSession, path: str, schema, rows: DataFrame, listed: DataFrame, key: list[str], part: Column, within: Callable[[str], bool] = lambda _: True) -> list[str]:
    """Everything that a table has of the listed keys gives way to ``rows``; partitions that have neither are not touched.

    ``within`` names the partitions that can have listed keys, others are not looked at. ``rows`` and ``listed`` are read several times.
    """
    held = read(spark, path, schema, within).join(listed.select(*key), key, "left_semi")
    touched = sorted({*parts_of(rows, part), *parts_of(held, part)})
    target = read(spark, path, schema, touched)
    return publish(without(target, listed, key).unionByName(_filled(rows, target)), path, part, touched, order=key)


def replace(spark: SparkSession, path: str, source: DataFrame, column: str, values: list) -> list[str]:
    """Replaces what a table partitioned by ``column`` has of these values; the others are not touched."""
    return publish(source.filter(F.col(column).isin(*values)), path, F.col(column), [str(v) for v in values])


def save(df: DataFrame, path: str, part: Column | None = None) -> None:
    """Publishes all of a table; partitions that it no longer has become empty."""
    publish(df, path, part, versions(df.sparkSession, path) if part is not None else ())
