"""As-of join by key: each row with the last one of the other side at or before its time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def monthly(time: Column) -> Column:
    return F.year(time) * 12 + F.month(time)


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], matched: str | None = None, strict: bool = False, bucket: Callable[[Column], Column] = monthly) -> DataFrame:
    """``left`` with ``values`` (and, as ``matched``, the time) of the last row of ``right`` with the same keys at or before its ``time``; before it if ``strict``.

    Both sides are sorted together within a key and a ``bucket`` of time (a function that never falls as time grows, and not finer than time), so that a
    key of any size is as many tasks' work as it has buckets. What a bucket's first rows need is carried over: of each key and bucket the last row of
    ``right``, a summary by which windows over buckets, not rows, are filled. Each side is read twice and shuffled once, the summary
    after it is combined; the join with it keeps that partitioning.

    Every row of ``left`` comes back once, repeated ones as often as they are there, with NULL where nothing matches: also where a key or the time is NULL. A
    NULL among the values of a match stays. Of rows of ``right`` with the same keys and time the one with the greatest values, in their order, counts. Columns
    that ``left`` has already can't be ``values``: ValueError.
    """
    keys, values = list(keys), list(values)
    taken = set(left.columns) & {*values, *([matched] if matched else [])}
    if taken:
        raise ValueError(f"both sides have {sorted(taken)}")
    known = reduce(lambda a, k: a & F.col(k).isNotNull(), [*keys, time], F.lit(True))
    found = F.struct(F.col(time).alias("_t"), *values)
    shape = right.select(found.alias("_")).schema["_"].dataType
    own = F.struct(*[F.col(c) for c in left.columns])
    side = F.lit(0 if strict else 1)
    rows = left.filter(known).select(*keys, F.col(time).alias("_time"), side.alias("_side"), own.alias("_left"))
    others = right.filter(known).select(*keys, F.col(time).alias("_time"), F.lit(1 if strict else 0).alias("_side"), found.alias("_right"))
    both = rows.unionByName(others, allowMissingColumns=True).withColumn("_bucket", bucket(F.col("_time")))

    order = ["_time", "_side", "_right"]
    here = F.last("_right", ignorenulls=True).over(Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    inside = both.withColumn("_here", here).filter("_left is not null")
    ends = both.groupBy(*keys, "_bucket").agg(F.max("_right").alias("_end"))
    before = F.last("_end", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.select(*keys, "_bucket", before.alias("_before")).filter("_before is not null")
    out = inside.join(carried, [*keys, "_bucket"], "left").select("_left.*", F.coalesce("_here", "_before").alias("_match"))
    lone = left.filter(~known).withColumn("_match", F.lit(None).cast(shape))
    out = out.unionByName(lone)
    return out.select(*left.columns, *([F.col("_match._t").alias(matched)] if matched else []), *[F.col(f"_match.{v}").alias(v) for v in values])
