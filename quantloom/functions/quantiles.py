"""Exact quantiles of groups of any size, without a group in one task.

A group's ranks are narrowed down by counts: its range is cut into ``buckets`` equal steps, the rows of each are counted with
their least and greatest value, and the buckets that hold a wanted rank are the next ranges. When a range has ``limit`` rows or a
single value, its ranks are read off. A pass is one aggregation that is combined before the shuffle; all groups
and all ranks go through the same passes. Values at heavy ties end in ranges of one value, however many rows have it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed

LIMIT = 1 << 16
SMALL = 20_000


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on &= a[k].eqNullSafe(b[f"_{k}"])
    return on


def _named(df: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_{k}") for k in keys], *columns)


def _hinted(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast where it has few rows, which is known; else what the planner thinks best."""
    return F.broadcast(df) if rows <= SMALL else df


def quantiles(rows: DataFrame, keys: Sequence[str], value: str, at: Sequence[float], limit: int = LIMIT, buckets: int = 1024) -> DataFrame:
    """(keys, n, q): how many finite values a group has and its quantiles ``at`` (0 to 1) in their order, interpolated between neighbours.

    ``rows`` is read once for the sizes and once for each pass, so pass it cheap to read again. Nulls, NaN and infinite values are left out;
    a null key is a group like others; a group without values has no row. Groups of ``limit`` rows at most are settled in one aggregation.
    """
    keys, x = list(keys), F.col("_x")
    rows = rows.select(*keys, F.col(value).cast("double").alias("_x")).filter("_x is not null and not isnan(_x) and abs(_x) < double('infinity')")
    sizes = checkpointed(rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")))
    seen = sizes.agg(F.count("*"), F.count(F.when(F.col("n") > limit, 1))).first()
    groups, large = seen[0], seen[1]
    percentile = F.percentile("_x", F.array(*[F.lit(p) for p in at])).alias("q")
    if not large:
        return _hinted(rows.groupBy(*keys).agg(F.count("*").alias("n"), percentile), groups)
    big, small = sizes.filter(F.col("n") > limit), _named(sizes.filter(F.col("n") <= limit), keys)
    short = rows.join(_hinted(small, groups - large), _same(rows, small, keys), "left_semi").groupBy(*keys).agg(F.count("*").alias("n"), percentile) if groups > large else None

    places = [F.col("n") - 1 if p >= 1 else (F.col("n") - 1) * F.lit(float(p)) for p in at]
    ranks = F.array_sort(F.array_distinct(F.array(*[f(p).cast("long") for p in places for f in (F.floor, F.ceil)])))
    open_ = checkpointed(big.select(*keys, "_lo", "_hi", F.lit(0).cast("long").alias("_below"), F.col("n").alias("_m"), ranks.alias("_ranks")))
    done = None
    while True:
        over = (F.col("_m") <= limit) | (F.col("_lo") == F.col("_hi"))
        ready = open_.filter(over)
        done = ready if done is None else done.unionByName(ready)
        open_ = open_.filter(~over)
        n = open_.count()
        if not n:
            break
        open_ = checkpointed(_narrowed(rows, open_, n, keys, buckets))
    done = checkpointed(done)
    found = _read_off(rows, done, done.count(), keys)
    values = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_values"))  # two for each of ``at``
    named = _named(big, keys, "n")
    out = values.join(_hinted(named, large), _same(values, named, keys)).select(*keys, "n", "_values")

    def between(place: Column) -> Column:
        low, high = F.col("_values")[F.floor(place).cast("long")], F.col("_values")[F.ceil(place).cast("long")]
        share = place - F.floor(place)
        return F.when(share == 0, low).otherwise((1 - share) * low + share * high)

    out = out.select(*keys, "n", F.array(*[between(p) for p in places]).alias("q"))
    return _hinted(checkpointed(out if short is None else out.unionByName(short)), groups)


def _ranged(rows: DataFrame, ranges: DataFrame, n: int, keys: list[str], *columns: str) -> DataFrame:
    """Rows beside each range of their group that they lie in."""
    named = _named(ranges, keys, "_lo", "_hi", "_below", *columns)
    return rows.join(_hinted(named, n), _same(rows, named, keys) & F.col("_x").between(F.col("_lo"), F.col("_hi"))).drop(*[f"_{k}" for k in keys])


def _narrowed(rows: DataFrame, ranges: DataFrame, n: int, keys: list[str], buckets: int) -> DataFrame:
    """The buckets of the ranges that hold wanted ranks."""
    width, half = F.col("_hi") - F.col("_lo"), lambda c: F.col(c) / 2  # halves where the difference would be infinite
    part = F.when(width < float("inf"), (F.col("_x") - F.col("_lo")) / width).otherwise((half("_x") - half("_lo")) / (half("_hi") - half("_lo")))
    step = F.floor(part * buckets)
    inside = _ranged(rows, ranges, n, keys, "_ranks").withColumn("_bucket", F.least(step, F.lit(buckets - 1)))
    counts = inside.groupBy(*keys, "_below", "_bucket").agg(F.count("*").alias("_m"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.first("_ranks").alias("_ranks"))
    before = Window.partitionBy(*keys, "_below").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most ``buckets`` rows
    counts = counts.withColumn("_below", F.col("_below") + F.coalesce(F.sum("_m").over(before), F.lit(0)))
    own = F.filter("_ranks", lambda k: (k >= F.col("_below")) & (k < F.col("_below") + F.col("_m")))
    return counts.withColumn("_ranks", own).filter(F.size("_ranks") > 0).select(*keys, "_lo", "_hi", "_below", "_m", "_ranks")


def _read_off(rows: DataFrame, ranges: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """(keys, _rank, _value) of every wanted rank: a range's only value, or its place among the sorted values, which are few."""
    single = ranges.filter("_lo = _hi").select(*keys, F.explode("_ranks").alias("_rank"), F.col("_lo").alias("_value"))
    many = ranges.filter("_lo < _hi")
    lists = _ranged(rows, many, n, keys, "_ranks").groupBy(*keys, "_below").agg(F.sort_array(F.collect_list("_x")).alias("_sorted"), F.first("_ranks").alias("_ranks"))
    picked = lists.select(*keys, "_below", "_sorted", F.explode("_ranks").alias("_rank"))
    return single.unionByName(picked.select(*keys, "_rank", F.element_at("_sorted", (F.col("_rank") - F.col("_below") + 1).cast("int")).alias("_value")))


def medians(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], limit: int = LIMIT) -> DataFrame:
    """(keys, a median for each column named as the column is): one table of cells for all columns."""
    cells = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_value")) for c in columns])
    long = rows.select(*keys, F.inline(cells)).filter("_value is not null")
    found = quantiles(long, [*keys, "_column"], "_value", [0.5], limit)
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_column") == c, F.col("q")[0])).alias(c) for c in columns])
