"""Column helpers: guarded division, portable rounding, bands, full frames and the exponential average."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from math import log1p

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEY, TIME = "ticker", "date"


def by_ticker() -> WindowSpec:
    """The one window key of the library: textually equal keys share an exchange and a sort."""
    return Window.partitionBy(KEY).orderBy(TIME)


SAME = 1e-9


def exceeds(a: Column, b: Column) -> Column:
    """a > b by more than the noise of sums: averages of equal prices stay equal."""
    return a - b > SAME


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return a / F.nullif(b, F.lit(0.0))


def _decimal(c: Column, digits: int) -> Column:
    """A double as a decimal, half up from its tenth place.

    SQL engines take that place from the double itself, times 1e10. Spark's cast takes the shortest text that reads back as the double, and of a large
    one that can be a half where the double is under it. So the tenths of a billionth are counted here, as whole numbers: ``high`` * 2**32 + ``low``.
    """
    unit, over = 10 ** (10 - digits), 2**32
    places = F.rint(c * 1e10)
    high, low = (places / float(over)).cast("long"), (places % float(over)).cast("long")
    whole = lambda a: F.call_function("div", a, F.lit(unit))
    n = whole(high) * over + whole(high % unit * over + low + (F.signum(places) * (unit // 2)).cast("long"))
    fits = F.abs(c) < 1e18  # what is larger fails in the cast, or is NULL if it is no number
    kind = f"decimal(18,{digits})"
    return F.when(fits, (n.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(kind)).otherwise(c.cast("decimal(28,10)").cast(kind))


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding that other engines repeat: through decimals, back to double."""
    return _decimal(c, digits).cast("double")


def fixed(c: Column, digits: int = 2) -> Column:
    """A number as text with fixed digits."""
    return _decimal(c, digits).cast("string")


def trailing(rows: int) -> WindowSpec:
    return by_ticker().rowsBetween(-(rows - 1), 0)


def full(aggregate: Column, of: Column, rows: int) -> Column:
    """An aggregate over the last ``rows`` rows, NULL until so many values are there."""
    frame = trailing(rows)
    return F.when(F.count(of).over(frame) == rows, aggregate.over(frame))


def band(value: Column, bands: Sequence[tuple], last: object, take: int = 1) -> Column:
    """What stands beside the first upper bound above the value, ``last`` if there is none; NULL for NULL."""
    out = None
    for row in bands:
        test, result = value < row[0], F.lit(row[take])
        out = F.when(test, result) if out is None else out.when(test, result)
    return F.when(value.isNotNull(), out.otherwise(F.lit(last)))


BLOCK, ROWS = "_block", 256


def in_blocks() -> WindowSpec:
    """The ticker's rows in their order, sorted as the blocks of ``ewms`` are."""
    return Window.partitionBy(KEY).orderBy(BLOCK, TIME)


def ewms(df: DataFrame, averages: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Adds exponential averages (out: (value, alpha)) without adjustment, seeded by the first value; NULLs repeat the
    last average and widen the next step's weight.

    The recurrence y = a y' + b x is summed in closed form: with L the running sum of ln a,
    y = exp(L) * sum(b x exp(-L)). exp(-L) would overflow on long histories, so the sums start anew in every
    block of ``ROWS`` rows. What a block starts from is folded over the ends of all blocks before it, once a block. No UDF, any length of history,
    and nothing is forgotten: a large value that is far back still counts beside small ones.

    Blocks are counted on the ticker's rows alone: an average is the same, to the last bit, whatever is averaged beside it. The first call leaves
    the block in ``_block`` for later ones (whose averages may not be much faster), so that all their windows share one sort.
    """
    before, so_far = (Window.unboundedPreceding, -1), (Window.unboundedPreceding, 0)
    items = [(out, F.col(value), alpha, f"_{i}") for i, (out, (value, alpha)) in enumerate(averages.items())]
    keep = [c for c in df.columns if c != BLOCK]
    if BLOCK not in df.columns:
        rows = min(ROWS, int(600 / -log1p(-max(alpha for *_, alpha, _ in items))))  # exp(600) is no overflow
        df = df.withColumn(BLOCK, F.floor((F.row_number().over(by_ticker()) - 1) / rows))
    w = in_blocks()
    inner = Window.partitionBy(KEY, BLOCK).orderBy(TIME).rowsBetween(*so_far)
    df = df.withColumn("_p", F.row_number().over(w))
    df = df.withColumns({f"_q{i}": F.last(F.when(x.isNotNull(), F.col("_p")), ignorenulls=True).over(w.rowsBetween(*before)) for _, x, _, i in items})
    steps = {}
    for _, x, alpha, i in items:
        old = F.pow(F.lit(1 - alpha), F.col("_p") - F.col(f"_q{i}"))
        seeded = F.col(f"_q{i}").isNotNull()
        steps[f"_a{i}"] = F.when(x.isNotNull() & seeded, F.ln(old / (old + alpha))).otherwise(0.0)
        steps[f"_b{i}"] = F.when(x.isNotNull(), F.when(seeded, alpha / (old + alpha)).otherwise(F.lit(1.0)) * x).otherwise(0.0)
    df = df.withColumns(steps)
    df = df.withColumns({f"_l{i}": F.sum(f"_a{i}").over(inner) for *_, i in items})
    df = df.withColumns({f"_y{i}": F.exp(f"_l{i}") * F.sum(F.col(f"_b{i}") * F.exp(-F.col(f"_l{i}"))).over(inner) for *_, i in items})
    df = df.withColumns({"_ends": F.coalesce(F.lead(BLOCK).over(w) != F.col(BLOCK), F.lit(False)), "_starts": F.coalesce(F.lag(BLOCK).over(w) != F.col(BLOCK), F.lit(True))})
    df = df.withColumn("_past", F.collect_list(F.when(F.col("_ends"), F.struct(*[f"{n}{i}" for *_, i in items for n in ("_y", "_l")]))).over(w.rowsBetween(*before)))
    carried = lambda i: F.aggregate("_past", F.lit(0.0), lambda f, end: end[f"_y{i}"] + F.exp(end[f"_l{i}"]) * f)
    df = df.withColumns({f"_f{i}": F.when(F.col("_starts"), carried(i)) for *_, i in items})
    df = df.withColumns({f"_f{i}": F.last(f"_f{i}", ignorenulls=True).over(w.rowsBetween(*so_far)) for *_, i in items})
    known = {i: x.isNotNull() | F.col(f"_q{i}").isNotNull() for _, x, _, i in items}
    return df.select(*keep, BLOCK, *[F.when(known[i], F.col(f"_y{i}") + F.exp(f"_l{i}") * F.col(f"_f{i}")).alias(out) for out, _, _, i in items])


def ewm(df: DataFrame, value: str, alpha: float, out: str) -> DataFrame:
    """One exponential average by itself."""
    return ewms(df, {out: (value, alpha)}).drop(BLOCK)
