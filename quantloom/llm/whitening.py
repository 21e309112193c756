"""Whitening of embeddings by their leading principal components.

Vectors are made whole numbers (256ths), the distinct ones are the fit list. It is written once as blocks of numbers and never
multiplied into a covariance matrix: the eigenpairs come from products of the centred list with a few columns, each one a
Spark job that leaves one small sum a partition, added up in levels where partitions are many (``jacobidavidson.largest``).

Nulls: rows whose vector is null, empty or holds a null or non-finite entry, or one that has no place in a long once it is in
256ths (2**55 or more), are dropped; a null id is an id like any other. A table has the length that most of its vectors have (of two that are equally
frequent the longer); others are dropped. Repeated vectors count once in the fit and each get their rows. Equal eigenvalues share their space,
any basis of it is right. A component without variance (rounding aside) has null in ``whitened``; ``deviation`` is null where
its exact value has no place in a long. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import checkpointed, importable, lean, table
from .jacobidavidson import EPS, largest

SCALE = 256
LIMIT = 2.0**55
BLOCK_BYTES = 1 << 20
TASK_BYTES = 4 << 20
FAN = 64
Work = Callable[[Iterator[np.ndarray]], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """A fit: how many distinct vectors, their exact sums, eigenvalues and unit eigenvectors (columns), the trace, and how far whitened rows are from the identity."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def sound(self) -> np.ndarray:
        """Which components have variance."""
        return self.values > len(self.sums) * EPS * max(self.trace, np.finfo(float).tiny)

    @property
    def scaled(self) -> np.ndarray:
        return self.vectors[:, self.sound] / np.sqrt(self.values[self.sound])


def usable(column: str) -> Column:
    good = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT))
    return F.col(column).isNotNull() & (F.size(column) > 0) & good


def whole(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """``df`` without what can't be used, ``_x`` the vector in 256ths, and the vectors' length."""
    rows = df.filter(usable(column)).withColumn("_x", F.transform(column, lambda c: F.floor(c.cast("double") * SCALE)))
    common = rows.groupBy(F.size(column).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = common["dims"] if common else 0
    return rows.filter(F.size(column) == dims), dims


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def blocks(rows: DataFrame, dims: int) -> DataFrame:
    """(n, block): the distinct vectors in blocks of a megabyte, each in the narrowest integers that hold it; written to the shared folder."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for i in range(0, len(x), step := max(1, BLOCK_BYTES // (8 * dims))):
                some = x[i : i + step]
                kind = next(k for k in (np.int16, np.int32, np.int64) if np.iinfo(k).min <= some.min() and some.max() <= np.iinfo(k).max)
                yield pa.RecordBatch.from_arrays([pa.array([len(some)], pa.int32()), pa.array([some.astype(kind).tobytes()], pa.binary())], ["n", "block"])

    return checkpointed(rows.select("_x").distinct().mapInArrow(pack, "n int, block binary"))


def gathered(data: DataFrame, dims: int, work: Work, parts: int) -> np.ndarray | None:
    """The sum of what ``work`` makes of each partition's blocks (None if there are none). At most ``FAN`` partial sums or the root of their number meet in one place."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[np.ndarray]:
            for batch in batches:
                for n, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    yield np.frombuffer(block, f"<i{len(block) // (n * dims)}").reshape(n, dims)

        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(work(each()))], pa.binary())], ["partial"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(pickle.loads(p) for batch in batches for p in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], ["partial"])

    sums = data.mapInArrow(partial, "partial binary")
    while parts > FAN:
        parts = math.isqrt(parts - 1) + 1
        sums = sums.repartition(parts).mapInArrow(added, "partial binary")
    found = [pickle.loads(bytes(r[0])) for r in sums.collect()]
    return sum(found) if found else None


def _exact(each: Iterator[np.ndarray], dims: int) -> np.ndarray:
    """Sums by dimension as unbounded integers, the number of rows and of bytes behind them."""
    total = np.zeros(dims + 2, object)
    for x in each:
        high, low = x.astype(np.int64) >> 32, x.astype(np.int64) & 0xFFFFFFFF
        total[:dims] += high.sum(axis=0).astype(object) * (1 << 32) + low.sum(axis=0).astype(object)
        total[dims] += len(x)
        total[dims + 1] += x.nbytes
    return total


def fitted(rows: DataFrame, dims: int, components: int = 4, seed: int = 7) -> Whitening | None:
    """Fits the whitening to the distinct vectors of ``rows``; None if there are none."""
    list_ = blocks(rows, dims)
    parts = list_.rdd.getNumPartitions()
    total = gathered(list_, dims, lambda each: _exact(each, dims), parts)
    if total is None or not total[dims]:
        return None
    n, sums, size = int(total[dims]), tuple(int(s) for s in total[:dims]), int(total[dims + 1])
    parts = max(1, min(parts, -(-size // TASK_BYTES)))
    data = list_.coalesce(parts)
    mean = np.array([s / n for s in sums])

    def product(columns: np.ndarray) -> np.ndarray:
        def work(each: Iterator[np.ndarray]) -> np.ndarray:
            out = np.zeros_like(columns)
            for x in each:
                centred = x - mean
                out += centred.T @ (centred @ columns)
            return out

        return gathered(data, dims, work, parts) / n

    trace = float(gathered(data, dims, lambda each: sum((((x - mean) ** 2).sum() for x in each), 0.0), parts)) / n
    values, vectors, _ = largest(product, dims, components, seed)
    fit = Whitening(n, sums, values, vectors, trace)
    scaled, k = fit.scaled, int(fit.sound.sum())
    if not k:
        return fit

    def means(each: Iterator[np.ndarray]) -> np.ndarray:
        return sum((((x - mean) @ scaled).sum(axis=0) for x in each), np.zeros(k))

    centre = gathered(data, dims, means, parts) / n

    def covariance(each: Iterator[np.ndarray]) -> np.ndarray:
        return sum((y.T @ y for x in each for y in [(x - mean) @ scaled - centre]), np.zeros((k, k)))

    error = float(np.abs(gathered(data, dims, covariance, parts) / n - np.eye(k)).max())
    return Whitening(n, sums, values, vectors, trace, error)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> pa.Array:
    """Exact sums of ``(n*x - S)**2`` by row, null where one has no place in a long."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if len(sums) * most * most < 1 << 63:
        gap = x * n - np.array(sums, np.int64)
        return pa.array((gap * gap).sum(axis=1))
    exact = ((x.astype(object) * n - np.array(sums, object)) ** 2).sum(axis=1)
    return pa.array([int(e) if e < 1 << 63 else None for e in exact], pa.int64())


def whitened(df: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = 4) -> DataFrame:
    """A row for each usable vector and component: the id, component, n, deviation, whitened, explained, identity_error. The fit runs when this is called."""
    importable(df.sparkSession)
    given = df.select(F.col(id_column), F.col(column).alias("_vector"))
    rows, dims = whole(given, "_vector")
    kinds = {"component": IntegerType(), "n": LongType(), "deviation": LongType(), "whitened": DoubleType(), "explained": DoubleType(), "identity_error": DoubleType()}
    schema = StructType([given.schema[id_column], *(StructField(name, kind) for name, kind in kinds.items())])
    fit = fitted(rows, dims, components) if dims else None
    if fit is None:
        return df.sparkSession.createDataFrame([], schema)
    names, mean, scaled, sound = schema.names, fit.mean, fit.scaled, fit.sound
    explained = [v / fit.trace if fit.trace > 0 else None for v in fit.values.tolist()]
    n, sums, error = fit.n, fit.sums, fit.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), dims)
            y, own, many = (x - mean) @ scaled, deviations(x, n, sums), len(x)
            found = iter(y.T)
            for j, good in enumerate(sound):
                put = pa.array(next(found)) if good else pa.nulls(many, pa.float64())
                same = lambda v, kind: pa.array([v], kind).take(pa.array(np.zeros(many, np.int32)))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([batch.column(0), same(j + 1, pa.int32()), same(n, pa.int64()), own, put, same(explained[j], pa.float64()), same(error, pa.float64())], names)
        lean()

    return rows.select(id_column, "_x").mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
