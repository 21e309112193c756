"""Language ID: averaged hashed subword embeddings and a linear softmax, with calibrated rejection.

A text's subwords are its byte n-grams of one to three bytes, hashed to ``BUCKETS`` rows of an
embedding table. The mean of their embeddings goes through one linear layer and a softmax. Table and
layer are trained by minibatch stochastic gradient descent in numpy on a bounded sample of labelled
texts (``rows``, a parameter; chosen by a hash of id and text over the whole table). On a second bounded sample
(``held``) that training has not seen a temperature is fitted, so that a score is a probability, and the score
under which a text is rejected, so that a share ``wrong`` of rightly named texts go.

Counting n-grams, in training and in prediction, runs in Spark tasks over whole texts, a bounded
slice at a time; only the sample's counts and the model (``BUCKETS`` x ``DIM``) pass the driver.

Nulls: a null text, or one with no letter, is ``und`` with score 0 and is rejected. Rows without a label
teach nothing. Ties between languages go to the first in order. With no labelled row at all every
text is ``und``. A very long text is counted whole, in a slice by itself. An empty table gives an empty result; repeated rows are predicted alike; columns with the
names of those that are added give way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .buffers import LOWER, text_buffer
from .common import lean, slices, table

BUCKETS, DIM, UNKNOWN = 4096, 16, "und"
_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def features(column: pa.Array) -> np.ndarray:
    """Mean one-hot of each text's hashed n-grams (texts x BUCKETS); a text with no byte is all zero."""
    buffer, offsets = text_buffer(column)
    n, b = len(offsets) - 1, LOWER[buffer].astype(np.uint32)
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets)) * BUCKETS
    out = np.zeros(n * BUCKETS)
    gram = np.zeros(len(b), np.uint32)
    for k, multiplier in enumerate(_MULTIPLIERS):
        size = len(b) - k
        if size <= 0:
            break
        gram = (gram[:size] << np.uint32(8)) | b[k:]
        same = row[:size] == row[k:]  # an n-gram lies within one text
        bucket = ((gram + np.uint32(k + 1)) * multiplier) >> np.uint32(20)
        out += np.bincount((row[:size] + bucket)[same], minlength=n * BUCKETS)
    out = out.reshape(n, BUCKETS)
    return (out / np.maximum(out.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_under: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.table) @ self.layer + self.bias

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = softmax(self.logits(x) / self.temperature)
        return p.argmax(axis=1), p.max(axis=1)


def train(x: np.ndarray, labels: list[str], epochs: int = 60, batch: int = 32, rate: float = 20.0, seed: int = 7) -> Model:
    """Stochastic gradient descent; languages weigh as the root of their share."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    y = np.array([languages.index(v) for v in labels])
    order = rng.permutation(len(y))
    m = Model(languages, rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32), np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32))
    weight = 1 / np.sqrt(np.bincount(y, minlength=len(languages)).clip(1))
    weight = (weight / weight.mean())[y]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        rng.shuffle(order)
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            own = x[rows].astype(np.float32)
            mean = own @ m.table
            error = softmax(mean @ m.layer + m.bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error *= (weight[rows] / len(rows))[:, None]
            back = error @ m.layer.T
            m.layer -= 0.1 * step * (mean.T @ error)
            m.bias -= 0.01 * step * error.sum(axis=0)
            m.table -= step * (own.T @ back)
    return m


def calibrate(m: Model, z: np.ndarray, labels: list[str], wrong: float = 0.001) -> Model:
    """Fits the temperature and the least score on logits of rows that the training has not seen."""
    known = [i for i, v in enumerate(labels) if v in m.languages]
    if not known:
        return m
    z, y = z[known], np.array([m.languages.index(labels[i]) for i in known])
    loss = lambda t: -np.log(softmax(z / t)[np.arange(len(y)), y].clip(1e-12)).mean()
    m.temperature = float(min(np.geomspace(0.02, 8, 61), key=loss))
    p = softmax(z / m.temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y])
    m.reject_under = float(right[int(wrong * len(right))]) if len(right) else 0.0
    return m


def fit(labelled: DataFrame, key: Column, rows: int = 4000, held: int = 20_000, wrong: float = 0.001) -> Model | None:
    """A model from ``rows`` of the labelled (text, lang) rows, those whose ``key`` and text hash lowest (four fifths where there are
    no more); calibrated on the ``held`` that hash next. Both samples are bounded, and the same however the table is laid out."""
    labelled = labelled.filter(F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    n = labelled.count()
    if not n:
        return None
    parts = 1 << 30
    cut = int(min(0.8, rows / n) * parts) + 1
    top = int(min(1.0, cut / parts + max(held / n, 0.2 if n < held else 0)) * parts)
    drawn = labelled.select("text", "lang", F.pmod(F.xxhash64(key, "text"), F.lit(parts)).alias("draw"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in slices(batches, 0, limit=1 << 20, rows=256):
            x = features(batch.column(0)).astype(np.float16)
            met = [np.flatnonzero(r) for r in x]  # a text meets a part of the buckets
            yield pa.RecordBatch.from_arrays([pa.array([i.astype("<u2").tobytes() + r[i].tobytes() for i, r in zip(met, x, strict=True)], pa.binary()), *batch.columns[1:]], names=["x", "lang", "draw"])

    sample = drawn.filter(F.col("draw") < cut).mapInArrow(counted, "x binary, lang string, draw long").orderBy("draw", "x").limit(rows)
    x, names = np.zeros((rows, BUCKETS), np.float16), []
    for r in sample.toLocalIterator():  # a row at a time, so that the driver holds the sample once
        n = len(r["x"]) // 4
        x[len(names), np.frombuffer(r["x"], "<u2", n)] = np.frombuffer(r["x"], np.float16, n, 2 * n)
        names.append(r["lang"])
    if not names:
        return None
    model = train(x[: len(names)], names)
    del x
    lean()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in slices(batches, 0, limit=1 << 20, rows=256):
            z = model.logits(features(batch.column(0))).astype("<f4")
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in z], pa.binary()), *batch.columns[1:]], names=["z", "lang", "draw"])

    held_out = drawn.filter((F.col("draw") >= cut) & (F.col("draw") < top)).mapInArrow(judged, "z binary, lang string, draw long").orderBy("draw", "z").limit(held).collect()
    z = np.frombuffer(b"".join(bytes(r["z"]) for r in held_out), "<f4").reshape(len(held_out), len(model.languages))
    return calibrate(model, z, [r["lang"] for r in held_out], wrong)


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Adds lang_pred, score and accepted to the rows; other columns pass through untouched."""
    df = df.drop("lang_pred", "score", "accepted", "_letter")
    schema = T.StructType([*df.schema.fields]).add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    names = schema.names
    at = df.columns.index(text)
    lettered = df.withColumn("_letter", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in slices(batches, at, limit=1 << 20, rows=256):
            letter = np.array(batch.column(batch.num_columns - 1).to_pylist(), bool)
            if model is None:
                name, score, ok = np.full(len(letter), UNKNOWN, object), np.zeros(len(letter)), np.zeros(len(letter), bool)
            else:
                best, score = model.predict(features(batch.column(at)))
                name = np.where(letter, np.array(model.languages, object)[best], UNKNOWN)
                score = np.where(letter, score.astype(np.float64), 0.0)
                ok = letter & (score >= model.reject_under)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(ok, pa.bool_())], names=names)
        lean()

    return lettered.mapInArrow(run, schema)


def remainder(of: int) -> Column:
    """crc32 of the decimal doc_id modulo ``of``; a null id counts as the empty text."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % of


def op4_subword_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = fit(docs.filter(remainder(3) != 1), F.col("doc_id"))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score", "accepted")
