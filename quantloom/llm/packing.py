"""Best-fit packing with large-item matching.

Documents are cut into pieces of at most ``capacity`` tokens. Of pieces above a third of the
capacity at most two fit a bin: they are paired greedily, the longest first, each with the longest
partner that fits. The smaller ones then go, longest first, into the tightest gap that holds them.

Both steps need lengths alone, and there are ``capacity`` lengths: the plan is made on the counts
by length (at most ``capacity`` numbers on the driver, however many documents), as runs "pieces
number lo to hi of this length go, so many a bin, to bins from this number on". Pieces are then
numbered within their length and look their run up; no piece visits the driver.

Null and empty texts give one piece with the end token alone; a very long text gives as many as it takes, encoded by itself. Pieces that tie in
length go by id, number and checksum; repeated rows are packed each. Only doc_id and text are read, so that no other column can clash.
An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, lean, ranked, slices, table
from .subwords import subwords

CAPACITY, END = 1024, 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full but the first, which takes what is over."""
    first = n % capacity or capacity
    return [(0, min(n, first))] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, path: str | None = None) -> DataFrame:
    """One row for each piece of each document's subword ids, ``end`` included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        encode = subwords(path).encode
        for batch in slices(batches, 1, limit=1 << 20):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.uint32(end)).astype("<u4", copy=False)
                rows += [(doc_id, k, s, n, zlib.crc32(ids[s : s + n])) for k, (s, n) in enumerate(cut(len(ids), capacity))]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in PIECES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs (length, lo, hi, first bin, a bin, offset) for so many pieces of each length, and the number of bins.

    Its work and its size depend on the number of lengths, not of pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges of bins (first, how many)
    bins = 0

    def gap(size: int, first: int, many: int) -> None:
        if size and many:
            gaps.setdefault(size, []).append((first, many))

    def place(n: int, k: int, first: int, a_bin: int, offset: int) -> None:
        runs.append((n, used[n], used[n] + k, first, a_bin, offset))
        used[n] += k
        left[n] -= k

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            partner = next((m for m in large if m <= min(n, capacity - n) and left[m] >= 1 + (m == n)), None)
            k = left[n] if partner is None else left[n] // 2 if partner == n else min(left[n], left[partner])
            place(n, k, bins, 1, 0)
            if partner is not None:
                place(partner, k, bins, 1, n)
            gap(capacity - n - (partner or 0), bins, k)
            bins += k
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            size = min((g for g, ranges in gaps.items() if ranges and g >= n), default=0)  # of at most ``capacity``
            if not size:
                need = -(-left[n] // (capacity // n))
                gap(capacity, bins, need)
                bins += need
                continue
            first, many = gaps[size].pop()
            a_bin = size // n
            full = min(many, left[n] // a_bin)
            if full:
                place(n, full * a_bin, first, a_bin, capacity - size)
                gap(size - a_bin * n, first, full)
            if full < many and left[n] and left[n] < a_bin:
                rest = left[n]
                place(n, rest, first + full, rest, capacity - size)
                gap(size - rest * n, first + full, 1)
                full += 1
            gap(size, first + full, many - full)
    return runs, bins


def pack(items: DataFrame, tie: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``; read twice, so pass it checkpointed."""
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    runs, _ = plan(counts, capacity)
    bound = items.sparkSession.createDataFrame(runs or [(0, 0, 0, 0, 1, 0)], "_length long, _lo long, _hi long, _first long, _a_bin long, _offset long")
    rank = ranked(items, ["length"], tie, "_rank")
    # the runs are a few for each length and gap, whatever the input
    out = rank.join(F.broadcast(bound), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
    step = F.col("_rank") - F.col("_lo")
    return out.select(
        *items.columns,
        (F.col("_first") + F.floor(step / F.col("_a_bin"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (step % F.col("_a_bin")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end: int = END, path: str | None = None) -> DataFrame:
    """Pieces of all documents with their places. The pieces, without their ids, are checkpointed: texts are encoded once."""
    return pack(checkpointed(pieces(docs, capacity, end, path)), ["doc_id", "piece", "ids_crc32"], capacity)


def op3_large_item_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
