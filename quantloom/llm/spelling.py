"""Spelling variants: words that differ by one code point, found by probing edits against Bloom filters.

Every edit of a word is probed against a blocked Bloom filter of the words of the edit's length. Only what a filter
lets through is shuffled, to an exact join with the vocabulary that removes false positives; so results don't
depend on the filters. Of a pair that differs by an insertion the longer word's deletion is probed, of a pair that differs in one place
the replacement by a greater code point: each pair is found once.

Filters are split by length, lengths with many words again by a hash. Those of one pass fill ``BOUND`` bytes at most,
which is what is broadcast at a time; a larger vocabulary takes more passes, each written before the next begins.

Nulls: a null text has no words, a null id counts as an empty string, a null word of a vocabulary or one without a count is left
out. A word may be of any length: what its edits give is handed on a few megabytes at a time. Of two forms
that occur equally often the smaller by code points is taken. Rows that repeat id and text count again. Of extra columns nothing is
read. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .buffers import mix
from .common import checkpointed, importable, lean, table

RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BOUND = 32 << 20
BITS = 24
BLOCK = 8  # 32-bit cells; one bit of a word in each
SEGMENT = 2048  # blocks that one task fills
_BASE = np.uint64(0xBF58476D1CE4E5B9)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32)
_LOW = np.uint64(0xFFFFFFFF)


# words

def runs(docs: DataFrame, least_length: int = 6) -> DataFrame:
    """(id, run): maximal runs of letters of at least so many code points, A-Z lower-cased."""
    found = F.regexp_extract_all("text", F.lit(f"{RUN}{{{least_length},}}"), F.lit(0))
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run")).withColumn("run", F.translate("run", UPPER, LOWER))


def slipped(own: Column, run: Column, every: int = 199) -> Column:
    """``run``, or for one in ``every`` the run without one code point; which ones and where is decided by a checksum of id and run."""
    h = F.crc32(F.concat(own, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def counted(words: DataFrame, least_length: int = 6, least: int = 5) -> DataFrame:
    """(word, n) of the words of at least so many code points that occur so often."""
    sums = words.groupBy("word").agg(F.count("*").alias("n"), F.max(F.length("word")).alias("_length"))  # a filter on the word itself would work out every word twice
    return sums.filter((F.col("n") >= least) & (F.col("_length") >= least_length)).drop("_length")


# filters

class Shards:
    """Where the filters of one pass lie: for a length its first block, blocks, and which part of how many it is."""

    def __init__(self, parts: list[tuple[int, int, int, int]]) -> None:
        self.blocks, self.at = 0, {}
        for length, blocks, part, of in parts:
            self.at[length] = (self.blocks, blocks, part, of)
            self.blocks += blocks

    def place(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Each hash's block, its 32-bit key and whether this pass has its part of the length (None: it has all)."""
        first, blocks, part, of = self.at[length]
        h = mix(hashes.copy())
        own = None if of == 1 else (h >> np.uint64(32)) % np.uint64(of) == part
        block = first + ((mix(h + np.uint64(1)) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
        return block, (h & _LOW).astype(np.uint32), own


def passes(counts: dict[int, int], bound: int = BOUND, bits: int = BITS) -> list[Shards]:
    """Deals filters for so many words of each length over passes of at most ``bound`` bytes."""
    width, most = 32 * BLOCK, bound // (4 * BLOCK)
    parts = []
    for length, n in sorted(counts.items()):
        blocks = max(8, -(-n * bits // width))
        of = -(-blocks // most)
        parts += [(length, -(-blocks // of), part, of) for part in range(of)]
    out: list[list] = []
    room: list[int] = []
    for p in parts:
        if not out or room[-1] < p[1] or any(p[0] == q[0] for q in out[-1]):
            out.append([])
            room.append(most)
        out[-1].append(p)
        room[-1] -= p[1]
    return [Shards(p) for p in out]


def _bits(keys: np.ndarray, cell: int) -> np.ndarray:
    return np.uint32(1) << ((keys * _SALTS[cell]) >> np.uint32(27))


def _present(cells: np.ndarray, block: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Numbers of the candidates that the filter lets through; most leave after a cell or two."""
    left = np.arange(len(keys))
    for cell in range(BLOCK):
        left = left[(cells[block[left] * BLOCK + cell] & _bits(keys[left], cell)) != 0]
    return left


def _codes(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words of a batch by length: their numbers and a matrix of code points."""
    texts = words.to_pylist()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        for some in np.array_split(rows, max(1, len(rows) * int(length) // (1 << 20))):
            yield some, np.frombuffer("".join(texts[i] for i in some).encode("utf-32-le"), np.uint32).reshape(len(some), int(length))


def _hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of code points times powers of a base up to each place (one column more than places), and the powers."""
    powers = np.full(codes.shape[1], _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    np.cumsum(codes.astype(np.uint64) * powers, axis=1, dtype=np.uint64, out=sums[:, 1:])
    return sums, powers


def bloom(words: DataFrame, shards: Shards) -> np.ndarray:
    """The filters of one pass, filled a segment a task; what comes to the driver is their bytes."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes in _codes(batch.column(0)):
                block, keys, own = shards.place(codes.shape[1], _hashes(codes)[0][:, -1])
                if own is not None:
                    block, keys = block[own], keys[own]
                yield pa.RecordBatch.from_arrays([pa.array(block // SEGMENT), pa.array((block % SEGMENT).astype(np.int32)), pa.array(keys.view(np.int32))], ["segment", "block", "key"])

    def filled(key: tuple, group: pa.Table) -> pa.Table:
        cells = np.zeros(SEGMENT * BLOCK, np.uint32)
        block, keys = group.column("block").to_numpy(), group.column("key").to_numpy().view(np.uint32)
        for cell in range(BLOCK):
            np.bitwise_or.at(cells, block * BLOCK + cell, _bits(keys, cell))
        return pa.table({"segment": [key[0]], "cells": pa.array([cells.tobytes()], pa.binary())})

    rows = words.filter(F.length("word").isin(list(shards.at))).select("word").mapInArrow(placed, "segment long, block int, key int")
    out = np.zeros(-(-shards.blocks // SEGMENT) * SEGMENT * BLOCK, np.uint32)
    for segment, cells in rows.groupBy("segment").applyInArrow(filled, "segment long, cells binary").toLocalIterator():
        out[segment * SEGMENT * BLOCK : (segment + 1) * SEGMENT * BLOCK] = np.frombuffer(bytes(cells), np.uint32)
    return out


def _edits(codes: np.ndarray, alphabet: np.ndarray, shards: Shards, cells: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edits of words of one length that the filters let through: the words' numbers and the edits' code points."""
    length = codes.shape[1]
    sums, powers = _hashes(codes)
    through = lambda n, hashes: _through(shards, cells, n, hashes)
    if length in shards.at:
        for i in range(length):
            other = sums[:, -1:] + (alphabet[None, :].astype(np.uint64) - codes[:, i : i + 1].astype(np.uint64)) * powers[i]
            row, letter = np.nonzero(alphabet[None, :] > codes[:, i : i + 1])
            at = through(length, other[row, letter])
            if len(at):
                found = codes[row[at]]
                found[:, i] = alphabet[letter[at]]
                yield row[at], found
    if length - 1 in shards.at:
        for i in range(length):
            row = np.arange(len(codes)) if not i else np.flatnonzero(codes[:, i] != codes[:, i - 1])  # one of a run of equal letters
            row = row[through(length - 1, sums[row, i] + (sums[row, -1] - sums[row, i + 1]) * _BACK)]
            if len(row):
                yield row, np.delete(codes[row], i, axis=1)


def _through(shards: Shards, cells: np.ndarray, length: int, hashes: np.ndarray) -> np.ndarray:
    block, keys, own = shards.place(length, hashes)
    at = _present(cells, block, keys)
    return at if own is None else at[own[at]]


def probed(words: DataFrame, alphabet: np.ndarray, shards: Shards, cells: np.ndarray) -> DataFrame:
    """(word, n, near): edits that are perhaps words."""
    context = words.sparkSession.sparkContext
    sent = context.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for rows, codes in _codes(batch.column(0)):
                for at, found in _edits(codes, alphabet, shards, sent.value):
                    for i in range(0, len(at), step := max(1, (4 << 20) // (4 * codes.shape[1]))):
                        some = np.ascontiguousarray(found[i : i + step]).astype("<u4")
                        near = some.view(f"<U{some.shape[1]}").ravel().tolist()
                        own = pa.array(rows[at[i : i + step]])
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array(near, pa.string())], ["word", "n", "near"])
        lean()

    lengths = sorted({*shards.at, *(n + 1 for n in shards.at)})
    out = checkpointed(words.filter(F.length("word").isin(lengths)).mapInArrow(run, "word string, n long, near string"))
    sent.unpersist()
    return out


# variants

def neighbours(words: DataFrame, bound: int = BOUND) -> DataFrame:
    """(word, n, near, near_n): pairs of words one code point apart, each once. ``words``: (word, n), cheap to read again."""
    importable(words.sparkSession)
    counts = {r[0]: r[1] for r in words.groupBy(F.length("word")).count().collect()}  # a row for each length
    letters = words.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").distinct().collect()  # the alphabet
    alphabet = np.array(sorted(ord(r[0]) for r in letters), np.uint32)
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    out = None
    for shards in passes(counts, bound):
        found = probed(words, alphabet, shards, bloom(words, shards)).join(known, "near").select("word", "n", "near", "near_n")
        out = found if out is None else out.unionByName(found)
    return words.sparkSession.createDataFrame([], "word string, n long, near string, near_n long") if out is None else out


def rooted(links: DataFrame, steps: int) -> DataFrame:
    """(word, root): (word, form) followed to its end, in rounds that double how far each word sees."""
    seen = checkpointed(links.select("word", F.col("form").alias("root")))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        on = seen.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        seen = checkpointed(seen.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root")))
    return seen


def variants(vocabulary: DataFrame, ratio: int = 5, bound: int = BOUND) -> DataFrame:
    """(word, n) with n_near, form, form_n and root.

    ``form``: the word's most frequent neighbour, where that occurs ``ratio`` times as often at least. A step to a form multiplies the
    count by ``ratio``, which bounds how many there are from the least count to the greatest.
    """
    words = checkpointed(vocabulary.filter("word is not null and n is not null").select("word", "n"))
    ends = words.agg(F.min("n"), F.max("n")).first()
    both = neighbours(words, bound).select(F.inline(F.array(*[F.struct(F.col(a).alias("word"), F.col(n).alias("_n"), F.col(b).alias("_near")) for a, b, n in (("word", "near", "near_n"), ("near", "word", "n"))])))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("_n")).alias("_minus"), "_near")).alias("_best"))
    enough = -F.col("_best._minus") >= ratio * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("_best._near")).alias("form"), F.when(enough, -F.col("_best._minus")).alias("form_n")
    )
    formed = checkpointed(formed)
    steps = int(math.log(max(1.0, ends[1] / max(1, ends[0]))) / math.log(ratio) + 1e-9) if ends[0] is not None else 0
    roots = rooted(formed.filter("form is not null"), steps)
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    words = runs(docs).select(slipped(F.col("id"), F.col("run")).alias("word"))
    return variants(counted(words)).select("word", "form", "root", "n", "n_near", "form_n")
