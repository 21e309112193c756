"""Benchmark decontamination as a prefix-filtered set join.

An item's windows (``WINDOW`` consecutive words; a shorter item is one window) are the sets, their words
the tokens. Tokens are ordered by rarity, the count of the word over all documents. A document contains
a window only if it contains the window's whole prefix, and for exact containment a prefix of one token,
its rarest, is enough: documents are joined with windows on that word. A candidate is kept if the
window, laid so that the word falls on its position in it, lies within the document (length and
positional bounds), and is then verified word by word.

The benchmark is a stated query set: it is taken in blocks of bounded size and each block is held against
all documents. Counting rarities and joining both run in tasks over bounded slices of documents. Of more than ``LIVE`` blocks
the first ones' results are written before the next are read, so that executors hold no more than that many at any size of the benchmark.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, compared by 64-bit hashes. Nulls: a null
text has no words, as an empty one, a null item id is left out of the list of items. Ties in rarity go by position. A very long text is taken
whole, in a slice by itself.
Repeated items or documents are each counted. Columns with the names of those that are added give way.
Empty tables: nothing is contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .buffers import LOWER, PUNCT, prefix_hash, span_hash, text_buffer, words
from .common import checkpointed, lean, slices, table

WINDOW, BLOCK_MB = 10, 8
LIVE = 8  # blocks that are broadcast at a time


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts, and each text's first."""
    buffer, offsets = text_buffer(column)
    buffer = LOWER[buffer]
    start, end, at = words(buffer, offsets, PUNCT)
    return span_hash(prefix_hash(buffer), start, end), at


class Block:
    """The windows of some items: their words (numbers in a vocabulary), and after ``order`` their prefix tokens."""

    def __init__(self, item_ids: list, texts: list[str | None], window: int) -> None:
        hashes, at = word_hashes(pa.array(texts, pa.string()))
        self.vocabulary, ids = np.unique(hashes, return_inverse=True)
        rows: dict[tuple[int, ...], set[int]] = {}
        for i in range(len(texts)):
            own = ids[at[i] : at[i + 1]].tolist()
            for s in range(len(own) - min(window, len(own)) + 1 if own else 0):
                rows.setdefault(tuple(own[s : s + window]), set()).add(i)
        self.item_ids = item_ids
        self.windows = list(rows)
        self.items = [sorted(v) for v in rows.values()]
        self.length = np.array([len(w) for w in self.windows], np.int64)
        self.words = np.full((len(self.windows), window), -1, np.int64)
        for i, w in enumerate(self.windows):
            self.words[i, : len(w)] = w

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word in the vocabulary, -1 for others."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1, np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def order(self, counts: np.ndarray) -> None:
        """Chooses each window's rarest word and sorts windows by it."""
        rarity = np.where(self.words >= 0, counts[self.words], np.iinfo(np.int64).max)
        self.position = rarity.argmin(axis=1) if len(self.windows) else np.zeros(0, np.int64)
        self.prefix = self.words[np.arange(len(self.windows)), self.position]
        self.by_prefix = np.argsort(self.prefix, kind="stable")
        self.first = np.searchsorted(self.prefix[self.by_prefix], np.arange(len(self.vocabulary) + 1))

    def occurrences(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, window) of every window that stands in the documents ``ids[at[d]:at[d + 1]]``."""
        place = np.flatnonzero(ids >= 0)
        many = self.first[ids[place] + 1] - self.first[ids[place]]
        place, many = place[many > 0], many[many > 0]
        doc = np.searchsorted(at, place, side="right") - 1
        which = np.repeat(self.first[ids[place]], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        window = self.by_prefix[which]
        doc, start = np.repeat(doc, many), np.repeat(place, many) - self.position[window]
        inside = (start >= at[doc]) & (start + self.length[window] <= at[doc + 1])  # length and positional bounds
        doc, start, window = doc[inside], start[inside], window[inside]
        for k in range(self.words.shape[1]):
            same = (k >= self.length[window]) | (ids[np.minimum(start + k, len(ids) - 1)] == self.words[window, k])
            doc, start, window = doc[same], start[same], window[same]
        return doc, start, window


def blocks(benchmark: DataFrame, window: int, block_mb: int) -> Iterator[Block]:
    """The benchmark in blocks of at most ``block_mb`` MB of text (or one item), so that what is sent to tasks is bounded."""
    rows, size = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        rows.append((r["item_id"], r["text"]))
        size += len(r["text"] or "")
        if size > block_mb << 20:
            yield Block([x[0] for x in rows], [x[1] for x in rows], window)
            rows, size = [], 0
    if rows:
        yield Block([x[0] for x in rows], [x[1] for x in rows], window)


def rarities(docs: DataFrame, block: Block, text: str = "text") -> np.ndarray:
    """How often each word of the block's vocabulary stands in all documents."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(block.vocabulary)  # of one block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        total = np.zeros(len(vocabulary.value), np.int64)
        for batch in slices(batches, 0, limit=1 << 20):
            hashes, _ = word_hashes(batch.column(0))
            at = np.minimum(np.searchsorted(vocabulary.value, hashes), max(len(total) - 1, 0))
            if len(total):
                total += np.bincount(at[vocabulary.value[at] == hashes], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["word", "n"])

    out = np.zeros(len(block.vocabulary) or 1, np.int64)
    for r in docs.select(text).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():  # a row for each word of the block
        out[r["word"]] = r["n"]
    vocabulary.unpersist()
    return out


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open spans as maximal ones."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _against(df: DataFrame, block: Block, at: int) -> DataFrame:
    """Adds the block's hits to n_words, spans and items, the last three columns."""
    shared = df.sparkSession.sparkContext.broadcast(block)  # of bounded size
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        block = shared.value
        for batch in slices(batches, at, limit=1 << 20):
            hashes, first = word_hashes(batch.column(at))
            doc, start, window = block.occurrences(block.number(hashes), first)
            spans, items = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
            spans = [[(x["start"], x["end"]) for x in s] for s in spans]
            for d, s, e in zip(doc.tolist(), (start - first[doc]).tolist(), (start - first[doc] + block.length[window]).tolist(), strict=True):
                spans[d].append((s, e))
            for d, w in zip(*(x.tolist() for x in np.unique(np.stack([doc, window]), axis=1)), strict=True):  # a window's items once a document
                items[d] += [str(block.item_ids[i]) for i in block.items[w] if block.item_ids[i] is not None]
            for d in set(doc.tolist()):
                spans[d], items[d] = merge(spans[d]), sorted(set(items[d]))
            spans = pa.array([[{"start": s, "end": e} for s, e in own] for own in spans], SPANS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(np.diff(first), pa.int64()), spans, pa.array(items, pa.list_(pa.string()))], names=names)
        lean()

    return df.mapInArrow(run, df.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_mb: int = BLOCK_MB, text: str = "text", live: int = LIVE) -> DataFrame:
    """Adds to each document n_words, the hit ``spans`` of words (merged) and the ids of the ``items`` with occurring windows, sorted as strings."""
    docs = docs.drop("n_words", "spans", "items")
    out = docs.select(
        *docs.columns, F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"), F.array().cast("array<string>").alias("items")
    )
    at = docs.columns.index(text)
    for n, block in enumerate(blocks(benchmark, window, block_mb) if benchmark.head(1) else [Block([], [], window)]):
        if n and n % live == 0:
            out = checkpointed(out)  # nothing refers to the blocks before any more
        block.order(rarities(docs, block, text))
        out = _against(out, block, at)
    return out


def op6_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    found = found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP6_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS g
        FROM b, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) u(i) WHERE len(w) > 0),
size AS (SELECT DISTINCT n FROM win),
laid AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, size, unnest(range(1, len(w) - n + 2)) u(i) WHERE len(w) >= n),
hit AS (SELECT doc_id, i, laid.n, item_id FROM laid JOIN win ON laid.n = win.n AND laid.g = win.g),
word AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, range({WINDOW}) r(k) WHERE k < n GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
"""
