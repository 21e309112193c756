"""Byte-level BPE, encoded in padded matrices and decoded again.

A text is split by the vocabulary's pattern, each piece encoded by itself. The distinct pieces of a batch are laid
out as matrices of byte ids, a row each, bucketed by length and padded. In each round every row merges its
leftmost pair of least rank; what stands right of it moves up one place, and rows without a pair that can merge
leave. Ranks of pairs come from a hash table over all pairs of tokens that make a token. A piece over ``LONG``
bytes is one row folded into a square, so that a round looks at the squares' least ranks and one of its rows
instead of the whole piece; the rule is the same. Pieces seen before are remembered up to a bound, which changes no result.

Nulls: a null text is empty, an empty one has no ids; null ids decode to no bytes. Special tokens' strings are ordinary text. Texts
are encoded whole, a part of the pieces at a time, so that a long one needs room for its ids and not for its
pieces. Repeated rows give repeated results; which of two equal ranks merges first is settled by the place. Added
columns replace those of the same name. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from .common import lean, slices, table

NONE = np.int32(np.iinfo(np.int32).max)
PAD = np.int32(-1)
LONG = 1024
CELLS = 1 << 21
REMEMBERED = 400_000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_FREE = np.uint64(2**64 - 1)


class Pairs:
    """(left id, right id) to the id that they merge to, by open addressing with linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray) -> None:
        bits = max(4, int(4 * len(left)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, _FREE), np.full(1 << bits, NONE, np.int32)
        keys = self._key(left, right)
        slots = self._slot(keys)
        while len(keys):
            free = self.keys[slots] == _FREE
            _, first = np.unique(slots, return_index=True)
            put = np.zeros(len(keys), bool)
            put[first] = True
            put &= free
            self.keys[slots[put]], self.values[slots[put]] = keys[put], merged[put]
            keys, merged, slots = keys[~put], merged[~put], (slots[~put] + 1) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint32).astype(np.uint64) << np.uint64(32)) | right.astype(np.uint32).astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, ``NONE`` where a pair doesn't merge; arrays of any shape."""
        keys = self._key(left.ravel(), right.ravel())
        slots = self._slot(keys)
        out, found = np.full(len(keys), NONE, np.int32), self.keys[slots]
        hit = found == keys
        out[hit] = self.values[slots[hit]]
        at = np.flatnonzero(~hit & (found != _FREE))
        while len(at):
            slots_at = slots[at] = (slots[at] + 1) & self.mask
            found = self.keys[slots_at]
            hit = found == keys[at]
            out[at[hit]] = self.values[slots_at[hit]]
            at = at[~hit & (found != _FREE)]
        return out.reshape(left.shape)


class Vocabulary:
    """A rank file: token bytes and ranks, which are the ids."""

    def __init__(self, path: str | None = None, pattern: str | None = None) -> None:
        import public_tokenizers

        with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.pattern = regex.compile(pattern or public_tokenizers.PATTERN)
        get = self.ranks.get
        made = [(a, b, rank) for token, rank in self.ranks.items() for i in range(1, len(token)) if (a := get(token[:i])) is not None and (b := get(token[i:])) is not None]
        left, right, merged = np.array(made, np.int32).reshape(-1, 3).T
        self.pairs = Pairs(left, right, merged)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._known: defaultdict[str, int] = defaultdict(count().__next__)
        self._ids, self._lens = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) < 1 << 20:
            yield self.pattern.findall(text)
        else:
            found = self.pattern.finditer(text)
            while some := [m.group() for m in islice(found, 1 << 18)]:
                yield some

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and each text's offset in them (one more than texts)."""
        if len(self._known) > REMEMBERED:
            self._known = defaultdict(count().__next__)
            self._ids, self._lens = np.zeros(0, np.int32), np.zeros(0, np.int64)
        get, codes, ends = self._known.__getitem__, [], [0]
        for text in texts:
            n = 0
            for some in self._pieces(text or ""):
                codes.append(np.fromiter(map(get, some), np.int64, len(some)))
                n += len(some)
            ends.append(ends[-1] + n)
        if len(self._known) > len(self._lens):
            ids, lens = self.merged([p.encode() for p in islice(self._known, len(self._lens), None)])
            self._ids, self._lens = np.concatenate([self._ids, ids]), np.concatenate([self._lens, lens])
        every = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        lens = self._lens[every]
        before = np.concatenate([[0], np.cumsum(lens)])
        return self._ids[_ranges((np.cumsum(self._lens) - self._lens)[every], lens)], before[np.array(ends)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of rows of ids one after another, and each row's offset in them."""
        lens = self.lengths[ids]
        return self.bytes[_ranges(self.starts[ids], lens)], np.concatenate([[0], np.cumsum(lens)])[offsets]

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and how many each has. A piece that is a token is its id."""
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [((at := np.flatnonzero(whole >= 0)), np.ones(len(at), np.int64), whole[at].astype(np.int32))]
        rest = np.flatnonzero((whole < 0) & (sizes <= LONG))
        for width in np.unique(buckets := _width(sizes[rest])):
            rows = rest[buckets == width]
            for i in range(0, len(rows), step := max(1, CELLS // int(width))):
                some = rows[i : i + step]
                padded = np.full((len(some), width), PAD, np.int32)
                padded[np.arange(width) < sizes[some][:, None]] = self.single[np.frombuffer(b"".join(pieces[j] for j in some), np.uint8)]
                done += [(some[at], lens, ids) for at, lens, ids in self._rounds(padded)]
        for j in np.flatnonzero((whole < 0) & (sizes > LONG)):
            ids = self._folded(self.single[np.frombuffer(pieces[j], np.uint8)])
            done.append((np.array([j]), np.array([len(ids)]), ids))
        lens = np.zeros(len(pieces), np.int64)
        for at, n, _ in done:
            lens[at] = n
        starts = np.cumsum(lens) - lens
        out = np.zeros(int(lens.sum()), np.int32)
        for at, n, ids in done:
            out[_ranges(starts[at], n)] = ids
        return out, lens

    def _rounds(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Merges the rows of a padded matrix; gives rows that are done: their numbers, lengths and ids."""
        number = np.arange(len(ids))
        ranks = self.pairs(ids[:, :-1], ids[:, 1:])
        while True:
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            best = ranks[np.arange(len(ids)), at] if ranks.shape[1] else np.full(len(ids), NONE)
            if (over := best == NONE).any():
                out = ids[over]
                held = out != PAD
                yield number[over], held.sum(axis=1), out[held]
                number, ids, ranks, at, best = number[~over], ids[~over], ranks[~over], at[~over], best[~over]
            if not len(ids):
                return
            rows, width = np.arange(len(ids)), ids.shape[1] - 1
            ids[rows, at] = best
            place = np.arange(width)
            ids = np.take_along_axis(ids, place + (place > at[:, None]), axis=1)
            ranks = np.take_along_axis(ranks, place[:-1] + (place[:-1] >= at[:, None]), axis=1)
            if width > 1:
                left, right = np.flatnonzero(at > 0), np.flatnonzero(at < width - 1)
                ranks[left, at[left] - 1] = self.pairs(ids[left, at[left] - 1], best[left])
                ranks[right, at[right]] = self.pairs(best[right], ids[right, at[right] + 1])

    def _folded(self, ids: np.ndarray) -> np.ndarray:
        """Merges one long piece: ranks lie in a square, ``least`` has the least of each of its rows."""
        n = len(ids)
        side = int(np.ceil(np.sqrt(n)))
        ids = ids.copy()
        square = np.full((side, side), NONE, np.int32)
        ranks = square.reshape(-1)
        ranks[: n - 1] = self.pairs(ids[:-1], ids[1:])
        least = square.min(axis=1)
        after, before = np.arange(1, n + 1), np.arange(-1, n)
        gone = np.zeros(n, bool)
        while (best := least[row := int(least.argmin())]) != NONE:
            i = row * side + int(square[row].argmin())
            taken = int(after[i])
            right, left = int(after[taken]), int(before[i])
            ids[i], gone[taken], ranks[taken], after[i], before[right] = best, True, NONE, right, i
            a = np.array([best, ids[left] if left >= 0 else PAD], np.int32)
            b = np.array([ids[right] if right < n else PAD, best], np.int32)
            ranks[i], own = self.pairs(a, b)
            if left >= 0:
                ranks[left] = own
            for r in {row, taken // side, max(left, 0) // side}:
                least[r] = square[r].min()
        return ids[~gone]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _width(sizes: np.ndarray) -> np.ndarray:
    """Widths of buckets: to 16 in steps of 4, then a quarter of the power of two below."""
    step = np.maximum(4, 2 ** np.maximum(0, np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64) - 2))
    return -(-sizes // step) * step


_kept: dict[tuple[str | None, str | None], Vocabulary] = {}


def vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """One for each worker process."""
    if (path, pattern) not in _kept:
        _kept[path, pattern] = Vocabulary(path, pattern)
    return _kept[path, pattern]


def _added(df: DataFrame, column: str, out: str, kind: DataType, make: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """``df`` with ``out``, made of ``column`` in tasks, a few megabytes at a time."""
    kept = [c for c in df.columns if c != out]
    given = df.select(F.col(column).alias("_given"), *kept)
    schema = StructType([*df.select(*kept).schema.fields, StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for part in slices([batch], 0, 2 << 20) if pa.types.is_string(batch.column(0).type) else [batch]:
                yield pa.RecordBatch.from_arrays([*part.columns[1:], make(part.column(0))], [*kept, out])
        lean()

    return given.mapInArrow(run, schema)


def encode(df: DataFrame, column: str = "text", out: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Adds ``out``, the ids of ``column`` as an array of ints. ``path``: a rank file that workers can read."""

    def make(texts: pa.Array) -> pa.Array:
        ids, offsets = vocabulary(path, pattern).encode(texts.to_pylist())
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))

    return _added(df, column, out, ArrayType(IntegerType()), make)


def decode(df: DataFrame, column: str = "ids", out: str = "bytes", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Adds ``out``, the bytes that the ids in ``column`` stand for; null ids give empty bytes."""

    def make(lists: pa.Array) -> pa.Array:
        lists = lists.fill_null([]) if lists.null_count else lists
        offsets = lists.offsets.to_numpy()
        data, ends = vocabulary(path, pattern).decode(lists.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())

    return _added(df, column, out, BinaryType(), make)


def op13_matrix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode(encode(table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", "text")).drop("text"))
    digits = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(digits, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
