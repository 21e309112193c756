"""Removal of long repeated passages, byte by byte, over a whole corpus.

A byte goes if a ``length``-byte string covers it that also starts earlier: in a document of a smaller
id, or earlier in the same one. Strings are judged on the input and never cross documents.

1. Each string is assigned to its anchor, the leftmost least-hashed ``K``-gram in it: equal strings have
   equal anchors, and strings of one anchor are consecutive, a *context* of at most ``2 * length - K`` bytes.
   Contexts are dealt out by their whole hash as short records (no text). Equal contexts are told apart from the
   earliest of their kind where they are found: in the task that makes them already, which remembers those that it has
   met twice (``REMEMBERED`` of them), so that a passage that a third of all documents hold leaves a task once.
   How many different contexts an anchor has is summed apart, from one number of each bucket: no anchor's records meet in one task.
2. Where an anchor has several different contexts, their texts are fetched and dealt out by anchor (an anchor
   with more than ``HOT`` is dealt out string by string instead, by a hash of the whole string and its anchor, each string once a
   slice from the task that holds it; equal ones are marked where they meet). Each shard is indexed by a
   run-compressed Burrows-Wheeler transform with sampled run ends, all its contexts are streamed through it,
   and the starts whose matching statistics reach ``length`` in an earlier context are marked.
3. Marks meet their documents, are unified and cut out.

Records travel packed, many to a row, as the columns of one numpy table. The numbers of groups and buckets follow the bytes of
the input, so that a group is about ``GROUP_MB`` of it at any size; a task sends a bucket at most one row for each record.

Nulls: a null text is empty, a null id sorts before all others. Rows with one id and different texts are
documents in the order of a checksum of the text; rows that repeat id and text are one document and
get one result each. A very long text is hashed a chunk at a time and stands in one group. Texts shorter than ``length`` lose nothing. An empty table gives an empty result; columns with the names of
added ones give way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .buffers import mix, prefix_hash, row_ranges, span_hash, text_buffer
from .common import checkpointed, lean, parts_for, slices, table
from .runindex import RunLengthIndex

LENGTH, K, BUCKET_MB, GROUP_MB, HOT, SHARD, REMEMBERED = 100, 40, 8, 4, 4096, 1 << 19, 1 << 17
NO_ID = -(1 << 63)
FIRST, COPY, SAME = range(3)
_CHUNK = 1 << 18

RECORD = [("mh", "<u8"), ("ch", "<u8"), ("doc", "<i8"), ("th", "<u4"), ("s", "<u4"), ("n", "u1"), ("off", "u1")]
MARK = [("doc", "<i8"), ("th", "<u4"), ("s", "<u4"), ("n", "u1")]
NEED = [("mh", "<u8"), ("doc", "<i8"), ("th", "<u4"), ("s", "<u4"), ("n", "u1"), ("off", "u1"), ("hot", "u1")]
CONTEXT = [("mh", "<u8"), ("doc", "<i8"), ("th", "<u4"), ("s", "<u4"), ("n", "u1")]
Table = dict[str, np.ndarray]


def packed(t: Table, form: list[tuple[str, str]], rows: np.ndarray) -> bytes:
    return len(rows).to_bytes(8, "little") + b"".join(t[name][rows].astype(kind, copy=False).tobytes() for name, kind in form)


def unpacked(blobs: list[bytes], form: list[tuple[str, str]]) -> Table:
    """The tables of all blobs, one after another; bytes after a table are left alone."""
    parts: dict[str, list[np.ndarray]] = {name: [np.zeros(0, kind)] for name, kind in form}
    for blob in blobs:
        n, at = int.from_bytes(blob[:8], "little"), 8
        for name, kind in form:
            parts[name].append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(x) for name, x in parts.items()}


def split(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value of ``key`` with its rows."""
    if len(key):
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        for rows in np.split(order, cuts[1:]):
            yield int(key[rows[0]]), rows


def group_of(ids: np.ndarray, th: np.ndarray, groups: int) -> np.ndarray:
    """Documents are dealt by id and checksum of the text; the same numbers as ``group_column``."""
    prime = 2147483647
    return np.mod(np.mod(np.mod(ids, prime) + np.mod(th.astype(np.int64), prime), prime) * 48271, prime) % groups


def group_column(groups: int) -> Column:
    prime = F.lit(2147483647)
    return (F.pmod(F.pmod(F.pmod(F.col("_id"), prime) + F.pmod(F.col("_th"), prime), prime) * 48271, prime) % groups).cast("int")


def contexts(buffer: np.ndarray, offsets: np.ndarray, length: int, k: int) -> Table:
    """The contexts in a batch of texts: anchor hash, context hash, text number ``row``, start ``s`` of the
    first string, number ``n`` of strings and the anchor's offset ``off`` from ``s``."""
    width, low = length - k + 1, np.uint64(_CHUNK - 1)
    prefix = prefix_hash(buffer)
    last = offsets[1:] - length  # of a text, the start of its last string
    out: list[tuple[np.ndarray, ...]] = []
    step = _CHUNK - width
    for c in range(0, max(len(buffer) - length + 1, 0), step):
        at = np.arange(c, min(c + _CHUNK, len(buffer) - k + 1))
        gram = span_hash(prefix, at, at + k)
        least = (gram & ~low) | np.arange(len(at), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        least = least[:step]
        anchor = (least & low).astype(np.int64) + c
        start = np.arange(c, c + len(least))
        row = np.searchsorted(offsets, start, side="right") - 1
        valid = np.flatnonzero(start <= last[row])
        if not len(valid):
            continue
        anchor, start, row = anchor[valid], start[valid], row[valid]
        cut = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])))
        n = np.diff(np.append(cut, len(valid)))
        s, a = start[cut], anchor[cut]
        out.append((gram[a - c], span_hash(prefix, s, s + n + length - 1), row[cut], s - offsets[row[cut]], n, a - s))
    names, kinds = ("mh", "ch", "row", "s", "n", "off"), (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64)
    return {name: np.concatenate([x[i] for x in out]) if out else np.zeros(0, kind) for i, (name, kind) in enumerate(zip(names, kinds, strict=True))}


def later_copies(t: Table) -> np.ndarray:
    """``FIRST``, ``COPY`` or ``SAME`` for each context: of equal ones, all at other places than the first are copies; a place that comes again counts once."""
    if not len(t["mh"]):
        return np.zeros(0, np.uint8)
    same = _both(t)
    order = np.argsort(same)
    twice = np.append(False, same[order][1:] == same[order][:-1])
    twice = order[twice | np.append(twice[1:], False)]
    flag = np.full(len(same), FIRST, np.uint8)
    if len(twice):
        rows = twice[np.lexsort((t["s"][twice], t["th"][twice], t["doc"][twice], t["ch"][twice], t["mh"][twice]))]
        as_before = lambda *names: np.append(False, np.logical_and.reduce([t[n][rows][1:] == t[n][rows][:-1] for n in names]))
        flag[rows[as_before("mh", "ch")]] = COPY
        flag[rows[as_before("mh", "ch", "doc", "th", "s")]] = SAME
    return flag


class Remembered:
    """Contexts that a task has met twice, with the least place of each: what comes again is known to be a copy and need not be sent."""

    def __init__(self, most: int = REMEMBERED) -> None:
        self.most, self.key = most, np.zeros(0, np.uint64)
        self.t = {name: np.zeros(0, kind) for name, kind in RECORD[:5]}

    def look(self, t: Table, flag: np.ndarray) -> np.ndarray:
        """``flag`` of ``later_copies``, with those that are first in ``t`` alone set to ``COPY`` or ``SAME``."""
        first = np.flatnonzero(flag == FIRST)
        key = _both(t)[first]
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            known = (self.key[at] == key) & (self.t["mh"][at] == t["mh"][first]) & (self.t["ch"][at] == t["ch"][first])
            at, own = at[known], first[known]
            before = np.zeros(len(at), bool)
            level = np.ones(len(at), bool)  # equal so far
            for name in ("doc", "th", "s"):
                a, b = self.t[name][at].astype(np.int64), t[name][own].astype(np.int64)
                before |= level & (a < b)
                level &= a == b
            flag[own[before]], flag[own[level]] = COPY, SAME
            lower = ~before & ~level
            for name in ("doc", "th", "s"):
                self.t[name][at[lower]] = t[name][own[lower]]
            first, key = first[~known], key[~known]
        room = self.most - len(self.key)
        again = np.flatnonzero(np.isin(key, _both(t)[flag == COPY]))[:room]
        if len(again):
            new = np.append(self.key, key[again])
            order = np.argsort(new, kind="stable")
            self.key = new[order]
            self.t = {name: np.append(x, t[name][first[again]].astype(x.dtype))[order] for name, x in self.t.items()}
        return flag


def _both(t: Table) -> np.ndarray:
    return mix(t["mh"] + t["ch"] * np.uint64(0x9E3779B97F4A7C15))


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _rows(out: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = zip(*out, strict=True) if out else [[] for _ in schema]
    return pa.table([pa.array(list(c), kind) for c, (_, kind) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])


SENT = [("bucket", pa.int32()), ("kind", pa.int32()), ("g", pa.int32()), ("blob", pa.binary())]
SENT_SQL = "bucket int, kind int, g int, blob binary"
FOUND = SENT[1:]
FOUND_SQL = "kind int, g int, blob binary"
ASKED = [("owner", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary())]
ASKED_SQL = "owner int, bucket int, blob binary"
RECORDS, MARKS, NEEDS, STRINGS, CONTEXTS = range(5)
SPREAD, LOT = 8, 1 << 13


def _send(buckets: int, groups: int, length: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        known = Remembered()
        for batch in slices(batches, 2, limit=2 << 20, rows=1 << 20):
            buffer, offsets = text_buffer(batch.column(2))
            t = contexts(buffer, offsets, length, k)
            ids, th = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            t["doc"], t["th"] = ids[t["row"]], th[t["row"]]
            copy = known.look(t, later_copies(t))
            first, again = np.flatnonzero(copy == FIRST), np.flatnonzero(copy == COPY)
            out = [(b, RECORDS, -1, packed(t, RECORD, first[rows])) for b, rows in split(_bucket(_both(t)[first], buckets))]
            out += [(g % buckets, MARKS, g, packed(t, MARK, again[rows])) for g, rows in split(group_of(t["doc"][again], t["th"][again], groups))]
            yield from _rows(out, SENT).to_batches()
        lean()

    return run


def _received(sent: pa.Table) -> tuple[Table, np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's records, what later_copies says of them, and the anchors of the first ones with their numbers."""
    rows = zip(sent.column("kind").to_pylist(), sent.column("blob").to_pylist(), strict=True)
    t = unpacked([b for kind, b in rows if kind == RECORDS], RECORD)
    copy = later_copies(t)
    anchors, count = np.unique(t["mh"][copy == FIRST], return_counts=True)
    return t, copy, anchors, count


def _count(buckets: int) -> Callable:
    """To the owner of each anchor: how many different contexts this bucket has of it."""

    def run(sent: pa.Table) -> pa.Table:
        lean()
        _, _, anchors, count = _received(sent)
        own = sent.column("bucket")[0].as_py()
        return _rows([(o, own, anchors[rows].tobytes() + np.minimum(count[rows], 255).astype("u1").tobytes()) for o, rows in split(_bucket(anchors, buckets))], ASKED)

    return run


def _total(hot: int) -> Callable:
    """Back to each bucket, in its order: 0 for an anchor with one context in all buckets, 1 for several, 2 for more than ``hot``."""

    def run(asked: pa.Table) -> pa.Table:
        lean()
        blobs = asked.column("blob").to_pylist()
        size = [len(b) // 9 for b in blobs]
        anchors, at = np.unique(np.concatenate([np.frombuffer(b, "<u8", n) for b, n in zip(blobs, size, strict=True)]), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([np.frombuffer(b, "u1", n, 8 * n) for b, n in zip(blobs, size, strict=True)]), minlength=len(anchors))
        told = ((total > 1).astype("u1") + (total > hot))[at].astype("u1")
        return _rows(list(zip(asked.column("owner").to_pylist(), asked.column("bucket").to_pylist(), [x.tobytes() for x in np.split(told, np.cumsum(size)[:-1])], strict=True)), ASKED)

    return run


def _meet(buckets: int, groups: int) -> Callable:
    """The records of some contexts: later copies of one are marks, and where the anchor has others a context's text is needed."""

    def run(sent: pa.Table, answered: pa.Table) -> pa.Table:
        lean()
        rows = list(zip(*(sent.column(c).to_pylist() for c in ("kind", "g", "blob")), strict=True))
        out = [row for row in rows if row[0] == MARKS]
        t, copy, anchors, _ = _received(sent)
        told = np.zeros(len(anchors), np.uint8)
        said = dict(zip(answered.column("owner").to_pylist(), answered.column("blob").to_pylist(), strict=True))
        for o, own in split(_bucket(anchors, buckets)):
            told[own] = np.frombuffer(said[o], "u1")
        again, first = np.flatnonzero(copy == COPY), np.flatnonzero(copy == FIRST)
        told = told[np.searchsorted(anchors, t["mh"][first])]
        first, told = first[told > 0], told[told > 0]
        t["hot"] = np.zeros(len(copy), np.uint8)
        t["hot"][first] = told > 1
        out += [(MARKS, g, packed(t, MARK, again[own])) for g, own in split(group_of(t["doc"][again], t["th"][again], groups))]
        out += [(NEEDS, g, packed(t, NEED, first[own])) for g, own in split(group_of(t["doc"][first], t["th"][first], groups))]
        return _rows(out, FOUND)

    return run


def _places(docs: pa.Table, t: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The documents' bytes and offsets, and each record with each document row that it is about."""
    buffer, offsets = text_buffer(docs.column("_body").combine_chunks())
    key = lambda doc, th: mix(doc.astype(np.int64).view(np.uint64) + th.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    own = key(docs.column("_id").to_numpy(), docs.column("_th").to_numpy())
    order = np.argsort(own, kind="stable")
    about = key(t["doc"], t["th"])
    low, high = np.searchsorted(own[order], about), np.searchsorted(own[order], about, side="right")
    many = high - low
    record = np.repeat(np.arange(len(about)), many)
    row = order[np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)] if many.sum() else np.zeros(0, np.int64)
    return buffer, offsets, record, row


def _strings(t: Table, base: np.ndarray, buffer: np.ndarray, buckets: int, groups: int, length: int) -> list[tuple]:
    """The strings of some contexts, one by one: each distinct one once, by its hash, and marks for its copies."""
    n = t["n"].astype(np.int64)
    of = np.repeat(np.arange(len(n)), n)
    s = t["s"][of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    size = n + length - 1  # contexts laid side by side, so that a string's bytes are hashed by prefix sums
    edge = np.cumsum(size) - size
    at = np.repeat(base + t["s"] - edge, size) + np.arange(size.sum())
    start = edge[of] + s - t["s"][of]
    whole = span_hash(prefix_hash(buffer[at]), start, start + length)
    u = {"mh": whole, "ch": t["mh"][of], "doc": t["doc"][of], "th": t["th"][of], "s": s, "n": np.ones(len(of), np.uint8), "off": np.zeros(len(of), np.uint8)}
    copy = later_copies(u)
    first, again = np.flatnonzero(copy == FIRST), np.flatnonzero(copy == COPY)
    # strings side by side of one context are one mark
    cut = np.flatnonzero(np.append(True, (np.diff(again) != 1) | (np.diff(of[again]) != 0))) if len(again) else again
    m = {"doc": u["doc"][again[cut]], "th": u["th"][again[cut]], "s": s[again[cut]], "n": np.diff(np.append(cut, len(again)))}
    out = [(g, MARKS, g, packed(m, MARK, rows)) for g, rows in split(group_of(m["doc"], m["th"], groups))]
    return out + [(b, STRINGS, -1, packed(u, RECORD, first[rows])) for b, rows in split(_bucket(u["mh"][first], buckets * SPREAD) + buckets)]


def _fetch(buckets: int, groups: int, length: int) -> Callable:
    """The texts of the contexts that are asked for; of those of a hot anchor, their strings."""

    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        lean()
        t = unpacked(asked.column("blob").to_pylist(), NEED)
        if not len(t["doc"]):
            return _rows([], SENT)
        buffer, offsets, record, row = _places(docs, t)
        record, once = np.unique(record, return_index=True)
        row = row[once]
        t = {name: x[record] for name, x in t.items()}
        t["s"] = t["s"].astype(np.int64)
        base = offsets[row]
        out = []
        hot = np.flatnonzero(t["hot"])
        for i in range(0, len(hot), LOT):
            rows = hot[i : i + LOT]
            out += _strings({name: x[rows] for name, x in t.items()}, base[rows], buffer, buckets, groups, length)
        cool = np.flatnonzero(t["hot"] == 0)
        for bucket, rows in split(_bucket(t["mh"][cool], buckets)):
            rows = cool[rows]
            size = t["n"][rows].astype(np.int64) + length - 1
            at = np.repeat(base[rows] + t["s"][rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            out.append((bucket, CONTEXTS, -1, packed(t, CONTEXT, rows) + buffer[at].tobytes()))
        return _rows(out, SENT)

    return run


def _index(groups: int, length: int) -> Callable:
    """Indexes the contexts of some anchors, a shard of about a megabyte at a time, and marks what stands in an earlier one; marks later ones of equal strings."""

    def run(sent: pa.Table) -> pa.Table:
        lean()
        rows = list(zip(*(sent.column(c).to_pylist() for c in ("kind", "g", "blob")), strict=True))
        done = [row for row in rows if row[0] == MARKS]
        u = unpacked([b for kind, _, b in rows if kind == STRINGS], RECORD)
        again = np.flatnonzero(later_copies(u) == COPY)
        done += [(MARKS, g, packed(u, MARK, again[rows])) for g, rows in split(group_of(u["doc"][again], u["th"][again], groups))]
        blobs = [b for kind, _, b in rows if kind == CONTEXTS]
        if not blobs:
            return _rows(done, FOUND)
        t = unpacked(blobs, CONTEXT)
        record = sum(np.dtype(kind).itemsize for _, kind in CONTEXT)
        text = np.concatenate([np.frombuffer(b, np.uint8, offset=8 + record * int.from_bytes(b[:8], "little")) for b in blobs])
        size = t["n"].astype(np.int64) + length - 1
        begin = np.cumsum(size) - size
        order = np.lexsort((t["s"], t["th"], t["doc"], t["mh"]))
        anchor = t["mh"][order]
        new = np.append(True, anchor[1:] != anchor[:-1])
        group = np.cumsum(new) - 1
        order, group = (x[np.bincount(group)[group] > 1] for x in (order, group))
        if not len(order):
            return _rows(done, FOUND)
        total = np.cumsum(size[order])
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        shard = (total[starts] // SHARD)[np.searchsorted(starts, np.arange(len(order)), side="right") - 1]  # groups are not torn apart
        marks: dict[str, list[np.ndarray]] = {name: [] for name, _ in MARK}
        for _, rows in split(shard):
            rows = order[rows]
            n = size[rows]
            at = np.repeat(begin[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            which, first = RunLengthIndex(text[at], np.append(0, np.cumsum(n)), length).repeats()
            by = np.lexsort((first, which))
            which, first = which[by], first[by]
            cut = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (first[1:] != first[:-1] + 1))) if len(which) else np.zeros(0, np.int64)
            who = rows[which[cut]]
            for name, x in (("doc", t["doc"][who]), ("th", t["th"][who]), ("s", t["s"][who] + first[cut]), ("n", np.diff(np.append(cut, len(which))))):
                marks[name].append(x)
        m = {name: np.concatenate(x) for name, x in marks.items()}
        return _rows(done + [(MARKS, g, packed(m, MARK, rows)) for g, rows in split(group_of(m["doc"], m["th"], groups))], FOUND)

    return run


def _cut(length: int, names: list[str], whole: bool) -> Callable:
    """Documents with their marks: what is left of each, and the spans that go."""

    def run(docs: pa.Table, marks: pa.Table) -> pa.Table:
        lean()
        t = unpacked(marks.column("blob").to_pylist(), MARK)
        buffer, offsets, record, row = _places(docs, t)
        start = offsets[row] + t["s"][record]
        by = np.argsort(start, kind="stable")
        start, end = start[by], (start + t["n"][record] + length - 1)[by]
        gone = np.zeros(len(buffer), bool)
        for i, j in row_ranges(offsets, 1 << 20):  # marks lie within their documents
            lo, hi = offsets[i], offsets[j]
            own = slice(*np.searchsorted(start, [lo, hi]))
            step = np.zeros(hi - lo + 1, np.int32)
            np.add.at(step, start[own] - lo, 1)
            np.subtract.at(step, end[own] - lo, 1)
            part = np.cumsum(step, out=step)[:-1] > 0
            if whole and len(part):
                lead = np.flatnonzero((buffer[lo:hi] & 0xC0) != 0x80)  # a character goes if all its bytes do
                part = np.repeat(np.logical_and.reduceat(part, lead), np.diff(np.append(lead, len(part))))
            gone[lo:hi] = part
        rise = gone.copy()
        rise[1:] &= ~gone[:-1]
        inner = offsets[:-1][(offsets[:-1] < offsets[1:])]
        rise[inner] = gone[inner]  # a span ends with its document
        fall = np.append(gone[:-1] & (~gone[1:] | rise[1:]), gone[-1:])
        s, e = np.flatnonzero(rise), np.flatnonzero(fall) + 1
        of = np.searchsorted(s, offsets)
        base = np.repeat(offsets[:-1], np.diff(of))
        spans = pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.StructArray.from_arrays([pa.array(s - base, pa.int64()), pa.array(e - base, pa.int64())], names=["start", "end"]))
        left = np.append(0, np.cumsum(~gone, dtype=np.int32))[offsets]
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(docs), [None, pa.py_buffer(left.astype(np.int64).tobytes()), pa.py_buffer(buffer[~gone].tobytes())]).cast(pa.binary())
        out = [docs.column(name) for name in names] + [pa.array(np.diff(offsets), pa.int64()), spans, kept]
        return pa.table(out, names=[*names, "n_bytes", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = K, text: str = "text", id_column: str = "doc_id", hot: int = HOT, whole: bool = False) -> DataFrame:
    """The columns of ``docs`` but its text, and ``n_bytes``, ``spans`` (what goes, in bytes) and ``kept`` (what is left, bytes).

    ``whole``: characters of which a byte stays are kept whole, so that what is left is text.
    """
    added = (text, "n_bytes", "spans", "kept", "_id", "_th", "_body", "_g")
    others = [c for c in docs.columns if c not in added]
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    buckets = parts_for(docs, text, BUCKET_MB)
    groups = -(-buckets * BUCKET_MB // GROUP_MB)
    keyed = docs.select(*others, F.coalesce(F.col(id_column), F.lit(NO_ID)).cast("long").alias("_id"), F.crc32(body).alias("_th"), body.alias("_body"))
    sent = keyed.select("_id", "_th", "_body").mapInArrow(_send(buckets, groups, length, k), SENT_SQL)
    counted = sent.groupBy("bucket").applyInArrow(_count(buckets), ASKED_SQL).groupBy("owner").applyInArrow(_total(hot), ASKED_SQL)
    found = checkpointed(sent.groupBy("bucket").cogroup(counted.groupBy("bucket")).applyInArrow(_meet(buckets, groups), FOUND_SQL))
    dealt = keyed.withColumn("_g", group_column(groups))
    needs = found.filter(F.col("kind") == NEEDS).select("g", "blob")
    texts = dealt.groupBy("_g").cogroup(needs.groupBy("g")).applyInArrow(_fetch(buckets, groups, length), SENT_SQL)
    marks = texts.groupBy("bucket").applyInArrow(_index(groups, length), FOUND_SQL).unionAll(found.filter(F.col("kind") == MARKS)).select("g", "blob")
    span = T.StructType().add("start", "long").add("end", "long")
    schema = docs.select(*others).schema.add("n_bytes", "long").add("spans", T.ArrayType(span)).add("kept", "binary")
    return dealt.groupBy("_g").cogroup(marks.groupBy("g")).applyInArrow(_cut(length, others, whole), schema)


def op2_run_length_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )
