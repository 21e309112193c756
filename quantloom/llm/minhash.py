"""Near-duplicates by a signature-coordinate inverted join.

Documents with equal shingle sets are one class, and a class is one node. A node has a MinHash signature
of ``COORDINATES`` values and is posted under each coordinate-value pair: a pair's nodes are its list. Two sets that are
similar enough agree in at least ``t`` coordinates (all but a share of 1e-6 of such pairs; ``match_threshold``), which is
a T-occurrence join over the lists, merged with skips:

- a pair that only one node has cannot agree with anyone; a node with fewer than ``t`` shared pairs is done;
- lists are ordered by length, the shortest first. The ``t - 1`` longest lists of a node are skipped: whoever agrees with it
  in t lists meets it in one of the others (its prefix);
- where two nodes meet in a list their collisions are counted over both signatures, by the one list that comes first of those
  they share, so that a pair is counted once however many lists it shares. Pairs with ``t`` or more that pass the length
  bound are retained and confirmed on the full sets; pairs that links of the same list already connect are passed over.

A list is never expanded into its pairs: lists are dealt to tasks, many short ones to one, and a task gives the nodes
that have a retained partner, then, with their sets beside them, the links that connect them. A list of more than ``BLOCK``
nodes is cut into blocks. All blocks are held against the first; then only nodes that this leaves apart from
the list's largest component are held, block by block, against the whole list. A list of copies so costs in
proportion to its length; one of many nodes that agree in ``t`` coordinates and are yet not similar costs its square, in bounded tasks.

Nulls: a null or wordless text has an empty set and is linked with nothing; a null id sorts first. Rows
that repeat an id are rows of their own. Fewer words than a shingle has are one shingle. A very long text is hashed a slice at a time with
those around it and costs in proportion. Ties (equal sets) are one class under the least id. An empty
table gives an empty result; other columns than the id and the text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .buffers import LOWER, WHITE, mix, prefix_hash, span_hash, text_buffer, words
from .common import checkpointed, lean, sieved, slices, table
from .components import components

COORDINATES, BLOCK, SET_MB = 32, 2048, 8
NO_ID = -(1 << 63)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_A = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix(np.arange(1001, COORDINATES + 1001, dtype=np.uint64))


def match_threshold(similar: float, coordinates: int = COORDINATES, miss: float = 1e-6) -> int:
    """The most coordinates in which sets of this similarity agree but for a share ``miss`` of pairs."""
    below = 0.0
    for t in range(coordinates + 1):
        below += math.comb(coordinates, t) * similar**t * (1 - similar) ** (coordinates - t)
        if below > miss:
            return max(t, 1)
    return coordinates


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles."""
    buffer, offsets = text_buffer(column)
    buffer = LOWER[buffer]
    start, end, at = words(buffer, offsets, WHITE)
    hashes = span_hash(prefix_hash(buffer), start, end)
    n = len(hashes)
    chain = [np.full(n, np.uint64(1))]  # chain[k][i]: words i to i + k - 1
    for k in range(width):
        size = n - k
        chain.append(mix(chain[-1][: max(size, 0)] * _ODD + hashes[k:]) if size > 0 else np.zeros(0, np.uint64))
    out = []
    for d in range(len(at) - 1):
        lo, hi = int(at[d]), int(at[d + 1])
        k = min(width, hi - lo)
        out.append(np.unique(chain[k][lo : hi - k + 1]) if k else np.zeros(0, np.uint64))
    return out


def digest(x: np.ndarray) -> bytes:
    return np.array([mix(x).sum(dtype=np.uint64), mix(x ^ _ODD).sum(dtype=np.uint64) + np.uint64(len(x))], "<u8").tobytes()


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (sets x COORDINATES) of non-empty sets."""
    if not sets:
        return np.zeros((0, COORDINATES), np.int64)
    flat, cut = np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets[:-1]])
    out = np.empty((len(sets), COORDINATES), np.uint64)
    for j in range(COORDINATES):
        out[:, j] = np.minimum.reduceat((flat ^ _B[j]) * _A[j], cut)
    return out.view(np.int64)


def _sign(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in slices(batches, 2, limit=1 << 20):
            sets = shingle_sets(batch.column(2), width)
            full = [x for x in sets if len(x)]
            sig, size = signatures(full), np.array([len(x) for x in sets], np.int64)
            of = np.append(0, np.cumsum(size > 0)) * COORDINATES
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(size), pa.array([digest(x) for x in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(sig.ravel()))],
                names=["_id", "_h", "n", "node", "sig"],
            )
        lean()

    return run


def _sets(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in slices(batches, 1, limit=1 << 20):
            sets = shingle_sets(batch.column(1), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "shingles"])
        lean()

    return run


def _pairs(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (a, b) of nodes that meet in a list, in bounded lots: within the one block, or between the two, that the rows are of.

    ``side`` is 0 for rows within their block, else 1 or 2.
    """
    lists, side = rows.column("list").to_numpy(), rows.column("side").to_numpy()
    order = np.lexsort((side, lists))
    lists, side = lists[order], side[order]
    if len(order) and side[0]:  # one list, two blocks
        left, right = order[side == 1], order[side == 2]
        for a in left:
            yield np.full(len(right), a), right
        return
    step = 1
    at = np.arange(len(order))
    while True:
        at = at[at + step < len(order)]
        at = at[lists[at] == lists[at + step]]
        if not len(at):
            return
        for i in range(0, len(at), 1 << 14):
            yield order[at[i : i + (1 << 14)]], order[at[i : i + (1 << 14)] + step]
        step += 1


def _retained(rows: pa.Table, t: int, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that meet here first, agree in ``t`` coordinates and pass the length bound."""
    flat = lambda name, kind: np.array(rows.column(name).combine_chunks().flatten()).astype(kind).reshape(len(rows), COORDINATES)
    sig, rank = flat("sig", np.int64), flat("rank", np.uint8)
    size, coordinate, label = rows.column("n").to_numpy(), rows.column("coordinate").to_numpy(), None
    if "label" in rows.column_names:
        label = rows.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
    for a, b in _pairs(rows):
        small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
        fits = small * den >= large * num
        if label is not None:
            fits &= label[a] != label[b]
        a, b = a[fits], b[fits]
        same = sig[a] == sig[b]
        enough = same.sum(axis=1) >= t
        a, b, same = a[enough], b[enough], same[enough]
        here = np.where(same, rank[a], 255).argmin(axis=1) == coordinate[a]
        if here.any():
            yield a[here], b[here]


KEY = ["_bucket", "_i", "_j"]
MET = "_bucket long, _i int, _j int, list long, coordinate int, side int, node binary"
LINKED = "a binary, b binary"


def _met(t: int, num: int, den: int) -> Callable:
    """The rows of which the list has a partner that is retained."""

    def run(rows: pa.Table) -> pa.Table:
        lean()
        found = np.zeros(len(rows), bool)
        for a, b in _retained(rows, t, num, den):
            found[a] = found[b] = True
        return rows.filter(pa.array(found)).select(["_bucket", "_i", "_j", "list", "coordinate", "side", "node"])

    return run


def _confirmed(t: int, num: int, den: int) -> Callable:
    """Links, confirmed on full sets, that connect all of these nodes that links of these lists connect."""

    def run(rows: pa.Table) -> pa.Table:
        lean()
        node, size = rows.column("node").to_pylist(), rows.column("n").to_numpy()
        known: dict[bytes, int] = {}
        of = [known.setdefault(x, i) for i, x in enumerate(rows.column("label" if "label" in rows.column_names else "node").to_pylist())]
        root = list(range(len(rows)))
        sets = [np.frombuffer(b, np.uint64) for b in rows.column("shingles").to_pylist()]

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        links = []
        for a, b in _retained(rows, t, num, den):
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                x, y = find(of[i]), find(of[j])
                if x != y:
                    few, many = (sets[i], sets[j]) if size[i] <= size[j] else (sets[j], sets[i])
                    both = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
                    if den * both >= num * (size[i] + size[j] - both):
                        root[y] = x
                        links.append((node[i], node[j]))
        return pa.table([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return run


def _blocks(dealt: DataFrame) -> DataFrame:
    """Rows for each pair of blocks that their list is first held by: its only block, or its first one with each."""
    long_ = F.col("_blocks") > 1
    own = F.col("_own")
    pair = lambda i, j, side: F.struct(i.cast("int").alias("_i"), j.cast("int").alias("_j"), side.cast("int").alias("side"))
    none, zero = F.lit(-1), F.lit(0)
    home = pair(none, none, zero)
    within = pair(zero, zero, zero)
    others = F.transform(F.sequence(F.lit(1), F.col("_blocks") - 1), lambda j: pair(zero, j, F.lit(1)))
    goes = F.when(~long_, F.array(home)).when(own == 0, F.concat(F.array(within), others)).otherwise(F.array(pair(zero, own, F.lit(2))))
    return dealt.select("list", "coordinate", "node", "_blocks", F.inline(goes)).withColumn("_bucket", F.col("list"))


def _links(goes: DataFrame, nodes: DataFrame, bodies: Callable[[DataFrame], DataFrame], t: int, num: int, den: int) -> DataFrame:
    """Confirmed links of dealt rows (list, coordinate, node, side and ``KEY``): first who has a partner, by signatures, then on their sets."""
    rows = goes.count()
    lot = max(1, rows // 20_000)
    keyed = goes.withColumn("_bucket", F.when(F.col("_i") < 0, F.pmod("list", F.lit(lot))).otherwise(F.col("_bucket")))
    own = ["n", "sig", "rank", *[c for c in nodes.columns if c == "label"]]
    met = checkpointed(keyed.select(*KEY, "list", "coordinate", "side", "node").join(nodes.select("node", *own), "node").groupBy(*KEY).applyInArrow(_met(t, num, den), MET))
    named = nodes.select("node", *own, "rep_id", "rep_h")
    held = met.join(named, "node")
    size = held.agg(F.sum("n")).first()[0] or 0
    lot = max(1, size * 8 // (SET_MB << 20))
    again = met.withColumn("_bucket", F.when(F.col("_i") < 0, F.pmod("list", F.lit(lot))).otherwise(F.col("_bucket")))
    full = again.join(named, "node").join(bodies(met.select("node").distinct().join(named.select("node", "rep_id", "rep_h"), "node")), "node")
    return checkpointed(full.select(*KEY, "list", "coordinate", "side", "node", *own, "shingles").groupBy(*KEY).applyInArrow(_confirmed(t, num, den), LINKED))


def grouped(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, text: str = "text", id_column: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """A row for each of ``docs``: _id (its id, ``NO_ID`` for none), _h (a hash of its text), n (shingles), _component (the smallest _id
    that links reach) and _group, equal for what links connect and for nothing else.

    Linked are sets with ``den * intersection >= num * union``.
    """
    t = match_threshold(num / den)
    keyed = docs.select(F.coalesce(F.col(id_column), F.lit(NO_ID)).cast("long").alias("_id"), F.xxhash64(text).alias("_h"), F.col(text).alias("_text"))
    signed = checkpointed(keyed.mapInArrow(_sign(width), "_id long, _h long, n long, node binary, sig array<long>"))
    classes = signed.filter("n > 0").groupBy("node").agg(F.min(F.struct("_id", "_h")).alias("_rep"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = checkpointed(classes.select("node", F.col("_rep._id").alias("rep_id"), F.col("_rep._h").alias("rep_h"), "n", "sig"))
    able = classes.filter(F.col("n") * (den - num) >= num)  # sets that differ and are this similar share as many shingles
    posted = able.select("node", F.posexplode("sig").alias("coordinate", "value")).select("node", "coordinate", F.xxhash64("coordinate", "value").alias("list"))
    crowded = posted.groupBy("list").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    crowded = checkpointed(crowded)  # so that a long list's rows can be split in the join
    met = posted.join(crowded, "list").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("crowd", "list", "coordinate"))).alias("_lists"))  # at most ``COORDINATES``
    met = checkpointed(met.filter(F.size("_lists") >= t))
    place = lambda c: F.array_position(F.transform("_lists", lambda x: x["coordinate"]), c)  # noqa: E731  0 for none
    rank = F.transform(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda c: F.when(place(c) > 0, place(c) - 1).otherwise(254).cast("int"))
    nodes = checkpointed(met.select("node", rank.alias("rank")).join(able, "node"))
    prefix = met.select("node", F.inline(F.slice("_lists", F.lit(1), F.size("_lists") - t + 1))).join(nodes.select("node", "n"), "node")
    lists = prefix.groupBy("list").agg(F.count("*").alias("_size"), F.sum("n").alias("_shingles")).filter("_size > 1")
    lists = checkpointed(lists)
    blocks = F.greatest(F.ceil(F.col("_size") / block), F.ceil(F.col("_shingles") * 8 / (SET_MB << 20))).cast("int")
    dealt = prefix.select("list", "coordinate", "node").join(lists.select("list", blocks.alias("_blocks")), "list")
    dealt = checkpointed(dealt.withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")))

    def bodies(wanted: DataFrame) -> DataFrame:
        """(node, shingles) of classes, read again from the rows that stand for them."""
        wanted = wanted.select(F.col("rep_id").alias("_id"), F.col("rep_h").alias("_h"), "node")
        own = sieved(keyed, "_id", wanted, "_wanted").filter("_wanted").select("_id", "_h", "_text").join(wanted, ["_id", "_h"])
        return own.select("node", "_text").mapInArrow(_sets(width), "node binary, shingles binary").dropDuplicates(["node"])

    links = _links(_blocks(dealt), nodes, bodies, t, num, den)
    labels = components(links)
    if dealt.filter("_blocks > 1").limit(1).count():
        labels = _rest(dealt.filter("_blocks > 1"), nodes, bodies, links, labels, t, num, den)
    told = signed.select("_id", "_h", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    reps = classes.select("node", F.struct("rep_id", "rep_h").alias("_rep"))
    reached = reps.join(labels, "node").groupBy("label").agg(F.min("_rep").alias("_component"))
    named = reps.join(labels, "node", "left").join(reached, "label", "left").select("node", F.coalesce("label", "node").alias("_group"), F.coalesce("_component", "_rep")["rep_id"].alias("_component"))
    out = told.join(named, "node", "left")
    return out.select("_id", "_h", "n", F.coalesce("_component", "_id").alias("_component"), F.coalesce("_group", F.concat(F.col("_id").cast("string"), F.lit(" "), F.col("_h").cast("string")).cast("binary")).alias("_group"))


def _rest(dealt: DataFrame, nodes: DataFrame, bodies: Callable[[DataFrame], DataFrame], links: DataFrame, labels: DataFrame, t: int, num: int, den: int) -> DataFrame:
    """Labels with the links of long lists that their first blocks don't have: nodes apart from a list's largest component, against all of it."""
    marked = dealt.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    most = marked.groupBy("list", "label").agg(F.count("*").alias("_n")).groupBy("list").agg(F.max_by("label", F.struct("_n", "label")).alias("_most"))
    marked = checkpointed(marked.join(most, "list"))
    apart = marked.filter(F.col("label") != F.col("_most"))
    every = F.sequence(F.lit(0), F.col("_blocks") - 1)
    asks = apart.select("list", "coordinate", "node", F.col("_own").alias("_i"), F.explode(every).alias("_j"), F.lit(1).alias("side"))
    blocks = apart.select("list", F.col("_own").alias("_i")).distinct()
    answers = marked.join(blocks, "list").select("list", "coordinate", "node", "_i", F.col("_own").alias("_j"), F.lit(2).alias("side"))
    goes = checkpointed(asks.unionByName(answers).withColumn("_bucket", F.col("list")))
    of = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return components(links.unionAll(_links(goes, of, bodies, t, num, den)))


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, text: str = "text", id_column: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """One row for each of ``docs``: its id, n_shingles, component_id (the smallest id that links reach) and whether the two are the same (``kept``)."""
    told = grouped(docs, width, num, den, text, id_column, block)
    shown = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return told.select(shown("_id").alias(id_column), F.col("n").alias("n_shingles"), shown("_component").alias("component_id"), (F.col("_id") == F.col("_component")).alias("kept"))


def op10_minhash_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), width=3, num=85, den=100)
