"""Language-model scores of texts: a word unigram base and a causal attention model, both over the whole corpus.

Base. Word counts of all training texts are too many to send to every task. Documents are dealt into groups
by id and text; a group asks about its distinct words, in packed requests by word hash; each bucket of words adds up
the counts of all groups and answers each request in its own order; the answers meet their group again.
A word that every document holds is asked once a group, with its count added up. A group sends at most one
request for each of its distinct words, however many buckets there are.

Attention. Where a group's answers come back its texts are encoded, once, and the subword ids are
checkpointed. Over the ids of all training texts are then counted: the ids, and their neighbours among frequent
ids, from which ``attention`` takes classes, shares and the prior. The network's first weights come from ``WINDOWS`` windows
on the driver (a bounded start, the lowest by a hash); it then learns from every window of every training text where the data is: a window
belongs to one of ``ROUNDS`` rounds, in which every partition of the ids steps through its windows of that round, and what the
partitions learnt is averaged, an embedding over those that met its id. So all that is gathered grows with the corpus; what reaches the driver is
bounded by the vocabulary, as sums over a tree of tasks. Texts are then scored whole.

Nulls: a null text is empty and has its end token alone; a null id counts as the empty text in the choice
of training texts. Repeated rows are scored, and counted, each. Texts are as long as they are: windows of a
long one go through the model a lot at a time. An empty table gives an empty result; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention
from .buffers import LOWER, WHITE, mix, prefix_hash, row_ranges, span_hash, text_buffer, words
from .common import checkpointed, lean, parts_for, slices, table
from .langid import remainder
from .subwords import subwords

GROUP_MB = 8
BLOCK = 24 << 10  # bytes hashed at a time: eight bytes for each of them stay in a core's cache
WINDOWS, ROUNDS, FAN = 40_000, 2, 16
END_WORD = mix(np.array([0xE2D], np.uint64))[0]


def word_stream(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and of an end after each text's, and each text's first; a block at a time."""
    buffer, offsets = text_buffer(texts)
    hashes, firsts, total = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
    for i, j in row_ranges(offsets, BLOCK):
        part = LOWER[buffer[offsets[i] : offsets[j]]]
        start, end, at = words(part, offsets[i : j + 1] - offsets[i], WHITE)
        hashes.append(np.insert(span_hash(prefix_hash(part), start, end), at[1:], END_WORD))
        firsts.append(total + (at + np.arange(len(at)))[1:])
        total += len(hashes[-1])
    return np.concatenate(hashes), np.concatenate(firsts)


def numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, in the order in which they come, and the number of each one's value; by hashing, not by a sort."""
    coded = pa.array(x).dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy(zero_copy_only=False)


def distinct(texts: pa.ChunkedArray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words ordered by bucket and hash, the buckets met, where each begins and the last ends, each word's place in that order, and each text's first word."""
    stream, at = word_stream(texts)
    hashes, place = numbered(stream)
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((hashes, bucket))
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    used, first = np.unique(bucket[order], return_index=True)
    return hashes[order], used, np.append(first, len(order)), back[place], at


def _ask(buckets: int) -> Callable:
    def run(docs: pa.Table) -> pa.Table:
        lean()
        hashes, used, bound, place, at = distinct(docs.column("_text"), buckets)
        taught = np.repeat(np.array(docs.column("_train").to_pylist(), bool), np.diff(at))
        count = np.bincount(place[taught], minlength=len(hashes)).astype("<u8")
        g = docs.column("_g")[0].as_py()
        blobs = [hashes[i:j].tobytes() + count[i:j].tobytes() for i, j in zip(bound[:-1], bound[1:], strict=True)]
        return pa.table([pa.array(used, pa.int32()), pa.array([g] * len(used), pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "g", "blob"])

    return run


def _answer(asked: pa.Table) -> pa.Table:
    """The corpus counts of one bucket's words, to each group in the order it asked; the number of words that training texts have with the first answer."""
    lean()
    blobs = asked.column("blob").to_pylist()
    tables = [np.frombuffer(b, "<u8").reshape(2, -1) for b in blobs]
    hashes, place = numbered(np.concatenate([t[0] for t in tables]))
    own = np.concatenate([t[1] for t in tables])
    total = np.zeros(len(hashes), np.uint64)
    np.add.at(total, place, own)
    cuts = np.cumsum([t.shape[1] for t in tables])[:-1]
    answers = [x.astype("<u8").tobytes() for x in np.split(total[place], cuts)]
    taught = [int((total > 0).sum()), *[0] * (len(blobs) - 1)]
    return pa.table([asked.column("bucket"), asked.column("g"), pa.array(answers, pa.binary()), pa.array(taught, pa.int64())], names=["bucket", "g", "blob", "taught"])


MEASURED = "doc_id long, _train boolean, n_tokens long, n_known long, _logs double, _taught long, _ids binary"


def _measure(buckets: int, path: str | None) -> Callable:
    """Word counts and logs of a group's documents, and their subword ids (two bytes each); the group's share of the number of words taught with its first."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        lean()
        hashes, used, bound, place, at = distinct(docs.column("_text"), buckets)
        count = np.zeros(len(hashes), np.uint64)
        where = {b: k for k, b in enumerate(used.tolist())}
        for b, blob in zip(answers.column("bucket").to_pylist(), answers.column("blob").to_pylist(), strict=True):
            count[bound[where[b]] : bound[where[b] + 1]] = np.frombuffer(blob, "<u8")
        logs = np.log10(count.astype(np.float64) + 1)[place]
        known, first = (count > 0)[place], at[:-1]
        encode = subwords(path).encode
        ids = [encode(t or "").astype("<u2").tobytes() for part in docs.select(["_text"]).to_batches() for t in part.column(0).to_pylist()]
        taught = np.zeros(len(first), np.int64)
        taught[0] = sum(answers.column("taught").to_pylist())
        out = [docs.column("doc_id"), docs.column("_train"), pa.array(np.diff(at), pa.int64()), pa.array(np.add.reduceat(known.astype(np.int64), first)), pa.array(np.add.reduceat(logs, first)), pa.array(taught), pa.array(ids, pa.binary())]
        return pa.table(out, names=[x.split()[0] for x in MEASURED.split(", ")])

    return run


CELLS = "part int, cell binary, value binary"


def _cells(part: int, cell: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    if (cell[1:] <= cell[:-1]).any():
        cell, at = np.unique(cell, return_inverse=True)
        value = np.bincount(at, weights=value, minlength=len(cell))
    blobs = [pa.array([x.tobytes()], pa.binary()) for x in (cell.astype("<i8"), value.astype("<f8"))]
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *blobs], names=["part", "cell", "value"])


def _added(rows: pa.Table) -> pa.Table:
    lean()
    cell, value = (np.concatenate([np.frombuffer(b, kind) for b in rows.column(name).to_pylist()]) for name, kind in (("cell", "<i8"), ("value", "<f8")))
    return pa.Table.from_batches([_cells(rows.column("part")[0].as_py(), cell, value)])


def tree_sum(cells: DataFrame, size: int, parts: int) -> np.ndarray:
    """The sum of sparse vectors of ``size`` cells, one a partition, ``FAN`` of them a task and level, so that no task holds many."""
    while parts > FAN:
        cells = cells.withColumn("part", F.expr(f"part div {FAN}").cast("int")).groupBy("part").applyInArrow(_added, CELLS)
        parts = -(-parts // FAN)
    out = np.zeros(size)
    for row in cells.toLocalIterator():  # at most ``FAN`` rows
        np.add.at(out, np.frombuffer(row["cell"], "<i8"), np.frombuffer(row["value"], "<f8"))
    return out


def _joined(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some texts, one after another, and how many each has."""
    return np.frombuffer(b"".join(blobs), "<u2"), np.array([len(b) // 2 for b in blobs], np.int64)


def summed(ids: DataFrame, cells_of: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int, parts: int) -> np.ndarray:
    """How often each cell is met in the ids of all rows; ``cells_of`` gives the cells of some texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        total, part = np.zeros(size, np.float32 if size > 1 << 20 else np.float64), TaskContext.get().partitionId()
        for batch in slices(batches, 0, limit=2 << 20, rows=10_000):
            total += np.bincount(cells_of(*_joined(batch.column(0).to_pylist())), minlength=size)
        cell = np.flatnonzero(total)
        yield _cells(part, cell, total[cell])

    return tree_sum(ids.select("_ids").mapInArrow(run, CELLS), size, parts)


def _laid(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``attention.windows`` of some texts' ids."""
    return attention.windows(*_joined(blobs))


def _drawn(blobs: list[bytes], keep: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows whose number ``keep`` takes: that number, the line, where they begin in it, targets and tokens. Only texts that have one are laid out.

    The number is of the text's ids and the window's place: equal texts draw the same wherever they are.
    """
    many = attention.n_windows(np.array([len(b) // 2 for b in blobs], np.int64))
    of = np.repeat(np.arange(len(blobs)), many)
    place = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    seed = np.array([zlib.crc32(b) for b in blobs], np.uint64)[of]
    draw = mix(seed * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
    own = np.flatnonzero(keep(draw))
    texts = np.flatnonzero(np.bincount(of[own], minlength=len(blobs)))
    which = np.searchsorted(texts, of[own])
    line, begin, y, real, _ = _laid([blobs[t] for t in texts])
    at = (np.cumsum(many[texts]) - many[texts])[which] + place[own]
    return draw[own], line, begin[at], y[at], real[at]


def _sample(ids: DataFrame, total: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``WINDOWS`` different windows that draw the lowest, of all training texts."""
    below = int(min(1.0, 1.5 * WINDOWS / max(total, 1)) * (1 << 62))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in slices(batches, 0, limit=2 << 20, rows=10_000):
            draw, line, begin, y, real = _drawn(batch.column(0).to_pylist(), lambda d: d >> np.uint64(2) <= below)
            rows = np.concatenate([attention.inputs_at(line, begin), y, real], axis=1).astype("<i4")
            yield pa.RecordBatch.from_arrays([pa.array((draw >> np.uint64(2)).astype(np.int64)), pa.array([b.tobytes() for b in rows], pa.binary())], names=["draw", "w"])

    rows = ids.select("_ids").mapInArrow(run, "draw long, w binary").distinct().orderBy("draw", "w").limit(WINDOWS).collect()  # the sample
    flat = np.frombuffer(b"".join(bytes(r["w"]) for r in rows), "<i4").reshape(len(rows), attention.CONTEXT + 2 * attention.STEP)
    c, s = attention.CONTEXT, attention.STEP
    return flat[:, :c], flat[:, c : c + s], flat[:, c + s :].astype(bool)


def _learn(model: attention.Model, turn: int, batch: int = 128, rate: float = 0.002) -> Callable:
    """Steps through all of a partition's windows of this round; what changed, times its weight, and the weights."""
    at = np.cumsum([0, *(w.size for w in model.p.values())])
    names, size, dim = list(model.p), int(at[-1]), attention.DIM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        trainer, met, seen = attention.Trainer(model), np.zeros(attention.VOCABULARY, bool), 0
        rng = np.random.default_rng(turn)
        for part in slices(batches, 0, limit=2 << 20, rows=10_000):
            _, line, begin, y, real = _drawn(part.column(0).to_pylist(), lambda d: d % np.uint64(ROUNDS) == np.uint64(turn))
            own = rng.permutation(len(begin))
            for i in range(0, len(own), batch):
                pick = own[i : i + batch]
                x = attention.inputs_at(line, begin[pick])
                trainer.step(x, y[pick], real[pick], rate)
                met[x.ravel()] = True
            seen += len(own)
        change = np.concatenate([((trainer.model.p[n] - model.p[n]) * (1 if n == "embed" else seen)).ravel() for n in names])
        weight = np.concatenate([np.repeat(met, dim) if n == "embed" else np.full(model.p[n].size, seen) for n in names]).astype(np.float64)
        cell = np.flatnonzero(weight)
        yield _cells(TaskContext.get().partitionId(), np.concatenate([cell, size + cell]), np.concatenate([change[cell], weight[cell]]))

    return run


def fit(ids: DataFrame) -> attention.Model:
    """The attention model, from the ids of all training texts (``_ids``, checkpointed)."""
    parts = ids.rdd.getNumPartitions()
    v, width = attention.VOCABULARY, 2 * attention.BESIDE
    # the last cell counts windows
    counts = summed(ids, lambda x, n: np.concatenate([x.astype(np.int64), np.full(len(n), attention.END), np.full(int(attention.n_windows(n).sum()), v)]), v + 1, parts)
    count, total = counts[:v], counts[v]
    top = np.argsort(-count, kind="stable")[: attention.BESIDE]
    feature = summed(ids, lambda x, n: attention.neighbours(x, n, top), v * width, parts).reshape(v, width)
    model = attention.train(attention.start(count, feature), *_sample(ids, total))
    for turn in range(ROUNDS):
        size = sum(w.size for w in model.p.values())
        out = tree_sum(ids.select("_ids").mapInArrow(_learn(model, turn), CELLS), 2 * size, parts)
        mean = np.divide(out[:size], out[size:], out=np.zeros(size), where=out[size:] > 0)
        at = np.cumsum([0, *(w.size for w in model.p.values())])
        for (name, w), lo, hi in zip(model.p.items(), at[:-1], at[1:], strict=True):
            model.p[name] = (w + mean[lo:hi].reshape(w.shape)).astype(np.float32)
    return model


def text_scores(model: attention.Model, blobs: list[bytes]) -> np.ndarray:
    """log10 probability of each text's ids and end; windows of many texts go through the model together."""
    line, begin, targets, real, of = _laid(blobs)
    logs, joined = np.zeros(real.shape, np.float32), model.joined()
    for i in range(0, len(begin), attention.LOT):
        lot = slice(i, i + attention.LOT)
        logs[lot] = model.log10(attention.inputs_at(line, begin[lot]), targets[lot], joined)
    return np.bincount(of, weights=np.where(real, logs, 0).sum(axis=1, dtype=np.float64), minlength=len(blobs))


def _score(model: attention.Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in slices(batches, 5, limit=1 << 19):
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(text_scores(model, batch.column(5).to_pylist()))], names=["doc_id", "_train", "n_tokens", "n_known", "_logs", "score"])

    return run


def score_texts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    groups = parts_for(docs, "text", GROUP_MB)
    dealt = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"), (remainder(7) != 2).alias("_train"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("_g"))
    asked = dealt.groupBy("_g").applyInArrow(_ask(groups), "bucket int, g int, blob binary")
    answered = asked.groupBy("bucket").applyInArrow(_answer, "bucket int, g int, blob binary, taught long")
    measured = checkpointed(dealt.groupBy("_g").cogroup(answered.groupBy("g")).applyInArrow(_measure(groups, path), MEASURED))
    taught = measured.filter("_train")
    size = measured.agg(F.coalesce(F.sum(F.when(F.col("_train"), F.col("n_tokens"))), F.lit(0)).alias("train_tokens"), F.coalesce(F.sum("_taught"), F.lit(0)).alias("_v"))  # one row
    scored = measured.select("doc_id", "_train", "n_tokens", "n_known", "_logs", "_ids").mapInArrow(_score(fit(taught)), "doc_id long, _train boolean, n_tokens long, n_known long, _logs double, score double")
    out = scored.crossJoin(F.broadcast(size))  # with one row
    base = F.col("_logs") - F.col("n_tokens") * F.log10((F.col("train_tokens") + F.col("_v") + 1).cast("double"))
    return out.select("doc_id", (~F.col("_train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", base.alias("base_score"), "score")


def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents", "doc_id", "text"))
