"""Training-data operators against brute force, and on odd rows."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from math import log10

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quantloom.functions import shared
from quantloom.llm import attention, chat, decontamination, langid, licenses, minhash, packing, quality, queries, scoring, sharding, suffixdedup
from quantloom.llm.components import components
from quantloom.llm.runindex import RunLengthIndex
from quantloom.llm.subwords import SPECIAL, subwords

TABLES = "documents benchmark conversations".split()
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="module")
def texts(small):
    t = pq.read_table(f"{small}/documents.parquet").to_pydict()
    return dict(sorted(zip(t["doc_id"], t["text"], strict=True)))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and names that operators use themselves."""
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, passage, "en", "a"), (2, passage, "en", "a"), (2, passage, "en", "a"), (3, None, None, None), (None, "a text without an id " + passage, "en", "b"),
        (4, "", "en", "b"), (5, "1234 !!! ***", None, "b"), (6, "é" * 60000 + " " + "x y " * 9000, "fr", "b"), (7, "ab", "en", None), (8, "aaaa" * 200, "en", "b"), (9, " \n\t ", "en", "b"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = ["shard", "slot", "hilbert", "spans", "kept", "items", "n_words", "score", "lang_pred", "label", "failed", "rules", "_id", "n_bytes"]
    return df.withColumn("n_chars", F.length("text").cast("long")).withColumns({n: F.lit("own") for n in names})


def nothing(df):
    return df.limit(0)


# 1
def test_hilbert_steps_to_neighbours():
    for dims, bits in ((2, 3), (3, 4)):
        n = 1 << (dims * bits)
        axes = np.stack([(np.arange(n) >> (bits * d)) & ((1 << bits) - 1) for d in range(dims)], axis=1)
        order = np.argsort(sharding.hilbert_index(axes, bits))
        assert sorted(sharding.hilbert_index(axes, bits)) == list(range(n))
        assert (np.abs(np.diff(axes[order], axis=0)).sum(axis=1) == 1).all()


def test_shards_are_even_runs_of_the_curve(spark, small, texts, odd):
    rows = queries.QUERIES["op1_hilbert_shards"](spark, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 1, zlib.crc32(texts[r.doc_id].encode()))
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append((r.slot, r.hilbert))
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and sorted(by) == list(range(16))
    line = []
    for s in range(16):
        assert [x[0] for x in sorted(by[s])] == list(range(len(by[s])))
        line += [x[1] for x in sorted(by[s])]
    assert line == sorted(line)
    out = sharding.shard_documents(odd).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in out) == sorted((r.doc_id is None, r.doc_id) for r in odd.collect()) and sharding.shard_documents(nothing(odd)).count() == 0
    by_id = {r.doc_id: r for r in out}
    assert (by_id[3].size, by_id[3].text_crc32, by_id[3].source_cell) == (1, 0, 0) and by_id[4].size == 1 and by_id[6].size == 120000 + 1 + 36000 + 1


def test_shards_skip_by_source(spark, docs, tmp_path):
    sharded = sharding.shard_documents(docs).cache()
    runs = sharding.manifest(sharded, ["source", "lang", "size"], rows=4).cache()
    assert runs.agg(F.sum("n_rows")).first()[0] == docs.count()
    for column in ("source", "lang"):
        value = docs.filter(f"{column} is not null").groupBy(column).count().orderBy("count").first()[column]
        kept = sharding.matching(runs, **{column: value})
        assert kept.count() < 0.7 * runs.count()
        assert sharded.filter(F.col(column) == value).join(kept.withColumnRenamed("shard", "s"), (F.col("s") == F.col("shard")) & (F.expr("slot div 4") == F.col("run")), "left_anti").count() == 0
    sharding.write_shards(sharded, str(tmp_path / "s"), 32)
    assert spark.read.parquet(str(tmp_path / "s")).count() == docs.count() and len(list((tmp_path / "s").rglob("*.parquet"))) > 16


# 2
def brute_repeats(rows, length=100):
    seen, out = set(), []
    for body in rows:
        gone = np.zeros(len(body), bool)
        for s in range(len(body) - length + 1):
            w = body[s : s + length]
            if w in seen:
                gone[s : s + length] = True
            seen.add(w)
        out.append(gone)
    return out


def test_run_length_index_against_a_set():
    rng = np.random.default_rng(0)
    for _ in range(20):
        parts = [rng.integers(97, 100, rng.integers(5, 40)).astype(np.uint8) for _ in range(4)]
        rows = [np.concatenate([parts[i] for i in rng.integers(0, 4, rng.integers(1, 4))]) for _ in range(int(rng.integers(1, 30)))]
        match, seen, want = int(rng.integers(7, 15)), set(), set()
        for i, row in enumerate(rows):
            for k in range(len(row) - match + 1):
                w = row[k : k + match].tobytes()
                want |= {(i, k)} if w in seen else set()
                seen.add(w)
        got = RunLengthIndex(np.concatenate(rows), np.cumsum([0] + [len(r) for r in rows]), match).repeats()
        assert set(zip(*(x.tolist() for x in got), strict=True)) == want


@pytest.mark.parametrize("hot", [4096, 1])
def test_repeats_against_brute_force(docs, texts, hot):
    got = {r.doc_id: r for r in suffixdedup.remove_repeats(docs.select("doc_id", "text"), hot=hot).collect()}
    bodies = {i: t.encode() for i, t in texts.items()}
    for (i, body), gone in zip(bodies.items(), brute_repeats(bodies.values()), strict=True):
        assert bytes(got[i].kept) == bytes(np.frombuffer(body, np.uint8)[~gone])
        assert sum(s["end"] - s["start"] for s in got[i].spans) == gone.sum()


def test_op2_against_brute_force(spark, small, texts):
    rows = {r.doc_id: r for r in queries.QUERIES["op2_run_length_dedup"](spark, small).collect()}
    bodies = {i: (t or "").encode() for i, t in texts.items()}
    for (i, body), gone in zip(bodies.items(), brute_repeats(bodies.values()), strict=True):
        r, starts = rows[i], gone & ~np.append(False, gone[:-1])
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(body), gone.sum(), starts.sum(), hashlib.sha256(kept).hexdigest())


def test_a_boilerplate_in_many_surroundings(spark):
    """No task gets all records of an anchor: they are dealt by whole contexts, and what remains is right."""
    boiler = " ".join(f"legal{i}" for i in range(16))[:95]
    rows = [(i, f"{i * 7919:0120d}{boiler}{i * 104729:0120d}") for i in range(400)] + [(i, f"head {i} " + boiler * 3 + f" tail {i}") for i in range(400, 440)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: bytes(r.kept) for r in suffixdedup.remove_repeats(df, hot=16).collect()}
    for (i, text), gone in zip(rows, brute_repeats([t.encode() for _, t in rows]), strict=True):
        assert got[i] == bytes(np.frombuffer(text.encode(), np.uint8)[~gone])


def test_a_task_sends_what_repeats_once():
    body = [b"x" * 30 + bytes(range(97, 123)) * 6 + b"%d" % i for i in range(50)]
    docs = lambda ids: pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([zlib.crc32(body[i]) for i in ids], pa.int64()), pa.array([body[i] for i in ids], pa.binary())], names=["_id", "_th", "_body"])
    sent = pa.Table.from_batches(list(suffixdedup._send(1, 1, 100, 40)(iter([docs([40, 41, 42]), docs([10, 11]), docs([20, 21, 45])]))))
    t = suffixdedup.unpacked([b for b, kind in zip(sent.column("blob").to_pylist(), sent.column("kind").to_pylist(), strict=True) if kind == suffixdedup.RECORDS], suffixdedup.RECORD)
    times = Counter(zip(t["mh"].tolist(), t["ch"].tolist(), strict=True))
    places = defaultdict(list)
    for m, c, d in zip(t["mh"].tolist(), t["ch"].tolist(), t["doc"].tolist(), strict=True):
        places[m, c].append(d)
    common = [v for v in places.values() if len(v) > 1]
    assert max(times.values()) == 2 and common and all(v == [40, 10] for v in common)  # again only where a smaller id comes


def test_repeats_on_odd_rows(odd):
    rows = suffixdedup.remove_repeats(odd.select("doc_id", "text", "spans", "kept", "_id")).collect()
    left = {r.doc_id: bytes(r.kept) for r in rows}
    assert len(rows) == 11 and left[3] == left[4] == b"" and left[7] == b"ab" and left[2] == b"" and left[9] == b" \n\t "
    assert left[8] == b"a"  # what starts later in a text covers all but its first byte
    assert all(r._id == "own" for r in rows if "_id" in r) and left[None].startswith(b"a text without an id ")
    assert suffixdedup.remove_repeats(nothing(odd)).count() == 0


def test_rows_that_repeat_id_and_text_keep_a_unique_text(spark):
    one, two, other = (" ".join(f"{w}{i}" for i in range(40)) for w in ("alpha", "beta", "gamma"))
    rows = [(5, one), (5, one), (None, two), (None, two), (None, two), (6, other), (7, other), (7, other)]
    for parts in (1, 8):  # in one batch, and each in its own
        got = suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
        left = Counter((r.doc_id, bytes(r.kept).decode()) for r in got)
        assert left == {(5, one): 2, (None, two): 3, (6, other): 1, (7, ""): 2}


def test_strings_of_a_hot_anchor_are_sent_once(spark):
    """Many documents with one passage in different surroundings: what a task sends names no key twice, so that no group grows with them."""
    passage, n = " ".join(f"word{i}" for i in range(60)), 50
    body = [f"{i * 7919:0150d}{passage}{i * 104729:0150d}".encode() for i in range(n)]
    docs = pa.table({"_id": pa.array(range(n), pa.int64()), "_th": pa.array([zlib.crc32(b) for b in body], pa.int64()), "_body": pa.array(body, pa.binary())})
    (sent,) = suffixdedup._send(1, 1, 100, 40)(iter(docs.to_batches()))
    sent = pa.Table.from_batches([sent])
    found = suffixdedup._meet(1, 1)(sent, suffixdedup._total(1)(suffixdedup._count(1)(sent)))
    needs = found.filter(pa.array([k == suffixdedup.NEEDS for k in found.column("kind").to_pylist()]))
    out = suffixdedup._fetch(1, 1, 100)(docs, needs)
    rows = [suffixdedup.unpacked([b], suffixdedup.RECORD) for kind, b in zip(out.column("kind").to_pylist(), out.column("blob").to_pylist(), strict=True) if kind == suffixdedup.STRINGS]
    assert not any(kind == suffixdedup.CONTEXTS for kind in out.column("kind").to_pylist())
    keys = np.concatenate([t["mh"] for t in rows])
    assert len(keys) and len(np.unique(keys)) == len(keys)


def test_documents_without_an_id_are_dealt_by_their_texts(spark):
    rows = spark.range(2000).select(F.lit(suffixdedup.NO_ID).alias("_id"), F.crc32(F.col("id").cast("string")).alias("_th"))
    got = rows.select("_id", "_th", suffixdedup.group_column(16).alias("g")).toPandas()
    assert got.g.value_counts().max() < 300
    assert (suffixdedup.group_of(got._id.to_numpy(), got._th.to_numpy().astype(np.uint32), 16) == got.g).all()


# 3
def test_ids_equal_the_tokenizer_file(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    file = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for t in [*list(texts.values())[:40], f"a {SPECIAL} b", "", "  x\n\n y", "don't É 12"]:
        assert subwords().encode(t).tolist() == file.encode(t, add_special_tokens=False).ids


def test_packing_round_trip(spark, small, texts, odd):
    rows = queries.QUERIES["op3_large_item_packing"](spark, small).collect()
    bins, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    for i, text in texts.items():
        ids = np.append(subwords().encode(text), 2).astype("<u4")
        own = sorted(docs[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        assert all(r.length == 1024 for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert len(bins) <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 1
    out = [(r.doc_id, r.piece, r.start, r.length) for r in packing.pack_documents(odd).collect()]
    assert Counter(x for x in out if x[0] in (3, 4)) == {(3, 0, 0, 1): 1, (4, 0, 0, 1): 1} and len({x[1:] for x in out if x[0] == 2}) * 2 == len([x for x in out if x[0] == 2])
    assert sum(x[3] for x in out if x[0] == 6) == len(subwords().encode(odd.filter("doc_id = 6").first().text)) + 1
    assert packing.pack_documents(nothing(odd)).count() == 0


def test_at_most_two_large_pieces_a_bin():
    rng = np.random.default_rng(2)
    counts = Counter(rng.integers(1, 1025, 5000).tolist())
    runs, bins = packing.plan(counts)
    large = Counter()
    for n, lo, hi, first, a_bin, _ in runs:
        if 3 * n > 1024:
            assert a_bin == 1
            large.update(range(first, first + hi - lo))
    assert max(large.values()) == 2 and sum(hi - lo for _, lo, hi, *_ in runs) == 5000
    assert bins <= 1.01 * -(-sum(n * c for n, c in counts.items()) // 1024) + 1


# 4
def test_language_on_held_out_rows(spark, small, odd):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    rows = queries.QUERIES["op4_subword_langid"](spark, small).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in rows)
    out = {r.doc_id: r for r in langid.predict(odd, langid.fit(odd.select("doc_id", "text", "lang"), F.col("doc_id"))).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 and not out[i].accepted for i in (3, 4, 5, 9)) and all(r.spans == "own" for r in out.values())
    assert langid.predict(odd, langid.fit(nothing(odd), F.col("doc_id"))).filter("lang_pred <> 'und'").count() == 0


def test_rejection_is_calibrated(spark):
    """On rows that neither training nor calibration has seen: few rightly named ones go, scores are probabilities, and what is no language goes more often."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(langid.remainder(3) != 1), F.col("doc_id"), rows=1500, wrong=0.005)
    assert model.reject_under > 1 / len(model.languages) and 0.02 < model.temperature < 8
    rng = np.random.default_rng(3)
    noise = spark.createDataFrame([(i, "".join(chr(c) for c in rng.choice([*range(97, 123), 32], 400))) for i in range(300)], "doc_id long, text string")
    seen = langid.predict(docs.filter(langid.remainder(3) == 1), model).filter(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull()).select("lang", "lang_pred", "score", "accepted").toPandas()
    right = seen[seen.lang == seen.lang_pred]
    assert len(right) > 0.95 * len(seen) and (~right.accepted).mean() < 0.02
    assert abs(seen.score.mean() - (seen.lang == seen.lang_pred).mean()) < 0.02
    assert langid.predict(noise, model).filter("not accepted").count() > 30 * (~right.accepted).mean() * 300


# 5
def test_events_fold(spark):
    log = [
        ("c", 1, 0, "create", "user", None), ("c", 2, 0, "delta", None, "Hel"), ("c", 4, 0, "delta", None, "lo"), ("c", 5, 1, "create", "assistant", None), ("c", 6, 1, "delta", None, "bad"),
        ("c", 7, 2, "create", "user", None), ("c", 8, 2, "delta", None, "gone"), ("c", 9, 1, "regenerate", None, "good"), ("c", 10, 1, "delta", None, "!"), ("c", 11, 0, "edit", None, "Hi"),
        ("c", 12, 2, "create", "user", None), ("c", 13, 2, "delta", None, "bye"), ("c", 14, 3, "create", "user", "x"), ("c", 15, 3, "delete", None, None),
    ]
    df = spark.createDataFrame(log[::-1], "conv_id string, seq long, turn long, kind string, role string, text string")
    got = [(r.turn, r.role, r.text) for r in chat.fold(df).orderBy("turn").collect()]
    assert got == [(0, "user", "Hi"), (1, "assistant", "good!"), (2, "user", "bye")]


def test_chat_round_trip(spark):
    said = [("u&ser\n", "a <|im_end|> &lt;| &amp;amp; <|im_start|>x\ny"), ("assistant", "<<|im_end|>\n" * 3), ("assistant", ""), (None, None), ("user", "z" * 5000)]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(said)], "conv_id long, turn long, role string, text string")
    row = chat.render(chat.fold(chat.events_of(df))).select("formatted", chat.read_back(F.col("formatted")).alias("t"), "segments").first()
    assert [(t.role, t.text) for t in row.t] == [(r or "", t or "") for r, t in said]
    assert "".join(s.text for s in row.segments) == row.formatted
    log = chat.events_of(df, part=5, drafts=True).cache()
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"create", "delta", "edit", "regenerate", "delete"}
    assert [(r.turn, r.role, r.text) for r in chat.fold(log).orderBy("turn").collect()] == [(i, r or "", t or "") for i, (r, t) in enumerate(said)]
    assert chat.render(chat.fold(chat.events_of(nothing(df)))).count() == 0


def test_chat_on_odd_rows(spark):
    """Ties follow by role and text, repeated rows are repeated turns, a null conversation is one of its own; names that the operator uses itself are left alone."""
    rows = [(1, 0, "user", "b", "own"), (1, 0, "user", "a", "own"), (1, 0, "assistant", "z", "own"), (2, 0, "user", "same", "own"), (2, 0, "user", "same", "own"), (None, 3, "user", None, "own"), (3, None, "user", "x" * 100000, "own")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string").withColumns({c: F.lit("own") for c in ("kind", "formatted", "segments", "e", "_turns")})
    out = chat.render(chat.fold(chat.events_of(df))).select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.t] for r in out} == {1: [("assistant", "z"), ("user", "a"), ("user", "b")], 2: [("user", "same")] * 2, None: [("user", "")], 3: [("user", "x" * 100000)]}


# 6, 8, 9 and 5 have SQL
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, small, name):
    from oracle import same

    same(spark, small, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_contamination_on_odd_rows(spark, odd):
    items = [(1, " ".join(f"WORD{i}" for i in range(20, 32))), (2, "ab"), (3, None), (None, "word1 word2"), (4, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = {r.doc_id: r for r in decontamination.contamination(odd, bench).collect()}
    assert out[1]["items"] == ["1"] and sum(s["end"] - s["start"] for s in out[1].spans) == 14
    assert out[7]["items"] == ["2"] and out[3].n_words == 0 and not out[4].spans
    by_block = {r.doc_id: r for r in decontamination.contamination(odd, bench, block_mb=0, live=2).collect()}
    assert {i: (r.spans, r["items"]) for i, r in by_block.items()} == {i: (r.spans, r["items"]) for i, r in out.items()}
    assert decontamination.contamination(odd, nothing(bench)).filter(F.size("spans") > 0).count() == 0
    assert decontamination.contamination(nothing(odd), bench).count() == 0


# 7
def test_base_scores_against_counts(spark, small, texts):
    rows = {r.doc_id: r for r in queries.QUERIES["op7_attention_lm"](spark, small).collect()}
    words = {i: [*re.findall(rb"[^\x20\x09-\x0D]+", t.encode().translate(LOWER)), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    count = Counter(w for i in words if not held[i] for w in words[i])
    n, v = sum(count.values()), len(count)
    for i, own in words.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(own), sum(count[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(log10((count[w] + 1) / (n + v + 1)) for w in own), rel=1e-9) and r.score < 0


def made_model(ids, steps=20):
    """A model of one text's counts, and its windows."""
    count = np.bincount(np.append(ids, attention.END), minlength=attention.VOCABULARY).astype(float)
    top = np.argsort(-count, kind="stable")[: attention.BESIDE]
    feature = np.bincount(attention.neighbours(ids, np.array([len(ids)]), top), minlength=attention.VOCABULARY * 2 * attention.BESIDE).reshape(attention.VOCABULARY, -1)
    cut = laid(ids)
    return attention.train(attention.start(count, feature), *cut, steps=steps), cut


def laid(*texts):
    line, begin, y, real, _ = attention.windows(np.concatenate(texts), np.array([len(t) for t in texts]))
    return attention.inputs_at(line, begin), y, real


def plain_logs(model, ids):
    """The same model, a token and a key at a time."""
    p, out = {n: w.astype(float) for n, w in model.p.items()}, []
    line = [attention.START] * (attention.PAD + 1) + list(ids)
    target = [*ids, attention.END]
    for t, own in enumerate(target):
        begin = t // attention.STEP * attention.STEP
        seen = line[begin : t + attention.PAD + 1]
        x = p["embed"][seen]
        q = x[-1] @ p["q"]
        s = np.array([q @ (k @ p["k"]) + p["distance"][len(seen) - 1 - i] for i, k in enumerate(x)])
        a = np.exp(s - s.max())
        y = x[-1] + (a / a.sum()) @ (x @ p["v"]) @ p["o"]
        z = y + np.maximum(y @ p["w1"] + p["b1"], 0) @ p["w2"]
        logit = z @ p["out"] + p["bias"]
        top = logit.max()
        out.append((logit[model.class_of[own]] - top - np.log(np.exp(logit - top).sum()) + model.share[own]) / np.log(10))
    return np.array(out)


def test_each_token_is_scored_once_and_causally():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 500, 333)
    model, (x, y, real) = made_model(ids)
    assert y[real].tolist() == [*ids.tolist(), attention.END]
    base = model.log10(x, y)[real]
    np.testing.assert_allclose(base, plain_logs(model, ids.tolist()), rtol=1e-3, atol=1e-4)
    changed = ids.copy()
    changed[200:] = 7
    x2, y2, real2 = laid(changed)
    np.testing.assert_allclose(model.log10(x2, y2)[real2][:200], base[:200], rtol=1e-4)
    both = laid(ids[:50], np.zeros(0, np.int64), ids)  # texts side by side are windows of their own
    assert both[1][both[2]].tolist() == [*ids[:50].tolist(), attention.END, attention.END, *ids.tolist(), attention.END] and (both[0][-len(x) :] == x).all()
    apart = Counter(np.concatenate([attention.neighbours(t, np.array([len(t)]), np.arange(32)) for t in (ids, ids[:0], ids[:9])]).tolist())
    assert Counter(attention.neighbours(np.concatenate([ids, ids[:9]]), np.array([len(ids), 0, 9]), np.arange(32)).tolist()) == apart
    blobs = [t.astype("<u2").tobytes() for t in (ids, ids[:0], ids[:100])]
    _, line, begin, y3, real3 = scoring._drawn(blobs, lambda d: d % np.uint64(3) == 0)
    every = {(a.tobytes(), b.tobytes(), c.tobytes()) for a, b, c in zip(*laid(ids, ids[:0], ids[:100]), strict=True)}
    some = list(zip(attention.inputs_at(line, begin), y3, real3, strict=True))
    assert 0 < len(some) < len(every) and all((a.tobytes(), b.tobytes(), c.tobytes()) in every for a, b, c in some)
    total = np.bincount(model.class_of, weights=np.exp(model.share), minlength=attention.CLASSES)
    np.testing.assert_allclose(total[np.unique(model.class_of)], 1, rtol=1e-3)  # shares of a class, and so all ids, come to one


def test_low_scores_stay_finite():
    model, (x, y, _) = made_model(np.arange(300))
    model.p["q"] *= 1e4
    model.p["bias"] -= 1e3
    assert np.isfinite(model.log10(x, y)).all()


def test_what_partitions_learn_is_averaged(spark):
    """The tree of sums equals a sum, with more partitions than a task takes."""
    cells = spark.range(0, 100, 1, 40).mapInArrow(
        lambda batches: (scoring._cells(int(b.column(0)[0].as_py()), np.array([3, 5, 3]), np.array([1.0, 2.0, 1.0])) for b in batches if b.num_rows), scoring.CELLS
    )
    out = scoring.tree_sum(cells, 8, 100)
    assert out[3] == 2 * cells.count() and out[5] == 2 * cells.count() and out.sum() == out[3] + out[5]


def test_every_window_of_the_training_texts_teaches(spark):
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 300, n).astype("<u2").tobytes() for n in (0, 5, 700, 5000, 24, 25, 700)]
    ids = spark.createDataFrame([(t,) for t in [*texts, texts[3]]], "_ids binary").repartition(3)
    model, _ = made_model(rng.integers(0, 300, 50), steps=1)
    size, dim = sum(w.size for w in model.p.values()), attention.DIM
    bias = sum(w.size for n, w in list(model.p.items())[: list(model.p).index("bias")])
    seen, met = 0, np.zeros(attention.VOCABULARY, bool)
    for turn in range(scoring.ROUNDS):
        out = scoring.tree_sum(ids.mapInArrow(scoring._learn(model, turn), scoring.CELLS), 2 * size, 3)
        seen += out[size + bias]  # windows stepped through
        met |= out[2 * size - attention.VOCABULARY * dim :: dim] > 0
    assert seen == sum(attention.n_windows(len(t) // 2) for t in [*texts, texts[3]])
    assert set(np.frombuffer(b"".join(texts), "<u2").tolist()) <= set(np.flatnonzero(met).tolist())


def test_a_step_takes_windows_in_lots_that_fit_a_cache(monkeypatch):
    """What a step and a score hold at once is bounded by the lot; lots change nothing but the order of sums; gradients are those of the score."""
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 500, 24 * 255)
    model, (x, y, real) = made_model(ids, steps=5)
    blob = ids.astype("<u2").tobytes()
    trainer, whole = attention.Trainer(model), attention.Trainer(model)
    trainer.step(x[:128], y[:128], real[:128], 0.002)
    tracemalloc.start()
    trainer.step(x[128:], y[128:], real[128:], 0.002)
    stepped = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    scores = scoring.text_scores(model, [blob, blob])
    scored = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert stepped < 2e6 and scored < 2e6, (stepped, scored)  # before: 5.5 MB and 2.5 MB
    np.testing.assert_allclose(scores, plain_logs(model, ids.tolist()).sum(), rtol=1e-4)
    monkeypatch.setattr(attention, "LOT", 1000)
    whole.step(x[:128], y[:128], real[:128], 0.002)
    whole.step(x[128:], y[128:], real[128:], 0.002)
    for n, w in whole.model.p.items():
        np.testing.assert_allclose(trainer.model.p[n], w, atol=1e-4)
    one = attention.Trainer(model)
    g, _ = one.gradient(x[:9], model.class_of[y[:9]].ravel(), real[:9].ravel().astype(np.float32), one.model.joined())
    g = attention._named(g)
    loss = lambda: -model.log10(x[:9], y[:9])[real[:9]].sum(dtype=float) * np.log(10)
    for n, own in g.items():
        at = np.unravel_index(np.abs(own).argmax(), own.shape)
        kept, sides = model.p[n][at], []
        for d in (0.01, -0.01):
            model.p[n][at] = kept + d
            sides.append(loss())
        model.p[n][at] = kept
        assert own[at] == pytest.approx((sides[0] - sides[1]) / 0.02, rel=0.05), n


def test_attention_beats_unigrams_on_held_out_texts(spark, small, texts):
    rows = {r.doc_id: r for r in scoring.op7_attention_lm(spark, small).collect()}
    ids = {i: np.append(subwords().encode(t or ""), attention.END) for i, t in texts.items()}
    count = np.bincount(np.concatenate([ids[i] for i in ids if not rows[i].held_out]), minlength=attention.VOCABULARY) + 0.5
    logs = np.log10(count / count.sum())
    held = [i for i in ids if rows[i].held_out]
    assert all(np.isfinite(r.score) and r.score < 0 for r in rows.values())
    assert sum(rows[i].score for i in held) > 0.9 * sum(logs[ids[i]].sum() for i in held)


def test_scores_on_odd_rows(odd):
    rows = {r.doc_id: r for r in scoring.score_texts(odd).collect()}
    assert rows[3].n_tokens == rows[4].n_tokens == rows[9].n_tokens == 1 and len(rows) == 10
    assert scoring.score_texts(nothing(odd)).count() == 0


# 8
def test_rules_on_odd_rows(odd):
    book = quality.ledger(odd)
    rows = {r.doc_id: r for r in book.collect()}
    assert rows[3].n_words == 0 and rows[3].failed & 1 and rows[6].n_repeat_words >= 17000 and not rows[1].failed
    report = {r.rule: r for r in quality.ablations(book, "base").collect()}
    assert report["few_words"].kept_without >= report["few_words"].failed_alone
    assert quality.ledger(nothing(odd)).count() == 0


# 9
def test_licence_rules(spark):
    mit = ". ".join(licenses.SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-as-is"))
    bsd = ".\n".join(licenses.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"))
    turned = ". ".join(licenses.SENTENCES[k] for k in ("mit-notice", "mit-grant", "mit-as-is"))
    rows = [(1, f"Hello. {mit}. Bye"), (2, bsd), (3, turned), (4, None), (5, "RELEASED under  the MIT license!")]
    got = {r.doc_id: r.rules for r in licenses.recognise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["mit-text"], 2: ["bsd3-text"], 3: [], 4: [], 5: ["mit-short"]}


def test_wrapped_and_commented_licences(spark):
    import textwrap

    wrap = lambda ids, end=".": "\n\n".join(textwrap.fill(licenses.SENTENCES[k] + end, 60) for k in ids)
    marked = lambda t, mark: "\n".join(f"{mark} {x}".rstrip() for x in t.split("\n"))
    rules = {name: ids for name, _, ids in licenses.RULES}
    apache = textwrap.fill(" ".join(licenses.SENTENCES[k] + (";" if k == "apache2-header" else ".") for k in rules["apache2-notice"]), 50)
    mit = wrap(rules["mit-text"])
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty"
    bsd = "\n".join(textwrap.fill(f"{i}. {licenses.SENTENCES[k]}.", 60) for i, k in enumerate(rules["bsd3-text"]))
    rows = [
        (1, "/*\n" + marked(f"Copyright (c) 2020 Someone\n{mit}", " *") + "\n */\nint x;"),
        (2, marked(f"Copyright 2021 Some Co\n\n{apache}", "#") + "\n\nimport os"),
        (3, marked(gpl, "//")),
        (4, bsd.replace("\n", "\r\n")),
        (5, "Released under the MIT License\nint x = 1\nfloat y"),
        (6, "x\n\nThis project is licensed\nunder the MIT License."),
        (7, mit.replace("free of charge", "for a fee")),
    ]
    got = {r.doc_id: r.rules for r in licenses.recognise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["mit-text"], 2: ["apache2-notice"], 3: ["gpl3-notice"], 4: ["bsd3-text"], 5: ["mit-short"], 6: ["mit-short"], 7: []}
    con = duckdb.connect()
    documents = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})  # noqa: F841  the SQL reads it
    assert {r[0]: r[1] for r in con.execute(f"SELECT doc_id, rules FROM ({licenses.OP9_SQL})").fetchall()} == {i: ",".join(r) for i, r in got.items()}


def test_licences_on_odd_rows(odd):
    out = licenses.recognise(odd.drop("rules").withColumn("sentence_ids", F.lit("own")))
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == 10 and all(r.rules == [] and r.spans == "own" for r in rows.values()) and rows[3].n_sentences == rows[4].n_sentences == rows[9].n_sentences == 0
    assert rows[1].n_sentences == 1 and licenses.recognise(nothing(odd)).count() == 0


# 10
def brute_components(texts, width, num, den):
    sets, root = {}, {i: i for i in texts}
    for i, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(LOWER))
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(max(len(w) - width + 1, 1))) if w else frozenset()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and den * min(len(sets[a]), len(sets[b])) >= num * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both) and find(a) != find(b):
                    root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in texts}


@pytest.mark.parametrize("block", [2048, 2])
def test_near_duplicates_against_brute_force(docs, texts, block):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, 3, 85, 100, block=block).collect()}
    assert got == brute_components(texts, 3, 85, 100)


def test_op10_against_brute_force(spark, small, texts):
    want = brute_components(texts, 3, 85, 100)
    rows = queries.QUERIES["op10_minhash_postings"](spark, small).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want and all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_a_pair_that_shares_many_lists_is_counted_once():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 40, minhash.COORDINATES)
    sig = np.array([np.where(rng.random(minhash.COORDINATES) < 0.8, base, rng.integers(0, 1 << 40, minhash.COORDINATES)) for _ in range(30)])
    lists = defaultdict(list)
    for i, row in enumerate(sig):
        for c, v in enumerate(row.tolist()):
            lists[c, v].append(i)
    order = {k: n for n, k in enumerate(sorted((k for k in lists if len(lists[k]) > 1), key=lambda k: (len(lists[k]), k)))}
    rank = np.full(sig.shape, 254)
    for i, row in enumerate(sig):
        own = sorted((c for c, v in enumerate(row.tolist()) if (c, v) in order), key=lambda c: order[c, int(row[c])])
        rank[i, own] = np.arange(len(own))
    members = [(n, c, i) for (c, v), n in order.items() for i in lists[c, v]]
    col = lambda x: pa.array(x.tolist(), pa.list_(pa.int64()))
    rows = pa.table({"list": [m[0] for m in members], "coordinate": [m[1] for m in members], "side": [0] * len(members), "n": [100] * len(members), "sig": col(sig[[m[2] for m in members]]), "rank": col(rank[[m[2] for m in members]])})
    got = Counter(frozenset((members[a][2], members[b][2])) for x, y in minhash._retained(rows, 16, 85, 100) for a, b in zip(x.tolist(), y.tolist(), strict=True))
    want = {frozenset((i, j)) for i in range(30) for j in range(i) if (sig[i] == sig[j]).sum() >= 16}
    assert want and set(got) == want and set(got.values()) == {1}


def test_near_duplicates_on_odd_rows(odd):
    rows = minhash.near_duplicates(odd).collect()
    out = {r.doc_id: r for r in rows}
    assert len(rows) == 11 and out[2].component_id is None and out[None].kept and not out[1].kept and not out[2].kept and out[3].component_id == 3 and out[9].n_shingles == 0
    assert minhash.near_duplicates(nothing(odd)).count() == 0


def test_components_of_a_chain(spark):
    edges = [(bytes([i]), bytes([i + 1])) for i in range(30)] + [(b"x", b"y")]
    got = {bytes(r.node): bytes(r.label) for r in components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert {got[bytes([i])] for i in range(31)} == {bytes([0])} and got[b"y"] == b"x"


def test_estimated_sizes_stay_short_over_the_rounds_of_components(spark):
    """Carried on from round to round, the product of the joins' sizes here has more than 14,000 bits, and gets three times as long each round."""
    name = lambda i: i.to_bytes(2, "big")
    labels = components(spark.createDataFrame([(name(i), name(i + 1)) for i in range(120)], "a binary, b binary"))
    assert labels._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 4 * shared.ESTIMATE_BITS
    assert {(bytes(r.node), bytes(r.label)) for r in labels.collect()} == {(name(i), name(0)) for i in range(121)}


def test_a_checkpoint_without_its_estimate_has_the_same_rows(spark, monkeypatch):
    rows = spark.sql(
        "select * from values (1, 'a', date'1582-10-10', timestamp'0001-01-02 00:00:00.123456', 1.50bd, array(1, null), named_struct('x', x'00ff', 'y', null), map('k', 2.5d)),"
        " (null, null, null, null, null, null, null, null) as t(k, s, d, t, m, l, r, p)"
    )
    kept = shared.checkpointed(rows)
    monkeypatch.setattr(shared, "ESTIMATE_BITS", 0)
    bare = shared.checkpointed(rows)
    assert bare.schema == kept.schema == rows.schema and bare._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > 1 << 60
    assert sorted(map(str, bare.collect())) == sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))
    assert shared.checkpointed(bare.join(kept, "k", "left")).count() == 2


# pipeline
def rows_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_pipeline_stages_against_brute_force(spark, small):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    step = lambda name, df: stages[name](spark, df, small).cache()
    start = rows_of(docs)

    told = step("language_id", docs)
    assert told.columns == docs.columns
    kept = rows_of(told)
    model = langid.fit(docs, F.col("doc_id"))
    assert set(kept) == {r.doc_id for r in langid.predict(docs, model).filter("lang_pred <> 'und'").collect() if r.score >= model.reject_under} and len(kept) >= 0.98 * len(start)

    near = step("near_dedup", told)
    assert rows_of(near) == {i: t for i, t in kept.items() if brute_of(kept)[i] == i} and near.columns == docs.columns and near.count() < told.count()

    cut = step("suffix_dedup", near)
    bodies = {i: t.encode() for i, t in sorted(rows_of(near).items())}
    want = {}
    for (i, body), gone in zip(bodies.items(), brute_repeats(bodies.values()), strict=True):
        at, text = 0, ""
        for c in body.decode():
            n = len(c.encode())
            text += "" if gone[at : at + n].all() else c
            at += n
        if text or not body:
            want[i] = text
    assert rows_of(cut) == want and all(r.n_chars == len(r.text) for r in cut.collect())

    clean = step("decontamination", cut)
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().translate(LOWER))
    grams = lambda w, n: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    items = [words(r.text or "") for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    windows = {(min(10, len(w)), g) for w in items if w for g in grams(w, min(10, len(w)))}
    sizes = {n for n, _ in windows}
    assert rows_of(clean) == {i: t for i, t in want.items() if not any((n, g) in windows for n in sizes for g in grams(words(t), n))} and clean.count() < cut.count()

    packed = defaultdict(int)
    for r in stages["packing"](spark, clean, small).collect():
        packed[r.doc_id] += r.length
    assert packed == {i: len(subwords().encode(t)) + 1 for i, t in rows_of(clean).items()}


def brute_of(texts):
    if not hasattr(brute_of, "kept") or brute_of.kept[0] is not texts:
        brute_of.kept = texts, {i: c for i, (_, c) in brute_components(texts, 5, 80, 100).items()}
    return brute_of.kept[1]


def test_pipeline_stages_on_odd_rows(spark, small, odd):
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, small)
        ids[name] = Counter(r.doc_id for r in out.collect())
        assert name == "packing" or out.columns == odd.columns
        assert stage(spark, nothing(odd), small).count() == 0
    assert not {3, 4, 5, 9} & set(ids["language_id"])  # no letter
    # the passage stays under no id, the smallest; of those without words, all
    assert ids["near_dedup"] == {None: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1}
    assert 2 not in ids["suffix_dedup"] and ids["suffix_dedup"][3] == ids["suffix_dedup"][4] == 1
    assert ids["decontamination"] == Counter({1: 1, 2: 2, 3: 1, None: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1})


def test_near_dedup_decides_by_row(spark, small):
    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in ("alpha", "beta"))
    rows = [(1, a), (2, a), (2, b), (3, b + " end"), (4, None), (4, None), (4, ""), (None, b)]
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")), small)
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert got == {(1, a): 1, (None, b): 1, (4, None): 1, (4, ""): 1}
