"""Spelling variants, whitening and matrix BPE: registered queries against brute force, and odd rows with their results."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.dataset as ds
import public_tokenizers
import pytest
import tiktoken

from quantloom.llm import bpe, sharding, spelling, whitening
from quantloom.llm.jacobidavidson import largest

DOCS = "doc_id long, text string, ids string, bytes int, word string, n int"


def brute_variants(counts, ratio=5):
    """(form, root, n, n_near, form_n) by word, from all words that lose one code point in the same place and all deletions."""
    near, holes = {w: set() for w in counts}, {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), []).append(w)
            if (short := w[:i] + w[i + 1 :]) in counts:
                near[w].add(short)
                near[short].add(w)
    for same in holes.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    best = {w: min(near[w], key=lambda x: (-counts[x], x), default=None) for w in counts}
    form = {w: b if b and counts[b] >= ratio * counts[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def variant_rows(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_spelling_query(spark, small):
    counts = Counter()
    rows = ds.dataset(f"{small}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pylist()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    expected = brute_variants({w: n for w, n in counts.items() if n >= 5})
    assert len(expected) > 100
    assert variant_rows(spelling.op11_spelling_variants(spark, small)) == expected


@pytest.fixture(scope="module")
def vocabulary_rows():
    rnd = random.Random(5)
    counts = {}
    while len(counts) < 1500:
        w = "".join(rnd.choice("abcÀéß") for _ in range(rnd.randrange(1, 9)))
        counts[w] = 5 ** rnd.randrange(1, 7) + rnd.randrange(2)
    return counts


@pytest.mark.parametrize("bound", [spelling.BOUND, 512])
def test_variants_in_one_pass_and_in_many(spark, vocabulary_rows, bound):
    """Chains of forms, ties, equal letters in a row; a small bound splits lengths and takes many passes."""
    words = spark.createDataFrame([(n, w, 0) for w, n in vocabulary_rows.items()], "n long, word string, near int")
    counts = Counter(map(len, vocabulary_rows))
    assert (len(spelling.passes(dict(counts), bound)) > 5) == (bound == 512)
    assert variant_rows(spelling.variants(words, bound=bound)) == brute_variants(vocabulary_rows)


def test_long_chain_of_forms(spark):
    words = {"a" * (3 + i): 5**i for i in range(9)}
    got = variant_rows(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute_variants(words) and got["aaa"][1] == "a" * 11


def test_filters_hold_every_word_and_stay_in_bound(spark, vocabulary_rows):
    words = spark.createDataFrame(list(vocabulary_rows.items()), "word string, n long")
    seen = Counter()
    for shards in spelling.passes(dict(Counter(map(len, vocabulary_rows))), 512):
        assert shards.blocks * 32 <= 512
        cells = spelling.bloom(words, shards)
        for w in vocabulary_rows:
            if len(w) in shards.at:
                codes = np.array([[ord(c) for c in w]], np.uint32)
                seen[w] += len(spelling._through(shards, cells, len(w), spelling._hashes(codes)[0][:, -1]))
    assert set(seen.values()) == {1}  # in exactly the pass that has its part


def test_spelling_odd_rows(spark):
    empty = spelling.variants(spelling.counted(spelling.runs(spark.createDataFrame([], DOCS)).selectExpr("run as word")))
    assert empty.columns and empty.count() == 0
    long = "z" * 3000
    rows = [(1, None, "", 1, "", 1), (None, f"Straße {long} straße?", "", 1, "", 1), (2, "", "", 1, "", 1), (None, f"Straße {long} straße?", "", 1, "", 1)]
    runs = spelling.runs(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r["run"] for r in runs) == sorted(["straße", "straße", long] * 2) and {r["id"] for r in runs} == {""}
    words = spark.createDataFrame([(long, 30), (long + "z", 5), (None, 9), ("x", None)], "word string, n long")
    assert variant_rows(spelling.variants(words)) == brute_variants({long: 30, long + "z": 5})
    h = zlib.crc32(b":strasse")
    every = h if h > 1 else 3  # a divisor, so that the run slips
    row = spark.createDataFrame([("", "strasse")], "id string, run string").select(spelling.slipped(*map(__import__("pyspark").sql.functions.col, ("id", "run")), every)).first()
    assert row[0] == "strasse"[: h % 7] + "strasse"[h % 7 + 1 :]


def dense(x):
    """Eigenpairs of the covariance of distinct vectors by a full decomposition."""
    fit = np.unique(x, axis=0)
    centred = fit - fit.sum(0) / len(fit)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    return fit, values[::-1], vectors[:, ::-1]


def test_whitening_query(spark, small):
    t = ds.dataset(f"{small}/embeddings.parquet").to_table()
    x = np.floor(256 * np.array(t["embedding"].to_pylist(), float)).astype(np.int64)
    fit, values, vectors = dense(x)
    n, sums = len(fit), fit.sum(0)
    out = whitening.op12_whitening(spark, small).toPandas()
    assert len(out) == 4 * len(x) and (out["n"] == n).all() and out["identity_error"].max() < 1e-10 and out["identity_error"].nunique() == 1
    place = {v: i for i, v in enumerate(t["vec_id"].to_pylist())}
    rows, j = out["vec_id"].map(place).to_numpy(), out["component"].to_numpy() - 1
    y = (x - sums / n) @ vectors[:, :4] / np.sqrt(values[:4])
    assert np.abs(np.abs(out["whitened"]) - np.abs(y[rows, j])).max() < 1e-9
    for c in range(4):
        own = out[out["component"] == c + 1]
        assert abs(abs(np.corrcoef(own["whitened"], y[own["vec_id"].map(place), c])[0, 1]) - 1) < 1e-12  # one sign for all rows
    assert np.allclose(out["explained"], (values / values.sum())[j], rtol=1e-12)
    assert (out["deviation"].to_numpy() == ((n * x - sums) ** 2).sum(1)[rows]).all()


@pytest.mark.parametrize(
    "matrix",
    [
        np.diag([5.0, 5, 5, 1] + [0] * 40), np.eye(30), np.zeros((20, 20)), np.diag(1e8 * 0.5 ** np.arange(50)), np.diag(np.concatenate([[10, 9, 8, 7, 7], np.linspace(6.999, 1, 60)])),
        np.outer(np.arange(40.0), np.arange(40.0)), np.array([[2.0]]), np.diag(np.linspace(1, 1.01, 200)),
    ],
)
def test_largest_pairs_against_a_full_decomposition(matrix):
    """Ties, no rank, wide and narrow spectra: values, residuals and orthogonality at rounding."""
    values, vectors, norms = largest(lambda p: matrix @ p, len(matrix), 4)
    k = min(4, len(matrix))
    top = np.linalg.eigvalsh(matrix)[::-1][:k]
    scale = max(top[0], 1e-300)
    assert np.abs(values - top).max() <= 1e-13 * scale and np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() <= len(matrix) * 2e-15 * scale and norms.max() <= len(matrix) * 2e-15 * scale


VECTORS = "vec_id long, embedding array<float>, component string, n int, _x int"


def test_whitening_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    assert whitening.whitened(spark.createDataFrame([], VECTORS)).count() == 0
    bad = [(1, None, "", 1, 1), (2, [], "", 1, 1), (3, [1.0, None], "", 1, 1), (4, [nan, 1.0], "", 1, 1), (5, [1.0, -inf], "", 1, 1), (6, [1.0, 2.0, 3.0], "", 1, 1), (7, [1.0, 1e30], "", 1, 1)]
    assert whitening.whitened(spark.createDataFrame(bad[:5] + bad[6:], VECTORS)).count() == 0
    good = [(8, [1.0, 0.0], "", 1, 1), (8, [1.0, 0.0], "", 1, 1), (None, [-1.0, 0.5], "", 1, 1), (9, [0.0, -0.5], "", 1, 1)]
    rows = whitening.whitened(spark.createDataFrame(bad + good, VECTORS)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in rows) == [(0, 1), (0, 2), (8, 1), (8, 1), (8, 2), (8, 2), (9, 1), (9, 2)]  # as many components as dimensions
    assert {r["n"] for r in rows} == {3} and {r["identity_error"] < 1e-12 for r in rows} == {True}
    x = np.array([[256, 0], [-256, 128], [0, -128]])
    assert {r["deviation"] for r in rows if r["vec_id"] is None} == {int(((3 * x[1] - x.sum(0)) ** 2).sum())}
    flat = whitening.whitened(spark.createDataFrame([(1, [2.0, 2.0], "", 1, 1), (2, [2.0, 2.0], "", 1, 1)], VECTORS)).collect()
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in flat} == {(1, 0, None, None, None)}
    line = whitening.whitened(spark.createDataFrame([(i, [float(i), 0.0], "", 1, 1) for i in range(5)], VECTORS)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)
    huge = whitening.whitened(spark.createDataFrame([(1, [2.0**50], "", 1, 1), (2, [0.0], "", 1, 1)], VECTORS)).collect()
    assert {r["deviation"] for r in huge} == {None}
    exact = whitening.deviations(np.array([[2**31, 5]]), 2, (3, 7)).to_pylist()
    assert exact == [None] and whitening.deviations(np.array([[2**30, 5]]), 2, (3, 7)).to_pylist() == [(2**31 - 3) ** 2 + 9]


def test_sums_of_many_partitions(spark):
    """More partitions than meet in one place: partial sums are added in levels; sums beyond 64 bits stay exact."""
    rows = spark.range(500).selectExpr("id", "array(id, 3000000000000000000 + id) as _x").repartition(100)
    made = whitening.blocks(rows, 2)
    total = whitening.gathered(made.repartition(100), 2, lambda each: whitening._exact(each, 2), 100)
    assert list(total[:3]) == [sum(range(500)), 500 * 3 * 10**18 + sum(range(500)), 500]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary().ranks, special_tokens={})


def test_bpe_query(spark, small, library):
    rows = ds.dataset(f"{small}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pylist()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = {r["doc_id"]: library.encode_ordinary(r["text"] or "") for r in rows}
    expected = {r["doc_id"]: (len(i := ids[r["doc_id"]]), sha(" ".join(map(str, i)).encode()), sha((r["text"] or "").encode())) for r in rows}
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.op13_matrix_bpe(spark, small).collect()} == expected


def test_bpe_against_the_library(library, monkeypatch):
    """Every code point in several surroundings, invented words, long runs in one piece, and texts cut into parts of pieces."""
    points = [chr(c) for c in [*range(0x3000), *range(0x3000, 0x110000, 97)] if not 0xD800 <= c < 0xE000]
    rnd = random.Random(1)
    texts = [f"a{c}b 1{c}2 {c} {c}{c}'{c}\n" for c in points]
    texts += ["".join(rnd.choice("aaaabcdeéß中文 \n\t'0123!?<|# ") for _ in range(rnd.randrange(80))) for _ in range(2000)]
    texts += ["a" * 3000, "ab" * 1500, "".join(rnd.choice("abcdefgh") for _ in range(4000)), "中" * 1500, " " * 3000 + "x", "!" * 1024, "!" * 1025, "", None, "<|endoftext|> don't'll"]
    for remembered in (bpe.REMEMBERED, 10):  # what is remembered of earlier texts changes nothing
        monkeypatch.setattr(bpe, "REMEMBERED", remembered)
        own = bpe.Vocabulary()
        for i in range(0, len(texts), 5000):
            ids, ends = own.encode(texts[i : i + 5000])
            assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode_ordinary(t or "") for t in texts[i : i + 5000]]
            data, ends = own.decode(ids, ends)
            assert [data[a:b].tobytes().decode() for a, b in zip(ends, ends[1:])] == [t or "" for t in texts[i : i + 5000]]
    long = "word and word's 12 " * 60_000  # over a million characters
    assert own.encode([long])[0].tolist() == library.encode_ordinary(long)


def test_merges_are_the_leftmost_of_least_rank():
    """Matrix rounds and the folded square against the rule itself, on pieces that are no tokens."""
    own, rnd = bpe.vocabulary(), random.Random(2)

    def plain(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while ranked := [(own.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in own.ranks]:
            i = min(ranked)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [own.ranks[p] for p in parts]

    pieces = [p for p in (bytes(rnd.choice(b"aehinrst \xc3\xa9") for _ in range(rnd.randrange(2, 90))) for _ in range(600)) if p not in own.ranks]
    ids, lens = own.merged(pieces)
    cuts = np.concatenate([[0], np.cumsum(lens)])
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [plain(p) for p in pieces]
    for p in pieces[:60]:
        assert own._folded(own.single[np.frombuffer(p, np.uint8)]).tolist() == plain(p)


def test_bpe_odd_rows(spark):
    assert bpe.decode(bpe.encode(spark.createDataFrame([], DOCS))).count() == 0
    rows = [(1, None, "x", 7, "w", 1), (1, "", "x", 7, "w", 1), (2, "a b", "x", 7, "w", 1), (2, "a b", "x", 7, "w", 1), (None, "<|endoftext|>", "x", 7, "w", 1)]
    out = bpe.decode(bpe.encode(spark.createDataFrame(rows, DOCS)))
    assert sorted(out.columns) == ["bytes", "doc_id", "ids", "n", "text", "word"]
    got = sorted((r["doc_id"] or 0, bytes(r["bytes"]).decode(), len(r["ids"])) for r in out.collect())
    assert got == [(0, "<|endoftext|>", 7), (1, "", 0), (1, "", 0), (2, "a b", 2), (2, "a b", 2)]
    nothing = bpe.decode(spark.createDataFrame([(None,), ([64],)], "ids array<int>")).collect()
    assert [bytes(r["bytes"]) for r in nothing] == [b"", b"a"]


def test_steps_of_long_texts(spark):
    """Sources that agree in a long beginning are told apart; cuts are where the counts say, in one range of values and in many; a very frequent value has a step."""
    rows = [(f"https://example.org/crawl/{i % 300:04d}", "en") for i in range(6000)] + [("https://example.org/crawl/0100x", "é")] * 3000 + [(None, None)] * 5
    df = spark.createDataFrame(rows, "source string, lang string").repartition(5)
    values = sorted(r[0] for r in rows if r[0])
    expected = sorted({values[-(-k * len(values) // 16) - 1] for k in range(1, 16)} - {values[-1]})
    for most in (sharding.VALUES, 40):
        assert sharding.steps_of(df, "source", 16, most) == expected
    cells = {(r[0] or "", r[1], r[2]) for r in df.select("source", *[c.alias(n) for n, c in sharding.ordered(df, ["source", "lang"], 4).items()]).distinct().collect()}
    assert all(c == sum(q < s for q in expected) for s, c, _ in cells if s) and {c[1:] for c in cells if not c[0]} == {(0, 0)} and len({c[1] for c in cells}) > 10
    assert sharding.steps_of(df.limit(0), "source", 16) == []
