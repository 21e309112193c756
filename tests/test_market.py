"""Known answers on tiny frames."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantloom.config import DEFAULT, load
from quantloom.operators import analysis, events, features, indicators, ingest, outcomes, relatedness, research, tables, universe

DAY = dt.date(2024, 1, 1)


def bars(spark, closes, ticker="A", high=1.01, low=0.99):
    rows = [(ticker, DAY + dt.timedelta(i), c, c * high, c * low, float(c), 1000) for i, c in enumerate(map(float, closes))]
    return spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume long")


def last(df):
    return df.orderBy(F.desc("date")).first()


def test_rsi_is_100_on_a_rise_and_unknown_when_flat(spark):
    assert last(indicators.with_rsi(bars(spark, range(100, 140)))).rsi_14 == 100.0
    assert last(indicators.with_rsi(bars(spark, [100] * 40))).rsi_14 is None


def test_rsi_against_pandas(spark):
    x = 100 + np.random.default_rng(1).normal(size=80).cumsum()
    d = pd.Series(x).diff()
    up, down = d.clip(lower=0).ewm(alpha=1 / 14, adjust=False).mean(), (-d.clip(upper=0)).ewm(alpha=1 / 14, adjust=False).mean()
    want = 100 - 100 / (1 + up / down)
    got = [r.rsi_14 for r in indicators.with_rsi(bars(spark, x)).orderBy("date").collect()]
    assert got[0] is None
    np.testing.assert_allclose(got[1:], want[1:], rtol=1e-9)


def test_flat_prices_have_no_distance_and_no_band(spark):
    index = spark.createDataFrame([(DAY + dt.timedelta(i), 18.0, 95.0) for i in range(300)], "date date, vix double, vvix double")
    row = last(features.features(indicators.signals(indicators.indicators(bars(spark, [100] * 300)), indicators.vix_context(index))))
    assert row.dist_sma50 == 0 and row.dist_sma200 == 0 and row.bb_pctb is None and row.adx_14 is None
    assert (row.vix_regime, row.vix_trend, row.vol_environment) == ("normal", "stable", "clean_fear")
    assert row.composite_score == -1.0  # equal is not above


def test_adx_warms_up_for_28_rows(spark):
    rows = features.with_adx(bars(spark, range(100, 160))).orderBy("date").collect()
    assert all(r.adx_14 is None for r in rows[:28]) and rows[28].adx_14 == pytest.approx(100.0)


@pytest.mark.parametrize("vix,label", [(14.99, "low"), (15.0, "normal"), (20.0, "elevated"), (39.9, "high"), (40.0, "extreme"), (1000.0, "extreme")])
def test_vix_bands(spark, vix, label):
    index = spark.createDataFrame([(DAY, vix, 90.0)], "date date, vix double, vvix double")
    assert indicators.vix_context(index).first().vix_regime == label


def returns(spark, **series):
    rows = [(t, DAY + dt.timedelta(i), None if v is None else float(v)) for t, xs in series.items() for i, v in enumerate(xs)]
    return spark.createDataFrame(rows, "ticker string, date date, r double")


def test_correlation_and_beta_known_answers(spark):
    x = np.random.default_rng(42).normal(0, 0.01, 60)
    r = returns(spark, A=x, B=x, C=-x)
    got = {(p.ticker_a, p.ticker_b): p.pearson_r for p in relatedness.correlation_pairs(r, 90).collect()}
    assert got == {("A", "B"): 1.0, ("A", "C"): -1.0, ("B", "C"): -1.0}
    b = {p.ticker: p.beta for p in relatedness.betas(returns(spark, A=x, B=2 * x), returns(spark, E=x), 90).collect()}
    assert b == {"A": 1.0, "B": 2.0}


def test_blocks_equal_pairs_with_holes(spark):
    rng = np.random.default_rng(5)
    f = rng.normal(size=40)
    xs = {f"T{i}": [None if rng.random() < 0.2 else v for v in f * (i % 3) + rng.normal(size=40)] for i in range(9)}
    r = returns(spark, **xs)
    cfg = load({"min_abs_r": 0.0})
    a = {(p.ticker_a, p.ticker_b): (p.pearson_r, p.n_obs) for p in relatedness.correlation_pairs(r, 365, cfg).collect()}
    b = {(p.ticker_a, p.ticker_b): (p.pearson_r, p.n_obs) for p in relatedness.correlation_blocks(r, 365, cfg, block=2).collect()}
    assert a.keys() == b.keys() and len(a) == 36
    for k in a:
        assert a[k][1] == b[k][1] and a[k][0] == pytest.approx(b[k][0], abs=2e-6)


def test_mask_keeps_its_bounds(spark):
    r = spark.createDataFrame([(2.0,), (2.01,), (-0.66,), (-0.8,)], "r double").select(relatedness.masked(F.col("r")).alias("m"))
    assert [x.m is not None for x in r.collect()] == [True, False, True, False]


def test_confidence_and_bias(spark):
    df = spark.createDataFrame([(0.95, "improving"), (0.05, "deteriorating"), (-0.5, "deteriorating"), (None, "flat")], "s double, t string")
    got = [(r.b, r.c) for r in df.select(analysis.bias(F.col("s")).alias("b"), analysis.confidence(F.col("s"), F.col("t")).alias("c")).collect()]
    assert got == [("bullish", 1.0), ("bullish", 0.0), ("bearish", 0.6), ("neutral", 0.0)]


def test_reasoning(spark):
    df = spark.createDataFrame([(0.45, "improving", 25.0, "high"), (0.0, "flat", 55.0, "normal"), (None, "flat", 1.0, "low")], "s double, t string, r double, v string")
    got = [r[0] for r in df.select(analysis.reasoning(F.col("s"), F.col("t"), F.col("r"), F.col("v"))).collect()]
    assert got == ["Strengthening bullish signal (0.45); RSI oversold; VIX high — macro risk elevated.", "Stable bearish signal (0.00).", "Insufficient signal data."]


def test_correct_is_strict(spark):
    df = spark.createDataFrame([(0.01, "bullish"), (0.0101, "bullish"), (-0.02, "bearish"), (0.5, "neutral")], "r double, b string")
    assert [x[0] for x in df.select(outcomes.correct(F.col("r"), F.col("b"))).collect()] == [False, True, True, None]


def test_episode_heads(spark):
    rows = [("A", DAY + dt.timedelta(i), "bullish") for i in range(7)]
    got = outcomes.episodes(spark.createDataFrame(rows, "ticker string, signal_date date, bias string")).orderBy("signal_date").collect()
    assert [i for i, r in enumerate(got) if r.is_episode_head] == [0, 6]
    assert got[5].episode_id == "A:2024-01-01" and got[6].episode_id == "A:2024-01-07"


def test_seam_starts_with_the_second_day(spark):
    ahead = outcomes.forward(bars(spark, [100, 400, 401, 402, 403, 404, 405])).orderBy("date").collect()
    assert ahead[0].seam_5 is False  # the jump is from day 0 to day 1
    torn = outcomes.forward(bars(spark, [100, 100, 400, 400, 400, 400, 400])).orderBy("date").collect()
    assert torn[0].seam_5 is True


def test_dedup_keeps_the_greedy_choice(spark):
    at = [0, 5, 21, 22, 40, 44, 66]
    rows = [("A", "E1", p, DAY + dt.timedelta(p)) for p in at]
    got = events.dedup(spark.createDataFrame(rows, "ticker string, event string, position int, date date"))
    assert sorted(r.position for r in got.collect()) == [0, 22, 44, 66]


def test_robust_statistics(spark):
    rows = spark.createDataFrame([("x", float(v)) for v in range(-50, 51)], "k string, excess double")
    r = events.robust(rows, ["k"]).first()
    assert (r.n, r.median) == (101, 0.0) and r.wmean == pytest.approx(0.0) and r.frac_gt0 == pytest.approx(50 / 101, abs=1e-6)


def test_tables(spark, tmp_path):
    t = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0)], "k string, w int, v double")
    s = spark.createDataFrame([("B", 1, 3.0), ("C", 2, 4.0)], "k string, w int, v double")
    rows = lambda df: sorted(map(tuple, df.collect()))
    up = tables.upserted(t, s, ["k"])
    assert rows(up) == [("A", 1, 1.0), ("B", 1, 3.0), ("C", 2, 4.0)]
    assert rows(tables.upserted(up, s, ["k"])) == rows(up)
    assert rows(tables.upserted(t, s, ["k"], keep=("v",))) == [("A", 1, 1.0), ("B", 1, 2.0), ("C", 2, 4.0)]
    assert rows(tables.inserted(t, s, ["k"])) == [("A", 1, 1.0), ("B", 1, 2.0), ("C", 2, 4.0)]
    assert rows(tables.replaced(t, s.limit(0), "w", [1])) == []
    assert rows(tables.purged(t, F.col("v") > 1)) == [("A", 1, 1.0)]
    path = str(tmp_path / "t")
    assert tables.read(spark, path, t.schema).count() == 0
    tables.save(t, path)
    tables.merge(spark, path, t.schema, s, ["k"])
    assert rows(tables.read(spark, path, t.schema)) == rows(up)


def test_an_upsert_rewrites_only_its_partitions(spark, tmp_path):
    path, part = str(tmp_path / "t"), F.year("d")
    make = lambda *rs: spark.createDataFrame([(k, dt.date(y, 1, 2), v) for k, y, v in rs], "k string, d date, v double")
    rows = lambda: sorted((r.k, r.d.year, r.v) for r in tables.read(spark, path, schema).collect())
    first = make(("A", 2020, 1.0), ("A", 2021, 2.0), ("B", 2021, 3.0), ("A", 2022, 4.0))
    schema = first.schema
    tables.save(first, path, part)
    files = lambda: {str(f): f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    before = files()
    assert tables.merge(spark, path, schema, make(("B", 2021, 9.0), ("C", 2021, 5.0)), ["k", "d"], part) == ["2021"]
    new = [f for f in files() if f not in before]
    assert new and all("part=2021" in f for f in new) and all(files()[f] == t for f, t in before.items())
    want = [("A", 2020, 1.0), ("A", 2021, 2.0), ("A", 2022, 4.0), ("B", 2021, 9.0), ("C", 2021, 5.0)]
    assert rows() == want
    tables.merge(spark, path, schema, make(("C", 2021, 0.0), ("D", 2023, 7.0)), ["k", "d"], part, ignore=True)
    assert rows() == sorted([*want, ("D", 2023, 7.0)]) and tables.versions(spark, path)["2021"] == [2, 3]  # older ones are gone
    tables.replace(spark, path, make().withColumn("d", F.col("d")), "k", [])
    assert rows() == sorted([*want, ("D", 2023, 7.0)])


def test_columns_that_files_lack_are_null(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(spark.createDataFrame([("A", 1.0)], "k string, v double"), path)
    wider = spark.createDataFrame([("B", 2.0, "x")], "k string, v double, note string")
    tables.merge(spark, path, wider.schema, wider, ["k"])
    assert {r.k: r.note for r in tables.read(spark, path, wider.schema).collect()} == {"A": None, "B": "x"}


def test_replace_empties_a_window(spark, tmp_path):
    path = str(tmp_path / "w")
    t = spark.createDataFrame([("A", 90, 1.0), ("A", 365, 2.0)], "k string, w int, v double")
    tables.save(t, path, F.col("w"))
    tables.replace(spark, path, t.limit(0), "w", [90])
    assert [r.w for r in tables.read(spark, path, t.schema).collect()] == [365]


@pytest.mark.parametrize("step", range(4))
def test_a_run_that_stops_between_any_two_steps_loses_nothing(spark, tmp_path, monkeypatch, step):
    """Each rename and each deletion in turn is the one that does not happen any more."""
    path, part = str(tmp_path / "t"), F.col("w")
    old = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 1.0)], "k string, w int, v double")
    new = spark.createDataFrame([("A", 1, 2.0), ("A", 2, 2.0)], "k string, w int, v double")
    for v in (old, old):
        tables.save(v, path, part)
    real, done = tables._fs, []

    class Stops:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            def call(*args):
                if name in ("rename", "delete"):
                    if len(done) == step:
                        raise OSError("stopped")
                    done.append(name)
                return getattr(self.fs, name)(*args)

            return call

    monkeypatch.setattr(tables, "_fs", lambda *a: (Stops(real(*a)[0]), real(*a)[1]))
    with pytest.raises(OSError):
        tables.merge(spark, path, old.schema, new, ["k", "w"], part)
    monkeypatch.undo()
    seen = {r.w: r.v for r in tables.read(spark, path, old.schema).collect()}
    assert set(seen) == {1, 2} and set(seen.values()) <= {1.0, 2.0}
    tables.merge(spark, path, old.schema, new, ["k", "w"], part)
    assert {r.w: r.v for r in tables.read(spark, path, old.schema).collect()} == {1: 2.0, 2: 2.0}


def test_a_rename_that_does_not_happen_is_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    t = spark.createDataFrame([("A", 1.0)], "k string, v double")
    tables.save(t, path)
    real = tables._fs

    class Refuses:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return (lambda *a: False) if name == "rename" else getattr(self.fs, name)

    monkeypatch.setattr(tables, "_fs", lambda *a: (Refuses(real(*a)[0]), real(*a)[1]))
    with pytest.raises(OSError):
        tables.save(t.withColumn("v", F.lit(2.0)), path)
    monkeypatch.undo()
    assert tables.read(spark, path, t.schema).first().v == 1.0


def test_ingest(spark):
    raw = spark.createDataFrame([("A", DAY, 10.0, 12.0, 8.0, 10.0, 5.0, None), ("B.TO", DAY, 1.0, 1.0, 1.0, 1.0, 0.0, 1)], "ticker string, date date, open double, high double, low double, close double, adjusted_close double, volume long")
    rows = ingest.adjusted(raw).collect()
    assert [(r.ticker, r.open, r.high, r.low, r.close, r.volume, r.currency) for r in rows] == [("A", 5.0, 6.0, 4.0, 5.0, 0, "USD")]
    asked = spark.createDataFrame([("A",), ("B",)], "ticker string")
    with pytest.raises(RuntimeError):
        ingest.check(asked, raw.filter("ticker = 'A'").select("ticker"))
    ingest.check(asked, raw.limit(0).select("ticker"))  # a holiday
    split = spark.createDataFrame([("A", DAY + dt.timedelta(1), 2.0)], "ticker string, date date, factor double")
    assert ingest.rebased(bars(spark, [100, 50]), split).orderBy("date").first().close == 50.0


def test_universe(spark):
    codes = ["ZJZZT", "XXX-WT", "ABCD", "ABCDW", "WXYZW", "ITW"]
    df = spark.createDataFrame([(c, "us") for c in codes] + [("REI-UN.TO", "tsx")], "ticker string, exchange string")
    assert {r.ticker: r.reason for r in universe.audit(df).collect()} == {"ZJZZT": "nasdaq_test_symbol", "XXX-WT": "hyphenated_suffix", "ABCDW": "nasdaq5_warrant"}
    fields = "code string, type string, currency string, venue string, name string"
    listing = spark.createDataFrame([(c, "Common Stock", "USD", "NYSE", "Some " + ("Warrant" if c == "ITW" else "Company")) for c in codes], fields)
    own = spark.createDataFrame([("ABCD",)], "code string")
    assert sorted(r.code for r in universe.quality_listing(listing, "US", own).collect()) == ["ABCD", "WXYZW"]
    # a root that is not in the universe, for one because it is a fund, drops nothing
    assert sorted(r.code for r in universe.quality_listing(listing, "US", own.limit(0)).collect()) == ["ABCD", "ABCDW", "WXYZW"]
    old = spark.createDataFrame([("A", "us", True, ["x"]), ("B", "tsx", False, None)], "ticker string, exchange string, has_data boolean, categories array<string>")
    new = universe.migrated(old)
    assert {r.ticker: (r.signal_categories, r.cap_tier) for r in new.collect()} == {"A": (["x"], None), "B": ([], None)}
    row = universe.counts(new).first()
    assert (row.total_unique_tickers, row.us_listed, row.tsx_listed, row.tsx_venture_listed, row.no_data_tickers) == (2, 1, 1, 0, 1)
    filled = universe.merged(new.select("ticker", "cap_tier"), spark.createDataFrame([("A", "large"), ("C", "mid")], "ticker string, cap_tier string"), ["cap_tier"])
    assert {r.ticker: r.cap_tier for r in filled.collect()} == {"A": "large", "B": None, "C": "mid"}



def test_weights_and_config():
    assert all(abs(sum(c) - 1) <= 0.001 for c in research.weight_combos()) and len(research.weight_combos()) > 5
    assert load({"sma_short": 20, "nothing": 1}).sma_short == 20 and load("/nowhere.json") == DEFAULT
    assert DEFAULT.min_history == 263


def test_brief_ranks_selected_rows_with_a_side(spark):
    rows = [("A", DAY, "bullish", 0.4, 0.1), ("B", DAY, "neutral", 0.99, 0.9), ("C", DAY, "bearish", 0.7, -0.7), ("D", DAY, "bullish", 0.8, 0.8), ("E", DAY - dt.timedelta(1), "bullish", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "ticker string, date date, bias string, confidence double, composite_vix_adj double")
    assert [r.ticker for r in analysis.top_brief(analysis.selected(df)).collect()] == ["D", "C"]
    assert [r.ticker for r in analysis.strongest(analysis.selected(df)).collect()] == ["E", "B", "D", "C"]
    told = df.withColumns({c: F.lit("x") for c in ("reasoning", "vix_regime", "vix_trend", "vol_environment")})
    text = analysis.brief_text(analysis.top_brief(analysis.selected(told)).collect())
    assert text.splitlines() == ["VIX x, x; volatility x", "Bullish", "- D (0.80): x", "Bearish", "- C (0.70): x"] and analysis.brief_text([]) == "No signals."


def test_trend_over_two_weeks(spark):
    rows = [("A", DAY + dt.timedelta(d), s) for d, s in ((0, 0.1), (10, 0.5), (30, 0.5), (31, None))]
    df = spark.createDataFrame(rows, "ticker string, date date, s double")
    got = [r.t for r in df.withColumn("t", analysis.signal_trend("s", rows=None)).orderBy("date").collect()]
    assert got == ["flat", "improving", "flat", "flat"]


def test_seeds_wait_for_what_is_not_there_or_torn(spark):
    prices = bars(spark, [100] * 4 + [1000] + [1000] * 20)
    preds = spark.createDataFrame([("A", DAY, "v1.0", "bullish", 0.6, 0.6, "normal", "calm", "flat", 100.0)], "ticker string, signal_date date, signal_version string, bias string, composite_vix_adj double, confidence double, vix_regime string, vol_environment string, vix_trend string, price_at_signal double")
    ahead = outcomes.forward(prices)
    waiting = {r.horizon_days for r in outcomes.seeds(preds, ahead).collect()}
    bench, betas = prices.select("date", "close", "ticker"), spark.createDataFrame([], "ticker string, beta double")
    assert waiting == {5, 10, 20, 21, 42, 63}  # torn at day four, or beyond the end
    calm = outcomes.forward(bars(spark, [100] * 30))
    assert {r.horizon_days for r in outcomes.seeds(preds, calm).collect()} == {42, 63}
    assert {r.horizon_days for r in outcomes.outcomes_v2(preds, calm, bench, betas).collect()} == {5, 10, 20, 21}
    assert relatedness.fallbacks(preds, betas).first().fallbacks == 1


def test_proposals_and_their_review(spark):
    rows = [("bullish", "high", 0.75, i % 10 != 0) for i in range(60)] + [("bullish", "high", 0.5, i % 2 == 0) for i in range(60)]
    df = spark.createDataFrame(rows, "bias string, vix_regime string, composite_vix_adj double, correct_10d boolean")
    found = {(r.param_name, r.vix_regime_scope): r for r in research.numbered(research.proposals(df), 4).collect()}
    assert set(found) == {("signal_threshold", None), ("vix_high_mult", "high")}
    best = found["signal_threshold", None]
    assert (best.proposed_value, best.sample_size, best.accuracy_delta) == (0.6, 60, 0.2) and sorted(r.id for r in found.values()) == [5, 6]
    assert found["vix_high_mult", "high"].proposed_value == 1.0 and found["vix_high_mult", "high"].sample_size == 120
    assert research.proposals(df.limit(20)).count() == 0  # too few
    accuracy = [{"signal_version": "v1.0", "vix_regime": "high", "bias": "bullish", "horizon_days": 10, "correct_signals": 7, "total_signals": 10, "accuracy_rate": 0.7, "avg_return": None}]
    pending = [{"id": 5, "param_name": "p", "current_value": 0.5, "proposed_value": 0.6, "accuracy_delta": 0.2, "vix_regime_scope": "high", "vol_env_scope": None, "sample_size": 60, "rationale": "r"}]
    text = research.review_prompt(accuracy, pending, DAY)
    assert "v1.0 high bullish 10d: 7 of 10 right (70.0%)" in text and "#5 p: 0.5 to 0.6, +20.0% [regime high], 60 predictions. r" in text
    assert "No proposal waits." in research.review_prompt([], [], DAY)


def test_parity_counts_what_differs(spark):
    a = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", None)], "k string, v double")
    b = spark.createDataFrame([("A", 1.0), ("B", 2.5), ("C", 1.0), ("D", 0.0)], "k string, v double")
    r = research.parity(a, b, ["k"], ["v"]).first()
    assert (r.unmatched, r.max_diff, r.n_diff) == (1, 0.5, 2 + 1)


def test_event_groups(spark):
    kept = spark.createDataFrame([("A", "E1", 0, DAY), ("B", "E1", 0, DAY)], "ticker string, event string, position int, date date")
    feats = spark.createDataFrame([("A", DAY, 0.1, 2.0), ("B", DAY, None, None)], "ticker string, date date, sma200_slope double, vol_ratio double")
    excess = spark.createDataFrame([("A", DAY, 0.1, 0.2, None), ("B", DAY, 0.3, 0.4, 0.5)], "ticker string, date date, excess_21 double, excess_42 double, excess_63 double")
    got = sorted((r.horizon, r.split, r.value, r.excess) for r in events.splits(kept, feats, excess).collect() if r.horizon == 42)
    assert got == [(42, "all", "all", 0.2), (42, "all", "all", 0.4), (42, "slope", "not_up", 0.4), (42, "slope", "up", 0.2), (42, "volume", "confirmed", 0.2), (42, "volume", "unconfirmed", 0.4), (42, "year", "2024", 0.2), (42, "year", "2024", 0.4)]
    base = sorted((r.horizon, r.slope, r.excess) for r in events.base_rows(feats, excess).collect() if r.horizon == 42)
    assert base == [(42, "all", 0.2), (42, "all", 0.4), (42, "up", 0.2)]
    graded = spark.createDataFrame([("E1", 42, "all", "all", 90, 0.02)] + [("E1", 42, "year", str(y), n, m) for y, n, m in ((2020, 30, 0.03), (2021, 30, 0.02), (2022, 29, 0.9), (2023, 30, 0.0))] + [("E2", 42, "all", "all", 5, 0.02)], "event string, horizon int, split string, value string, n int, median double")
    base = spark.createDataFrame([(42, "all", 0.01), (42, "up", 0.5)], "horizon int, slope string, median double")
    assert {r.event: (r.years_better, r.years, r.edge) for r in events.verdict(graded, base).collect()} == {"E1": (2, 3, True), "E2": (0, 0, False)}
    buckets = spark.createDataFrame([(i, 42, s, m) for s, ms in (("all", (0.1, 0.2, 0.2, 0.3)), ("up", (0.1, 0.3, 0.2))) for i, m in enumerate(ms)], "n_bull int, horizon int, slope string, median double")
    assert {r.slope: (r.buckets, r.monotonic) for r in events.monotonic(buckets).collect()} == {"all": (4, True), "up": (3, False)}


def test_ingest_rules(spark):
    df = spark.createDataFrame([("A",), ("B.TO",), ("VIX.INDX",)], "ticker string")
    assert [(r.s, r.i) for r in df.select(ingest.provider_symbol(F.col("ticker")).alias("s"), ingest.is_index(F.col("ticker")).alias("i")).collect()] == [("A.US", False), ("B.TO", False), ("VIX.INDX", True)]
    meta = spark.createDataFrame([("A", None), ("B", DAY), ("C", DAY + dt.timedelta(1))], "ticker string, updated_at date")
    assert [r.ticker for r in ingest.stale(meta, F.lit(DAY + dt.timedelta(7))).collect()] == ["A", "B"]


