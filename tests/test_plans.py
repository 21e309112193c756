"""The nightly run and the landing stream, end to end on small data."""

import datetime as dt
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantloom.config import load
from quantloom.functions.shared import checkpointed
from quantloom.operators import ingest, tables
from quantloom.plans import nightly
from quantloom.schemas import TABLES, buckets_of, fit, key, schema, within
from quantloom.sources import files, market
from quantloom.streaming import landing


def test_landing_takes_each_file_once_and_corrections(spark, tmp_path):
    land, root, mark = (str(tmp_path / n) for n in ("land", "root", "mark"))
    (tmp_path / "land").mkdir()

    def put(name, close):
        bar = {"ticker": "A", "date": "2024-01-02", "open": 1.0, "high": 2.0, "low": 0.5, "close": close, "adjusted_close": close, "volume": 3}
        (tmp_path / "land" / name).write_text(json.dumps(bar) + "\n")

    put("a.json", 1.5)
    landing.take(spark, land, root, mark)
    landing.take(spark, land, root, mark)
    put("b.json", 1.75)
    landing.take(spark, land, root, mark)
    rows = tables.read(spark, f"{root}/raw_prices", schema("raw_prices")).collect()
    assert [(r.ticker, r.date, r.close) for r in rows] == [("A", dt.date(2024, 1, 2), 1.75)]


def test_the_last_file_wins_within_a_batch_and_between_batches(spark, tmp_path):
    """A bar and its correction landed together: the correction is kept, though its prices are lower; an older file that is seen later changes nothing."""
    land, root, mark = (str(tmp_path / n) for n in ("land", "root", "mark"))
    (tmp_path / "land").mkdir()

    def put(name, when, open_, close):
        bar = {"ticker": "A.TO", "date": "2024-01-02", "open": open_, "high": 10.0, "low": 0.5, "close": close, "adjusted_close": close, "volume": 3}
        (tmp_path / "land" / name).write_text(json.dumps(bar) + "\n")
        os.utime(tmp_path / "land" / name, (when, when))

    put("a.json", 1_700_000_100, 9.0, 9.5)
    put("b.json", 1_700_000_200, 1.0, 1.75)
    landing.take(spark, land, root, mark)
    read = lambda: [(r.close, r.currency, r.source, r.fetched_at.timestamp()) for r in tables.read(spark, f"{root}/raw_prices", schema("raw_prices")).collect()]
    assert [r[:3] for r in read()] == [(1.75, "CAD", "landed")]
    before = read()
    put("late.json", 1_700_000_050, 8.0, 8.5)
    landing.take(spark, land, root, mark)
    assert read() == before
    put("c.json", 1_700_000_300, 0.75, 0.5)
    landing.take(spark, land, root, mark)
    assert [r[0] for r in read()] == [0.5]


def test_a_year_is_written_by_several_tasks(spark, tmp_path):
    """Bytes decide how many; rows are in order in each file, and all there."""
    rows = spark.range(60_000).selectExpr("concat('T', id % 50) as ticker", "date_add(date'2024-01-01', cast(id div 50 % 366 as int)) as date", "rand(7) as v", "id")
    kept = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(kept, "100k")
    try:
        tables.publish(rows, str(tmp_path / "t"), F.year("date"), order=["ticker", "date"])
    finally:
        spark.conf.unset(kept)
    files_ = list((tmp_path / "t/part=2024/v=1").glob("*.parquet"))
    assert len(files_) > 3
    for f in files_:
        got = pd.read_parquet(f)[["ticker", "date"]]
        assert got.equals(got.sort_values(["ticker", "date"], ignore_index=True))
    assert tables.read(spark, str(tmp_path / "t"), rows.schema).count() == 60_000


def inputs(spark, small):
    """Three brands; proxies are QQQ and SPY, of which the first by name is not the benchmark."""
    bars = market.bars(spark, small).filter("ticker in ('Brand#1', 'Brand#2', 'Brand#3')").cache()
    bench = market.benchmark(spark, small)
    other = bars.filter("ticker = 'Brand#1'").select(F.lit("QQQ").alias("ticker"), "date", "close")
    return bars, market.index_vol(spark, small), bench, other.unionByName(bench)


def stored(spark, root):
    return {t: tables.read(spark, f"{root}/{t}", schema(t)) for t in TABLES}


def test_nightly_fills_its_tables_and_repeats(spark, small, tmp_path):
    bars, index, bench, proxies = inputs(spark, small)
    counts = []
    for _ in range(2):
        nightly.run(spark, str(tmp_path), bars, index, bench, proxies)
        counts.append({t: df.count() for t, df in stored(spark, tmp_path).items()})
    assert counts[0] == counts[1] and counts[0]["stock_signals"] == bars.count() and counts[0]["prediction_outcomes"] > 0
    got = stored(spark, tmp_path)
    for t, df in got.items():
        assert df.count() == df.select(*key(t)).distinct().count()
    assert {r[0] for r in got["sector_beta"].select("etf_proxy").distinct().collect()} <= {"QQQ", "SPY"}
    beta = {r.ticker: r.beta for r in got["sector_beta"].filter("etf_proxy = 'SPY' and window_days = 365").collect()}
    used = got["prediction_outcomes"].filter("resolved_at is not null").select("ticker", "beta_used").distinct().collect()
    assert used and all(abs(r.beta_used - (0.67 * beta[r.ticker] + 0.33 if r.ticker in beta else 1.0)) < 1e-9 for r in used)
    assert got["prediction_outcomes"].filter("resolved_at is null and excess_return is null and vol_at_signal is not null").count() > 0  # seeds
    assert sorted(r.brief_type for r in got["daily_brief"].collect())[-1] == "parameter_review"


def test_a_night_equals_the_backfill_and_sunday_relates(spark, small, tmp_path):
    _, index, bench, proxies = inputs(spark, small)
    made = [bench.select(F.lit(t).alias("ticker"), "date", *[(F.col("close") * f).alias(c) for c, f in (("open", 1.0), ("high", high), ("low", 0.99), ("close", 1.0))], (F.dayofmonth("date") * k).cast("long").alias("volume")) for t, high, k in (("A", 1.01, 10), ("B", 1.02, 7))]
    bars = made[0].unionByName(made[1]).cache()  # a bar every day
    cfg = load({"sma_short": 5, "sma_long": 20, "macd": [3, 6, 3], "rsi_window": 5, "adx_window": 5, "year": 30, "slope_window": 10, "signal_threshold": 0.1, "days_a_year": 365})
    assert bars.agg(F.countDistinct("date")).first()[0] > 3 * cfg.history_days
    whole, night = str(tmp_path / "whole"), str(tmp_path / "night")
    nightly.run(spark, whole, bars, index, bench, proxies, cfg=cfg)
    last = stored(spark, whole)["analysis"].agg(F.max("date")).first()[0]
    weekday, sunday = ([d for d in (last - dt.timedelta(i) for i in range(14)) if (d.weekday() == 6) == is_sunday][0] for is_sunday in (False, True))
    for on in sorted([weekday, sunday]):
        nightly.run(spark, night, bars, index, bench, proxies, on=on, cfg=cfg)
        got = stored(spark, night)
        assert (got["sector_beta"].count() + tables.read(spark, f"{night}/daily_brief", schema("daily_brief")).filter("brief_type = 'parameter_review'").count() > 0) == (on >= sunday)
        for t in ("stock_signals", "signal_features"):
            a, b = (stored(spark, root)[t].filter(F.col("date") == F.lit(on)).toPandas().sort_values("ticker", ignore_index=True) for root in (whole, night))
            pd.testing.assert_frame_equal(a, b, rtol=1e-9)
        chosen = stored(spark, night)["analysis"].filter((F.col("date") == F.lit(on)) & (F.col("bias") != "neutral")).count()
        briefs = got["daily_brief"].filter((F.col("date") == F.lit(on)) & (F.col("brief_type") == "daily")).collect()
        assert [r.ticker_count for r in briefs] == ([min(chosen, 12)] if chosen else [])  # every night with a signal
    years = tables.versions(spark, f"{night}/stock_signals")
    assert {name[:4] for name in years} == {str(weekday.year), str(sunday.year)}


SHORT = {"sma_short": 5, "sma_long": 20, "macd": [3, 6, 3], "rsi_window": 5, "adx_window": 5, "year": 30, "slope_window": 10, "signal_threshold": 0.1, "days_a_year": 365, "windows": [90], "min_sample": 5}


def made(bench, days, *tickers):
    """A provider's bars of some tickers for the last days of the benchmark: walks of their own, raw and adjusted the same."""
    own = bench.orderBy(F.desc("date")).limit(days).select("date", "close")
    parts = [own.select(F.lit(t).alias("ticker"), "date", (F.col("close") * (1 + 0.1 * F.sin(F.datediff("date", F.lit("1992-01-01")) / (3.0 + i)))).alias("close")) for i, t in enumerate(tickers)]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return df.select("ticker", "date", F.col("close").alias("open"), (F.col("close") * 1.01).alias("high"), (F.col("close") * 0.99).alias("low"), "close", F.col("close").alias("adjusted_close"), (F.dayofmonth("date") * 10).cast("long").alias("volume"))


def test_refresh_equals_a_rebuild_and_leaves_others_alone(spark, small, tmp_path):
    """A split and a dividend: what is stored of the two tickers is that of a rebuild from the new history; files without them are the same files."""
    _, index, bench, proxies = inputs(spark, small)
    cfg, names = load(SHORT), [f"T{i}" for i in range(8)]
    raw = made(bench, 400, *names).cache()
    day = raw.agg(F.max("date")).first()[0]
    good = lambda df: ingest.valid(ingest.adjusted(df))
    on_split, on_dividend = (day - dt.timedelta(n) for n in (150, 100))
    factor = F.when((F.col("ticker") == "T1") & (F.col("date") < F.lit(on_split)), 0.5).when((F.col("ticker") == "T2") & (F.col("date") < F.lit(on_dividend)), 0.97).otherwise(1.0)
    provider = raw.withColumn("adjusted_close", F.col("close") * factor)
    refreshed, rebuilt = str(tmp_path / "refreshed"), str(tmp_path / "rebuilt")
    nightly.run(spark, refreshed, good(raw), index, bench, proxies, cfg=cfg)
    listing = lambda: {str(f.relative_to(refreshed)): f.stat().st_mtime_ns for f in (tmp_path / "refreshed").rglob("*.parquet")}
    before = listing()
    assert nightly.refresh(spark, refreshed, good(provider.filter("ticker in ('T1', 'T2')")), index, bench, proxies, cfg) == 2
    nightly.run(spark, rebuilt, good(provider), index, bench, proxies, cfg=cfg)
    a, b = stored(spark, refreshed), stored(spark, rebuilt)
    for t in ("raw_prices", "stock_signals", "signal_features", "analysis", "sector_beta", "signal_predictions", "prediction_outcomes", "signal_accuracy"):
        columns = [c for c in a[t].columns if c not in ("resolved_at", "created_at", "computed_at", "fetched_at", "key_levels")]
        x, y = (df.select(*columns, *([F.to_json("key_levels").alias("levels")] if t == "analysis" else []), *([F.col("resolved_at").isNotNull().alias("resolved")] if "resolved_at" in df.columns else [])).toPandas().sort_values(key(t), ignore_index=True) for df in (a[t], b[t]))
        pd.testing.assert_frame_equal(x, y, rtol=1e-9, obj=t)
        assert len(x)
    groups = set(buckets_of(spark.createDataFrame([("T1",), ("T2",)], "ticker string")))
    others = [f for f in before if f.split("/")[0] in ("raw_prices", "stock_signals", "signal_features", "signal_predictions", "prediction_outcomes") and f.split("/")[1].rpartition("-")[2] not in groups]
    assert others and all(listing().get(f) == before[f] for f in others)
    assert set(r[0] for r in ingest.shifted(good(raw), good(provider)).collect()) == {"T1", "T2"}


def test_a_night_from_landed_bars(spark, small, tmp_path):
    """Breaker, holiday, corporate action, stale company data and the day's tables in one call."""
    _, index, bench, proxies = inputs(spark, small)
    cfg, root, names = load(SHORT), str(tmp_path), ["A", "B", "C", "D.TO", "E"]
    raw = made(bench, 330, *names).cache()
    last = raw.agg(F.max("date")).first()[0]
    on = next(d for d in (last - dt.timedelta(i) for i in range(7)) if d.weekday() not in (5, 6))
    tickers = spark.createDataFrame([(t,) for t in [*names, "VIX.INDX"]], "ticker string")
    nightly.run(spark, root, ingest.valid(ingest.adjusted(raw.filter(F.col("date") < F.lit(on)))), index, bench, proxies, cfg=cfg)
    halved = raw.withColumn("adjusted_close", F.when((F.col("ticker") == "B") & (F.col("date") < F.lit(on)), F.col("close") / 2).otherwise(F.col("close")))
    asked, alerts = {}, []

    def history(changed):
        asked["history"] = sorted(r.ticker for r in changed.collect())
        return halved.join(changed, "ticker", "left_semi")

    def metadata(due):
        asked["metadata"] = sorted(r.ticker for r in due.collect())
        return due.select("ticker", F.concat(F.lit("Company "), "ticker").alias("name"), F.lit(now).alias("updated_at"))

    now = dt.datetime(2024, 1, 10, 23, tzinfo=dt.UTC)
    splits = spark.createDataFrame([("B", on, 2.0), ("A", on - dt.timedelta(30), 2.0), ("Z", on, 3.0)], "ticker string, date date, factor double")
    dividends = spark.createDataFrame([], "ticker string, date date, amount double")
    tonight = lambda fetched, now: nightly.night(spark, root, on, tickers, fetched, index, bench, proxies, (splits, dividends), history, metadata, now, cfg, alert=alerts.append)
    old = {t: tables.versions(spark, f"{root}/{t}") for t in TABLES}
    assert not tonight(raw.limit(0), now) and {t: tables.versions(spark, f"{root}/{t}") for t in TABLES} == old  # a holiday
    with pytest.raises(RuntimeError, match="3 of 6"):
        tonight(raw.filter("ticker in ('A', 'B', 'C')"), now)
    assert len(alerts) == 1 and "3 of 6" in alerts[0]
    assert tonight(raw, now)
    assert asked == {"history": ["B"], "metadata": names}
    got = stored(spark, root)
    assert got["raw_prices"].filter("ticker = 'B'").agg(F.min("close") < 0.6 * raw.filter("ticker = 'B'").agg(F.min("close")).first()[0]).first()[0]
    today = got["stock_signals"].filter(F.col("date") == F.lit(on))
    assert today.count() == 5 and {r[0] for r in today.select("vix_source").distinct().collect()} <= {"provider", None}
    assert {(r.ticker, r.currency) for r in got["raw_prices"].filter(F.col("date") == F.lit(on)).select("ticker", "currency").collect()} == {(t, "CAD" if t == "D.TO" else "USD") for t in names}
    due = lambda **later: sorted(r.ticker for r in ingest.due(tickers, got["ticker_metadata"], F.lit(now + dt.timedelta(**later))).collect())
    assert due(days=6, hours=23) == [] and due(days=7) == names  # fresh for seven whole days


def test_nights_step_on_from_states(spark, small, tmp_path, monkeypatch):
    """Nights after a backfill, a day between them and one ticker new: tables equal a backfill of all; after a late correction too."""
    _, index, bench, proxies = inputs(spark, small)
    cfg, root, whole = load(SHORT), str(tmp_path / "nights"), str(tmp_path / "whole")
    bars = ingest.valid(ingest.adjusted(made(bench, 150, "A", "B", "C", "N")))
    last = bars.agg(F.max("date")).first()[0]
    days = [last - dt.timedelta(n) for n in (2, 0)]
    bars = checkpointed(bars.filter((F.col("ticker") != "N") | (F.col("date") >= F.lit(days[0]))))
    nightly.run(spark, root, bars.filter(F.col("date") < F.lit(days[0])), index, bench, proxies, cfg=cfg)
    long_way = []
    real = nightly._whole
    monkeypatch.setattr(nightly, "_whole", lambda df, *rest: long_way.append(sorted(r.ticker for r in df.select("ticker").distinct().collect())) or real(df, *rest))
    fixed = bars.withColumn("close", F.when((F.col("ticker") == "B") & (F.col("date") == F.lit(days[0])), F.col("close") * 1.03).otherwise(F.col("close")))
    nightly.run(spark, root, bars, index, bench, proxies, on=days[0], cfg=cfg)
    nightly.forget(spark, root, fixed.filter((F.col("ticker") == "B") & (F.col("date") == F.lit(days[0]))))
    assert {(r.ticker, r.date) for r in stored(spark, root)["ewm_state"].filter(F.col("date") == F.lit(days[0])).select("ticker", "date").collect()} == {(t, days[0]) for t in "ACN"}
    nightly.run(spark, root, fixed, index, bench, proxies, on=last, cfg=cfg)
    assert long_way == [["N"]]  # on its first night; then its history is its tail
    nightly.run(spark, whole, fixed, index, bench, proxies, cfg=cfg)
    for t in ("stock_signals", "signal_features", "analysis"):
        x, y = (stored(spark, r)[t].drop("key_levels").filter(F.col("date") >= F.lit(days[0])).toPandas().sort_values(key(t), ignore_index=True) for r in (root, whole))
        pd.testing.assert_frame_equal(x, y, rtol=1e-9, atol=1e-12, obj=t)
        assert len(x) >= 3 * 4 if t != "analysis" else True


def test_only_partitions_that_can_matter_are_read(spark, small, tmp_path):
    bars, *_ = inputs(spark, small)
    rows = fit(bars, "raw_prices")
    tables.save(rows, f"{tmp_path}/raw_prices", nightly.part("raw_prices"))
    one = spark.createDataFrame([("Brand#1",)], "ticker string")
    since, until = dt.date(1994, 3, 1), dt.date(1995, 2, 1)
    got = nightly.prices(spark, str(tmp_path), one, since, until)
    want = rows.filter("ticker = 'Brand#1' and date between date'1994-03-01' and date'1995-02-01'")
    assert got.count() == want.count() > 0
    read = {name for f in got.inputFiles() for name in [f.split("part=")[1].split("/")[0]]}
    assert read and read <= {f"{y}-{buckets_of(one)[0]}" for y in (1994, 1995)} < set(tables.versions(spark, f"{tmp_path}/raw_prices")) | {f"1994-{buckets_of(one)[0]}"}
    assert within(lambda y: y > 2000)("-03") and not within(lambda y: y > 2000)("1999-03")


def test_landed_files_and_reports(spark, tmp_path):
    def put(name, *rows):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.json").write_text("\n".join(json.dumps(r) for r in rows))
        return str(tmp_path / name)

    acts = put("acts", {"ticker": "A", "date": "2024-01-02", "kind": "split", "factor": 2.0}, {"ticker": "A", "date": "2024-01-03", "kind": "dividend", "amount": 0.5})
    assert [(r.ticker, r.factor) for r in files.actions(spark, acts, "split").collect()] == [("A", 2.0)]
    assert [r.amount for r in files.actions(spark, acts, "dividend").collect()] == [0.5]
    listed = put("sym", {"Code": "A", "Name": "Alpha", "Exchange": "NYSE", "Currency": "USD", "Type": "Common Stock"})
    assert files.symbols(spark, listed).first().asDict() == {"code": "A", "name": "Alpha", "venue": "NYSE", "currency": "USD", "type": "Common Stock"}
    meta = files.metadata(spark, put("meta", {"ticker": "A", "Name": "Alpha", "Sector": "Tech", "Industry": "Chips", "MarketCapitalization": 5, "Exchange": "NYSE"}))
    root = str(tmp_path / "ticker_metadata")
    tables.merge(spark, root, schema("ticker_metadata"), fit(meta, "ticker_metadata"), key("ticker_metadata"))
    row = tables.read(spark, root, schema("ticker_metadata")).first()
    assert (row.name, row.provider_sector, row.market_cap) == ("Alpha", "Tech", 5) and row.updated_at is not None
    fires = spark.createDataFrame([("A", "E1", 1), ("B", "E2", 2)], "ticker string, event string, position int")
    files.write_events(fires, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/events")).count() == 2
    files.write_summary(fires, str(tmp_path / "out"), "summary")
    assert len(list((tmp_path / "out/summary").glob("*.csv"))) == 1
    doc = str(tmp_path / "doc")
    files.write_universe(fires, doc)
    files.write_universe(fires.limit(1), doc, backup=True)
    assert (spark.read.json(doc).count(), spark.read.json(f"{doc}.bak").count()) == (1, 2)


def test_universe_document(spark, tmp_path):
    (tmp_path / "u.json").write_text(json.dumps({"A": {"exchange": "us", "has_data": True, "signal_categories": ["x"]}, "B.TO": {"exchange": "tsx", "has_data": True}, "C": {"exchange": "us", "has_data": False}}))
    u = files.universe(spark, str(tmp_path / "u.json"))
    assert sorted(r.ticker for r in files.tickers(u).collect()) == ["A", "B.TO"]
    assert [r.ticker for r in files.tickers(u, ["us"]).collect()] == ["A"]
