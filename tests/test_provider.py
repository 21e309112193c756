"""The provider as a data source, against a transport that keeps a diary of its requests in a folder."""

import datetime as dt
import json
import sys
import uuid
from collections import Counter
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quantloom.functions.shared import checkpointed
from quantloom.operators import ingest, tables
from quantloom.plans import nightly
from quantloom.schemas import schema
from quantloom.sources import provider

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't have this module
DAY = dt.date(2024, 3, 1)


class Diary:
    """Answers for every weekday; ``bad`` names symbols that answer with a status a number of times before they work."""

    def __init__(self, folder, bad=None, splits=None, unknown=(), halved=()):
        self.folder, self.bad, self.splits, self.unknown, self.halved = str(folder), bad or {}, splits or {}, unknown, halved

    def asked(self):
        return [json.loads(f.read_text()) for f in Path(self.folder).glob("*.json")]

    def __call__(self, kind, symbol, start, end):
        before = sum(a[:2] == [kind, symbol] for a in self.asked())
        with open(f"{self.folder}/{uuid.uuid4()}.json", "w") as f:
            json.dump([kind, symbol, str(start), str(end)], f)
        status, times = self.bad.get(symbol, (200, 0))
        if before < times:
            if status == "reset":
                raise ConnectionResetError
            return status, None, 0.0
        if symbol in self.unknown:
            return 404, {"message": "not found"}, None
        if kind == "metadata":
            return 200, {"Name": f"Company {symbol}", "Sector": "Tech", "MarketCapitalization": 5}, None
        if kind == "splits":
            return 200, [{"date": d, "split": s} for d, s in self.splits.get(symbol, {}).items()], None
        if kind == "dividends":
            return 404, None, None
        days = [start + dt.timedelta(n) for n in range((end - start).days + 1)]
        factor = 0.5 if symbol in self.halved else 1.0
        return 200, [{"date": str(d), "open": 10, "high": 12, "low": 9, "close": 11, "adjusted_close": 11 * factor} for d in days if d.weekday() < 5], None


def frame(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "ticker string")


def test_dates_are_inclusive_and_split_into_requests(spark, tmp_path):
    diary = Diary(tmp_path)
    got = provider.asked(spark, diary, "bars", frame(spark, "A", "B.TO", "A", None, ""), DAY, DAY + dt.timedelta(9), span=4, backoff=0)
    rows = got.collect()
    assert Counter(r.ticker for r in rows) == {"A": 6, "B.TO": 6} and {min(r.date for r in rows), max(r.date for r in rows)} == {DAY, dt.date(2024, 3, 8)}
    days = [["2024-03-01", "2024-03-04"], ["2024-03-05", "2024-03-08"], ["2024-03-09", "2024-03-10"]]
    assert sorted(diary.asked()) == [["bars", s, *d] for s in ("A.US", "B.TO") for d in days]
    assert rows[0].volume == 0 and rows[0].source == "provider" and rows[0].fetched_at is not None
    assert got.rdd.getNumPartitions() == 2
    names = frame(spark, "A", "B.TO", "C.V", "VIX.INDX", "A.B")
    assert all(r.ours == r.theirs for r in names.select(ingest.provider_symbol(F.col("ticker")).alias("theirs"), F.udf(provider.symbol, "string")("ticker").alias("ours")).collect())


def test_nothing_asked_and_nothing_there(spark, tmp_path):
    diary = Diary(tmp_path, unknown=("X.US",))
    assert provider.asked(spark, diary, "bars", frame(spark), DAY, DAY).count() == 0
    assert provider.asked(spark, diary, "bars", frame(spark, "A"), DAY, DAY - dt.timedelta(1)).count() == 0
    assert diary.asked() == []
    weekend = dt.date(2024, 3, 2)
    assert provider.asked(spark, diary, "bars", frame(spark, "A"), weekend, weekend).count() == 0
    for kind in ("bars", "splits", "dividends", "metadata"):
        assert provider.asked(spark, diary, kind, frame(spark, "X"), DAY, DAY).count() == 0
    stray = provider.Asked("bars", ("A",), DAY, DAY, 9, 0, 0.0, "p")
    assert list(provider.rows_of(stray, "A", [{"date": "2024-02-29", "close": 1}, {"close": 2}], None)) == []
    assert next(provider.rows_of(stray, "A", [{"date": "2024-03-01", "close": 1}], None)) == ("A", DAY, None, None, None, 1.0, None, 0, "p", None)
    assert next(provider.rows_of(provider.replace(stray, kind="splits"), "A", [{"date": "2024-03-01", "split": "3/2"}], None)) == ("A", DAY, 1.5)


@pytest.mark.parametrize("status", [429, 503, "reset"])
def test_overload_is_tried_five_times(spark, tmp_path, status):
    diary = Diary(tmp_path, bad={"A.US": (status, 5)})
    assert provider.asked(spark, diary, "bars", frame(spark, "A"), DAY, DAY, backoff=0).count() == 1
    assert len(diary.asked()) == 6


def test_what_fails_for_good(tmp_path):
    waits = []
    one = provider.Asked("bars", ("A",), DAY, DAY, 9, 5, 2.0, "p")
    with pytest.raises(provider.ProviderError, match="bars of A from 2024-03-01 to 2024-03-01: 429"):
        provider.request(lambda *a: (429, None, None), one, "A", DAY, DAY, waits.append)
    assert waits == [2, 4, 8, 16, 32]
    with pytest.raises(provider.ProviderError, match="401"):
        provider.request(lambda *a: (401, None, None), one, "A", DAY, DAY, waits.append)
    assert len(waits) == 5  # a wrong key is not tried again
    with pytest.raises(provider.ProviderError, match="ConnectionResetError"):
        provider.request(Diary(tmp_path, bad={"A.US": ("reset", 9)}), one, "A", DAY, DAY, lambda s: None)
    provider.request(lambda *a, n=iter([503, 200]): (next(n), [], 7.0), one, "A", DAY, DAY, waits.append)
    assert waits[5:] == [7.0]  # as long as the provider asks for


def test_filters_narrow_the_requests(spark, tmp_path):
    diary = Diary(tmp_path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = provider.asked(spark, diary, "bars", frame(spark, "A", "B", "C"), DAY, DAY + dt.timedelta(60), backoff=0)
        near = got.filter("ticker in ('A', 'C') and date > date'2024-03-04' and date <= date'2024-03-06' and close > 1")
        assert sorted((r.ticker, r.date.day) for r in near.collect()) == [("A", 5), ("A", 6), ("C", 5), ("C", 6)]
        assert sorted(diary.asked()) == [["bars", s, "2024-03-05", "2024-03-06"] for s in ("A.US", "C.US")]
        assert got.filter("ticker = 'B' and date = date'2024-03-07'").count() == 1 and diary.asked().count(["bars", "B.US", "2024-03-07", "2024-03-07"]) == 1
        n = len(diary.asked())
        assert got.filter("ticker = 'Z'").count() == 0 and got.filter("date > date'2025-01-01'").count() == 0 and len(diary.asked()) == n
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_a_night_asks_its_provider(spark, tmp_path):
    """Breaker, whole history of a split ticker, company data: each asked for once."""
    diary = Diary(tmp_path, splits={"B.US": {"2024-03-08": 2.0}}, unknown=("GONE.US",), halved=("B.US",))
    root, on, since = f"{tmp_path}/root", dt.date(2024, 3, 8), dt.date(2024, 2, 1)
    tickers = frame(spark, "A", "B", "C.TO", "D", "E", "GONE")
    market = checkpointed(provider.asked(spark, Diary(tmp_path), "bars", frame(spark, "VIX.INDX", "SPY"), since, on).select("ticker", "date", "close"))
    bench = market.filter("ticker = 'SPY'")
    index = market.filter("ticker = 'SPY'").select("date", F.col("close").alias("vix"), F.lit(90.0).alias("vvix"))
    feeds = provider.feeds(spark, diary, on, tickers, since, backoff=0)
    assert nightly.night(spark, root, on, tickers, feeds["fetched"], index, bench, bench, feeds["actions"], feeds["history"], feeds["metadata"])
    read = lambda t: tables.read(spark, f"{root}/{t}", schema(t))
    stored = Counter((r.ticker, r.close, r.currency, r.source) for r in read("raw_prices").collect())
    whole = sum((since + dt.timedelta(n)).weekday() < 5 for n in range((on - since).days + 1))
    assert stored == {("A", 11.0, "USD", "provider"): 1, ("B", 5.5, "USD", "provider"): whole, ("C.TO", 11.0, "CAD", "provider"): 1, ("D", 11.0, "USD", "provider"): 1, ("E", 11.0, "USD", "provider"): 1}
    assert {r.name for r in read("ticker_metadata").collect()} == {"Company A.US", "Company B.US", "Company C.TO", "Company D.US", "Company E.US"}
    own = [a for a in diary.asked() if a[1] not in ("VIX.INDX", "SPY.US")]
    assert max(Counter(map(tuple, own)).values()) == 1
    assert [a for a in own if a[0] == "bars" and a[2] != str(on)] == [["bars", "B.US", str(since), str(on)]]
