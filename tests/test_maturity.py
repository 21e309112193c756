"""Outcomes by the stream against outcomes by looking ahead."""

import datetime as dt
import random

from quantloom.operators import outcomes
from quantloom.streaming import maturity

DAYS = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(160)]


def _made():
    rng = random.Random(5)
    bars, preds = [], []
    for ticker, every in (("A", 1), ("B", 2), ("C", 1)):
        price = 50.0
        for i, day in enumerate(DAYS[::every]):
            price *= rng.uniform(0.95, 1.06)
            if ticker == "C" and i == 60:
                price *= 5  # a seam
            bars.append((ticker, day, None if ticker == "C" and i == 90 else 0.0 if ticker == "B" and i == 40 else price))
            if i % 3 == 0:
                preds.append((ticker, day, "v1.0", rng.choice(["bullish", "bearish"]), price if price else 1.0))
                if i % 9 == 0:
                    preds.append((ticker, day, "v2.0", "bullish", price * 1.01))
    preds.append(("B", DAYS[1], "v1.0", "bullish", 9.0))  # no bar on that day
    preds.append(("A", DAYS[2], "v1.0", "bullish", 0.5))  # under the floor
    return bars, preds


def test_replayed_with_restarts_equals_looking_ahead(spark, tmp_path):
    """Batches of uneven size, each run a restart from the checkpoint; predictions on the day, a batch late and a batch early; a bar given twice."""
    bars, preds = _made()
    frame = lambda b, p: maturity.rows_of(
        spark.createDataFrame(b, "ticker string, date date, close double"), spark.createDataFrame(p, "ticker string, signal_date date, signal_version string, bias string, price_at_signal double")
    )
    landed, state, out = (f"{tmp_path}/{n}" for n in ("landed", "state", "out"))
    cuts = [0, 40, 41, 110, 160]
    for n, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        early, late = [0, 0, 1, 0][n], [0, 7, 0, 0][n]
        mine = [p for p in preds if DAYS.index(p[1]) >= cuts[n] - late and DAYS.index(p[1]) < hi + 30 * early]
        again = [b for b in bars if DAYS.index(b[1]) == lo - 1]
        new = [b for b in bars if lo <= DAYS.index(b[1]) < hi] + [(t, d, 1.0) for t, d, _ in again]
        random.Random(n).shuffle(new)
        frame(new, mine).coalesce(1).write.mode("append").parquet(landed)
        maturity.take(spark, landed, state, lambda rows, batch: rows.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
    got = [(r.ticker, r.signal_date, r.horizon_days, r.bias, r.future_price, r.vol_at_signal, r.price_at_signal) for r in spark.read.parquet(out).filter("future_price is not null and not seam").collect()]
    ahead = outcomes.forward(spark.createDataFrame(bars, "ticker string, date date, close double"))
    all_preds = spark.createDataFrame(preds, "ticker string, signal_date date, signal_version string, bias string, price_at_signal double")
    bench = spark.createDataFrame([("SPY", d, 100.0 + i) for i, d in enumerate(DAYS)], "ticker string, date date, close double")
    betas = spark.createDataFrame([("A", 1.2)], "ticker string, beta double")
    want = outcomes.outcomes_v2(all_preds, ahead, bench, betas).collect()
    assert len(got) == len({g[:3] for g in got})
    assert {g[:4] for g in got} == {(r.ticker, r.signal_date, r.horizon_days, r.bias) for r in want} and len(want) > 300
    by = {(r.ticker, r.signal_date, r.horizon_days): r for r in want}
    for ticker, day, h, _, future, vol, price in got:
        r = by[ticker, day, h]
        assert (future, price) == (r.future_price, r.price_at_signal)
        assert (vol is None) == (r.vol_at_signal is None) and (vol is None or abs(vol - r.vol_at_signal) < 1e-12)


def test_a_higher_version_that_comes_later_speaks_anew(spark, tmp_path):
    landed, state = f"{tmp_path}/landed", f"{tmp_path}/state"
    seen = []
    bars = spark.createDataFrame([("A", d, 10.0 + i) for i, d in enumerate(DAYS[:12])], "ticker string, date date, close double")
    pred = lambda v, p: spark.createDataFrame([("A", DAYS[0], v, "bullish", p)], "ticker string, signal_date date, signal_version string, bias string, price_at_signal double")
    for b, p in ((bars, pred("v1.0", 10.0)), (bars.limit(0), pred("v2.0", 11.0)), (bars.limit(0), pred("v1.0", 10.0))):
        maturity.rows_of(b, p).coalesce(1).write.mode("append").parquet(landed)
        maturity.take(spark, landed, state, lambda rows, _: seen.extend((r.horizon_days, r.price_at_signal) for r in rows.collect()))
    assert sorted(seen[:2]) == [(5, 10.0), (10, 10.0)] and sorted(seen[2:]) == [(5, 11.0), (10, 11.0)]


def test_a_ticker_without_open_predictions_or_without_bars(spark, tmp_path):
    """B has bars alone, C a prediction before any bar; A's last prediction matures, and D's is dropped, in a batch after it came."""
    landed, state = f"{tmp_path}/landed", f"{tmp_path}/state"
    seen = []
    bars = lambda lo, hi: [(t, d, 10.0 + DAYS.index(d)) for t in "ABD" for d in DAYS[lo:hi]]
    preds = [("A", DAYS[0], "v1.0", "bullish", 10.0), ("C", DAYS[100], "v1.0", "bearish", 7.0), ("D", DAYS[5], "v1.0", "bullish", 15.0)]
    batches = [([b for b in bars(0, 5)], preds), ([b for b in bars(5, 100) if b[::2] != ("D", 15.0)], []), ([("C", d, 5.0) for d in DAYS[100:106]], [])]
    for b, p in batches:
        p = spark.createDataFrame(p, "ticker string, signal_date date, signal_version string, bias string, price_at_signal double")
        maturity.rows_of(spark.createDataFrame(b, "ticker string, date date, close double"), p).coalesce(1).write.mode("append").parquet(landed)
        maturity.take(spark, landed, state, lambda rows, _: seen.extend((r.ticker, r.horizon_days, r.future_price) for r in rows.collect()))
    assert sorted(seen) == [*[("A", h, 10.0 + h) for h in sorted(maturity.DEFAULT.horizons_v2)], ("C", 5, 5.0)]
