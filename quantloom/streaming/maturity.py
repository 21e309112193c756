"""Outcomes as they mature: a stream of bars and predictions, the open predictions of a ticker as its state.

Where ``outcomes.outcomes_v2`` looks ahead over the whole history each time, a batch here costs its own rows and the state of the tickers in it:
the last bars (as many as the longest horizon and the volatility need) and the predictions whose last horizon is not reached.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from statistics import stdev

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import DEFAULT, Config
from ..operators import outcomes

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MATURED = "ticker string, signal_date date, horizon_days int, bias string, price_at_signal double, vol_at_signal double, future_price double, seam boolean"
_INPUT = ("ticker", "date", "close", "bias", "signal_version", "price_at_signal")


def rows_of(bars: DataFrame, preds: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Bars and predictions as one stream. Predictions under the price floor are left out."""
    bars = bars.select("ticker", "date", "close")
    preds = preds.filter(F.col("price_at_signal") >= cfg.price_floor).select("ticker", F.col("signal_date").alias("date"), "bias", "signal_version", "price_at_signal")
    return bars.unionByName(preds, allowMissingColumns=True).select(*_INPUT).filter("ticker is not null and date is not null")


class Maturity(StatefulProcessor):
    """One ticker: places each prediction on its bar, counts the bars since and gives a row for each horizon reached.

    Bars of a batch may come in any order. A bar at or before the last one seen is ignored: what was counted stays counted, and a corrected history
    goes through a refresh. A prediction waits for its bar and may come after it, while the state has the bars that it needs; it is dropped if the
    ticker's bars go past its date without one on it, or if it comes later than that. Of several versions of a prediction the highest speaks: one that
    comes later gives all its horizons anew, with the same keys, so that an upsert replaces them.
    """

    def __init__(self, cfg: Config = DEFAULT) -> None:
        self.horizons, self.lookback, self.max_ratio = sorted(cfg.horizons_v2), cfg.vol_lookback, cfg.max_ratio
        # the bar of a prediction on its last horizon, and before it the closes of the volatility's ratios
        self.keeps = self.horizons[-1] + 1 + self.lookback

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bars = handle.getListState("bars", "date date, close double")
        self.open = handle.getListState("open", "date date, bias string, version string, price double, reached int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bars = [tuple(r) for r in self.bars.get()]
        waiting = {r[0]: tuple(r[1:]) for r in self.open.get()}
        last = bars[-1][0] if bars else dt.date.min
        least = self.lookback if len(bars) == self.keeps else 0  # bars before were let go
        new: dict[dt.date, float | None] = {}
        for chunk in rows:
            for date, close, bias, version, price in zip(chunk["date"], chunk["close"], chunk["bias"], chunk["signal_version"], chunk["price_at_signal"]):
                if pd.isna(price):
                    if date > last:
                        new[date] = None if pd.isna(close) else float(close)
                elif date not in waiting or (version or "") > (waiting[date][1] or ""):
                    waiting[date] = (bias, version, float(price), 0)
        bars += sorted(new.items())
        at = {date: i for i, (date, _) in enumerate(bars)}
        out, still = [], []
        for date, (bias, version, price, reached) in sorted(waiting.items()):
            if date not in at:
                if not bars or date > bars[-1][0]:
                    still.append((date, bias, version, price, reached))
                continue
            if at[date] < least:
                continue
            passed = len(bars) - 1 - at[date]
            due = [h for h in self.horizons if reached < h <= passed]
            vol = self.volatility(bars, at[date]) if due else None
            out += [(key[0], date, h, bias, price, vol, bars[at[date] + h][1], self.torn(bars, at[date], h)) for h in due]
            if passed < self.horizons[-1]:
                still.append((date, bias, version, price, max([reached, *due])))
        for state, left in ((self.bars, bars[-self.keeps :]), (self.open, still)):
            if left:
                state.put(left)
            else:  # an empty list can't be written
                state.clear()
        yield pd.DataFrame(out, columns=[c.split()[0] for c in MATURED.split(", ")])

    def step(self, bars: list[tuple], i: int) -> float | None:
        now, before = bars[i][1], bars[i - 1][1] if i else None
        return now / before if now is not None and before else None

    def torn(self, bars: list[tuple], i: int, h: int) -> bool:
        """A seam between two of the bars ahead, the first pair from day 1 to day 2."""
        steps = [self.step(bars, i + k) for k in range(2, h + 1)]
        return any(s is None or s > self.max_ratio or s < 1 / self.max_ratio for s in steps)

    def volatility(self, bars: list[tuple], i: int) -> float | None:
        steps = [self.step(bars, k) for k in range(max(0, i - self.lookback + 1), i + 1)]
        known = [s - 1.0 for s in steps if s is not None]
        return stdev(known) if len(known) >= 2 else None

    def close(self) -> None:
        pass


def take(spark: SparkSession, landing: str, checkpoint: str, sink: Callable[[DataFrame, int], None], cfg: Config = DEFAULT, files: int | None = None) -> None:
    """Runs landed rows (Parquet, as ``rows_of`` gives them) through the state until all are seen, ``files`` at most in a batch; ``sink`` takes what matured.

    A batch that was stopped comes again with its number: ``sink`` must replace what it wrote before (an upsert does).
    """
    shape = "ticker string, date date, close double, bias string, signal_version string, price_at_signal double"
    reader = spark.readStream.schema(shape)
    stream = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(landing)
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PROVIDER)
    try:
        query = matured(stream, cfg).writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(name, before)


def resolved(rows: DataFrame, bench: DataFrame, betas: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Outcomes of what matured without a seam, as ``outcomes.outcomes_v2`` gives them."""
    rows = rows.filter("future_price is not null and not seam").drop("seam").withColumn("threshold_used", outcomes.threshold(cfg))
    return outcomes.judged(rows, bench, betas, cfg)


def matured(stream: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The horizons reached, as a stream (``MATURED``); rows with a seam are given too, for the caller to leave waiting.

    The state is small and bounded by ticker; its session needs RocksDB (``PROVIDER``) as its state store.
    """
    return stream.groupBy("ticker").transformWithStateInPandas(Maturity(cfg), MATURED, "Append", "none")
