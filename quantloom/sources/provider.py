"""A provider's bars, splits, dividends and company data, asked for by Spark's tasks: a Python data source.

Tickers are dealt to ``tasks`` partitions, which is also how many requests run at once; a request is one ticker and at most
``span`` days. Both ends of the dates count. How a request travels is the caller's: ``transport(kind, symbol, start, end)`` gives a
status, the decoded rows and the seconds that the provider asks to wait (or None). It is pickled with the plan, so a lost
executor's requests are simply made again by another.

Reads of the frame ask anew: keep it (``checkpointed``) where it is read twice.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from .files import COMPANY, PROVIDER_BARS, company

SCHEMAS = {
    "bars": f"ticker string, {PROVIDER_BARS}, source string, fetched_at timestamp",
    "splits": "ticker string, date date, factor double",
    "dividends": "ticker string, date date, amount double",
    "metadata": COMPANY,
}
AGAIN = (429, 500, 502, 503, 504)
PRICES = ("open", "high", "low", "close", "adjusted_close")
Transport = Callable[[str, str, dt.date, dt.date], tuple[int, Any, float | None]]


class ProviderError(RuntimeError):
    """A request that failed for good; it fails its task, and after Spark's own attempts the job."""


@dataclass(frozen=True)
class Asked:
    """What one partition asks for."""

    kind: str
    tickers: tuple[str, ...]
    start: dt.date
    end: dt.date
    span: int
    tries: int
    backoff: float
    source: str

    def spans(self) -> Iterator[tuple[dt.date, dt.date]]:
        """The dates in pieces of at most ``span`` days, without gaps or overlaps; none where the end lies before the start."""
        at = self.start
        while at <= self.end:
            last = min(self.end, at + dt.timedelta(days=self.span - 1))
            yield at, last
            at = last + dt.timedelta(days=1)


@dataclass
class Part(D.InputPartition):
    asked: Asked


def symbol(ticker: str) -> str:
    """The same as ``ingest.provider_symbol``, for use in tasks."""
    return ticker if ticker.endswith((".TO", ".V", ".INDX")) else f"{ticker}.US"


def request(transport: Transport, asked: Asked, ticker: str, start: dt.date, end: dt.date, sleep: Callable[[float], None] = time.sleep) -> Any:
    """The rows of one request. Overload, server faults and broken connections are tried again, each time after twice the wait or
    what the provider asks for; a ticker that the provider doesn't know has none."""
    for attempt in range(asked.tries + 1):
        wait = None
        try:
            status, rows, wait = transport(asked.kind, symbol(ticker), start, end)
        except OSError as error:
            status, rows = type(error).__name__, None
        if status == 200:
            return rows
        if status == 404:
            return []
        if isinstance(status, int) and status not in AGAIN:
            break
        if attempt < asked.tries:
            sleep(asked.backoff * 2**attempt if wait is None else wait)
    raise ProviderError(f"{asked.kind} of {ticker} from {start} to {end}: {status}")


def rows_of(asked: Asked, ticker: str, rows: Any, now: dt.datetime) -> Iterator[tuple]:
    """A provider's rows as rows of ``SCHEMAS``; what is no list, or has no date, is none. A price that is absent is NULL, and dates outside of what was asked for go."""
    if asked.kind == "metadata":
        if isinstance(rows, dict):
            cap = rows.get("MarketCapitalization")
            yield ticker, rows.get("Name"), rows.get("Sector"), rows.get("Industry"), None if cap is None else int(cap), rows.get("Exchange")
        return
    for row in rows if isinstance(rows, list) else ():
        if not row.get("date"):
            continue
        date = dt.date.fromisoformat(row["date"])
        if not asked.start <= date <= asked.end:
            continue
        if asked.kind == "bars":
            prices = (None if row.get(c) is None else float(row[c]) for c in PRICES)
            yield (ticker, date, *prices, int(row.get("volume") or 0), asked.source, now)
        elif asked.kind == "splits":
            new, _, old = str(row["split"]).partition("/")  # 2.0, or 2/1
            yield ticker, date, float(new) / float(old or 1)
        else:
            yield ticker, date, float(row["value"])


class Reader(D.DataSourceReader):
    def __init__(self, transport: Transport, asked: Asked, tasks: int) -> None:
        self.transport, self.asked, self.tasks = transport, asked, tasks

    def partitions(self) -> list[Part]:
        names = self.asked.tickers
        n = max(1, min(self.tasks, len(names)))
        return [Part(replace(self.asked, tickers=names[i::n])) for i in range(n)]

    def read(self, partition: Part) -> Iterator[tuple]:
        asked = partition.asked
        spans = list(asked.spans())
        if asked.kind == "metadata":
            spans = spans[:1]
        for ticker in asked.tickers:
            for start, end in spans:
                rows = request(self.transport, asked, ticker, start, end)
                yield from rows_of(asked, ticker, rows, dt.datetime.now(dt.UTC))


class Narrowing(Reader):
    """Filters on the ticker and the date become fewer and shorter requests; the others are Spark's."""

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        day = dt.timedelta(days=1)
        for f in filters:
            on, value, asked = getattr(f, "attribute", None), getattr(f, "value", None), self.asked
            if on == ("ticker",) and isinstance(f, (D.EqualTo, D.In)):
                wanted = {value} if isinstance(f, D.EqualTo) else set(value)
                self.asked = replace(asked, tickers=tuple(t for t in asked.tickers if t in wanted))
            elif on == ("date",) and isinstance(f, D.EqualTo):
                self.asked = replace(asked, start=max(asked.start, value), end=min(asked.end, value))
            elif on == ("date",) and isinstance(f, (D.GreaterThan, D.GreaterThanOrEqual)):
                self.asked = replace(asked, start=max(asked.start, value if isinstance(f, D.GreaterThanOrEqual) else value + day))
            elif on == ("date",) and isinstance(f, (D.LessThan, D.LessThanOrEqual)):
                self.asked = replace(asked, end=min(asked.end, value if isinstance(f, D.LessThanOrEqual) else value - day))
            else:
                yield f


def source(transport: Transport, narrowing: bool) -> type[D.DataSource]:
    """The data source class for one transport. ``narrowing`` needs the session's ``spark.sql.python.filterPushdown.enabled``."""

    class Provider(D.DataSource):
        @classmethod
        def name(cls) -> str:
            return "market_provider"

        def schema(self) -> str:
            return SCHEMAS[self.options["kind"]]

        def reader(self, schema) -> Reader:
            o = self.options
            tickers = tuple(dict.fromkeys(t for t in o["tickers"].split(",") if t))
            start, end = (dt.date.fromisoformat(o[k]) for k in ("start", "end"))
            asked = Asked(o["kind"], tickers, start, end, int(o["span"]), int(o["tries"]), float(o["backoff"]), o["source"])
            return (Narrowing if narrowing else Reader)(transport, asked, int(o["tasks"]))

    return Provider


def asked(
    spark: SparkSession, transport: Transport, kind: str, tickers: DataFrame, start: dt.date, end: dt.date,
    tasks: int = 8, span: int = 3650, tries: int = 5, backoff: float = 2.0, named: str = "provider",
) -> DataFrame:
    """``bars``, ``splits``, ``dividends`` or ``metadata`` of tickers (their names pass the driver: a universe, some ten thousand at most) from ``start`` to ``end``, both included.

    A ticker named twice is asked for once, a NULL or empty name not at all. With ``spark.sql.python.filterPushdown.enabled`` later filters on ticker and date narrow the requests.
    """
    names = sorted(r[0] for r in tickers.select("ticker").distinct().collect() if r[0])
    if not names or start > end:
        return spark.createDataFrame([], SCHEMAS[kind])
    narrowing = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true"
    spark.dataSource.register(source(transport, narrowing))
    options = {"kind": kind, "tickers": ",".join(names), "start": str(start), "end": str(end), "tasks": tasks, "span": span, "tries": tries, "backoff": backoff, "source": named}
    return spark.read.format("market_provider").options(**options).load()


def feeds(spark: SparkSession, transport: Transport, on: dt.date, tickers: DataFrame, since: dt.date, **options: Any) -> dict[str, Any]:
    """What ``nightly.night`` takes from a provider: the night's bars, the actions of its last two days, whole histories and company data."""
    before = on - dt.timedelta(days=1)
    return {
        "fetched": asked(spark, transport, "bars", tickers, on, on, **options),
        "actions": tuple(asked(spark, transport, kind, tickers, before, on, **options) for kind in ("splits", "dividends")),
        "history": lambda changed: asked(spark, transport, "bars", changed, since, on, **options),
        "metadata": lambda due: company(asked(spark, transport, "metadata", due.filter(~F.col("ticker").endswith(".INDX")), on, on, **options)),
    }
