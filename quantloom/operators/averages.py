"""The state of all exponential averages of a ticker as one row, so that a night steps on from the last one instead of reading history.

A state has each average's value and how many rows ago its input was last known, the last bar's prices and how many bars there were. One step is
column arithmetic; several are a fold over the ticker's new bars, inside the engine, with the same step. Averages that are made of averages
(the signal line, ADX) step on the values of the same step. Equal to ``functions.expr.ewms`` over the whole history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.expr import ratio

NAMES = ("fast", "slow", "signal", "gain", "loss", "tr", "plus", "minus", "dx")
PRICES = ("close", "high", "low")
STATE = "ticker string, date date, n_bars long, " + ", ".join([*(f"last_{p} double" for p in PRICES), *(f"{n}_avg double, {n}_gap int" for n in NAMES)])
OUT = ("macd", "macd_signal", "macd_hist", "rsi_14", "adx_14")
_FIELDS = [f.split()[0] for f in STATE.split(", ")][1:]


def _alphas(cfg: Config) -> dict[str, float]:
    fast, slow, signal = (2 / (n + 1) for n in cfg.macd)
    wilder, adx = 1 / cfg.rsi_window, 1 / cfg.adx_window
    return {"fast": fast, "slow": slow, "signal": signal, "gain": wilder, "loss": wilder, "tr": adx, "plus": adx, "minus": adx, "dx": adx}


def _let(made: dict[str, Column], use: Callable[[Column], Column]) -> Column:
    """``use`` of a struct that is worked out once: what is used several times would otherwise be written out as often."""
    return F.transform(F.array(F.struct(*[c.alias(n) for n, c in made.items()])), use)[0]


def step(state: Column, bar: Column, cfg: Config = DEFAULT) -> Column:
    """A struct of the state after one more bar and the indicators of that bar."""
    alphas, was = _alphas(cfg), lambda p: state[f"last_{p}"]

    def averaged(inputs: Column, *names: str) -> dict[str, Column]:
        """Each named average after its input."""
        out = {}
        for n in names:
            x, value, alpha = inputs[n], state[f"{n}_avg"], alphas[n]
            old = F.pow(F.lit(1 - alpha), state[f"{n}_gap"] + 1)
            out[f"{n}_avg"] = F.when(x.isNull(), value).when(value.isNull(), x).otherwise((old * value + alpha * x) / (old + alpha))
            out[f"{n}_gap"] = F.when(x.isNotNull(), 0).otherwise(state[f"{n}_gap"] + 1)
        return out

    close, high, low = (bar[p] for p in PRICES)
    moves = {"moved": close - was("close"), "up": high - was("high"), "down": was("low") - low}
    first, second = ("fast", "slow", "gain", "loss", "tr", "plus", "minus"), ("signal", "dx")

    def inputs(m: Column) -> Column:
        found = {n: F.when(m["moved"].isNotNull(), F.greatest(x, F.lit(0.0))) for n, x in (("gain", m["moved"]), ("loss", -m["moved"]))}
        found |= {n: F.when((x > y) & (x > 0), x).otherwise(0.0) for n, x, y in (("plus", m["up"], m["down"]), ("minus", m["down"], m["up"]))}
        found |= {"fast": close, "slow": close, "tr": F.greatest(high - low, F.abs(high - was("close")), F.abs(low - was("close")))}
        return _let(found, lambda x: _let(averaged(x, *first), composed))

    def composed(a: Column) -> Column:
        sides = {"macd": a["fast_avg"] - a["slow_avg"], "plus": 100.0 * ratio(a["plus_avg"], a["tr_avg"]), "minus": 100.0 * ratio(a["minus_avg"], a["tr_avg"])}
        return _let(sides, lambda s: _let({"signal": s["macd"], "dx": 100.0 * ratio(F.abs(s["plus"] - s["minus"]), s["plus"] + s["minus"])}, lambda x: _let(averaged(x, *second), lambda b: finished(a, b, s))))

    def finished(a: Column, b: Column, s: Column) -> Column:
        bars, gain, loss = state["n_bars"] + 1, a["gain_avg"], a["loss_avg"]
        new = {"date": bar["date"], "n_bars": bars} | {f"last_{p}": bar[p] for p in PRICES} | {f"{n}_{k}": (b if n in second else a)[f"{n}_{k}"] for n in NAMES for k in ("avg", "gap")}
        rsi = F.when(loss > 0, 100.0 - 100.0 / (1.0 + ratio(gain, loss))).when(gain > 0, F.lit(100.0))
        out = {"date": bar["date"], "macd": s["macd"], "macd_signal": b["signal_avg"], "macd_hist": s["macd"] - b["signal_avg"], "rsi_14": rsi, "adx_14": F.when(bars > 2 * cfg.adx_window, b["dx_avg"])}
        kinds = {f.split()[0]: f.split()[1] for f in STATE.split(", ")}
        return F.struct(F.struct(*[new[n].cast(kinds[n]).alias(n) for n in _FIELDS]).alias("state"), F.struct(*[c.alias(n) for n, c in out.items()]).alias("row"))

    return _let(moves, inputs)


def stepped(bars: DataFrame, states: DataFrame | None = None, cfg: Config = DEFAULT, outputs: bool = True) -> DataFrame:
    """(ticker, state, rows): each ticker's state after its bars that are newer than its state in ``states`` (all of them where it has none),
    and with ``outputs`` the indicators of each of these bars. Tickers without new bars have no row."""
    kinds = {f.split()[0]: f.split()[1] for f in STATE.split(", ")}
    empty = F.struct(*[F.lit(0 if n == "n_bars" or n.endswith("_gap") else None).cast(kinds[n]).alias(n) for n in _FIELDS])
    bar = F.struct("date", *[F.col(p).cast("double").alias(p) for p in PRICES])
    if states is None:
        lists = bars.groupBy("ticker").agg(F.array_sort(F.collect_list(bar)).alias("_bars")).withColumn("_from", empty)
    else:
        held = states.select("ticker", F.struct(*[F.col(n).cast(kinds[n]).alias(n) for n in _FIELDS]).alias("_from"))
        newer = bars.join(held.select("ticker", F.col("_from.date").alias("_since")), "ticker", "left").filter("_since is null or date > _since")
        lists = newer.groupBy("ticker").agg(F.array_sort(F.collect_list(bar)).alias("_bars")).join(held, "ticker", "left").withColumn("_from", F.coalesce("_from", empty))
    row = f"struct<date:date,{','.join(f'{n}:double' for n in OUT)}>"
    start = F.struct(F.col("_from").alias("state"), F.array().cast(f"array<{row}>").alias("rows"))

    def fold(acc: Column, x: Column) -> Column:
        after = lambda new: F.struct(new["state"].alias("state"), (F.concat(acc["rows"], F.array(new["row"])) if outputs else acc["rows"]).alias("rows"))
        return F.transform(F.array(step(acc["state"], x, cfg)), after)[0]

    return lists.select("ticker", F.aggregate("_bars", start, fold).alias("_to")).select("ticker", "_to.state", "_to.rows")


def states(done: DataFrame) -> DataFrame:
    """Rows of ``STATE`` of what ``stepped`` gives."""
    return done.select("ticker", "state.*")


def indicators(done: DataFrame) -> DataFrame:
    """(ticker, date, indicators) of what ``stepped`` gives."""
    return done.select("ticker", F.inline("rows"))


def newest(stored: DataFrame, before: Column) -> DataFrame:
    """Each ticker's last state of a date before ``before``."""
    last = F.max_by(F.struct(*_FIELDS), "date").alias("_last")
    return stored.filter(F.col("date") < before).groupBy("ticker").agg(last).select("ticker", "_last.*")
