"""Research queries over features, predictions and outcomes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.expr import exceeds, rounded
from ..functions.quantiles import medians, quantiles
from ..functions.shared import checkpointed
from .indicators import score_parts, weighted

# The parameter grids that are searched.
GRID = {
    "signal_threshold": (0.4, 0.5, 0.6, 0.7),
    "vix_high_mult": ("high", 1.2, (1.0, 1.1, 1.2, 1.3)),
    "vix_elevated_mult": ("elevated", 1.1, (1.0, 1.05, 1.1, 1.15)),
    "vix_low_mult": ("low", 0.85, (0.8, 0.85, 0.9, 1.0)),
    "weights": ((0.25, 0.30, 0.35), (0.20, 0.25, 0.30), (0.20, 0.25, 0.30), (0.15, 0.20, 0.25)),
}
# Lower bounds of the distance to the year's high, nearest first.
DISTANCES = ((0.0, "d10_at_or_above_high"), (-0.02, "d9_within_2pct"), (-0.05, "d8_within_5pct"), (-0.10, "d7_within_10pct"), (-0.15, "d6_within_15pct"), (-0.20, "d5_within_20pct"), (-0.30, "d4_within_30pct"), (-0.40, "d3_within_40pct"), (-0.50, "d2_within_50pct"))
FARTHEST = "d1_below_50pct"


def share(hit: Column) -> Column:
    return rounded(F.avg(hit.cast("int")), 4)


def regime_share(df: DataFrame) -> DataFrame:
    out = df.filter("ticker_regime is not null").groupBy("ticker_regime").agg(F.count("*").alias("n"))
    return out.withColumn("share", rounded(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4))  # a row for each regime


def regime_by_year(df: DataFrame) -> DataFrame:
    out = df.filter("ticker_regime is not null").groupBy(F.year("date").alias("year"), "ticker_regime").agg(F.count("*").alias("n"))
    return out.withColumn("share", rounded(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("year")), 4))


def regime_streaks(df: DataFrame) -> DataFrame:
    """Lengths of runs of one regime, by gaps and islands: mean, quartiles, longest."""
    df = df.filter("ticker_regime is not null")
    island = F.row_number().over(Window.partitionBy("ticker").orderBy("date")) - F.row_number().over(Window.partitionBy("ticker", "ticker_regime").orderBy("date"))
    runs = checkpointed(df.select("ticker", "ticker_regime", island.alias("_island")).groupBy("ticker", "ticker_regime", "_island").agg(F.count("*").alias("run")))
    out = runs.groupBy("ticker_regime").agg(F.count("*").alias("n_streaks"), rounded(F.avg("run"), 4).alias("mean_days"), F.max("run").alias("max_days"))
    cuts = quantiles(runs, ["ticker_regime"], "run", [0.25, 0.5, 0.75]).select("ticker_regime", *[rounded(F.col("q")[i], 4).alias(n) for i, n in enumerate(("p25", "median_days", "p75"))])
    return out.join(cuts, "ticker_regime").select("ticker_regime", "n_streaks", "mean_days", "p25", "median_days", "p75", "max_days")


def falling_knife(feats: DataFrame, outcomes: DataFrame, below: float = -0.15) -> DataFrame:
    """Excess after signals far under the long average, by regime and direction, NULLs last."""
    deep = feats.filter((F.col("dist_sma200") < below) & F.col("ticker_regime").isNotNull()).select("ticker", F.col("date").alias("signal_date"), "ticker_regime", "trend_direction")
    at = lambda h: outcomes.filter(F.col("horizon_days") == h).select("ticker", "signal_date", F.col("excess_return").alias(f"x{h}"), F.col("direction_correct").alias(f"d{h}"))
    df = checkpointed(deep.join(at(21), ["ticker", "signal_date"], "left").join(at(63), ["ticker", "signal_date"], "left").filter("x21 is not null or x63 is not null"))
    keys = ["ticker_regime", "trend_direction"]
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), rounded(F.avg("x21"), 6).alias("mean_21"), rounded(F.avg("x63"), 6).alias("mean_63"), share(F.col("d21")).alias("dir_acc_21"))
    middle = medians(df, keys, ["x21", "x63"]).select(F.col(keys[0]).alias("_regime"), F.col(keys[1]).alias("_trend"), rounded(F.col("x21"), 6).alias("median_21"), rounded(F.col("x63"), 6).alias("median_63"))
    both = out.join(middle, F.col("_regime").eqNullSafe(F.col(keys[0])) & F.col("_trend").eqNullSafe(F.col(keys[1])))  # a row for each pair of labels
    return both.select(*keys, "n", "mean_21", "median_21", "mean_63", "median_63", "dir_acc_21").orderBy(keys[0], F.asc_nulls_last(keys[1]))


def _with_median(out: DataFrame, rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    found = quantiles(rows, keys, value, [0.5])
    return out.join(found.select(*keys, rounded(F.col("q")[0], 6).alias(name)), keys)


def outcome_base_rates(outcomes: DataFrame, horizons: Sequence[int] = (21, 63)) -> DataFrame:
    df = outcomes.filter(F.col("excess_return").isNotNull() & F.col("horizon_days").isin(*horizons))
    df = checkpointed(df.select("horizon_days", "excess_return", "direction_correct"))
    out = df.groupBy("horizon_days").agg(F.count("*").alias("n"), rounded(F.avg("excess_return"), 6).alias("mean_excess"), share(F.col("direction_correct")).alias("dir_acc"))
    return _with_median(out, df, ["horizon_days"], "excess_return", "median_excess").select("horizon_days", "n", "mean_excess", "median_excess", "dir_acc")


def threshold_sensitivity(df: DataFrame, cuts: Sequence[int] = (20, 25, 30, 35, 40), slope: float = 0.02) -> DataFrame:
    """How the regimes would split at other ADX cuts."""
    df = df.filter("adx_14 is not null and sma200_slope is not null").select("adx_14", F.abs("sma200_slope").alias("_s"), F.explode(F.array(*[F.lit(c) for c in cuts])).alias("threshold"))
    trending = (F.col("adx_14") >= F.col("threshold")) | (F.col("_s") >= slope)
    out = df.groupBy("threshold").agg(F.sum(trending.cast("int")).alias("trending_n"), F.sum((~trending).cast("int")).alias("ranging_n"))
    return out.withColumn("trending_pct", rounded(F.col("trending_n") * 100.0 / (F.col("trending_n") + F.col("ranging_n")), 4))


def distance_bucket(distance: Column) -> Column:
    out = None
    for low, name in DISTANCES:
        out = F.when(distance >= low, name) if out is None else out.when(distance >= low, name)
    return out.otherwise(FARTHEST)


def dist_buckets(feats: DataFrame, outcomes: DataFrame, horizon: int = 42) -> DataFrame:
    f = feats.filter("dist_52w_high is not null and sma200_slope > 0").select("ticker", F.col("date").alias("signal_date"), distance_bucket(F.col("dist_52w_high")).alias("dist_bucket"))
    o = outcomes.filter((F.col("horizon_days") == horizon) & F.col("excess_return").isNotNull() & (F.col("price_at_signal") >= 1.0)).select("ticker", "signal_date", "excess_return")
    df = checkpointed(o.join(f, ["ticker", "signal_date"]).select("dist_bucket", "excess_return"))
    out = df.groupBy("dist_bucket").agg(F.count("*").alias("n"), share(exceeds(F.col("excess_return"), F.lit(0.0))).alias("frac_gt0"))
    return _with_median(out, df, ["dist_bucket"], "excess_return", "median_42d").select("dist_bucket", "n", "median_42d", "frac_gt0")


def three_way(rows: DataFrame) -> DataFrame:
    """Up, down and dead zone by bias and horizon, and how often the mere direction was right."""
    r, side = F.col("ret"), F.when(F.col("bias") == "bullish", 1.0).otherwise(-1.0)
    return rows.filter("ret is not null").groupBy("bias", "horizon_days").agg(
        F.count("*").alias("n"), share(r > 0.01).alias("frac_up"), share(r < -0.01).alias("frac_down"), share(F.abs(r) <= 0.01).alias("frac_dead_zone"), share(F.signum(r) == side).alias("direction_only")
    )


def base_rates(rows: DataFrame) -> DataFrame:
    r = F.col("ret")
    return rows.filter("ret is not null").groupBy("horizon_days").agg(F.count("*").alias("n"), share(r > 0.01).alias("base_up"), share(r < -0.01).alias("base_down"), share(r > 0).alias("base_up_any"), rounded(F.avg("ret"), 6).alias("avg_return"))


def inversion(rows: DataFrame) -> DataFrame:
    flipped = F.when(F.col("bias") == "bullish", F.col("ret") < -0.01).otherwise(F.col("ret") > 0.01)
    return rows.filter("ret is not null").groupBy("bias", "horizon_days").agg(share(flipped).alias("inverted_accuracy"))


def conditions() -> dict[str, Column]:
    c = {n: F.col(n) for n in ("rsi_14", "close", "bb_lower", "bb_upper", "sma_200", "macd", "macd_signal")}
    return {
        "rsi_oversold": c["rsi_14"] < 30, "rsi_overbought": c["rsi_14"] > 70, "below_bb_lower": exceeds(c["bb_lower"], c["close"]), "above_bb_upper": exceeds(c["close"], c["bb_upper"]),
        "above_sma200": exceeds(c["close"], c["sma_200"]), "below_sma200": exceeds(c["sma_200"], c["close"]), "macd_above_signal": exceeds(c["macd"], c["macd_signal"]),
        "deep_below_sma200": c["close"] < c["sma_200"] * 0.85, "far_above_sma200": c["close"] > c["sma_200"] * 1.15,
    }


def condition_hits(resolved: DataFrame, signals: DataFrame, days: int = 10) -> DataFrame:
    """What followed each indicator condition by itself."""
    s = signals.select("ticker", F.col("date").alias("signal_date"), *[hit.alias(n) for n, hit in conditions().items()])
    df = resolved.select("ticker", "signal_date", F.col(f"return_{days}d").alias("ret")).filter("ret is not null").join(s, ["ticker", "signal_date"])
    cells = F.array(*[F.struct(F.lit(n).alias("condition"), F.col(n).alias("hit")) for n in conditions()])
    return df.select("ret", F.inline(cells)).filter("hit").groupBy("condition").agg(F.count("*").alias("n"), share(F.col("ret") > 0).alias("frac_up_10d"), rounded(F.avg("ret"), 6).alias("avg_ret_10d"))


def confidence_deciles(resolved: DataFrame, days: int = 10) -> DataFrame:
    df = resolved.withColumn("ret", F.col(f"return_{days}d")).filter("ret is not null").withColumn("conf_decile", F.expr("width_bucket(confidence, 0.0D, 1.0D, 10)"))
    return df.groupBy("bias", "conf_decile").agg(F.count("*").alias("n"), share(F.col("ret") > 0).alias("frac_up_10d"), rounded(F.avg("ret"), 6).alias("avg_ret_10d"))


def episode_inflation(preds: DataFrame, gap_days: int = 7) -> DataFrame:
    """Rows against runs without a gap of more than ``gap_days``."""
    before = F.lag("signal_date").over(Window.partitionBy("ticker", "bias").orderBy("signal_date"))
    new = before.isNull() | (F.datediff("signal_date", before) > gap_days)
    df = preds.select("bias", new.cast("int").alias("_new"))
    return df.groupBy("bias").agg(F.count("*").alias("raw_rows"), F.sum("_new").alias("episodes"))


def price_buckets(outcomes: DataFrame, horizon: int = 42) -> DataFrame:
    p = F.col("price_at_signal")
    bucket = F.when(p < 5, "a_under_5").when(p < 20, "b_5_to_20").when(p < 100, "c_20_to_100").otherwise("d_100_up")
    df = outcomes.filter((F.col("horizon_days") == horizon) & F.col("excess_return").isNotNull())
    found = quantiles(checkpointed(df.select(bucket.alias("price_bucket"), "excess_return")), ["price_bucket"], "excess_return", [0.5])
    return found.select("price_bucket", "n", rounded(F.col("q")[0], 6).alias("median_excess"))


def threshold_grid(resolved: DataFrame, days: int = 10, cfg: Config = DEFAULT) -> DataFrame:
    """Accuracy of those at or above each threshold by bias, where there are ``min_sample`` of them."""
    df = resolved.select("bias", F.abs("composite_vix_adj").alias("_s"), F.col(f"correct_{days}d").alias("hit")).filter("hit is not null and _s is not null")
    df = df.select("bias", "_s", "hit", F.explode(F.array(*[F.lit(t) for t in GRID["signal_threshold"]])).alias("threshold")).filter(F.col("_s") >= F.col("threshold"))
    out = df.groupBy("bias", "threshold").agg(F.count("*").alias("n"), share(F.col("hit")).alias("accuracy"))
    return out.filter(F.col("n") >= cfg.min_sample)


def proposals(resolved: DataFrame, bias: str = "bullish", days: int = 10, least: float = 0.03, cfg: Config = DEFAULT) -> DataFrame:
    """(param_name, current_value, proposed_value, accuracy_delta, sample_size, vix_regime_scope): what gains ``least`` in accuracy.

    The threshold against all predictions of ``bias``; each regime's multiplier against those of ``bias`` in the regime, with candidates
    judged on all of its predictions. Among equal candidates the first of the grid; each side needs ``min_sample``.
    """
    hit = F.col(f"correct_{days}d")
    rows = resolved.filter(hit.isNotNull()).select("bias", "vix_regime", F.abs("composite_vix_adj").alias("_s"), hit.cast("int").alias("_hit"))
    own = rows.filter(F.col("bias") == bias)
    enough = lambda df: df.filter(F.col("n") >= cfg.min_sample)
    rate = [F.count("*").alias("n"), F.avg("_hit").alias("accuracy")]
    best = F.max_by(F.struct("candidate", "accuracy", "n"), F.struct("accuracy", -F.col("candidate"))).alias("_best")

    others = F.array(*[F.lit(t) for t in GRID["signal_threshold"] if t != cfg.signal_threshold])
    kept = own.select("_s", "_hit", F.explode(others).alias("candidate")).filter(F.col("_s") >= F.col("candidate"))
    found = enough(kept.groupBy("candidate").agg(*rate)).agg(best)
    base = enough(own.agg(*rate)).select(F.col("accuracy").alias("_base"))
    threshold = found.crossJoin(F.broadcast(base)).select(F.lit("signal_threshold").alias("param_name"), F.lit(cfg.signal_threshold).alias("current_value"), "_best", "_base", F.col("_best.n").alias("sample_size"), F.lit(None).cast("string").alias("vix_regime_scope"))  # one row each

    cells = [F.struct(F.lit(name).alias("param_name"), F.lit(regime).alias("vix_regime"), F.lit(now).alias("current_value"), F.lit(c).alias("candidate")) for name, (regime, now, cs) in ((k, v) for k, v in GRID.items() if k.startswith("vix_")) for c in cs if c != now]
    grid = resolved.sparkSession.range(1).select(F.inline(F.array(*cells)))  # a dozen rows
    moved = rows.join(F.broadcast(grid), "vix_regime").filter(F.col("_s") * (F.col("candidate") / F.col("current_value")) >= cfg.signal_threshold)
    found = enough(moved.groupBy("param_name", "vix_regime", "current_value", "candidate").agg(*rate)).groupBy("param_name", "vix_regime", "current_value").agg(best)
    base = enough(own.groupBy("vix_regime").agg(*rate)).select("vix_regime", F.col("accuracy").alias("_base"))
    whole = enough(rows.groupBy("vix_regime").agg(F.count("*").alias("n"))).select("vix_regime", F.col("n").alias("sample_size"))
    regimes = found.join(base, "vix_regime").join(whole, "vix_regime").select("param_name", "current_value", "_best", "_base", "sample_size", F.col("vix_regime").alias("vix_regime_scope"))

    out = threshold.unionByName(regimes).withColumn("accuracy_delta", F.col("_best.accuracy") - F.col("_base"))
    out = out.filter(F.col("accuracy_delta") >= least)
    return out.select("param_name", "current_value", F.col("_best.candidate").alias("proposed_value"), rounded(F.col("accuracy_delta"), 4).alias("accuracy_delta"), "sample_size", "vix_regime_scope")


def numbered(found: DataFrame, last: int) -> DataFrame:
    """Proposals with ids after ``last`` and a sentence on each."""
    said = F.format_string("%s from %s to %s: accuracy %+.1f points on %d predictions.", "param_name", F.col("current_value").cast("string"), F.col("proposed_value").cast("string"), F.col("accuracy_delta") * 100, "sample_size")
    at = F.row_number().over(Window.orderBy("param_name", "vix_regime_scope"))  # four rows at most
    return found.withColumns({"id": (at + last).cast("long"), "rationale": said})


def review_prompt(accuracy: Sequence[Row], pending: Sequence[Row], when: dt.date) -> str:
    """The weekly review's message, of the accuracy table and the proposals that wait."""
    percent = lambda v, form="+.2%": "" if v is None else format(v, form)
    lines = [f"Parameter health, {when}", ""]
    for r in accuracy:
        told = f"{r['signal_version']} {r['vix_regime']} {r['bias']} {r['horizon_days']}d: {r['correct_signals']} of {r['total_signals']} right ({percent(r['accuracy_rate'], '.1%')})"
        lines.append(told + (f", mean return {percent(r['avg_return'])}" if r["avg_return"] is not None else ""))
    lines += [] if accuracy else ["No accuracy yet."]
    lines.append("")
    for p in pending:
        scope = "".join(f" [{k} {p[c]}]" for k, c in (("regime", "vix_regime_scope"), ("volatility", "vol_env_scope")) if p[c])
        lines.append(f"#{p['id']} {p['param_name']}: {p['current_value']} to {p['proposed_value']}, {percent(p['accuracy_delta'], '+.1%')}{scope}, {p['sample_size']} predictions. {p['rationale'] or ''}".rstrip())
    lines += [] if pending else ["No proposal waits."]
    return "\n".join([*lines, "", "Approve or reject each proposal, with a reason."])


def vix_grid(resolved: DataFrame, days: int = 10, cfg: Config = DEFAULT) -> DataFrame:
    """Accuracy by regime if its multiplier were another: scores are rescaled and the threshold applied again."""
    cells = [F.struct(F.lit(name).alias("param"), F.lit(regime).alias("vix_regime"), F.lit(c).alias("candidate"), F.lit(c / now).alias("scale")) for name, (regime, now, cs) in ((k, v) for k, v in GRID.items() if k.startswith("vix_")) for c in cs]
    grid = resolved.sparkSession.range(1).select(F.inline(F.array(*cells)))  # a dozen rows
    df = resolved.select("vix_regime", F.abs("composite_vix_adj").alias("_s"), F.col(f"correct_{days}d").alias("hit")).filter("hit is not null and _s is not null")
    df = df.join(F.broadcast(grid), "vix_regime").filter(F.col("_s") * F.col("scale") >= cfg.signal_threshold)
    return df.groupBy("param", "vix_regime", "candidate").agg(F.count("*").alias("n"), share(F.col("hit")).alias("accuracy")).filter(F.col("n") >= cfg.min_sample)


def weight_combos(tolerance: float = 0.001) -> list[tuple[float, float, float, float]]:
    return [c for c in product(*GRID["weights"]) if abs(sum(c) - 1.0) <= tolerance]


def weight_grid(signals: DataFrame, resolved: DataFrame, days: int = 10) -> DataFrame:
    """For each combination of weights: how far the scores of right and wrong predictions stand apart."""
    combos = weight_combos()
    cells = F.array(*[F.struct(*[F.lit(w).alias(f"w{i}") for i, w in enumerate(c)]) for c in combos])
    df = resolved.select("ticker", "signal_date", F.col(f"correct_{days}d").alias("hit")).filter("hit is not null").join(signals.withColumnRenamed("date", "signal_date"), ["ticker", "signal_date"])
    df = df.select("hit", "close", "sma_50", "sma_200", "macd", "macd_signal", "rsi_14", F.inline(cells))
    df = df.withColumn("score", F.abs(weighted(score_parts(), [F.col(f"w{i}") for i in range(4)])))
    out = df.groupBy("w0", "w1", "w2", "w3").agg(F.count("*").alias("n"), (F.avg(F.when(F.col("hit"), F.col("score"))) - F.avg(F.when(~F.col("hit"), F.col("score")))).alias("_gap"))
    return out.select("w0", "w1", "w2", "w3", "n", rounded(F.col("_gap"), 4).alias("separation"))


def parity(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Column by column: rows on one side only, the largest difference, and how many exceed the tolerance."""
    x, y = a.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(1).alias("_ina")), b.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(1).alias("_inb"))
    both = x.join(y, keys, "full")
    d = {c: F.abs(F.col(f"_a_{c}") - F.col(f"_b_{c}")) for c in columns}
    torn = {c: F.col(f"_a_{c}").isNull() != F.col(f"_b_{c}").isNull() for c in columns}
    alone = F.col("_ina").isNull() | F.col("_inb").isNull()
    one = both.agg(F.count(F.when(alone, 1)).alias("_alone"), *[F.max(d[c]).alias(f"m_{c}") for c in columns], *[F.count(F.when((d[c] > tolerance) | torn[c], 1)).alias(f"n_{c}") for c in columns])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col("_alone").alias("unmatched"), F.col(f"m_{c}").alias("max_diff"), F.col(f"n_{c}").alias("n_diff")) for c in columns])))
