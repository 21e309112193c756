"""The nightly run as one function: stages in their order, tables written where they belong.

A backfill works from the whole history. A night steps on from the averages' stored states and reads the tail that windows need, and
unresolved predictions; what several tables are made of is computed once and kept in the shared folder. Relatedness and the review of parameters are Sunday's work; betas
come before outcomes, which use them.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.shared import checkpointed
from ..operators import analysis, averages, features, indicators, ingest, outcomes, relatedness, research, tables
from ..schemas import YEARS, buckets_of, fit, given, key, part, schema, within

log = logging.getLogger(__name__)
TREND_ROWS = 4  # of the signal's trend, the bar itself included


def _merge(spark: SparkSession, root: str, table: str, rows: DataFrame, ignore: bool = False, keep: tuple[str, ...] = (), latest: str | None = None) -> None:
    tables.merge(spark, f"{root}/{table}", schema(table), given(rows, table), key(table), part(table), ignore, keep, latest)


def _stored(spark: SparkSession, root: str, table: str, since: dt.date | None = None, until: dt.date | None = None, buckets: list[str] | None = None) -> DataFrame:
    """A table, or what lies between two dates and in some groups of tickers: of partitions by year and group only those are read."""
    dated = YEARS.get(table)
    near = lambda year: (since is None or year >= since.year) and (until is None or year <= until.year)
    df = tables.read(spark, f"{root}/{table}", schema(table), within(near, buckets) if dated else None)
    for bound, test in ((since, "__ge__"), (until, "__le__")):
        df = df if bound is None else df.filter(getattr(F.col(dated), test)(F.lit(bound)))
    return df


def prices(spark: SparkSession, root: str, tickers: DataFrame | None = None, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """Stored bars between two dates, of some tickers if they are given: only partitions that can have them are read."""
    df = _stored(spark, root, "raw_prices", since, until, None if tickers is None else buckets_of(tickers))
    return df if tickers is None else df.join(tickers.select("ticker"), "ticker", "left_semi")


def history(bars: DataFrame, on: dt.date | None, cfg: Config = DEFAULT) -> DataFrame:
    """The bars that a date's indicators depend on; all of them for a backfill."""
    if on is None:
        return bars
    return bars.filter((F.col("date") <= F.lit(on)) & (F.col("date") > F.lit(on - dt.timedelta(days=cfg.history_days))))


def _whole(bars: DataFrame, context: DataFrame, cfg: Config) -> DataFrame:
    return features.features(indicators.signals(indicators.indicators(bars, cfg), context, cfg), cfg)


def tonight(spark: SparkSession, root: str, bars: DataFrame, context: DataFrame, on: dt.date, cfg: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Signals and features up to a night, ``_new`` where they are to be written, and the averages' states after it.

    Tickers whose last state and signals are stored step on from them, over all bars since: of their history only the windows' tail is read. The others, new
    ones and those whose state was forgotten, go through the history that their averages can feel.
    """
    near = bars.filter((F.col("date") <= F.lit(on)) & (F.col("date") > F.lit(on - dt.timedelta(days=cfg.tail_days))))
    last = averages.newest(_stored(spark, root, "ewm_state", on - dt.timedelta(days=cfg.tail_days), on), F.lit(on))
    old = _stored(spark, root, "stock_signals", on - dt.timedelta(days=cfg.tail_days), on).select("ticker", "date", *(c for c in averages.OUT if c != "adx_14"), F.lit(True).alias("_has"))
    back = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("date")))
    before = near.join(last.select("ticker", F.col("date").alias("_since"), "n_bars"), "ticker").filter("date <= _since").withColumn("_back", back)
    before = before.join(old, ["ticker", "date"], "left").groupBy("ticker").agg(
        F.max("_since").alias("_since"), F.max("n_bars").alias("_n"), F.count("*").alias("_tail"), F.count(F.when((F.col("_back") < TREND_ROWS) & F.col("_has").isNull(), 1)).alias("_torn")
    )
    ready = checkpointed(before.filter(((F.col("_tail") == F.col("_n")) | (F.col("_tail") >= cfg.tail_rows)) & (F.col("_torn") == 0)).select("ticker", "_since"))
    own = near.join(ready, "ticker")
    done = checkpointed(averages.stepped(own.drop("_since"), last.join(ready, "ticker", "left_semi"), cfg))
    made = averages.indicators(done)
    known = made.unionByName(old.drop("_has").join(made.select("ticker", "date"), ["ticker", "date"], "left_anti").withColumn("adx_14", F.lit(None).cast("double")))
    tail = indicators.with_bollinger(indicators.with_sma(own, cfg), cfg).join(known, ["ticker", "date"], "left")
    found = features.with_regime(features.displacement(indicators.signals(tail, context, cfg), cfg), cfg)
    found, states = found.withColumn("_new", F.col("date") > F.col("_since")).drop("_since"), averages.states(done)
    rest = history(bars, on, cfg).join(ready, "ticker", "left_anti")
    if rest.head(1):
        rest = checkpointed(rest)
        found = found.unionByName(_whole(rest, context, cfg).withColumn("_new", F.col("date") == F.lit(on)))
        states = states.unionByName(averages.states(averages.stepped(rest, None, cfg, outputs=False)))
    return found, states


def forget(spark: SparkSession, root: str, corrected: DataFrame) -> None:
    """Drops the states that bars (ticker, date) which arrived late have made wrong: the next night steps on from the last one before, over all bars since."""
    first = checkpointed(corrected.groupBy("ticker").agg(F.min("date").alias("_from")))
    groups = buckets_of(first)
    kept = _stored(spark, root, "ewm_state", buckets=groups).join(first, "ticker").filter("date < _from").drop("_from")
    tables.replace_rows(spark, f"{root}/ewm_state", schema("ewm_state"), checkpointed(kept), first, ["ticker"], part("ewm_state"), within(buckets=groups))


def run(
    spark: SparkSession, root: str, bars: DataFrame, index: DataFrame, bench: DataFrame, proxies: DataFrame, on: dt.date | None = None, cfg: Config = DEFAULT, write: Callable[[str], str] = lambda prompt: prompt, store: bool = True
) -> None:
    """Computes and writes all tables below ``root``; ``on`` keeps one date (a night), None keeps all (a backfill). ``write`` turns a prompt into a text; without ``store`` the bars are there already."""
    sunday = on is None or on.weekday() == 6
    day = lambda df: df.filter("_new")
    if store:
        _merge(spark, root, "raw_prices", bars if on is None else bars.filter(F.col("date") == F.lit(on)))
    context = indicators.vix_context(index, cfg)
    if on is None:
        found, states = _whole(bars, context, cfg).withColumn("_new", F.lit(True)), averages.states(averages.stepped(bars, None, cfg, outputs=False))
    else:
        found, states = tonight(spark, root, bars, context, on, cfg)
    found = checkpointed(found)
    _merge(spark, root, "ewm_state", checkpointed(states))
    found = found.withColumn("vix_source", F.when(F.col("vix_close").isNotNull(), cfg.vix_source))
    _merge(spark, root, "stock_signals", day(found))
    _merge(spark, root, "signal_features", day(found))
    if sunday:
        relate(spark, root, bars if on is None else bars.filter(F.col("date") <= F.lit(on)), proxies, cfg)
    analysed = checkpointed(day(analysis.key_levels(analysis.analyse(found, cfg), cfg)))
    chosen = analysis.selected(analysed, cfg)
    _merge(spark, root, "analysis", chosen)
    top = analysis.top_brief(chosen, cfg).collect()  # a dozen rows
    if top:
        brief(spark, root, top[0]["date"], "daily", write(analysis.brief_text(top)), len(top))
    _merge(spark, root, "signal_predictions", outcomes.predictions(analysed, cfg=cfg), ignore=True)
    resolve(spark, root, bars, bench, cfg)
    if sunday:
        review(spark, root, on or (top[0]["date"] if top else None), cfg, write)


def relate(spark: SparkSession, root: str, bars: DataFrame, proxies: DataFrame, cfg: Config = DEFAULT) -> None:
    """Correlations and betas of each window. What the windows can't reach is not read."""
    end = bars.agg(F.max("date")).first()[0]
    if end is None:
        return
    near = F.col("date") >= F.lit(end - dt.timedelta(days=max(cfg.windows) + 30))
    returns, market = (relatedness.calendar_returns(df.filter(near)).withColumn("r", relatedness.masked(F.col("r"), cfg)) for df in (bars, proxies))
    good = checkpointed(returns.join(relatedness.eligible(bars, cfg).select("ticker"), "ticker", "left_semi"))
    for days in cfg.windows:
        tables.replace(spark, f"{root}/relatedness_matrix", fit(relatedness.correlation_blocks(good, days, cfg), "relatedness_matrix"), "window_days", [days])
        _merge(spark, root, "sector_beta", checkpointed(relatedness.betas(good, market, days, cfg)))


def resolve(spark: SparkSession, root: str, bars: DataFrame, bench: DataFrame, cfg: Config = DEFAULT, names: DataFrame | None = None) -> None:
    """Outcomes of all predictions that have waited long enough, seeds of those that have not, and the accuracy table; with ``names`` those of these tickers."""
    groups = None if names is None else buckets_of(names)
    own = (lambda df: df) if names is None else (lambda df: df.join(names.select("ticker"), "ticker", "left_semi"))
    held = lambda table, since=None: own(_stored(spark, root, table, since, buckets=groups))
    first = held("prediction_outcomes").filter("resolved_at is null").select("signal_date").unionAll(held("signal_predictions").filter("resolved_at is null").select("signal_date"))
    since = first.agg(F.min("signal_date")).first()[0]
    if since is None:
        return
    ahead = checkpointed(outcomes.forward(own(bars).filter(F.col("date") >= F.lit(since - dt.timedelta(days=4 * cfg.vol_lookback))), cfg))
    open_ = checkpointed(held("signal_predictions", since))
    v1 = outcomes.resolve_v1(open_.filter("resolved_at is null").drop(*[f"{n}_{h}d" for h in cfg.horizons_v1 for n in ("return", "correct")]), ahead, cfg)
    v1 = v1.withColumns({f"actual_price_{h}d": F.col(f"close_{h}") for h in cfg.horizons_v1}).withColumn("resolved_at", F.current_timestamp())
    _merge(spark, root, "signal_predictions", checkpointed(v1))
    _merge(spark, root, "signal_accuracy", outcomes.accuracy_rollup(_stored(spark, root, "signal_predictions").filter("resolved_at is not null"), cfg))
    betas = _stored(spark, root, "sector_beta").filter((F.col("window_days") == max(cfg.windows)) & (F.col("etf_proxy") == cfg.benchmark))
    missed = relatedness.fallbacks(open_, betas).first()
    if missed["fallbacks"]:
        log.warning("%s of %s tickers have no beta to %s: 1.0 is used", missed["fallbacks"], missed["tickers"], cfg.benchmark)
    named = outcomes.episodes(held("signal_predictions"), cfg).drop("bias")
    seeds = outcomes.seeds(open_, ahead, cfg).join(named, ["ticker", "signal_date"], "left")
    _merge(spark, root, "prediction_outcomes", checkpointed(seeds), ignore=True)
    out = outcomes.outcomes_v2(open_, ahead, bench, betas.select("ticker", "beta"), cfg).join(named, ["ticker", "signal_date"], "left")
    done = held("prediction_outcomes", since).filter("resolved_at is not null").select("ticker", "signal_date", "horizon_days")
    fresh = out.join(done, ["ticker", "signal_date", "horizon_days"], "left_anti").withColumn("resolved_at", F.current_timestamp())
    _merge(spark, root, "prediction_outcomes", checkpointed(fresh), keep=("price_at_signal", "episode_id", "is_episode_head"))


def refresh(spark: SparkSession, root: str, history: DataFrame, index: DataFrame, bench: DataFrame, proxies: DataFrame, cfg: Config = DEFAULT) -> int:
    """Replaces all that is stored of the tickers of ``history`` (whole, adjusted, valid) and what follows from it; gives how many there were.

    Prices, signals, features, levels, betas, predictions and outcomes of these tickers become those of a rebuild; partitions
    without them are not touched. Pairs of tickers wait for Sunday, briefs stay as they were sent.
    """
    history = checkpointed(given(history, "raw_prices"))
    names = checkpointed(history.select("ticker").distinct())
    groups = buckets_of(names)
    if not groups:
        return 0

    def put(table: str, rows: DataFrame) -> None:
        tables.replace_rows(spark, f"{root}/{table}", schema(table), given(rows, table), names, ["ticker"], part(table), within(buckets=groups))

    put("raw_prices", history)
    put("ewm_state", checkpointed(averages.states(averages.stepped(history, None, cfg, outputs=False))))
    found = checkpointed(features.features(indicators.signals(indicators.indicators(history, cfg), indicators.vix_context(index, cfg), cfg), cfg))
    found = found.withColumn("vix_source", F.when(F.col("vix_close").isNotNull(), cfg.vix_source))
    put("stock_signals", found)
    put("signal_features", found)
    analysed = checkpointed(analysis.key_levels(analysis.analyse(found, cfg), cfg))
    put("analysis", analysis.selected(analysed, cfg))
    put("signal_predictions", outcomes.predictions(analysed, cfg=cfg))
    put("prediction_outcomes", history.limit(0).select("ticker", F.col("date").alias("signal_date")))
    end = _stored(spark, root, "raw_prices").agg(F.max("date")).first()[0]
    near = end - dt.timedelta(days=max(cfg.windows) + 30)
    recent = _stored(spark, root, "raw_prices", near)
    own = recent.join(names, "ticker", "left_semi")
    returns = relatedness.calendar_returns(own, recent).join(relatedness.eligible(history, cfg).select("ticker"), "ticker", "left_semi")
    market = relatedness.calendar_returns(proxies.filter(F.col("date") >= F.lit(near)))
    returns, market = (df.withColumn("r", relatedness.masked(F.col("r"), cfg)) for df in (returns, market))
    cut = recent.agg(F.max("date").alias("_end"))  # one row
    for days in cfg.windows:
        fresh = relatedness.betas(checkpointed(returns.join(F.broadcast(cut), F.col("date") > F.date_sub("_end", days)).drop("_end")), market, days, cfg)
        tables.replace_rows(spark, f"{root}/sector_beta", schema("sector_beta"), checkpointed(given(fresh, "sector_beta")), names, ["ticker"], part("sector_beta"), str(days).__eq__)
    resolve(spark, root, prices(spark, root, names), bench, cfg, names)
    return names.count()


def night(
    spark: SparkSession, root: str, on: dt.date, tickers: DataFrame, fetched: DataFrame, index: DataFrame, bench: DataFrame, proxies: DataFrame,
    actions: tuple[DataFrame, DataFrame] | None = None, history: Callable[[DataFrame], DataFrame] | None = None, metadata: Callable[[DataFrame], DataFrame] | None = None,
    now: dt.datetime | None = None, cfg: Config = DEFAULT, write: Callable[[str], str] = lambda prompt: prompt, alert: Callable[[str], None] = log.error,
) -> bool:
    """A night from its landed bars (as a provider gives them) to its tables; false on a holiday, when nothing is done.

    The breaker stops it where too many of ``tickers`` are missing. Tickers with a split or dividend (``actions``) of the last two days get their
    whole ``history``, tickers whose company data is a week old their ``metadata``: both are given the tickers as rows and give a provider's rows.
    ``alert`` hears of what stopped the night, which is raised all the same.
    """
    try:
        fetched = checkpointed(fetched.filter(F.col("date") == F.lit(on)))  # of a provider that is asked, once
        if not ingest.check(tickers, fetched, cfg):
            return False
        stamped = lambda df: df if "fetched_at" in df.columns else df.withColumn("fetched_at", F.current_timestamp())
        good = lambda df: given(stamped(ingest.valid(ingest.adjusted(df))), "raw_prices")
        _merge(spark, root, "raw_prices", checkpointed(good(fetched)), latest="fetched_at")
        if actions and history:
            changed = checkpointed(ingest.acted(*actions, F.lit(on - dt.timedelta(days=1)), F.lit(on)).join(tickers.select("ticker").distinct(), "ticker", "left_semi"))
            if changed.head(1):
                n = refresh(spark, root, good(history(changed).filter(F.col("date") <= F.lit(on))), index, bench, proxies, cfg)
                log.info("%s tickers have a new adjustment", n)
        if metadata:
            due = checkpointed(ingest.due(tickers, _stored(spark, root, "ticker_metadata"), F.lit(now or dt.datetime.now(dt.UTC))))
            if due.head(1):
                _merge(spark, root, "ticker_metadata", checkpointed(given(metadata(due), "ticker_metadata")))
        waits = _stored(spark, root, "prediction_outcomes").filter("resolved_at is null").agg(F.min("signal_date")).first()[0] or on
        since = min(on - dt.timedelta(days=cfg.history_days), waits - dt.timedelta(days=4 * cfg.vol_lookback))
        run(spark, root, prices(spark, root, since=since, until=on), index, bench, proxies, on, cfg, write, store=False)
    except Exception as error:
        alert(f"{on}: {error}")
        raise
    return True


def brief(spark: SparkSession, root: str, when: dt.date, kind: str, text: str, n: int) -> None:
    row = spark.createDataFrame([(when, kind, text, n)], "date date, brief_type string, brief_text string, ticker_count int")
    _merge(spark, root, "daily_brief", row.withColumn("created_at", F.current_timestamp()))


def review(spark: SparkSession, root: str, when: dt.date | None, cfg: Config = DEFAULT, write: Callable[[str], str] = lambda prompt: prompt) -> None:
    """Appends new proposals, then writes the review of those pending beside the accuracy table."""
    resolved = _stored(spark, root, "signal_predictions").filter("resolved_at is not null")
    old = _stored(spark, root, "parameter_proposals")
    last = old.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = research.numbered(research.proposals(resolved, cfg=cfg), last).withColumns({"proposed_at": F.current_timestamp(), "status": F.lit("pending")})
    known = old.filter("status = 'pending'").select("param_name", F.col("proposed_value").alias("_v"))
    new = new.join(known, (new["param_name"] == known["param_name"]) & (new["proposed_value"] == known["_v"]), "left_anti")
    _merge(spark, root, "parameter_proposals", checkpointed(new), ignore=True)
    if when is not None:
        pending = _stored(spark, root, "parameter_proposals").filter("status = 'pending'").orderBy(F.desc("proposed_at"), "id").collect()  # a few rows
        accuracy = _stored(spark, root, "signal_accuracy").orderBy("signal_version", "horizon_days", F.desc("accuracy_rate"), "vix_regime", "vol_environment", "bias").collect()  # a row for each combination of labels
        brief(spark, root, when, "parameter_review", write(research.review_prompt(accuracy, pending, when)), len(pending))
