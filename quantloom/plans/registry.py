"""The registered queries: operators over the derived market tables, doubles rounded to compare."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.expr import rounded
from ..functions.shared import checkpoint_folder, checkpointed
from ..operators import analysis, asof, averages, events, features, indicators, ingest, outcomes, ranking, relatedness, research, tables, universe
from ..sources import market
from ..streaming import maturity
from .oracle import ORACLE_SQL

LOOSE = replace(DEFAULT, min_abs_r=0.05)  # the derived prices are nearly independent
FEATURES = ["dist_sma50", "dist_sma200", "dist_sma200_z", "rsi_centered", "bb_pctb", "macd_hist_norm", "dist_52w_high", "dist_52w_low", "vol_ratio", "ret_21d", "ret_63d", "adx_14", "sma200_slope"]


class Market:
    """The derived tables of one folder, each built when first asked for. What several tables are made of is kept in the shared
    folder (``kept`` in the name of a step below); the rest is lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir, self._made = spark, sf_dir, {}

    def _once(self, name: str, make: Callable[[], DataFrame], keep: bool = False) -> DataFrame:
        if name not in self._made:
            self._made[name] = checkpointed(make()) if keep else make()
        return self._made[name]

    bars = property(lambda s: s._once("bars", lambda: market.bars(s.spark, s.dir)))
    kept_bars = property(lambda s: s._once("kept_bars", lambda: s.bars, keep=True))
    bench = property(lambda s: s._once("bench", lambda: market.benchmark(s.spark, s.dir)))
    etf = property(lambda s: s._once("etf", lambda: market.etf(s.spark, s.dir).unionByName(s.bench)))
    context = property(lambda s: s._once("context", lambda: indicators.vix_context(market.index_vol(s.spark, s.dir))))
    signals = property(lambda s: s._once("signals", lambda: indicators.signals(indicators.indicators(s.bars), s.context)))
    kept_signals = property(lambda s: s._once("kept_signals", lambda: indicators.signals(indicators.indicators(s.kept_bars), s.context), keep=True))
    features = property(lambda s: s._once("features", lambda: features.features(s.signals)))
    kept_features = property(lambda s: s._once("kept_features", lambda: features.features(s.kept_signals), keep=True))
    returns = property(lambda s: s._once("returns", lambda: s._masked(s.bars)))
    betas = property(lambda s: s._once("betas", lambda: relatedness.betas(s.returns, s._masked(s.etf), 90)))
    market_beta = property(lambda s: s._once("market_beta", lambda: s.betas.filter(F.col("etf_proxy") == DEFAULT.benchmark).select("ticker", "beta"), keep=True))
    analysed = property(lambda s: s._once("analysed", lambda: analysis.analyse(s.signals)))
    preds = property(lambda s: s._once("preds", lambda: outcomes.predictions(analysis.analyse(s.kept_signals)), keep=True))
    ahead = property(lambda s: s._once("ahead", lambda: outcomes.forward(s.kept_bars)))
    resolved = property(lambda s: s._once("resolved", lambda: outcomes.resolve_v1(s.preds, s.ahead), keep=True))
    outcomes = property(lambda s: s._once("outcomes", lambda: outcomes.outcomes_v2(s.preds, s.ahead, s.bench, s.market_beta)))
    crossed = property(lambda s: s._once("crossed", lambda: events.crossings(events.priced(s.kept_features)), keep=True))
    kept = property(lambda s: s._once("kept", lambda: events.dedup(events.fires(s.crossed))))
    excess = property(lambda s: s._once("excess", lambda: events.forward_excess(events.priced(s.kept_bars), s.bench, s.market_beta), keep=True))
    graded = property(lambda s: s._once("graded", lambda: s._robust(events.splits(s.kept, s.crossed, s.excess), ["event", "horizon", "split", "value"]), keep=True))
    framed = property(lambda s: s._once("framed", lambda: ranking.frame(s.kept_features, s.excess), keep=True))
    ranked = property(lambda s: s._once("ranked", lambda: ranking.deciles(ranking.scored(s.framed, ranking.COEFFICIENTS)).withColumn("fold", F.year("date")), keep=True))
    walked = property(lambda s: s._once("walked", lambda: ranking.deciles(ranking.walked(s.framed, ranking.fit(s.framed, s.years))), keep=True))
    base = property(lambda s: s._once("base", lambda: s._robust(events.base_rows(s.crossed, s.excess), ["horizon", "slope"]), keep=True))

    @property
    def years(self) -> list[int]:
        return sorted(r[0] for r in self.framed.select(F.year("date")).distinct().collect())  # calendar years: a handful

    @property
    def confluent(self) -> DataFrame:
        """Buckets of bullish events on all dates, and on those with the long average rising."""
        rows = events.confluence(self.crossed, self.kept).join(events.base_rows(self.crossed.select("ticker", "date", "sma200_slope"), self.excess, by_date=True), ["ticker", "date"])
        return self._robust(rows.filter("slope <> 'flat_down'"), ["n_bull", "horizon", "slope"])

    @staticmethod
    def _robust(rows: DataFrame, keys: list[str]) -> DataFrame:
        return events.robust(checkpointed(rows), keys)  # read twice

    @staticmethod
    def _masked(bars: DataFrame) -> DataFrame:
        return relatedness.calendar_returns(bars).withColumn("r", relatedness.masked(F.col("r")))

    @property
    def symbols(self) -> DataFrame:
        """A listing, by rule from the parts: codes with and without the marks that curation looks for."""
        code = "case p_size % 8 when 0 then 'T' when 1 then 'W' when 2 then 'R' when 3 then 'U' when 4 then '-WT' when 5 then '.WS' when 6 then '-UN' else '' end"
        return market.load(self.spark, self.dir, "part").selectExpr(
            f"concat(char(65 + p_partkey % 26), char(65 + (p_partkey div 26) % 26), 'ZZ', {code}) as code",
            "case when p_partkey % 5 = 0 then 'ETF' else 'Common Stock' end as type",
            "case when p_partkey % 7 = 0 then 'CAD' else 'USD' end as currency",
            "case when p_partkey % 3 = 0 then 'NYSE' when p_partkey % 3 = 1 then 'NASDAQ' else 'OTC' end as venue",
            "concat(p_name, case when p_partkey % 11 = 0 then ' Warrant' when p_partkey % 11 = 1 then ' acquisition corp' else '' end) as name",
            "p_partkey % 2 = 0 as listed",
        )

    @property
    def provided(self) -> DataFrame:
        """Bars as a provider gives them, by rule from the daily ones: some adjusted, some without a trade, some of another exchange."""
        return self.bars.selectExpr(
            "concat(ticker, case when day(date) % 7 = 0 then '.TO' when day(date) % 11 = 0 then '.INDX' else '' end) as ticker", "date", "open", "high", "low",
            "case when day(date) = 31 then 0D else close end as close", "case when day(date) = 30 then 0D when month(date) < 7 then close / 2 else close end as adjusted_close", "case when day(date) = 29 then null else volume end as volume",
        )

    @property
    def companies(self) -> DataFrame:
        """Company data by rule from the suppliers."""
        return market.load(self.spark, self.dir, "supplier").selectExpr(
            "concat('S', s_suppkey) as ticker", "s_name as name", "cast(round(s_acctbal * 100) as bigint) as market_cap", "case when s_suppkey % 7 = 0 then null else timestamp_seconds(1704067200 + s_suppkey % 15 * 86400 + s_suppkey % 24 * 3600) end as updated_at"
        )


def show(df: DataFrame, exact: str, r4: str = "", r6: str = "") -> DataFrame:
    cells = [F.col(c) for c in exact.split()] + [rounded(F.col(c), n).alias(c) for names, n in ((r4, 4), (r6, 6)) for c in names.split()]
    return df.select(*cells)


def _long(m: Market) -> DataFrame:
    return outcomes.long_v1(m.resolved)


def _missing(m: Market) -> DataFrame:
    last = m.bars.agg(F.max("date").alias("_last"))  # one row
    today = m.bars.join(F.broadcast(last), F.col("date") == F.col("_last"))
    return ingest.missing(market.load(m.spark, m.dir, "part").select(F.col("p_brand").alias("ticker")), today)


def _ingested(m: Market) -> DataFrame:
    df = ingest.adjusted(m.provided)
    df = df.withColumns({"symbol": ingest.provider_symbol(F.col("ticker")), "is_index": ingest.is_index(F.col("ticker"))})
    return show(df, "ticker date volume currency symbol is_index", "close", "open high low")


def _companies(m: Market) -> DataFrame:
    new = m.companies.filter("market_cap > 0").selectExpr("ticker", "market_cap + 1 as market_cap", "timestamp'2024-02-01' as updated_at")
    out = tables.upserted(m.companies.filter("updated_at is not null"), new, ["ticker"])  # names stay as they are
    return out.withColumn("updated_at", F.unix_seconds("updated_at"))


def _parity(m: Market) -> DataFrame:
    """Indicators worked out together against each by itself."""
    each = indicators.with_bollinger(indicators.with_rsi(indicators.with_macd(indicators.with_sma(m.kept_bars))))
    names = ["sma_50", "sma_200", "macd", "macd_signal", "macd_hist", "rsi_14", "bb_upper", "bb_lower"]
    out = research.parity(indicators.indicators(m.kept_bars), each, ["ticker", "date"], names)
    return out.select("column", "unmatched", "n_diff", (F.col("max_diff") <= 1e-9).alias("within"))


def _counts(m: Market) -> DataFrame:
    entries = m.symbols.selectExpr("code as ticker", "case when venue = 'OTC' then 'tsx_venture' when currency = 'CAD' then 'tsx' else 'us' end as exchange", "type <> 'ETF' as has_data", "case when listed then array(venue) end as categories")
    out = universe.migrated(entries)
    return universe.counts(out).crossJoin(out.agg(F.sum(F.size("signal_categories")).alias("categories")))  # with one row


def _levels(m: Market) -> DataFrame:
    return analysis.key_levels(m.analysed).select("ticker", "date", F.inline("key_levels"))


def _upsert(m: Market, mode: str) -> DataFrame:
    target = m.bars.select("ticker", "date", "close").filter("date < '1999-01-01'")
    source = m.bars.select("ticker", "date", (F.col("close") * 2).alias("close")).filter("date >= '1998-01-01'" if mode == "update" else "true")
    out = tables.upserted(target, source, ["ticker", "date"]) if mode == "update" else tables.inserted(target, source, ["ticker", "date"])
    return show(out, "ticker date", "close")


def _replace(m: Market) -> DataFrame:
    own = m.betas.select("ticker", "etf_proxy", "window_days", "beta")
    both = own.unionByName(own.withColumn("window_days", F.lit(365)))
    return tables.replaced(both, own.withColumn("beta", -F.col("beta")), "window_days", [90])


def _landed(m: Market) -> DataFrame:
    """Three versions of every bar that arrived one after another, the second before and the third after what is stored of odd days."""
    stored = m.bars.select("ticker", "date", "close", "volume", F.expr("10 + day(date) % 2 * 10").alias("fetched_at"))
    version = lambda n, at: m.bars.select("ticker", "date", (F.col("close") + n).alias("close"), at.alias("fetched_at"))
    new = version(3.0, F.lit(5)).unionByName(version(2.0, F.lit(15))).unionByName(version(1.0, F.expr("case when month(date) = 6 then 25 else 12 end")))
    return show(tables.upserted(stored.filter("year(date) < 1998"), new, ["ticker", "date"], latest="fetched_at"), "ticker date volume fetched_at", "close")


def _split(m: Market) -> tuple[DataFrame, DataFrame]:
    """Splits by rule from the brands: two for one on a day of 1996; and what the provider then gives of all bars."""
    last = F.expr("cast(substring(ticker, -1) as int)")
    splits = m.bars.select("ticker").distinct().filter(last % 2 == 1).select("ticker", F.expr("date_add(date'1996-03-01', 10 * cast(substring(ticker, -1) as int))").alias("date"), F.lit(2.0).alias("factor"))
    return splits, ingest.rebased(m.bars, splits)


def _stepped(m: Market) -> DataFrame:
    """Indicators of the bars since July 1998, stepped on from the states before."""
    old = F.col("date") < F.lit("1998-07-01").cast("date")
    before = checkpointed(averages.states(averages.stepped(m.kept_bars.filter(old), outputs=False)))
    return show(averages.indicators(averages.stepped(m.kept_bars, before)), "ticker date", "macd macd_signal macd_hist rsi_14 adx_14")


def _matured(m: Market) -> DataFrame:
    """Outcomes by a stream over the bars and predictions of one time after another, three years a batch."""
    folder = f"{checkpoint_folder(m.spark)}/matured-{uuid4().hex}"
    rows = checkpointed(maturity.rows_of(m.kept_bars, m.preds).withColumn("_span", F.floor(F.year("date") / 3)))
    for span in [r[0] for r in rows.select("_span").distinct().orderBy("_span").collect()]:  # a handful
        rows.filter(F.col("_span") == span).drop("_span").write.mode("append").parquet(f"{folder}/landed")
        maturity.take(m.spark, f"{folder}/landed", f"{folder}/state", lambda new, batch: new.write.mode("overwrite").parquet(f"{folder}/out/batch={batch}"))
    return maturity.resolved(m.spark.read.parquet(f"{folder}/out").drop("batch"), m.bench, m.market_beta)


def _latest(m: Market, strict: bool) -> DataFrame:
    """Each day of a ticker with its latest signal, that day's included or not."""
    signals = m.preds.select("ticker", F.col("signal_date").alias("date"), "bias", "price_at_signal")
    return show(asof.asof(m.kept_bars.select("ticker", "date"), signals, ["ticker"], "date", ["bias", "price_at_signal"], matched="signal_date", strict=strict), "ticker date signal_date bias", "price_at_signal")


def _refreshed(m: Market) -> DataFrame:
    splits, provider = _split(m)
    changed = ingest.acted(splits, splits.limit(0), F.lit("1996-03-01").cast("date"), F.lit("1996-04-15").cast("date"))
    return show(ingest.refreshed(m.bars, provider.join(changed, "ticker", "left_semi")), "ticker date volume", "open high low close")


_BY_NAME: dict[str, Callable[[Market], DataFrame]] = {
    "bars_ohlcv": lambda m: show(m.bars, "ticker date volume", "open high low close"),
    "validate_missing": _missing,
    "sma_50_200": lambda m: show(indicators.with_sma(m.bars), "ticker date", "sma_50 sma_200"),
    "ema_macd": lambda m: show(indicators.with_macd(m.bars), "ticker date", "macd macd_signal macd_hist"),
    "rsi_14": lambda m: show(indicators.with_rsi(m.bars), "ticker date", "rsi_14"),
    "bollinger": lambda m: show(indicators.with_bollinger(m.bars), "ticker date", "bb_upper bb_lower"),
    "vix_context": lambda m: m.context,
    "composite": lambda m: show(m.signals, "ticker date vix_close vvix_close vix_regime vix_trend vol_environment composite_score composite_vix_adj", "sma_50 sma_200 macd macd_signal rsi_14 bb_upper bb_lower"),
    "dist_features": lambda m: show(features.displacement(m.signals), "ticker date", " ".join(f for f in FEATURES if f != "adx_14")),
    "adx_14": lambda m: show(features.with_adx(m.bars), "ticker date", "adx_14"),
    "regime": lambda m: show(m.features, "ticker date ticker_regime trend_direction"),
    "null_rates": lambda m: features.null_rates(m.features, FEATURES),
    "regime_share": lambda m: research.regime_share(m.features),
    "regime_by_year": lambda m: research.regime_by_year(m.features),
    "regime_streaks": lambda m: research.regime_streaks(m.features),
    "falling_knife": lambda m: research.falling_knife(m.kept_features, m.outcomes, -0.05),
    "outcome_base_rates": lambda m: research.outcome_base_rates(m.outcomes),
    "threshold_sensitivity": lambda m: research.threshold_sensitivity(m.features),
    "dist_bucket": lambda m: research.dist_buckets(m.kept_features, m.outcomes),
    "price_buckets": lambda m: research.price_buckets(m.outcomes),
    "three_way": lambda m: research.three_way(_long(m)),
    "base_rates": lambda m: research.base_rates(_long(m)),
    "inversion": lambda m: research.inversion(_long(m)),
    "condition_hits": lambda m: research.condition_hits(m.resolved, m.kept_signals),
    "conf_deciles": lambda m: research.confidence_deciles(m.resolved),
    "episode_inflation": lambda m: research.episode_inflation(m.preds),
    "returns_masked": lambda m: show(m.returns, "ticker date", r6="r"),
    "eligible_median": lambda m: show(relatedness.eligible(m.bars), "ticker", "median_close"),
    "corr_pairs_90": lambda m: relatedness.correlation_pairs(m.returns, 90, LOOSE),
    "corr_pairs_365": lambda m: relatedness.correlation_pairs(m.returns, 365, LOOSE),
    "corr_blocks_365": lambda m: relatedness.correlation_blocks(m.returns, 365, LOOSE, block=10),
    "peers": lambda m: relatedness.peers(relatedness.correlation_pairs(m.returns, 365, LOOSE), least=LOOSE.min_abs_r).withColumn("rank", F.col("rank").cast("long")),
    "beta_90": lambda m: m.betas,
    "signal_trend": lambda m: show(m.analysed, "ticker date composite_vix_adj signal_trend"),
    "bias_confidence": lambda m: show(m.analysed, "ticker date bias confidence"),
    "key_levels": _levels,
    "reasoning_text": lambda m: show(m.analysed, "ticker date reasoning"),
    "top_brief": lambda m: show(analysis.top_brief(analysis.selected(m.analysed)), "ticker date bias confidence reasoning"),
    "predictions": lambda m: m.preds.withColumn("price_at_signal", rounded(F.col("price_at_signal"), 4)),
    "resolve_v1": lambda m: show(m.resolved, "ticker signal_date bias correct_5d correct_10d correct_20d", r6="return_5d return_10d return_20d"),
    "accuracy_rollup": lambda m: outcomes.accuracy_rollup(m.resolved),
    "vol_threshold": lambda m: show(m.ahead.withColumn("threshold_21", DEFAULT.threshold_k * F.col("vol_at_signal") * F.sqrt(F.lit(21.0))), "ticker date", r6="vol_at_signal threshold_21"),
    "outcomes_v2": lambda m: show(m.outcomes, "ticker signal_date bias horizon_days direction_correct threshold_correct", r6="raw_return benchmark_return beta_used excess_return threshold_used"),
    "outcomes_matured": lambda m: show(_matured(m), "ticker signal_date bias horizon_days direction_correct threshold_correct", r6="raw_return benchmark_return beta_used excess_return threshold_used"),
    "latest_signal": lambda m: _latest(m, strict=False),
    "latest_signal_before": lambda m: _latest(m, strict=True),
    "episodes": lambda m: outcomes.episodes(m.preds),
    "unresolved_anti": lambda m: show(outcomes.unresolved(m.preds, m.outcomes), "ticker signal_date signal_version bias"),
    "events_cross": lambda m: show(events.fires(m.crossed), "ticker date event"),
    "event_dedup": lambda m: show(m.kept.withColumn("position", F.col("position").cast("long")), "ticker event position date"),
    "event_forward_excess": lambda m: show(m.excess, "ticker date", r6="excess_21 excess_42 excess_63"),
    "event_stats": lambda m: m.graded.filter("split = 'all'").drop("split", "value"),
    "event_splits": lambda m: m.graded,
    "event_summary": lambda m: events.summary(m.graded, m.base),
    "event_verdict": lambda m: events.verdict(m.graded, m.base),
    "base_stats": lambda m: m.base,
    "confluence": lambda m: m.confluent,
    "confluence_monotonic": lambda m: events.monotonic(m.confluent),
    "equivalence_gate": lambda m: events.equivalence(events.priced(m.kept_bars), m.bench, m.market_beta, m.excess),
    "rank_spread": lambda m: ranking.spreads(m.ranked),
    "rank_picks": lambda m: ranking.picks(m.ranked, 5).select("ticker", "date", "pick", "decile", rounded(F.col("score"), 6).alias("score")),
    "rank_confidence": lambda m: ranking.calibration(m.ranked),
    "rank_walk_forward": lambda m: ranking.spreads(m.walked),
    "rank_walk_confidence": lambda m: ranking.calibration(m.walked),
    "proposals": lambda m: research.proposals(m.resolved, least=0.0),
    "outcome_seeds": lambda m: show(outcomes.seeds(m.preds, m.ahead), "ticker signal_date horizon_days", r6="price_at_signal vol_at_signal threshold_used"),
    "beta_fallbacks": lambda m: relatedness.fallbacks(m.kept_bars.unionByName(m.kept_bars.filter("day(date) = 1").withColumn("ticker", F.concat("ticker", F.lit("x")))), m.market_beta),
    "indicator_parity": _parity,
    "ingest_adjusted": _ingested,
    "metadata_stale": lambda m: ingest.stale(m.companies, F.lit("2024-01-14 12:00:00").cast("timestamp")).select("ticker", "name", F.unix_seconds("updated_at").alias("updated_at")),
    "metadata_due": lambda m: ingest.due(m.companies, m.companies.filter("market_cap > 0"), F.lit("2024-01-14 12:00:00").cast("timestamp")),
    "metadata_upsert": _companies,
    "universe_counts": _counts,
    "threshold_grid": lambda m: research.threshold_grid(m.resolved),
    "vix_grid": lambda m: research.vix_grid(m.resolved),
    "weight_grid": lambda m: research.weight_grid(m.kept_signals, m.resolved),
    "universe_audit": lambda m: universe.audit(m.symbols.select(F.col("code").alias("ticker"), F.lit("us").alias("exchange"))),
    "listing_filter": lambda m: universe.quality_listing(m.symbols, "US", m.symbols.filter("listed")).select("code", "name", "venue"),
    "upsert_update": lambda m: _upsert(m, "update"),
    "upsert_latest": _landed,
    "averages_stepped": _stepped,
    "refreshed_history": _refreshed,
    "shifted_tickers": lambda m: ingest.shifted(m.bars, _split(m)[1]),
    "upsert_ignore": lambda m: _upsert(m, "ignore"),
    "replace_window": _replace,
}


def _query(build: Callable[[Market], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Market(spark, sf_dir))


QUERIES = {name: _query(build) for name, build in _BY_NAME.items()}
__all__ = ["ORACLE_SQL", "QUERIES", "Market"]
