"""The tables: their columns and primary keys."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators import averages

_LEVEL = "array<struct<price:double,type:string,role:string,significance:string,note:string>>"
TABLES = {
    "raw_prices": (("ticker", "date"), "ticker string, date date, open double, high double, low double, close double, volume bigint, currency string, source string, fetched_at timestamp"),
    "ticker_metadata": (("ticker",), "ticker string, name string, sector string, industry string, market_cap bigint, exchange string, provider_sector string, provider_industry string, cap_tier string, updated_at timestamp"),
    "stock_signals": (("ticker", "date"), "ticker string, date date, sma_50 double, sma_200 double, macd double, macd_signal double, macd_hist double, rsi_14 double, bb_upper double, bb_lower double, vix_close double, vvix_close double, vix_source string, vix_regime string, vix_trend string, vol_environment string, composite_score double, composite_vix_adj double"),
    "relatedness_matrix": (("ticker_a", "ticker_b", "window_days"), "ticker_a string, ticker_b string, window_days int, pearson_r double, computed_at timestamp"),
    "sector_beta": (("ticker", "etf_proxy", "window_days"), "ticker string, etf_proxy string, window_days int, beta double, computed_at timestamp"),
    "analysis": (("ticker", "date"), f"ticker string, date date, bias string, confidence double, key_levels {_LEVEL}, reasoning string, model string, prompt_tokens int, created_at timestamp"),
    "daily_brief": (("date", "brief_type"), "date date, brief_type string, brief_text string, ticker_count int, model string, created_at timestamp"),
    "signal_predictions": (("ticker", "signal_date", "signal_version"), "ticker string, signal_date date, signal_version string, bias string, composite_vix_adj double, confidence double, vix_regime string, vix_trend string, vol_environment string, volume_ratio double, earnings_flag boolean, signal_trend string, price_at_signal double, actual_price_5d double, actual_price_10d double, actual_price_20d double, return_5d double, return_10d double, return_20d double, correct_5d boolean, correct_10d boolean, correct_20d boolean, created_at timestamp, resolved_at timestamp"),
    "signal_accuracy": (("signal_version", "vix_regime", "vol_environment", "bias", "horizon_days"), "signal_version string, vix_regime string, vol_environment string, bias string, horizon_days int, total_signals int, correct_signals int, accuracy_rate double, avg_return double, avg_return_correct double, avg_return_wrong double, computed_at timestamp"),
    "parameter_proposals": (("id",), "id bigint, proposed_at timestamp, param_name string, current_value double, proposed_value double, rationale string, accuracy_delta double, sample_size int, vix_regime_scope string, vol_env_scope string, status string, reviewed_at timestamp, review_note string"),
    "prediction_outcomes": (("ticker", "signal_date", "horizon_days"), "ticker string, signal_date date, horizon_days int, price_at_signal double, future_price double, raw_return double, benchmark_return double, beta_used double, excess_return double, vol_at_signal double, threshold_used double, direction_correct boolean, threshold_correct boolean, episode_id string, is_episode_head boolean, resolved_at timestamp"),
    "signal_features": (("ticker", "date"), "ticker string, date date, dist_sma50 double, dist_sma200 double, dist_sma200_z double, rsi_centered double, bb_pctb double, macd_hist_norm double, dist_52w_high double, dist_52w_low double, vol_ratio double, ret_21d double, ret_63d double, adx_14 double, sma200_slope double, ticker_regime string, trend_direction string"),
    "ewm_state": (("ticker", "date"), averages.STATE),
}


# what a table is partitioned by: the year of a date and one of ``BUCKETS`` groups of tickers, or the length of a window; others are in one piece
YEARS = {"raw_prices": "date", "stock_signals": "date", "signal_features": "date", "analysis": "date", "signal_predictions": "signal_date", "prediction_outcomes": "signal_date", "ewm_state": "date"}
WINDOWS = ("relatedness_matrix", "sector_beta")
BUCKETS = 8


def bucket() -> Column:
    """A ticker's group, so that few tickers are few files, and a day's write is several tasks' work."""
    return F.format_string("%02d", F.pmod(F.xxhash64("ticker"), F.lit(BUCKETS)))


def part(table: str) -> Column | None:
    return F.concat_ws("-", F.year(YEARS[table]), bucket()) if table in YEARS else F.col("window_days") if table in WINDOWS else None


def within(years: Callable[[int], bool] | None = None, buckets: Iterable[str] | None = None) -> Callable[[str], bool]:
    """Which partitions of a table by year and bucket can have rows of these years and buckets; rows without a date are in all years."""
    groups = None if buckets is None else set(buckets)

    def wanted(name: str) -> bool:
        year, _, group = name.rpartition("-")
        return (not years or not year or years(int(year))) and (groups is None or group in groups)

    return wanted


def buckets_of(tickers: DataFrame) -> list[str]:
    return [r[0] for r in tickers.select(bucket()).distinct().collect()]


def key(table: str) -> list[str]:
    return list(TABLES[table][0])


def schema(table: str) -> T.StructType:
    return T._parse_datatype_string(TABLES[table][1])


def given(df: DataFrame, table: str) -> DataFrame:
    """Those of the table's columns that are given, in their types; an upsert leaves the others as they are."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema(table) if f.name in df.columns])


def fit(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in their order and types; what is not given is NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(table)])
