"""Registered market queries against their SQL."""

import os

import pytest

import __spark_entry__ as entry
from oracle import same

NAMES = ["composite", "adx_14", "regime", "key_levels", "reasoning_text", "top_brief", "accuracy_rollup", "outcomes_v2", "latest_signal", "latest_signal_before", "outcome_seeds", "outcomes_matured", "episodes", "event_dedup", "event_splits", "event_verdict", "confluence_monotonic", "equivalence_gate", "proposals", "weight_grid", "ingest_adjusted", "metadata_upsert", "universe_audit", "universe_counts", "listing_filter", "upsert_update", "upsert_latest", "refreshed_history", "metadata_stale", "metadata_due", "validate_missing", "averages_stepped", "peers", "replace_window", "corr_blocks_365"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, small, name):
    same(spark, small, entry.queries()[name], entry.oracle_sql()[name])


@pytest.mark.parametrize("name", ["rank_spread", "rank_picks", "rank_confidence"])
def test_ranks_equal_sql(spark, small, name):
    """On the next larger tables: the small ones have no history as long as the inputs need."""
    larger = os.path.join(os.path.dirname(small), "sf0.01")
    if not os.path.isdir(larger):
        pytest.skip("no larger tables")
    assert same(spark, larger, entry.queries()[name], entry.oracle_sql()[name]) > 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
