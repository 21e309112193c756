"""All constants of the analytics, in one frozen object; overrides come as a mapping (for example a JSON file)."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from typing import Any


@dataclass(frozen=True)
class Config:
    # indicators
    sma_short: int = 50
    sma_long: int = 200
    macd: tuple[int, int, int] = (12, 26, 9)
    rsi_window: int = 14
    bollinger: tuple[int, float] = (20, 2.0)
    weights: tuple[float, float, float, float] = (0.30, 0.25, 0.25, 0.20)  # close>sma200, close>sma50, macd>signal, rsi
    rsi_bands: tuple[tuple[float, float], ...] = ((30.0, 1.0), (40.0, 0.5))
    rsi_overbought: float = 70.0
    vix_bands: tuple[tuple[float, str, float], ...] = ((15.0, "low", 0.85), (20.0, "normal", 1.0), (30.0, "elevated", 1.1), (40.0, "high", 1.2), (999.0, "extreme", 0.7))
    vix_sma: int = 20
    vix_trend: tuple[float, float] = (0.85, 1.20)
    vvix_bands: tuple[tuple[float, str], ...] = ((85.0, "complacent"), (100.0, "clean_fear"), (115.0, "elevated"), (120.0, "chaotic"))
    vvix_top: str = "spike"
    # features
    year: int = 252
    volume_sma: int = 20
    ret_windows: tuple[int, int] = (21, 63)
    adx_window: int = 14
    slope_window: int = 63
    adx_trend_min: float = 25.0
    slope_trend_min: float = 0.02
    # relatedness
    windows: tuple[int, ...] = (90, 365)
    min_abs_r: float = 0.50
    min_overlap: int = 10
    price_floor: float = 1.0
    max_ratio: float = 3.0
    # analysis
    signal_threshold: float = 0.5
    brief_size: int = 12
    trend_delta: float = 0.1
    # outcomes
    horizons_v1: tuple[int, ...] = (5, 10, 20)
    horizons_v2: tuple[int, ...] = (5, 10, 20, 21, 42, 63)
    correct_move: float = 0.01
    vol_lookback: int = 20
    threshold_k: float = 0.5
    beta_shrink: tuple[float, float] = (0.67, 0.33)
    episode_gap: int = 5
    min_sample: int = 30
    # events
    horizons_events: tuple[int, ...] = (21, 42, 63)
    dedup_rows: int = 21
    volume_confirm: float = 1.5
    winsor: tuple[float, float] = (0.01, 0.99)
    # rank model
    rank_horizon: int = 42
    rank_embargo: int = 63
    rank_l2: float = 1.0
    episode_weight: float = 0.25
    # ingest
    max_missing_share: float = 0.20
    days_a_year: int = 252
    benchmark: str = "SPY"
    vix_source: str = "provider"

    @property
    def history_days(self) -> int:
        """Calendar days after which a bar no longer shows in any feature of today: the slowest average twice over (ADX averages an average) on top of the longest window.

        Counted at ``days_a_year`` bars a year; of a ticker that trades more rarely fewer bars are seen, and the first of them still shows a little.
        """
        slowest = 2 * 37 * max(self.rsi_window, self.adx_window, (self.macd[1] + 1) // 2)
        return (self.min_history + self.year + slowest) * 366 // self.days_a_year + 30

    @property
    def tail_rows(self) -> int:
        """Rows that the features of a bar need besides the averages' state: the year's window over the long average."""
        return self.sma_long + self.year

    @property
    def tail_days(self) -> int:
        return self.tail_rows * 366 // self.days_a_year + 30

    @property
    def min_history(self) -> int:
        """Rows of history that every feature needs: the slope window on top of the long average."""
        return max(self.sma_long + self.slope_window, self.year)


def load(overrides: Mapping[str, Any] | str | None = None) -> Config:
    """Defaults with overrides by field name: a mapping or the path of a JSON file; unknown keys and a missing file are ignored."""
    if isinstance(overrides, str):
        try:
            with open(overrides) as f:
                overrides = json.load(f)
        except FileNotFoundError:
            overrides = None
    known = {f.name for f in fields(Config)}
    freeze = lambda v: tuple(map(freeze, v)) if isinstance(v, list) else v
    return replace(Config(), **{k: freeze(v) for k, v in (overrides or {}).items() if k in known})


DEFAULT = Config()
