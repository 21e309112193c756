"""The registered queries in SQL, to hold them against another engine.

A query is a chain of named steps; ``chain`` writes the WITH clause of those that the last one needs.
"""

from __future__ import annotations

import re

from ..config import DEFAULT as C
from ..operators.analysis import NOTES, SIGNIFICANCE
from ..operators.events import BULLISH, EVENTS
from ..operators.ranking import COEFFICIENTS, DEEP, INPUTS
from ..operators.research import DISTANCES, FARTHEST, GRID, weight_combos
from ..operators.universe import DOTTED, HYPHENATED, NAMES

STEPS: dict[str, str] = {}


def r(x: str, digits: int) -> str:
    return f"CAST(CAST(CAST({x} AS DECIMAL(28,10)) AS DECIMAL(18,{digits})) AS DOUBLE)"


def text(x: str) -> str:
    return f"CAST(CAST(CAST({x} AS DECIMAL(28,10)) AS DECIMAL(18,2)) AS VARCHAR)"


def step(name: str, sql: str) -> str:
    STEPS[name] = sql
    return name


def chain(sql: str) -> str:
    need: list[str] = []

    def visit(q: str) -> None:
        for name in STEPS:
            if name not in need and re.search(rf"\b{name}\b", q):
                visit(STEPS[name])
                if name not in need:
                    need.append(name)

    visit(sql)
    return ("WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in need) + "\n" if need else "") + sql


def full(aggregate: str, of: str, rows: int) -> str:
    over = f"OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({of}) {over} = {rows} THEN {aggregate}({of}) {over} END"


def ewm(source: str, value: str, alpha: str, out: str) -> str:
    """Adds the exponential average as steps of its own; alpha in (0, 1). Gives the last step's name."""
    w = "PARTITION BY ticker ORDER BY date"
    run = f"OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = f"OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    a = f"({alpha})"
    step(f"{out}_p1", f"SELECT *, row_number() OVER ({w}) AS p_ FROM {source}")
    step(f"{out}_p2", f"SELECT *, max(CASE WHEN {value} IS NOT NULL THEN p_ END) {before} AS q_ FROM {out}_p1")
    step(f"{out}_p3", f"SELECT *, pow(1 - {a}, p_ - q_) AS old_ FROM {out}_p2")
    step(
        f"{out}_p4",
        f"SELECT *, CASE WHEN {value} IS NOT NULL AND q_ IS NOT NULL THEN ln(old_ / (old_ + {a})) ELSE 0.0::DOUBLE END AS la_, CASE WHEN q_ IS NULL THEN 1.0::DOUBLE ELSE {a} / (old_ + {a}) END AS b_ FROM {out}_p3",
    )
    step(f"{out}_p5", f"SELECT *, sum(la_) {run} AS l_ FROM {out}_p4")
    return step(
        f"{out}_p6",
        f"SELECT * EXCLUDE (p_, q_, old_, la_, b_, l_), CASE WHEN count({value}) {run} > 0 THEN exp(l_) * sum(CASE WHEN {value} IS NOT NULL THEN b_ * {value} * exp(-l_) ELSE 0.0::DOUBLE END) {run} END AS {out} FROM {out}_p5",
    )


_STEP = "CAST(sum(CAST(round(l_discount * 100) AS BIGINT) - 5) AS BIGINT)"
_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
for name, column in (("brand_days", "p_brand"), ("type_days", "p_type")):
    step(
        f"{name}_raw",
        f"SELECT {column} AS ticker, CAST(l_shipdate AS DATE) AS date, {_STEP} AS step, CAST(max(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS hi, CAST(sum(l_quantity) AS BIGINT) AS volume FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2",
    )
    step(name, f"SELECT *, sum(step) OVER (PARTITION BY ticker ORDER BY date {_RUN}) AS cum FROM {name}_raw")
step("bars_mid", "SELECT ticker, date, hi, volume, 100 * exp(0.002::DOUBLE * cum) AS close, 100 * exp(0.002::DOUBLE * (cum - step)) AS open FROM brand_days")
step("bars", "SELECT ticker, date, open, greatest(open, close) * (1 + hi::DOUBLE / 1000) AS high, least(open, close) * (1 - hi::DOUBLE / 1000) AS low, close, volume FROM bars_mid")
step("bench_days", f"SELECT CAST(l_shipdate AS DATE) AS date, {_STEP} AS step FROM lineitem GROUP BY 1")
step("bench", f"SELECT 'SPY' AS ticker, date, 100 * exp(0.0002::DOUBLE * sum(step) OVER (ORDER BY date {_RUN})) AS close FROM bench_days")
step("etf", "SELECT ticker, date, 100 * exp(0.002::DOUBLE * cum) AS close FROM type_days UNION ALL SELECT ticker, date, close FROM bench")
step("index_vol", "SELECT CAST(l_shipdate AS DATE) AS date, (10 + 4 * (count(*) % 9))::DOUBLE AS vix, (80 + (sum(l_linenumber) % 45))::DOUBLE AS vvix FROM lineitem GROUP BY 1")

W = "PARTITION BY ticker ORDER BY date"
step("with_sma", f"SELECT *, {full('avg', 'close', C.sma_short)} AS sma_50, {full('avg', 'close', C.sma_long)} AS sma_200 FROM bars")
_fast, _slow, _signal = (f"2.0::DOUBLE / {n + 1}" for n in C.macd)
_last = ewm(ewm("with_sma", "close", _fast, "ema_fast"), "close", _slow, "ema_slow")
step("macd_line", f"SELECT * EXCLUDE (ema_fast, ema_slow), ema_fast - ema_slow AS macd FROM {_last}")
_last = ewm("macd_line", "macd", _signal, "macd_signal")
step("steps", f"SELECT *, macd - macd_signal AS macd_hist, close - lag(close) OVER ({W}) AS st FROM {_last}")
step("moves", "SELECT * EXCLUDE (st), CASE WHEN st IS NOT NULL THEN greatest(st, 0.0::DOUBLE) END AS mv_up, CASE WHEN st IS NOT NULL THEN greatest(-st, 0.0::DOUBLE) END AS mv_down FROM steps")
_wilder = f"1.0::DOUBLE / {C.rsi_window}"
_last = ewm(ewm("moves", "mv_up", _wilder, "gain_avg"), "mv_down", _wilder, "loss_avg")
step("with_rsi", f"SELECT * EXCLUDE (mv_up, mv_down, gain_avg, loss_avg), CASE WHEN loss_avg > 0 THEN 100 - 100 / (1 + gain_avg / loss_avg) WHEN gain_avg > 0 THEN 100.0::DOUBLE END AS rsi_14 FROM {_last}")
_n, _k = C.bollinger
step("indicators", f"SELECT *, {full('avg', 'close', _n)} + {_k} * ({full('stddev_samp', 'close', _n)}) AS bb_upper, {full('avg', 'close', _n)} - {_k} * ({full('stddev_samp', 'close', _n)}) AS bb_lower FROM with_rsi")


def case(value: str, bands, last: str, show) -> str:
    return f"CASE WHEN {value} IS NULL THEN NULL " + " ".join(f"WHEN {value} < {b[0]} THEN {show(b)}" for b in bands) + f" ELSE {last} END"


step("vix_avg", f"SELECT *, avg(vix) OVER (ORDER BY date ROWS BETWEEN {C.vix_sma - 1} PRECEDING AND CURRENT ROW) AS a, count(vix) OVER (ORDER BY date ROWS BETWEEN {C.vix_sma - 1} PRECEDING AND CURRENT ROW) AS k FROM index_vol")
step("vix_ratio", f"SELECT *, CASE WHEN k = {C.vix_sma} THEN vix / nullif(a, 0) END AS q FROM vix_avg")
step(
    "context",
    f"SELECT date, vix AS vix_close, vvix AS vvix_close, {case('vix', C.vix_bands, repr(C.vix_bands[-1][1]), lambda b: repr(b[1]))} AS vix_regime, {case('vix', C.vix_bands, f'{C.vix_bands[-1][2]}::DOUBLE', lambda b: f'{b[2]}::DOUBLE')} AS vix_mult, "
    f"CASE WHEN q > {C.vix_trend[1]} THEN 'expanding' WHEN q < {C.vix_trend[0]} THEN 'contracting' WHEN q IS NOT NULL THEN 'stable' END AS vix_trend, {case('vvix', C.vvix_bands, repr(C.vvix_top), lambda b: repr(b[1]))} AS vol_environment FROM vix_ratio",
)
_sign = lambda a, b: f"CASE WHEN {a} - {b} > 1e-9 THEN 1.0::DOUBLE WHEN {a} - {b} <= 1e-9 THEN -1.0::DOUBLE END"
step(
    "parts",
    f"SELECT *, {_sign('close', 'sma_200')} AS s0, {_sign('close', 'sma_50')} AS s1, {_sign('macd', 'macd_signal')} AS s2, "
    f"CASE WHEN rsi_14 < {C.rsi_bands[0][0]} THEN {C.rsi_bands[0][1]}::DOUBLE WHEN rsi_14 < {C.rsi_bands[1][0]} THEN {C.rsi_bands[1][1]}::DOUBLE WHEN rsi_14 <= {C.rsi_overbought} THEN 0.0::DOUBLE WHEN rsi_14 > {C.rsi_overbought} THEN -1.0::DOUBLE END AS s3 FROM indicators",
)


def weighted(w) -> str:
    top = " + ".join(f"coalesce({x} * s{i}, 0.0::DOUBLE)" for i, x in enumerate(w))
    below = " + ".join(f"CASE WHEN s{i} IS NOT NULL THEN {x} ELSE 0.0::DOUBLE END" for i, x in enumerate(w))
    return r(f"(0.0::DOUBLE + {top}) / nullif(0.0::DOUBLE + {below}, 0)", 4)


step("scored", f"SELECT * EXCLUDE (s0, s1, s2, s3), {weighted([f'{x}::DOUBLE' for x in C.weights])} AS composite_score FROM parts")
step("signals", f"SELECT scored.*, context.* EXCLUDE (date), {r('composite_score * vix_mult', 4)} AS composite_vix_adj FROM scored LEFT JOIN context ON scored.date = context.date")

step("disp1", "SELECT *, (close - sma_50) / nullif(sma_50, 0) AS dist_sma50, (close - sma_200) / nullif(sma_200, 0) AS dist_sma200 FROM signals")
_ch = lambda c, k: f"{c} / nullif(lag({c}, {k}) OVER ({W}), 0) - 1"
step(
    "disp",
    f"SELECT *, (dist_sma200 - ({full('avg', 'dist_sma200', C.year)})) / nullif({full('stddev_samp', 'dist_sma200', C.year)}, 0) AS dist_sma200_z, (rsi_14 - 50) / 50 AS rsi_centered, (close - bb_lower) / nullif(bb_upper - bb_lower, 0) AS bb_pctb, "
    f"macd_hist / nullif(close, 0) AS macd_hist_norm, close / nullif({full('max', 'high', C.year)}, 0) - 1 AS dist_52w_high, close / nullif({full('min', 'low', C.year)}, 0) - 1 AS dist_52w_low, volume::DOUBLE / nullif({full('avg', 'volume', C.volume_sma)}, 0) AS vol_ratio, "
    f"{_ch('close', C.ret_windows[0])} AS ret_21d, {_ch('close', C.ret_windows[1])} AS ret_63d, {_ch('sma_200', C.slope_window)} AS sma200_slope FROM disp1",
)
step("adx1", f"SELECT *, lag(close) OVER ({W}) AS pc, high - lag(high) OVER ({W}) AS um, lag(low) OVER ({W}) - low AS dm FROM disp")
step("adx2", "SELECT * EXCLUDE (pc, um, dm), greatest(high - low, abs(high - pc), abs(low - pc)) AS tr, CASE WHEN um > dm AND um > 0 THEN um ELSE 0.0::DOUBLE END AS pdm, CASE WHEN dm > um AND dm > 0 THEN dm ELSE 0.0::DOUBLE END AS mdm FROM adx1")
_alpha = f"1.0::DOUBLE / {C.adx_window}"
_last = ewm(ewm(ewm("adx2", "tr", _alpha, "tr_avg"), "pdm", _alpha, "pdm_avg"), "mdm", _alpha, "mdm_avg")
step("adx3", f"SELECT * EXCLUDE (tr, pdm, mdm, tr_avg, pdm_avg, mdm_avg), 100 * pdm_avg / nullif(tr_avg, 0) AS pdi, 100 * mdm_avg / nullif(tr_avg, 0) AS mdi FROM {_last}")
step("adx4", "SELECT * EXCLUDE (pdi, mdi), 100 * (abs(pdi - mdi) / nullif(pdi + mdi, 0)) AS dx FROM adx3")
_last = ewm("adx4", "dx", _alpha, "adx_all")
step("adx5", f"SELECT * EXCLUDE (dx, adx_all), CASE WHEN row_number() OVER ({W}) > {2 * C.adx_window} THEN adx_all END AS adx_14 FROM {_last}")
step("regimed", f"SELECT *, CASE WHEN adx_14 IS NOT NULL AND sma200_slope IS NOT NULL THEN CASE WHEN adx_14 >= {C.adx_trend_min} OR abs(sma200_slope) >= {C.slope_trend_min} THEN 'trending' ELSE 'ranging' END END AS ticker_regime FROM adx5")
step("features", "SELECT *, CASE WHEN ticker_regime = 'trending' THEN CASE WHEN sma200_slope > 0 THEN 'up' WHEN sma200_slope < 0 THEN 'down' END END AS trend_direction FROM regimed")

for source, out in (("bars", "returns"), ("etf", "etf_returns")):
    step(f"{out}_days", f"SELECT date, row_number() OVER (ORDER BY date) AS d FROM (SELECT DISTINCT date FROM {source}) x")
    step(out, f"SELECT ticker, s.date, CASE WHEN lag(d) OVER (PARTITION BY ticker ORDER BY s.date) = d - 1 THEN close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY s.date), 0) - 1 END AS r FROM {source} s JOIN {out}_days USING (date)")
_mask = lambda x: f"CASE WHEN 1 + {x} BETWEEN 1.0::DOUBLE / {C.max_ratio} AND {C.max_ratio} THEN {x} END"
step("masked", f"SELECT ticker, date, {_mask('r')} AS r FROM returns")
step("etf_masked", f"SELECT ticker, date, {_mask('r')} AS r FROM etf_returns")


def correlation(days: int) -> str:
    return f"""SELECT ticker_a, ticker_b, CAST({days} AS INTEGER) AS window_days, {r('q', 6)} AS pearson_r, n AS n_obs FROM (
      SELECT a.ticker AS ticker_a, b.ticker AS ticker_b, count(*) AS n,
             (count(*) * sum(a.r * b.r) - sum(a.r) * sum(b.r)) / nullif(sqrt(greatest((count(*) * sum(a.r * a.r) - sum(a.r) * sum(a.r)) * (count(*) * sum(b.r * b.r) - sum(b.r) * sum(b.r)), 0)), 0) AS q
      FROM cut_{days} a JOIN cut_{days} b ON a.date = b.date AND a.ticker < b.ticker GROUP BY 1, 2) x WHERE n >= {C.min_overlap} AND abs(q) >= MIN_R"""


for d in C.windows:
    step(f"cut_{d}", f"SELECT ticker, date, r - avg(r) OVER (PARTITION BY ticker) AS r FROM masked WHERE r IS NOT NULL AND date > (SELECT max(date) FROM masked) - {d}")
    step(f"etf_cut_{d}", f"SELECT ticker AS etf_proxy, date, r AS m FROM etf_masked WHERE r IS NOT NULL AND date > (SELECT max(date) FROM etf_masked) - {d}")
    step(f"own_cut_{d}", f"SELECT ticker, date, r FROM masked WHERE r IS NOT NULL AND date > (SELECT max(date) FROM masked) - {d}")
step("beta_own", f"SELECT etf_proxy, var_samp(m) AS v, count(*) AS k FROM etf_cut_90 GROUP BY 1 HAVING count(*) >= {C.min_overlap} AND var_samp(m) <> 0")
step(
    "beta_90",
    f"SELECT ticker, etf_proxy, CAST(90 AS INTEGER) AS window_days, {r('c / nullif(v, 0)', 6)} AS beta, n AS n_obs FROM (SELECT ticker, etf_proxy, covar_samp(r, m) AS c, count(*) AS n FROM own_cut_90 JOIN etf_cut_90 USING (date) GROUP BY 1, 2) x JOIN beta_own USING (etf_proxy) WHERE n >= {C.min_overlap}",
)
step("beta_spy", f"SELECT ticker, beta FROM beta_90 WHERE etf_proxy = '{C.benchmark}'")

_frame = f"OVER ({W} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
step("trend1", f"SELECT *, list(composite_vix_adj) FILTER (composite_vix_adj IS NOT NULL) {_frame} AS seen FROM features")
step("trend2", f"SELECT * EXCLUDE (seen), CASE WHEN len(seen) >= 2 AND seen[-1] - seen[1] > {C.trend_delta} THEN 'improving' WHEN len(seen) >= 2 AND seen[-1] - seen[1] < -{C.trend_delta} THEN 'deteriorating' ELSE 'flat' END AS signal_trend FROM trend1")
step("biased", "SELECT *, CASE WHEN composite_vix_adj > 0 THEN 'bullish' WHEN composite_vix_adj < 0 THEN 'bearish' ELSE 'neutral' END AS bias FROM trend2")
_b = "least(abs(composite_vix_adj), 1.0::DOUBLE)"
_conf = f"CASE WHEN (composite_vix_adj > 0 AND signal_trend = 'improving') OR (composite_vix_adj < 0 AND signal_trend = 'deteriorating') THEN least({_b} + 0.1::DOUBLE, 1.0::DOUBLE) WHEN (composite_vix_adj > 0 AND signal_trend = 'deteriorating') OR (composite_vix_adj < 0 AND signal_trend = 'improving') THEN greatest({_b} - 0.1::DOUBLE, 0.0::DOUBLE) ELSE {_b} END"
step("confident", f"SELECT *, CASE WHEN composite_vix_adj IS NULL THEN 0.0::DOUBLE ELSE {r(_conf, 2)} END AS confidence FROM biased")
step(
    "analysed",
    "SELECT *, CASE WHEN composite_vix_adj IS NULL THEN 'Insufficient signal data.' ELSE concat_ws('; ', CASE signal_trend WHEN 'improving' THEN 'Strengthening' WHEN 'deteriorating' THEN 'Weakening' ELSE 'Stable' END || ' ' || CASE WHEN composite_vix_adj > 0 THEN 'bullish' ELSE 'bearish' END || ' signal (' || "
    + text("abs(composite_vix_adj)")
    + " || ')', CASE WHEN rsi_14 < 30 THEN 'RSI oversold' WHEN rsi_14 > 70 THEN 'RSI overbought' WHEN rsi_14 < 40 THEN 'RSI recovering' END, CASE WHEN vix_regime IN ('high', 'extreme') THEN 'VIX ' || vix_regime || ' — macro risk elevated' WHEN vix_regime = 'low' THEN 'VIX low — complacent conditions' END) || '.' END AS reasoning FROM confident",
)
step("preds", f"SELECT ticker, date AS signal_date, 'v1.0' AS signal_version, bias, composite_vix_adj, confidence, vix_regime, vix_trend, vol_environment, close AS price_at_signal FROM analysed WHERE abs(composite_vix_adj) >= {C.signal_threshold} AND bias <> 'neutral'")

_hs = sorted({*C.horizons_v1, *C.horizons_v2})
step("ratios", f"SELECT ticker, date, close, close / nullif(lag(close) OVER ({W}), 0) AS q FROM bars")
step("torn", f"SELECT *, CASE WHEN q IS NULL OR q > {C.max_ratio} OR q < 1.0::DOUBLE / {C.max_ratio} THEN 1 ELSE 0 END AS t, q - 1 AS rt FROM ratios")
_past = f"OVER ({W} ROWS BETWEEN {C.vol_lookback - 1} PRECEDING AND CURRENT ROW)"
step(
    "forward",
    f"SELECT ticker, date, close, CASE WHEN count(rt) {_past} >= 2 THEN stddev_samp(rt) {_past} END AS vol_at_signal, "
    + ", ".join(f"lead(close, {h}) OVER ({W}) AS close_{h}, max(t) OVER ({W} ROWS BETWEEN 2 FOLLOWING AND {h} FOLLOWING) = 1 AS seam_{h}" for h in _hs)
    + " FROM torn",
)
_ok = lambda h: f"CASE WHEN bias = 'bullish' THEN return_{h}d > {C.correct_move} WHEN bias = 'bearish' THEN return_{h}d < -{C.correct_move} END"
step(
    "resolved1",
    "SELECT preds.*, " + ", ".join(f"(close_{h} - price_at_signal) / nullif(price_at_signal, 0) AS return_{h}d" for h in C.horizons_v1) + f" FROM preds JOIN forward ON preds.ticker = forward.ticker AND signal_date = date WHERE close_{max(C.horizons_v1)} IS NOT NULL",
)
step("resolved", "SELECT *, " + ", ".join(f"{_ok(h)} AS correct_{h}d" for h in C.horizons_v1) + " FROM resolved1")
step("long_v1", " UNION ALL ".join(f"SELECT ticker, signal_date, signal_version, bias, vix_regime, vol_environment, confidence, composite_vix_adj, CAST({h} AS INTEGER) AS horizon_days, return_{h}d AS ret, correct_{h}d AS hit FROM resolved" for h in C.horizons_v1))
step("market", "SELECT date AS signal_date, " + ", ".join(f"lead(close, {h}) OVER (ORDER BY date) / nullif(close, 0) - 1 AS bench_{h}" for h in C.horizons_v2) + " FROM bench")
step("ahead", "SELECT preds.ticker, preds.signal_date, bias, price_at_signal, vol_at_signal, coalesce(0.67::DOUBLE * beta + 0.33::DOUBLE, 1.0::DOUBLE) AS beta_used, " + ", ".join(f"close_{h}, seam_{h}, bench_{h}" for h in C.horizons_v2) + " FROM preds JOIN forward ON preds.ticker = forward.ticker AND preds.signal_date = forward.date LEFT JOIN market ON preds.signal_date = market.signal_date LEFT JOIN beta_spy ON preds.ticker = beta_spy.ticker WHERE price_at_signal >= 1")
step("out1", " UNION ALL ".join(f"SELECT ticker, signal_date, bias, price_at_signal, vol_at_signal, beta_used, CAST({h} AS INTEGER) AS horizon_days, close_{h} AS future_price, bench_{h} AS benchmark_return FROM ahead WHERE close_{h} IS NOT NULL AND NOT coalesce(seam_{h}, false)" for h in C.horizons_v2))
step("seeds", " UNION ALL ".join(f"SELECT ticker, signal_date, CAST({h} AS INTEGER) AS horizon_days, price_at_signal, vol_at_signal, {C.threshold_k}::DOUBLE * vol_at_signal * sqrt({h}::DOUBLE) AS threshold_used FROM ahead WHERE close_{h} IS NULL OR coalesce(seam_{h}, false)" for h in C.horizons_v2))
step("out2", "SELECT *, (future_price - price_at_signal) / nullif(price_at_signal, 0) AS raw_return, 0.5::DOUBLE * vol_at_signal * sqrt(horizon_days::DOUBLE) AS threshold_used FROM out1")
step("out3", "SELECT *, raw_return - beta_used * benchmark_return AS excess_return FROM out2")
step("out4", "SELECT *, CASE WHEN threshold_used IS NOT NULL THEN CASE WHEN bias = 'bullish' THEN excess_return > 1e-9 WHEN bias = 'bearish' THEN -excess_return > 1e-9 END END AS direction_correct FROM out3")
step("outcomes", "SELECT *, direction_correct AND threshold_used - abs(excess_return) <= 1e-9 AS threshold_correct FROM out4")

_was = lambda c: f"lag({c}) OVER ({W})"
_up = lambda a, b, pa=None, pb=None: f"({pa or _was(a)}) - ({pb or _was(b)}) <= 1e-9 AND {a} - {b} > 1e-9"
step("priced", f"SELECT * FROM features WHERE close >= {C.price_floor}")
step("year", f"SELECT *, {full('max', 'high', C.year)} AS yh, {full('min', 'low', C.year)} AS yl FROM priced")
step("year_before", f"SELECT *, {_was('yh')} AS hi52, {_was('yl')} AS lo52 FROM year")
_events = {
    "E1": _up("sma_50", "sma_200"), "E2": _up("close", "sma_200"), "E3": _up("macd", "macd_signal"), "E4": _up("macd", "macd_signal") + " AND macd < 0",
    "E5": f"{_was('rsi_14')} - 30 <= 1e-9 AND rsi_14 - 30 > 1e-9", "E6": f"{_was('bb_lower')} - {_was('close')} > 1e-9 AND bb_lower - close <= 1e-9", "E7": f"{_was('close')} - hi52 <= 1e-9 AND close - hi52 > 1e-9", "E8": f"{_was('rsi_14')} - 50 <= 1e-9 AND rsi_14 - 50 > 1e-9",
    "E9": _up("sma_200", "sma_50"), "E10": _up("sma_200", "close"), "E11": f"lo52 - {_was('close')} <= 1e-9 AND lo52 - close > 1e-9",
}
step("crossed", "SELECT *, " + ", ".join(f"coalesce({q}, false) AS {e}" for e, q in _events.items()) + f", row_number() OVER ({W}) - 1 AS pos FROM year_before")
step("fires", " UNION ALL ".join(f"SELECT ticker, '{e}' AS event, pos AS position, date FROM crossed WHERE {e}" for e in EVENTS))
step("priced_ratios", f"SELECT ticker, date, close, close / nullif(lag(close) OVER ({W}), 0) AS q FROM bars WHERE close >= {C.price_floor}")
step("calendar", "SELECT date FROM priced_ratios UNION SELECT date FROM bench")
step("bench_asof", "SELECT c.date, b.close AS m FROM calendar c ASOF LEFT JOIN bench b ON c.date >= b.date")
step("looked", "SELECT ticker, date, close, " + ", ".join(f"lead(close, {h}) OVER ({W}) AS c{h}, lead(date, {h}) OVER ({W}) AS d{h}, max(q) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) AS m{h}" for h in C.horizons_events) + " FROM priced_ratios")
step(
    "excess",
    "SELECT looked.ticker, looked.date, "
    + ", ".join(f"CASE WHEN NOT coalesce(m{h} > {C.max_ratio} OR m{h} < 1.0::DOUBLE / {C.max_ratio}, false) THEN c{h} / nullif(looked.close, 0) - 1 - coalesce(0.67::DOUBLE * beta + 0.33::DOUBLE, 1.0::DOUBLE) * (a{h}.m / nullif(a.m, 0) - 1) END AS excess_{h}" for h in C.horizons_events)
    + " FROM looked LEFT JOIN bench_asof a ON looked.date = a.date LEFT JOIN beta_spy ON looked.ticker = beta_spy.ticker "
    + " ".join(f"LEFT JOIN bench_asof a{h} ON d{h} = a{h}.date" for h in C.horizons_events),
)
step("long_excess", " UNION ALL ".join(f"SELECT ticker, date, CAST({h} AS INTEGER) AS horizon, excess_{h} AS excess FROM excess WHERE excess_{h} IS NOT NULL" for h in C.horizons_events))
# the greedy choice, as a recursion from each kept fire to the next beyond the gap
step("first_fire", "SELECT ticker, event, min(position) AS position FROM fires GROUP BY 1, 2")
step("next_fire", f"SELECT f.ticker, f.event, f.position, (SELECT min(g.position) FROM fires g WHERE g.ticker = f.ticker AND g.event = f.event AND g.position - f.position > {C.dedup_rows}) AS following FROM fires f")


def kept_sql(select: str) -> str:
    body = chain("SELECT * FROM next_fire, first_fire WHERE false")
    with_part = body[: body.rindex("SELECT * FROM next_fire")].rstrip()
    rest = chain(select)
    extra = {n: s for n, s in STEPS.items() if re.search(rf"\b{n} AS \(", rest[: rest.rfind(select)]) and not re.search(rf"\b{n} AS \(", with_part)}
    more = "".join(f",\n{n} AS ({s})" for n, s in extra.items())
    recursive = "kept AS (SELECT ticker, event, position FROM first_fire UNION ALL SELECT n.ticker, n.event, n.following FROM kept k JOIN next_fire n ON n.ticker = k.ticker AND n.event = k.event AND n.position = k.position WHERE n.following IS NOT NULL),\nkept_dated AS (SELECT k.ticker, k.event, k.position, f.date FROM kept k JOIN fires f USING (ticker, event, position))"
    return with_part.replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + recursive + more + "\n" + select


def robust(rows: str, keys: str) -> str:
    lo, hi = C.winsor
    return f"""SELECT {keys}, count(excess) AS n, {r('any_value(mid)', 6)} AS median, {r('avg(least(greatest(excess, low), high))', 6)} AS wmean, {r('avg((excess > 1e-9)::INT)', 6)} AS frac_gt0
    FROM (SELECT *, quantile_cont(excess, {lo}) OVER (PARTITION BY {keys}) AS low, quantile_cont(excess, 0.5) OVER (PARTITION BY {keys}) AS mid, quantile_cont(excess, {hi}) OVER (PARTITION BY {keys}) AS high FROM ({rows}) z) y GROUP BY {keys}"""


def share(x: str) -> str:
    return r(f"avg(({x})::INT)", 4)


_F = ("dist_sma50", "dist_sma200", "dist_sma200_z", "rsi_centered", "bb_pctb", "macd_hist_norm", "dist_52w_high", "dist_52w_low", "vol_ratio", "ret_21d", "ret_63d", "adx_14", "sma200_slope")
_dist = "CASE " + " ".join(f"WHEN dist_52w_high >= {b} THEN '{n}'" for b, n in DISTANCES) + f" ELSE '{FARTHEST}' END"
_levels = []
step("levels", f"SELECT *, row_number() OVER ({W}) AS k, max(high) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS h20, min(low) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS l20, max(high) OVER ({W} ROWS BETWEEN {C.year - 1} PRECEDING AND CURRENT ROW) AS h52, min(low) OVER ({W} ROWS BETWEEN {C.year - 1} PRECEDING AND CURRENT ROW) AS l52 FROM analysed")
for kind, x in {"sma_50": "sma_50", "sma_200": "sma_200", "bb_upper": "bb_upper", "bb_lower": "bb_lower", "20d_high": "h20", "20d_low": "l20", "52w_high": f"CASE WHEN k >= {C.year} THEN h52 END", "52w_low": f"CASE WHEN k >= {C.year} THEN l52 END"}.items():
    said = {side: "'" + NOTES[kind, side].replace("{p}", f"' || {text('price')} || '") + "'" for side in ("support", "resistance")}
    _levels.append(f"SELECT ticker, date, price, '{kind}' AS type, CASE WHEN close >= price THEN 'support' ELSE 'resistance' END AS role, '{SIGNIFICANCE[kind]}' AS significance, CASE WHEN close >= price THEN {said['support']} ELSE {said['resistance']} END AS note FROM (SELECT ticker, date, close, {r(x, 4)} AS price FROM levels) z WHERE price IS NOT NULL")
_cond = {
    "rsi_oversold": "rsi_14 < 30", "rsi_overbought": "rsi_14 > 70", "below_bb_lower": "bb_lower - close > 1e-9", "above_bb_upper": "close - bb_upper > 1e-9", "above_sma200": "close - sma_200 > 1e-9", "below_sma200": "sma_200 - close > 1e-9",
    "macd_above_signal": "macd - macd_signal > 1e-9", "deep_below_sma200": "close < sma_200 * 0.85::DOUBLE", "far_above_sma200": "close > sma_200 * 1.15::DOUBLE",
}
_vix = ", ".join(f"('{n}', '{g}', {c}::DOUBLE, {c / now}::DOUBLE)" for n, v in GRID.items() if n.startswith("vix_") for g, now, cs in [v] for c in cs)
_combos = ", ".join("(" + ", ".join(f"{x}::DOUBLE" for x in c) + ")" for c in weight_combos())
step("weights", f"SELECT * FROM (VALUES {_combos}) v(w0, w1, w2, w3)")
step("symbols", "SELECT *, chr((65 + a % 26)::INT) || chr((65 + b % 26)::INT) || 'ZZ' || CASE k WHEN 0 THEN 'T' WHEN 1 THEN 'W' WHEN 2 THEN 'R' WHEN 3 THEN 'U' WHEN 4 THEN '-WT' WHEN 5 THEN '.WS' WHEN 6 THEN '-UN' ELSE '' END AS code, CASE WHEN p_partkey % 5 = 0 THEN 'ETF' ELSE 'Common Stock' END AS type, CASE WHEN p_partkey % 7 = 0 THEN 'CAD' ELSE 'USD' END AS currency, CASE WHEN p_partkey % 3 = 0 THEN 'NYSE' WHEN p_partkey % 3 = 1 THEN 'NASDAQ' ELSE 'OTC' END AS venue, p_name || CASE WHEN p_partkey % 11 = 0 THEN ' Warrant' WHEN p_partkey % 11 = 1 THEN ' acquisition corp' ELSE '' END AS name, p_partkey % 2 = 0 AS listed FROM (SELECT p_name, p_partkey, p_partkey % 26 AS a, (p_partkey // 26) % 26 AS b, p_size % 8 AS k FROM part) x")
step("provided", "SELECT ticker || CASE WHEN day(date) % 7 = 0 THEN '.TO' WHEN day(date) % 11 = 0 THEN '.INDX' ELSE '' END AS ticker, date, open, high, low, CASE WHEN day(date) = 31 THEN 0.0::DOUBLE ELSE close END AS close, CASE WHEN day(date) = 30 THEN 0.0::DOUBLE WHEN month(date) < 7 THEN close / 2 ELSE close END AS adjusted_close, CASE WHEN day(date) = 29 THEN NULL ELSE volume END AS volume FROM bars")
step("scaled", "SELECT *, CASE WHEN close <> 0 THEN adjusted_close / close ELSE 1.0::DOUBLE END AS f FROM provided WHERE adjusted_close > 0")
step("companies", "SELECT 'S' || s_suppkey AS ticker, s_name AS name, CAST(round(s_acctbal * 100) AS BIGINT) AS market_cap, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 1704067200 + s_suppkey % 15 * 86400 + s_suppkey % 24 * 3600 END AS updated_at FROM supplier")
step("entries", "SELECT CASE WHEN venue = 'OTC' THEN 'tsx_venture' WHEN currency = 'CAD' THEN 'tsx' ELSE 'us' END AS exchange, type <> 'ETF' AS has_data, listed FROM symbols")
_ends = lambda c, xs: "(" + " OR ".join(f"ends_with({c}, '{x}')" for x in xs) + ")"
_five = lambda c, only="": f"(length({c}) = 5 AND NOT contains({c}, '-') AND substr({c}, 5, 1) IN ('W', 'R', 'U') AND substr({c}, 1, 4) IN (SELECT code FROM symbols {only}))"

_grid = ", ".join(f"({t}::DOUBLE)" for t in GRID["signal_threshold"] if t != C.signal_threshold)
_moved = ", ".join(f"('{n}', '{g}', {now}::DOUBLE, {c}::DOUBLE)" for n, v in GRID.items() if n.startswith("vix_") for g, now, cs in [v] for c in cs if c != now)
step("hits", "SELECT bias, vix_regime, abs(composite_vix_adj) AS s, correct_10d::INT AS hit FROM resolved WHERE correct_10d IS NOT NULL")
step("hits_own", "SELECT * FROM hits WHERE bias = 'bullish'")
step("grid_1", f"SELECT t AS candidate, count(*) AS n, avg(hit) AS accuracy FROM hits_own, (VALUES {_grid}) v(t) WHERE s >= t GROUP BY 1 HAVING count(*) >= {C.min_sample}")
step("best_1", "SELECT * FROM grid_1 ORDER BY accuracy DESC, candidate LIMIT 1")
step("grid_2", f"SELECT param_name, g.vix_regime, now, candidate, count(*) AS n, avg(hit) AS accuracy FROM hits h JOIN (VALUES {_moved}) g(param_name, vix_regime, now, candidate) ON g.vix_regime = h.vix_regime WHERE s * (candidate / now) >= {C.signal_threshold} GROUP BY 1, 2, 3, 4 HAVING count(*) >= {C.min_sample}")
step("best_2", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY param_name ORDER BY accuracy DESC, candidate) AS k FROM grid_2) z WHERE k = 1")
step("proposed", f"SELECT 'signal_threshold' AS param_name, {C.signal_threshold}::DOUBLE AS current_value, candidate AS proposed_value, accuracy - b.a AS gain, n AS sample_size, NULL::VARCHAR AS vix_regime_scope FROM best_1, (SELECT avg(hit) AS a FROM hits_own HAVING count(*) >= {C.min_sample}) b UNION ALL SELECT param_name, now, candidate, accuracy - b.a, w.n, g.vix_regime FROM best_2 g JOIN (SELECT vix_regime, avg(hit) AS a FROM hits_own GROUP BY 1 HAVING count(*) >= {C.min_sample}) b ON b.vix_regime = g.vix_regime JOIN (SELECT vix_regime, count(*) AS n FROM hits GROUP BY 1 HAVING count(*) >= {C.min_sample}) w ON w.vix_regime = g.vix_regime")

_r4 = lambda *cs: ", ".join(f"{r(c, 4)} AS {c}" for c in cs)
_day = "OVER (PARTITION BY date)"
_past = lambda n: f"close / nullif(lag(close, {n}) OVER ({W}), 0)"
_DERIVED = {"mom_12_1": f"{_past(C.year)} - {_past(C.ret_windows[0])}", "vol_63d": f"stddev_samp(ret1) OVER ({W} ROWS BETWEEN {C.ret_windows[1] - 1} PRECEDING AND CURRENT ROW)", "above_sma200": "(dist_sma200 > 0)::INT::DOUBLE", "trend_up": "coalesce(trend_direction = 'up', false)::INT::DOUBLE", "trend_down": "coalesce(trend_direction = 'down', false)::INT::DOUBLE", "stretch_down": "dist_sma200_z * coalesce(trend_direction = 'down', false)::INT::DOUBLE"}
step("rank_steps", f"SELECT *, {_past(1)} - 1 AS ret1, (row_number() OVER ({W}) - 1) % {C.episode_gap + 1} = 0 AS is_head FROM features")
step("rank_inputs", f"SELECT *, {', '.join(f'{v} AS {k}' for k, v in _DERIVED.items())} FROM rank_steps")
step("rank_rows", f"SELECT i.*, e.excess_{C.rank_horizon} AS gain FROM rank_inputs i JOIN excess e ON e.ticker = i.ticker AND e.date = i.date WHERE e.excess_{C.rank_horizon} IS NOT NULL AND " + " AND ".join(f"{c} IS NOT NULL" for c in INPUTS))
step("rank_scaled", "SELECT ticker, date, trend_direction, vix_regime, dist_sma200, is_head, gain, " + ", ".join(f"CASE WHEN stddev_pop({c}) {_day} > 1e-12 THEN ({c} - avg({c}) {_day}) / stddev_pop({c}) {_day} ELSE 0 END AS x_{c}" for c in INPUTS) + " FROM rank_rows")
step("rank_scored", f"SELECT *, {r('1 / (1 + exp(-(' + ' + '.join(f'{v}::DOUBLE' if k == 'intercept' else f'({v}::DOUBLE) * x_{k}' for k, v in COEFFICIENTS.items()) + ')))', 9)} AS score FROM rank_scaled")
step("rank_placed", "SELECT *, CAST(ntile(10) OVER (PARTITION BY date ORDER BY score, ticker) AS INTEGER) AS decile, CAST(year(date) AS INTEGER) AS fold FROM rank_scored")
step("rank_counts", "SELECT coalesce(trend_direction, 'none') AS trend_direction, coalesce(vix_regime, 'none') AS vix_regime, decile, count(*) AS n, sum((gain > 1e-9)::INT)::BIGINT AS hits FROM rank_placed WHERE is_head GROUP BY 1, 2, 3")
step("rank_cells", "SELECT c.trend_direction, c.vix_regime, CAST(d AS INTEGER) AS decile, coalesce(max(n) FILTER (decile = d), 0) AS n, coalesce(max(hits) FILTER (decile = d), 0) AS hits, sum(n) >= " + str(C.min_sample) + " AS enough FROM rank_counts c, range(1, 11) t(d) GROUP BY 1, 2, 3")
step("rank_pools", "SELECT x.trend_direction, x.vix_regime, x.decile AS first, y.decile AS last, sum(z.hits)::DOUBLE / nullif(sum(z.n), 0) AS rate FROM rank_cells x JOIN rank_cells y ON x.trend_direction = y.trend_direction AND x.vix_regime = y.vix_regime AND x.decile <= y.decile JOIN rank_cells z ON x.trend_direction = z.trend_direction AND x.vix_regime = z.vix_regime AND z.decile BETWEEN x.decile AND y.decile GROUP BY 1, 2, 3, 4")
step("rank_floors", "SELECT p.trend_direction, p.vix_regime, c.decile, first, min(rate) AS least FROM rank_pools p JOIN rank_cells c ON c.trend_direction = p.trend_direction AND c.vix_regime = p.vix_regime AND c.decile BETWEEN first AND last GROUP BY 1, 2, 3, 4")

SQL = {
    "rank_spread": f"SELECT fold, n, {r('hi', 6)} AS top, {r('lo', 6)} AS bottom, {r('hi - lo', 6)} AS spread FROM (SELECT fold, count(*) AS n, avg(clipped) FILTER (decile = 10) AS hi, avg(clipped) FILTER (decile = 1) AS lo FROM (SELECT *, least(greatest(gain, quantile_cont(gain, {C.winsor[0]}) OVER (PARTITION BY fold)), quantile_cont(gain, {C.winsor[1]}) OVER (PARTITION BY fold)) AS clipped FROM rank_placed) q GROUP BY 1) g",
    "rank_picks": f"SELECT ticker, date, pick, decile, {r('score', 6)} AS score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY date ORDER BY score DESC, ticker) AS INTEGER) AS pick FROM rank_placed WHERE NOT coalesce(dist_sma200 < {DEEP} AND trend_direction = 'down', false)) q WHERE pick <= 5",
    "rank_confidence": f"SELECT c.trend_direction, c.vix_regime, c.decile, any_value(n) AS n, any_value(hits) AS hits, CASE WHEN bool_and(enough) THEN {r('max(least)', 6)} END AS confidence FROM rank_cells c LEFT JOIN rank_floors f ON f.trend_direction = c.trend_direction AND f.vix_regime = c.vix_regime AND f.decile = c.decile GROUP BY 1, 2, 3",
    "bars_ohlcv": f"SELECT ticker, date, {_r4('open', 'high', 'low', 'close')}, volume FROM bars",
    "validate_missing": f"SELECT count(*) AS requested, count(*) FILTER (b.ticker IS NULL) AS missing, (SELECT count(*) FROM bars) > 0 AND count(*) FILTER (b.ticker IS NULL) > {C.max_missing_share} * count(*) AS stop FROM (SELECT DISTINCT p_brand AS ticker FROM part) p LEFT JOIN (SELECT DISTINCT ticker FROM bars WHERE date = (SELECT max(date) FROM bars)) b USING (ticker)",
    "sma_50_200": f"SELECT ticker, date, {_r4('sma_50', 'sma_200')} FROM with_sma",
    "ema_macd": f"SELECT ticker, date, {_r4('macd', 'macd_signal', 'macd_hist')} FROM steps",
    "rsi_14": f"SELECT ticker, date, {_r4('rsi_14')} FROM with_rsi",
    "bollinger": f"SELECT ticker, date, {_r4('bb_upper', 'bb_lower')} FROM indicators",
    "vix_context": "SELECT * FROM context",
    "composite": f"SELECT ticker, date, {_r4('sma_50', 'sma_200', 'macd', 'macd_signal', 'rsi_14', 'bb_upper', 'bb_lower')}, vix_close, vvix_close, vix_regime, vix_trend, vol_environment, composite_score, composite_vix_adj FROM signals",
    "dist_features": f"SELECT ticker, date, {_r4(*(f for f in _F if f != 'adx_14'))} FROM disp",
    "adx_14": f"SELECT ticker, date, {_r4('adx_14')} FROM adx5",
    "averages_stepped": f"SELECT ticker, date, {_r4('macd', 'macd_signal', 'macd_hist', 'rsi_14', 'adx_14')} FROM features WHERE date >= DATE '1998-07-01'",
    "regime": "SELECT ticker, date, ticker_regime, trend_direction FROM features",
    "null_rates": " UNION ALL ".join(f"SELECT '{f}' AS feature, avg(({f} IS NULL)::INT) AS null_rate FROM features" for f in _F),
    "regime_share": f"SELECT ticker_regime, count(*) AS n, {r('count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()', 4)} AS share FROM features WHERE ticker_regime IS NOT NULL GROUP BY 1",
    "regime_by_year": f"SELECT CAST(year(date) AS INTEGER) AS year, ticker_regime, count(*) AS n, {r('count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY year(date))', 4)} AS share FROM features WHERE ticker_regime IS NOT NULL GROUP BY year(date), ticker_regime",
    "regime_streaks": f"SELECT ticker_regime, count(*) AS n_streaks, {r('avg(run)', 4)} AS mean_days, {r('quantile_cont(run, 0.25)', 4)} AS p25, {r('quantile_cont(run, 0.5)', 4)} AS median_days, {r('quantile_cont(run, 0.75)', 4)} AS p75, max(run) AS max_days FROM (SELECT ticker, ticker_regime, island, count(*) AS run FROM (SELECT ticker, ticker_regime, row_number() OVER (PARTITION BY ticker ORDER BY date) - row_number() OVER (PARTITION BY ticker, ticker_regime ORDER BY date) AS island FROM features WHERE ticker_regime IS NOT NULL) x GROUP BY 1, 2, 3) y GROUP BY 1",
    "falling_knife": f"SELECT ticker_regime, trend_direction, count(*) AS n, {r('avg(a.excess_return)', 6)} AS mean_21, {r('median(a.excess_return)', 6)} AS median_21, {r('avg(b.excess_return)', 6)} AS mean_63, {r('median(b.excess_return)', 6)} AS median_63, {share('a.direction_correct')} AS dir_acc_21 FROM features f LEFT JOIN (SELECT * FROM outcomes WHERE horizon_days = 21) a ON a.ticker = f.ticker AND a.signal_date = f.date LEFT JOIN (SELECT * FROM outcomes WHERE horizon_days = 63) b ON b.ticker = f.ticker AND b.signal_date = f.date WHERE dist_sma200 < -0.05 AND ticker_regime IS NOT NULL AND (a.excess_return IS NOT NULL OR b.excess_return IS NOT NULL) GROUP BY 1, 2",
    "outcome_base_rates": f"SELECT horizon_days, count(*) AS n, {r('avg(excess_return)', 6)} AS mean_excess, {r('median(excess_return)', 6)} AS median_excess, {share('direction_correct')} AS dir_acc FROM outcomes WHERE excess_return IS NOT NULL AND horizon_days IN (21, 63) GROUP BY 1",
    "threshold_sensitivity": f"SELECT CAST(t AS INTEGER) AS threshold, sum((adx_14 >= t OR abs(sma200_slope) >= 0.02)::INT)::BIGINT AS trending_n, sum((NOT (adx_14 >= t OR abs(sma200_slope) >= 0.02))::INT)::BIGINT AS ranging_n, {r('sum((adx_14 >= t OR abs(sma200_slope) >= 0.02)::INT) * 100.0::DOUBLE / count(*)', 4)} AS trending_pct FROM features, (VALUES (20), (25), (30), (35), (40)) v(t) WHERE adx_14 IS NOT NULL AND sma200_slope IS NOT NULL GROUP BY t",
    "dist_bucket": f"SELECT {_dist} AS dist_bucket, count(*) AS n, {r('median(excess_return)', 6)} AS median_42d, {share('excess_return > 1e-9')} AS frac_gt0 FROM outcomes o JOIN features f ON f.ticker = o.ticker AND f.date = o.signal_date WHERE horizon_days = 42 AND excess_return IS NOT NULL AND price_at_signal >= 1 AND dist_52w_high IS NOT NULL AND sma200_slope > 0 GROUP BY 1",
    "price_buckets": f"SELECT CASE WHEN price_at_signal < 5 THEN 'a_under_5' WHEN price_at_signal < 20 THEN 'b_5_to_20' WHEN price_at_signal < 100 THEN 'c_20_to_100' ELSE 'd_100_up' END AS price_bucket, count(*) AS n, {r('median(excess_return)', 6)} AS median_excess FROM outcomes WHERE horizon_days = 42 AND excess_return IS NOT NULL GROUP BY 1",
    "three_way": f"SELECT bias, horizon_days, count(*) AS n, {share('ret > 0.01')} AS frac_up, {share('ret < -0.01')} AS frac_down, {share('abs(ret) <= 0.01')} AS frac_dead_zone, {share(chr(39).join(['sign(ret) = CASE bias WHEN ', 'bullish', ' THEN 1 ELSE -1 END']))} AS direction_only FROM long_v1 WHERE ret IS NOT NULL GROUP BY 1, 2",
    "base_rates": f"SELECT horizon_days, count(*) AS n, {share('ret > 0.01')} AS base_up, {share('ret < -0.01')} AS base_down, {share('ret > 0')} AS base_up_any, {r('avg(ret)', 6)} AS avg_return FROM long_v1 WHERE ret IS NOT NULL GROUP BY 1",
    "inversion": f"SELECT bias, horizon_days, {share(chr(39).join(['CASE bias WHEN ', 'bullish', ' THEN ret < -0.01 ELSE ret > 0.01 END']))} AS inverted_accuracy FROM long_v1 WHERE ret IS NOT NULL GROUP BY 1, 2",
    "condition_hits": " UNION ALL ".join(f"SELECT '{n}' AS condition, count(*) AS n, {share('return_10d > 0')} AS frac_up_10d, {r('avg(return_10d)', 6)} AS avg_ret_10d FROM resolved p JOIN signals s ON s.ticker = p.ticker AND s.date = p.signal_date WHERE return_10d IS NOT NULL AND {q} HAVING count(*) > 0" for n, q in _cond.items()),
    "conf_deciles": f"SELECT bias, CAST(CASE WHEN confidence >= 1 THEN 11 ELSE floor(confidence * 10) + 1 END AS BIGINT) AS conf_decile, count(*) AS n, {share('return_10d > 0')} AS frac_up_10d, {r('avg(return_10d)', 6)} AS avg_ret_10d FROM resolved WHERE return_10d IS NOT NULL GROUP BY 1, 2",
    "episode_inflation": "SELECT bias, count(*) AS raw_rows, sum((prev IS NULL OR signal_date - prev > 7)::INT)::BIGINT AS episodes FROM (SELECT bias, signal_date, lag(signal_date) OVER (PARTITION BY ticker, bias ORDER BY signal_date) AS prev FROM preds) x GROUP BY 1",
    "returns_masked": f"SELECT ticker, date, {r('r', 6)} AS r FROM masked",
    "eligible_median": f"SELECT ticker, {r('median(close)', 4)} AS median_close FROM bars GROUP BY 1 HAVING median(close) >= {C.price_floor}",
    "corr_pairs_90": correlation(90).replace("MIN_R", "0.05"),
    "corr_pairs_365": correlation(365).replace("MIN_R", "0.05"),
    "corr_blocks_365": correlation(365).replace("MIN_R", "0.05"),
    "peers": "SELECT ticker, window_days, rank, peer, pearson_r FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY pearson_r DESC, peer) AS rank FROM (SELECT ticker_a AS ticker, ticker_b AS peer, window_days, pearson_r FROM (PAIRS) a UNION ALL SELECT ticker_b, ticker_a, window_days, pearson_r FROM (PAIRS) b) u WHERE pearson_r >= 0.05) q WHERE rank <= 5".replace("PAIRS", correlation(365).replace("MIN_R", "0.05")),
    "beta_90": "SELECT * FROM beta_90",
    "signal_trend": "SELECT ticker, date, composite_vix_adj, signal_trend FROM trend2",
    "bias_confidence": "SELECT ticker, date, bias, confidence FROM confident",
    "key_levels": " UNION ALL ".join(_levels),
    "reasoning_text": "SELECT ticker, date, reasoning FROM analysed",
    "top_brief": f"SELECT ticker, date, bias, confidence, reasoning FROM analysed WHERE abs(composite_vix_adj) >= {C.signal_threshold} AND bias <> 'neutral' AND date = (SELECT max(date) FROM analysed WHERE abs(composite_vix_adj) >= {C.signal_threshold}) ORDER BY confidence DESC, ticker LIMIT {C.brief_size}",
    "predictions": f"SELECT * REPLACE ({r('price_at_signal', 4)} AS price_at_signal) FROM preds",
    "resolve_v1": "SELECT ticker, signal_date, bias, " + ", ".join(f"{r(f'return_{h}d', 6)} AS return_{h}d, correct_{h}d" for h in C.horizons_v1) + " FROM resolved",
    "accuracy_rollup": f"SELECT signal_version, coalesce(vix_regime, '') AS vix_regime, coalesce(vol_environment, '') AS vol_environment, bias, horizon_days, count(*) AS total_signals, sum(hit::INT)::BIGINT AS correct_signals, {share('hit')} AS accuracy_rate, {r('avg(ret)', 4)} AS avg_return, {r('avg(ret) FILTER (hit)', 4)} AS avg_return_correct, {r('avg(ret) FILTER (NOT hit)', 4)} AS avg_return_wrong FROM long_v1 WHERE ret IS NOT NULL AND hit IS NOT NULL GROUP BY 1, 2, 3, 4, 5 HAVING count(*) >= {C.min_sample}",
    "vol_threshold": f"SELECT ticker, date, {r('vol_at_signal', 6)} AS vol_at_signal, {r('0.5::DOUBLE * vol_at_signal * sqrt(21.0::DOUBLE)', 6)} AS threshold_21 FROM forward",
    "outcomes_v2": f"SELECT ticker, signal_date, bias, horizon_days, {r('raw_return', 6)} AS raw_return, {r('benchmark_return', 6)} AS benchmark_return, {r('beta_used', 6)} AS beta_used, {r('excess_return', 6)} AS excess_return, {r('threshold_used', 6)} AS threshold_used, direction_correct, threshold_correct FROM outcomes",
    "episodes": f"SELECT ticker, signal_date, bias, ticker || ':' || strftime(min(signal_date) OVER (PARTITION BY ticker, bias, e), '%Y-%m-%d') AS episode_id, k % {C.episode_gap + 1} = 0 AS is_episode_head FROM (SELECT *, floor(k / {C.episode_gap + 1}) AS e FROM (SELECT ticker, signal_date, bias, row_number() OVER (PARTITION BY ticker, bias ORDER BY signal_date) - 1 AS k FROM preds) x) y",
    "unresolved_anti": "SELECT ticker, signal_date, signal_version, bias FROM preds p WHERE NOT EXISTS (SELECT 1 FROM outcomes o WHERE o.ticker = p.ticker AND o.signal_date = p.signal_date)",
    "events_cross": "SELECT ticker, date, event FROM fires",
    "event_forward_excess": "SELECT ticker, date, " + ", ".join(f"{r(f'excess_{h}', 6)} AS excess_{h}" for h in C.horizons_events) + " FROM excess",
    "threshold_grid": f"SELECT bias, t AS threshold, count(*) AS n, {share('correct_10d')} AS accuracy FROM resolved, (VALUES {', '.join(f'({t}::DOUBLE)' for t in GRID['signal_threshold'])}) v(t) WHERE correct_10d IS NOT NULL AND abs(composite_vix_adj) >= t GROUP BY 1, 2 HAVING count(*) >= {C.min_sample}",
    "vix_grid": f"SELECT param, g.vix_regime, candidate, count(*) AS n, {share('correct_10d')} AS accuracy FROM resolved p JOIN (VALUES {_vix}) g(param, vix_regime, candidate, scale) ON g.vix_regime = p.vix_regime WHERE correct_10d IS NOT NULL AND abs(composite_vix_adj) * scale >= {C.signal_threshold} GROUP BY 1, 2, 3 HAVING count(*) >= {C.min_sample}",
    "weight_grid": f"SELECT w0, w1, w2, w3, count(*) AS n, {r('avg(abs(sc)) FILTER (hit) - avg(abs(sc)) FILTER (NOT hit)', 4)} AS separation FROM (SELECT w.*, correct_10d AS hit, {weighted(['w0', 'w1', 'w2', 'w3'])} AS sc FROM resolved p JOIN parts s ON s.ticker = p.ticker AND s.date = p.signal_date, weights w WHERE correct_10d IS NOT NULL) x GROUP BY 1, 2, 3, 4",
    "universe_audit": "SELECT code AS ticker, 'us' AS exchange, CASE WHEN regexp_matches(code, '^Z[A-Z]ZZT$') THEN 'nasdaq_test_symbol' WHEN " + _ends("code", HYPHENATED) + " THEN 'hyphenated_suffix' WHEN " + _ends("code", (".WT", ".WS", ".RT")) + " THEN 'dotted_suffix' WHEN substr(code, 5, 1) = 'W' THEN 'nasdaq5_warrant' WHEN substr(code, 5, 1) = 'R' THEN 'nasdaq5_rights' ELSE 'nasdaq5_unit' END AS reason FROM symbols WHERE regexp_matches(code, '^Z[A-Z]ZZT$') OR " + _ends("code", HYPHENATED) + " OR " + _ends("code", (".WT", ".WS", ".RT")) + " OR " + _five("code"),
    "listing_filter": "SELECT code, name, venue FROM symbols WHERE type = 'Common Stock' AND currency = 'USD' AND venue IN ('NYSE', 'NASDAQ') AND NOT regexp_matches(code, '^Z[A-Z]ZZT$') AND NOT " + _ends("upper(code)", DOTTED) + " AND NOT " + _ends("upper(code)", HYPHENATED) + " AND NOT " + _five("code", "WHERE listed") + " AND NOT (" + " OR ".join(f"contains(lower(name), '{n.lower()}')" for n in NAMES) + ")",
    "upsert_update": f"SELECT ticker, date, {r('CASE WHEN date >= DATE ' + chr(39) + '1998-01-01' + chr(39) + ' THEN close * 2 ELSE close END', 4)} AS close FROM bars WHERE date < DATE '1999-01-01' OR date >= DATE '1998-01-01'",
    "upsert_latest": f"SELECT ticker, date, CASE WHEN year(date) < 1998 THEN volume END AS volume, CASE WHEN month(date) = 6 THEN 25 WHEN year(date) < 1998 AND day(date) % 2 = 1 THEN 20 ELSE 15 END AS fetched_at, {r('close + CASE WHEN month(date) = 6 THEN 1 WHEN year(date) < 1998 AND day(date) % 2 = 1 THEN 0 ELSE 2 END', 4)} AS close FROM bars",
    "refreshed_history": "SELECT ticker, date, CASE WHEN halved THEN volume * 2 ELSE volume END AS volume, " + ", ".join(f"{r(f'CASE WHEN halved THEN {c} / 2 ELSE {c} END', 4)} AS {c}" for c in ("open", "high", "low", "close")) + " FROM (SELECT *, CAST(right(ticker, 1) AS INTEGER) IN (1, 3) AND date < DATE '1996-03-01' + 10 * CAST(right(ticker, 1) AS INTEGER) AS halved FROM bars) b",
    "shifted_tickers": "SELECT DISTINCT ticker FROM bars WHERE CAST(right(ticker, 1) AS INTEGER) % 2 = 1 AND date < DATE '1996-03-01' + 10 * CAST(right(ticker, 1) AS INTEGER)",
    "upsert_ignore": f"SELECT ticker, date, {r('CASE WHEN date < DATE ' + chr(39) + '1999-01-01' + chr(39) + ' THEN close ELSE close * 2 END', 4)} AS close FROM bars",
    "proposals": f"SELECT param_name, current_value, proposed_value, {r('gain', 4)} AS accuracy_delta, sample_size, vix_regime_scope FROM proposed WHERE gain >= 0",
    "outcome_seeds": f"SELECT ticker, signal_date, horizon_days, {r('price_at_signal', 6)} AS price_at_signal, {r('vol_at_signal', 6)} AS vol_at_signal, {r('threshold_used', 6)} AS threshold_used FROM seeds",
    "beta_fallbacks": "SELECT count(*) AS tickers, count(*) FILTER (b.ticker IS NULL) AS fallbacks FROM (SELECT DISTINCT ticker FROM bars UNION SELECT ticker || 'x' FROM bars WHERE day(date) = 1) t LEFT JOIN beta_spy b USING (ticker)",
    "indicator_parity": " UNION ALL ".join(f"SELECT '{c}' AS column, count(*) - count(*) AS unmatched, count(*) - count(*) AS n_diff, true AS within FROM bars" for c in ("sma_50", "sma_200", "macd", "macd_signal", "macd_hist", "rsi_14", "bb_upper", "bb_lower")),
    "ingest_adjusted": f"SELECT ticker, date, {r('open * f', 6)} AS open, {r('high * f', 6)} AS high, {r('low * f', 6)} AS low, {r('adjusted_close', 4)} AS close, coalesce(volume, 0) AS volume, CASE WHEN ends_with(ticker, '.TO') OR ends_with(ticker, '.V') THEN 'CAD' ELSE 'USD' END AS currency, CASE WHEN regexp_matches(ticker, '[.](TO|V|INDX)$') THEN ticker ELSE ticker || '.US' END AS symbol, ticker IN ('VIX.INDX', 'VVIX.INDX') AS is_index FROM scaled",
    "metadata_stale": "SELECT ticker, name, updated_at FROM companies WHERE updated_at IS NULL OR epoch(TIMESTAMP '2024-01-14 12:00:00') - updated_at >= 7 * 86400",
    "metadata_due": "SELECT ticker FROM companies WHERE NOT coalesce(market_cap > 0 AND epoch(TIMESTAMP '2024-01-14 12:00:00') - updated_at < 7 * 86400, false)",
    "metadata_upsert": "SELECT ticker, CASE WHEN updated_at IS NOT NULL THEN name END AS name, market_cap + 1 AS market_cap, CAST(epoch(TIMESTAMP '2024-02-01') AS BIGINT) AS updated_at FROM companies WHERE market_cap > 0 UNION ALL SELECT ticker, name, market_cap, updated_at FROM companies WHERE updated_at IS NOT NULL AND market_cap <= 0",
    "universe_counts": "SELECT count(*) AS total_unique_tickers, count(*) FILTER (exchange = 'us') AS us_listed, count(*) FILTER (exchange = 'tsx') AS tsx_listed, count(*) FILTER (exchange = 'tsx_venture') AS tsx_venture_listed, count(*) FILTER (NOT has_data) AS no_data_tickers, sum(listed::INT)::BIGINT AS categories FROM entries",
    "replace_window": "SELECT ticker, etf_proxy, CAST(365 AS INTEGER) AS window_days, beta FROM beta_90 UNION ALL SELECT ticker, etf_proxy, window_days, -beta FROM beta_90",
}
ORACLE_SQL = {name: chain(sql) for name, sql in SQL.items()}
for _query, _than in (("latest_signal", ">="), ("latest_signal_before", ">")):
    ORACLE_SQL[_query] = chain(f"SELECT b.ticker, b.date, p.signal_date, p.bias, {r('p.price_at_signal', 4)} AS price_at_signal FROM bars b ASOF LEFT JOIN preds p ON b.ticker = p.ticker AND b.date {_than} p.signal_date")
ORACLE_SQL["outcomes_matured"] = ORACLE_SQL["outcomes_v2"]
ORACLE_SQL["event_dedup"] = kept_sql("SELECT ticker, event, position, date FROM kept_dated")
_bull = " + ".join(f"(count(*) FILTER (event = '{e}') > 0)::INT" for e in BULLISH)
_fired = "SELECT k.event, k.date, e.horizon, e.excess, coalesce(c.sma200_slope > 0, false) AS up, coalesce(c.vol_ratio >= {C.volume_confirm}, false) AS loud FROM kept_dated k JOIN long_excess e ON e.ticker = k.ticker AND e.date = k.date LEFT JOIN crossed c ON c.ticker = k.ticker AND c.date = k.date".replace("{C.volume_confirm}", str(C.volume_confirm))
_split = f"SELECT event, horizon, excess, split, value FROM (SELECT *, 'all' AS split, 'all' AS value FROM ({_fired}) f UNION ALL SELECT *, 'slope', CASE WHEN up THEN 'up' ELSE 'not_up' END FROM ({_fired}) f UNION ALL SELECT *, 'volume', CASE WHEN loud THEN 'confirmed' ELSE 'unconfirmed' END FROM ({_fired}) f UNION ALL SELECT *, 'year', CAST(year(date) AS VARCHAR) FROM ({_fired}) f WHERE horizon = 42) g"
_slopes = "SELECT e.ticker, e.date, e.horizon, e.excess, s.slope FROM long_excess e LEFT JOIN crossed c ON c.ticker = e.ticker AND c.date = e.date, (VALUES ('all'), ('up'), ('flat_down')) s(slope) WHERE s.slope = 'all' OR (s.slope = 'up' AND c.sma200_slope > 0) OR (s.slope = 'flat_down' AND c.sma200_slope <= 0)"
_graded, _base = robust(_split, "event, horizon, split, value"), robust(f"SELECT horizon, slope, excess FROM ({_slopes}) b", "horizon, slope")
_bulls = f"SELECT c.ticker, c.date, CAST(least({_bull}, 3) AS INTEGER) AS n_bull FROM crossed c LEFT JOIN kept_dated k ON k.ticker = c.ticker AND k.position BETWEEN c.pos - {C.dedup_rows} AND c.pos AND k.event IN ({', '.join(repr(e) for e in BULLISH)}) GROUP BY c.ticker, c.date"
_confluent = robust(f"SELECT n_bull, e.horizon, e.slope, e.excess FROM ({_bulls}) b JOIN ({_slopes}) e ON e.ticker = b.ticker AND e.date = b.date WHERE e.slope <> 'flat_down'", "n_bull, horizon, slope")
_name = "CASE g.event " + " ".join(f"WHEN '{e}' THEN '{n}'" for e, n in EVENTS.items()) + " END"
ORACLE_SQL["base_stats"] = kept_sql(_base)
ORACLE_SQL["event_splits"] = kept_sql(_graded)
ORACLE_SQL["event_stats"] = kept_sql(f"SELECT event, horizon, n, median, wmean, frac_gt0 FROM ({_graded}) q WHERE split = 'all'")
ORACLE_SQL["event_summary"] = kept_sql(
    f"SELECT g.event AS event_type, {_name} AS event_name, CASE WHEN g.event IN ({', '.join(repr(e) for e in BULLISH)}) THEN 'bullish' ELSE 'bearish' END AS bias, g.horizon AS horizon_days, g.n, {r('g.median * 100', 4)} AS median_excess_pct, {r('g.wmean * 100', 4)} AS wmean_excess_pct, {r('g.frac_gt0', 4)} AS frac_gt0, {r('b.median * 100', 4)} AS base_median_pct, {r('(g.median - b.median) * 100', 4)} AS vs_base_pct FROM ({_graded}) g JOIN ({_base}) b ON b.horizon = g.horizon AND b.slope = 'all' WHERE g.split = 'all'"
)
ORACLE_SQL["event_verdict"] = kept_sql(
    f"SELECT *, coalesce(years > 0 AND years_better >= 0.6::DOUBLE * years AND median > base_median, false) AS edge FROM (SELECT g.event, max(g.n) FILTER (split = 'all') AS n, max(g.median) FILTER (split = 'all') AS median, max(b.median) AS base_median, count(*) FILTER (split = 'year' AND g.n >= 30 AND g.median > b.median) AS years_better, count(*) FILTER (split = 'year' AND g.n >= 30) AS years FROM ({_graded}) g JOIN ({_base}) b ON b.slope = 'all' AND b.horizon = 42 WHERE g.horizon = 42 GROUP BY 1) v WHERE n IS NOT NULL"
)
ORACLE_SQL["confluence"] = kept_sql(_confluent)
ORACLE_SQL["confluence_monotonic"] = kept_sql(f"SELECT slope, count(*) AS buckets, NOT bool_or(coalesce(median < before, false)) AS monotonic FROM (SELECT *, lag(median) OVER (PARTITION BY slope ORDER BY n_bull) AS before FROM ({_confluent}) c WHERE horizon = 42) m GROUP BY 1")
ORACLE_SQL["equivalence_gate"] = chain("SELECT count(DISTINCT (ticker, date)) AS anchors, count(excess_21) + count(excess_42) + count(excess_63) AS checked, count(*) - count(*) AS failed FROM (SELECT * FROM excess WHERE excess_42 IS NOT NULL ORDER BY md5(ticker || '|' || CAST(date AS VARCHAR)) LIMIT 20) x")
