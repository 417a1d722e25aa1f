"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code, directly from the semantics: ticks are
ordered by ``(epoch ms, event_id)`` for E and ``(epoch ms, o_orderkey)`` for D.
Doubles are rounded to 6 decimals, like the Spark side.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- shared CTEs

E_TICKS = """e_ticks AS (
  SELECT event_type AS coin_id, epoch_us(ts) // 1000 AS event_ms, CAST(ts AS DATE) AS event_date,
         event_id, value AS price_usd, value * user_id AS volume, value * 100.0 AS market_cap
  FROM events)"""

E_BARS = """e_bars AS (
  SELECT coin_id, event_date,
         arg_min(price_usd, (event_ms, event_id)) AS open_price_usd,
         arg_max(price_usd, (event_ms, event_id)) AS close_price_usd,
         avg(price_usd) AS avg_price_usd, max(price_usd) AS max_price_usd,
         min(price_usd) AS min_price_usd, count(price_usd) AS samples_per_day
  FROM e_ticks WHERE price_usd IS NOT NULL GROUP BY coin_id, event_date)"""

E_METRICS = """e_metrics AS (
  SELECT b.*, coalesce(v.volume_usd, 0.0) AS volume_usd, coalesce(v.market_cap_usd, 0.0) AS market_cap_usd
  FROM e_bars b LEFT JOIN (
    SELECT coin_id, event_date, avg(volume) AS volume_usd, avg(market_cap) AS market_cap_usd
    FROM e_ticks GROUP BY coin_id, event_date) v USING (coin_id, event_date))"""

BAR_COLS = """round(open_price_usd, 6) AS open_price_usd, round(close_price_usd, 6) AS close_price_usd,
  round(avg_price_usd, 6) AS avg_price_usd, round(max_price_usd, 6) AS max_price_usd,
  round(min_price_usd, 6) AS min_price_usd, samples_per_day"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- stage 1: E

ORACLE["tick_points"] = with_(E_TICKS) + """
SELECT coin_id, event_ms, event_date, round(price_usd, 6) AS price_usd FROM e_ticks
WHERE price_usd IS NOT NULL"""

ORACLE["daily_bars"] = with_(E_TICKS, E_BARS) + f"SELECT coin_id, event_date, {BAR_COLS} FROM e_bars"

ORACLE["open_close_window"] = ORACLE["daily_bars"]

ORACLE["daily_volume"] = with_(E_TICKS) + """
SELECT coin_id, event_date, round(avg(volume), 6) AS volume_usd FROM e_ticks GROUP BY coin_id, event_date"""

ORACLE["daily_market_cap"] = with_(E_TICKS) + """
SELECT coin_id, event_date, round(avg(market_cap), 6) AS market_cap_usd FROM e_ticks GROUP BY coin_id, event_date"""

ORACLE["daily_metrics"] = with_(E_TICKS, E_BARS, E_METRICS) + f"""
SELECT coin_id, event_date, {BAR_COLS}, round(volume_usd, 6) AS volume_usd,
  round(market_cap_usd, 6) AS market_cap_usd FROM e_metrics"""


# ---------------------------------------------------------------- stage 2: tables (D base)

D_TICKS = """d_ticks AS (
  SELECT o_orderpriority AS coin_id, CAST(o_orderdate AS DATE) AS event_date,
         epoch_us(o_orderdate) // 1000 AS event_ms, o_orderkey, o_totalprice AS price_usd
  FROM orders WHERE o_totalprice IS NOT NULL)"""

D_BARS = """d_bars AS (
  SELECT coin_id, event_date,
         arg_min(price_usd, (event_ms, o_orderkey)) AS open_price_usd,
         arg_max(price_usd, (event_ms, o_orderkey)) AS close_price_usd,
         avg(price_usd) AS avg_price_usd, max(price_usd) AS max_price_usd,
         min(price_usd) AS min_price_usd, count(*) AS samples_per_day
  FROM d_ticks GROUP BY coin_id, event_date)"""

D_MEAS = """d_meas AS (
  SELECT o.o_orderpriority AS coin_id, CAST(l.l_shipdate AS DATE) AS event_date,
         avg(round(l.l_extendedprice)) AS volume_usd,
         avg(round(l.l_extendedprice) * l.l_quantity) AS market_cap_usd
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)"""

D = """d AS (
  SELECT b.coin_id, substr(b.coin_id, 1, 1) AS coin_symbol,
         substr(b.coin_id, strpos(b.coin_id, '-') + 1) AS coin_name, b.event_date,
         b.open_price_usd, b.close_price_usd, b.avg_price_usd, b.max_price_usd, b.min_price_usd,
         coalesce(m.volume_usd, 0.0::DOUBLE) AS volume_usd,
         coalesce(m.market_cap_usd, 0.0::DOUBLE) AS market_cap_usd, b.samples_per_day
  FROM d_bars b LEFT JOIN d_meas m ON b.coin_id = m.coin_id AND b.event_date = m.event_date)"""

D_ALL = (D_TICKS, D_BARS, D_MEAS, D)

SERIES_SEL = """coin_id, coin_symbol, coin_name, event_date,
  round(open_price_usd, 6) AS open_price_usd, round(close_price_usd, 6) AS close_price_usd,
  round(avg_price_usd, 6) AS avg_price_usd, round(max_price_usd, 6) AS max_price_usd,
  round(min_price_usd, 6) AS min_price_usd, round(volume_usd, 6) AS volume_usd,
  round(market_cap_usd, 6) AS market_cap_usd, samples_per_day"""

COIN = "1-URGENT"
SYMBOLS = ["1", "2", "3", "4", "5"]

ORACLE["enrich_dim"] = with_(*D_ALL) + f"SELECT {SERIES_SEL} FROM d"
ORACLE["scan_parquet"] = ORACLE["enrich_dim"]

ORACLE["fallback_source"] = with_(*D_ALL) + f"""
SELECT {SERIES_SEL} FROM d WHERE coin_id = 'bitcoin'
UNION ALL
SELECT 'bitcoin' AS coin_id, 'BTC' AS coin_symbol, 'Bitcoin' AS coin_name, event_date,
  round(open_price_usd, 6) AS open_price_usd, round(close_price_usd, 6) AS close_price_usd,
  round(avg_price_usd, 6) AS avg_price_usd, round(max_price_usd, 6) AS max_price_usd,
  round(min_price_usd, 6) AS min_price_usd, 0.0::DOUBLE AS volume_usd, 0.0::DOUBLE AS market_cap_usd,
  samples_per_day
FROM d WHERE coin_id = '{COIN}' AND NOT EXISTS (SELECT 1 FROM d WHERE coin_id = 'bitcoin')"""

S_POINTS = """s_points AS (
  SELECT CAST(ts AS DATE) AS event_date, CAST(json_extract_string(props, '$.k') AS INTEGER) AS value,
         event_type AS value_classification, event_id
  FROM events)"""

S_TABLE = """s_table AS (
  SELECT event_date, arg_max(value, event_id) AS value,
         arg_max(value_classification, event_id) AS value_classification
  FROM s_points GROUP BY event_date)"""

ORACLE["sentiment_points"] = with_(S_POINTS) + "SELECT event_date, value, value_classification FROM s_points"

ORACLE["upsert_sentiment"] = with_(S_POINTS) + """,
stored AS (SELECT event_date, arg_min(value, event_id) AS value,
                  arg_min(value_classification, event_id) AS value_classification
           FROM s_points WHERE day(event_date) <= 20 GROUP BY event_date),
incoming AS (SELECT event_date, arg_max(value, event_id) AS value,
                    arg_max(value_classification, event_id) AS value_classification
             FROM s_points WHERE day(event_date) >= 15 GROUP BY event_date)
SELECT coalesce(i.event_date, s.event_date) AS event_date,
       CASE WHEN i.event_date IS NOT NULL THEN i.value ELSE s.value END AS value,
       CASE WHEN i.event_date IS NOT NULL THEN i.value_classification ELSE s.value_classification END
         AS value_classification
FROM stored s FULL OUTER JOIN incoming i ON s.event_date = i.event_date"""

ORACLE["raw_latest"] = """
SELECT event_type AS coin_id, CAST(ts AS DATE) AS logical_date, arg_max(props, (ts, event_id)) AS payload
FROM events GROUP BY 1, 2"""

ORACLE["upsert_daily"] = with_(E_TICKS, E_BARS, E_METRICS) + """,
stored AS (SELECT coin_id, upper(coin_id) AS coin_symbol, upper(coin_id) AS coin_name, event_date,
                  open_price_usd, close_price_usd, avg_price_usd, max_price_usd, min_price_usd,
                  samples_per_day, 0.0::DOUBLE AS volume_usd, 0.0::DOUBLE AS market_cap_usd
           FROM e_bars WHERE day(event_date) <= 20),
incoming AS (SELECT coin_id, coin_id AS coin_symbol, coin_id AS coin_name, event_date,
                    open_price_usd, close_price_usd, avg_price_usd, max_price_usd, min_price_usd,
                    samples_per_day, volume_usd, market_cap_usd
             FROM e_metrics WHERE day(event_date) >= 15),
merged AS (
  SELECT coalesce(i.coin_id, s.coin_id) AS coin_id,
         CASE WHEN s.coin_id IS NOT NULL THEN s.coin_symbol ELSE i.coin_symbol END AS coin_symbol,
         CASE WHEN s.coin_id IS NOT NULL THEN s.coin_name ELSE i.coin_name END AS coin_name,
         coalesce(i.event_date, s.event_date) AS event_date,
         CASE WHEN i.coin_id IS NOT NULL THEN i.open_price_usd ELSE s.open_price_usd END AS open_price_usd,
         CASE WHEN i.coin_id IS NOT NULL THEN i.close_price_usd ELSE s.close_price_usd END AS close_price_usd,
         CASE WHEN i.coin_id IS NOT NULL THEN i.avg_price_usd ELSE s.avg_price_usd END AS avg_price_usd,
         CASE WHEN i.coin_id IS NOT NULL THEN i.max_price_usd ELSE s.max_price_usd END AS max_price_usd,
         CASE WHEN i.coin_id IS NOT NULL THEN i.min_price_usd ELSE s.min_price_usd END AS min_price_usd,
         CASE WHEN i.coin_id IS NOT NULL THEN i.volume_usd ELSE s.volume_usd END AS volume_usd,
         CASE WHEN i.coin_id IS NOT NULL THEN i.market_cap_usd ELSE s.market_cap_usd END AS market_cap_usd,
         CASE WHEN i.coin_id IS NOT NULL THEN i.samples_per_day ELSE s.samples_per_day END AS samples_per_day
  FROM stored s FULL OUTER JOIN incoming i ON s.coin_id = i.coin_id AND s.event_date = i.event_date)
SELECT """ + SERIES_SEL + " FROM merged"

# ---------------------------------------------------------------- files and tables

ORACLE["table_upsert"] = ORACLE["upsert_daily"].replace("day(event_date) >= 15)", "day(event_date) >= 15 AND coin_id <> 'purchase')")
ORACLE["table_one_coin"] = with_(*D_ALL) + f"SELECT {SERIES_SEL} FROM d WHERE coin_id = '{COIN}'"
ORACLE["csv_round_trip"] = ORACLE["enrich_dim"]

ORACLE["refresh_pulls"] = f"""WITH t AS (
  SELECT event_type AS coin_id, event_id // 1024 AS pull, epoch_us(ts) // 1000 AS event_ms, CAST(ts AS DATE) AS event_date,
         event_id, value AS price, value * user_id AS volume, value * 100.0 AS cap
  FROM events),
bars AS (
  SELECT coin_id, pull, event_date, arg_min(price, (event_ms, event_id)) AS open_price_usd,
         arg_max(price, (event_ms, event_id)) AS close_price_usd, avg(price) AS avg_price_usd,
         max(price) AS max_price_usd, min(price) AS min_price_usd, count(price) AS samples_per_day
  FROM t WHERE price IS NOT NULL GROUP BY ALL),
means AS (SELECT coin_id, pull, event_date, avg(volume) AS volume_usd, avg(cap) AS market_cap_usd FROM t GROUP BY ALL),
newest AS (SELECT coin_id, event_date, max(pull) AS pull FROM bars GROUP BY ALL),
d AS (SELECT b.* EXCLUDE (pull), coalesce(m.volume_usd, 0.0) AS volume_usd, coalesce(m.market_cap_usd, 0.0) AS market_cap_usd,
             upper(coin_id) AS coin_symbol, coin_id AS coin_name
      FROM bars b JOIN newest USING (coin_id, event_date, pull) JOIN means m USING (coin_id, event_date, pull))
SELECT {SERIES_SEL} FROM d"""

ORACLE["json_payload_scan"] = """
SELECT event_type || '_' || CAST(DATE '2024-01-01' + CAST(pull AS INTEGER) AS VARCHAR) || '.json' AS file_name, event_type AS coin_id,
  DATE '2024-01-01' + CAST(pull AS INTEGER) AS logical_date,
  CASE WHEN pull % 10 <> 3 THEN count(*) END AS n_prices, CASE WHEN pull % 10 <> 3 THEN count(*) END AS n_caps,
  CASE WHEN pull % 10 <> 3 THEN count(*) END AS n_volumes, CASE WHEN pull % 10 <> 3 THEN round(min(value), 6) END AS min_price,
  CASE WHEN pull % 10 <> 3 THEN round(max(value), 6) END AS max_price, CASE WHEN pull % 10 = 3 THEN 'malformed json' END AS reason
FROM (SELECT *, event_id // 1024 AS pull FROM events) GROUP BY event_type, pull"""

ORACLE["refresh_sentiment"] = """
SELECT CAST(ts AS DATE) AS event_date, CAST(arg_max(props ->> '$.k', ((event_id // 1024) % 2, event_id)) AS INTEGER) AS value,
  arg_max(event_type, ((event_id // 1024) % 2, event_id)) AS value_classification
FROM events GROUP BY 1"""

# ---------------------------------------------------------------- stage 3: serving

ORACLE["series_for_coin"] = with_(*D_ALL) + f"SELECT {SERIES_SEL} FROM d WHERE coin_id = '{COIN}'"

ORACLE["date_range"] = with_(*D_ALL) + f"""SELECT {SERIES_SEL} FROM d
WHERE coin_id = '{COIN}' AND event_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"""

ORACLE["price_series"] = with_(*D_ALL) + f"""
SELECT event_date AS time, round(close_price_usd, 6) AS value, coin_symbol AS metric
FROM d WHERE coin_id = '{COIN}'"""

ORACLE["volume_series"] = with_(*D_ALL) + f"""
SELECT event_date AS time, round(volume_usd, 6) AS value FROM d WHERE coin_id = '{COIN}' AND volume_usd > 0"""

ORACLE["intraday_volatility"] = with_(*D_ALL) + f"""
SELECT event_date AS time, round((max_price_usd - min_price_usd) / avg_price_usd * 100.0::DOUBLE, 6) AS value
FROM d WHERE coin_id = '{COIN}'"""

ORACLE["all_series"] = with_(*D_ALL) + """
SELECT coin_id, coin_symbol, event_date, round(close_price_usd, 6) AS close_price_usd FROM d"""

ORACLE["compare_series"] = with_(*D_ALL) + """
SELECT event_date AS time, round(close_price_usd, 6) AS value, coin_symbol AS metric FROM d"""

ORACLE["candles"] = with_(*D_ALL) + f"""
SELECT event_date, round(open_price_usd, 6) AS open, round(max_price_usd, 6) AS high,
       round(min_price_usd, 6) AS low, round(close_price_usd, 6) AS close
FROM d WHERE coin_id = '{COIN}'"""

ORACLE["band"] = with_(*D_ALL) + f"""
SELECT event_date, round(max_price_usd, 6) AS max_price_usd, round(min_price_usd, 6) AS min_price_usd,
       round(avg_price_usd, 6) AS avg_price_usd
FROM d WHERE coin_id = '{COIN}'"""

ORACLE["close_vs_avg"] = with_(*D_ALL) + f"""
SELECT event_date, round(close_price_usd, 6) AS close_price_usd, round(avg_price_usd, 6) AS avg_price_usd
FROM d WHERE coin_id = '{COIN}'"""

ORACLE["display_table"] = with_(*D_ALL) + f"""
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, round(open_price_usd, 6) AS open_price_usd,
       round(close_price_usd, 6) AS close_price_usd, round(avg_price_usd, 6) AS avg_price_usd,
       round(max_price_usd, 6) AS max_price_usd, round(min_price_usd, 6) AS min_price_usd,
       round(volume_usd, 6) AS volume_usd
FROM d WHERE coin_id = '{COIN}'"""

ORACLE["current_prices"] = with_(*D_ALL) + """
SELECT coin_symbol AS metric, round(close_price_usd, 6) AS value FROM d
WHERE event_date = (SELECT max(event_date) FROM d)"""

ORACLE["coverage"] = with_(*D_ALL) + """
SELECT coin_id, count(*) AS n_rows, min(event_date) AS first_date, max(event_date) AS last_date
FROM d GROUP BY coin_id"""

ORACLE["coin_count"] = with_(*D_ALL) + """
SELECT count(DISTINCT coin_id) AS n_coins, count(DISTINCT coin_id) >= 2 AS enough FROM d"""

ORACLE["selection_bounds"] = with_(*D_ALL) + f"""
SELECT min(event_date) AS min_date, max(event_date) AS max_date, count(*) AS n_days FROM d
WHERE coin_id = '{COIN}' AND event_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"""

ORACLE["series_reducers"] = with_(*D_ALL) + """
SELECT coin_symbol, round(arg_max(close_price_usd, event_date), 6) AS last_close,
       round(avg(close_price_usd), 6) AS mean_close,
       round(arg_max(volume_usd, event_date) FILTER (WHERE volume_usd IS NOT NULL), 6) AS last_volume
FROM d GROUP BY coin_symbol"""

ORACLE["kpi"] = with_(*D_ALL) + """,
k AS (SELECT *, coalesce(lag(close_price_usd) OVER w, close_price_usd) AS prev_close,
             lead(event_date) OVER w IS NULL AS is_last
      FROM d WINDOW w AS (PARTITION BY coin_id ORDER BY event_date))
SELECT coin_id, event_date, round(close_price_usd, 6) AS price,
       round(close_price_usd - prev_close, 6) AS price_delta,
       round(CASE WHEN prev_close > 0 THEN (close_price_usd - prev_close) / prev_close * 100.0::DOUBLE
                  ELSE 0.0::DOUBLE END, 6) AS price_pct,
       round(max_price_usd, 6) AS high, round(min_price_usd, 6) AS low,
       round((max_price_usd - min_price_usd) / avg_price_usd * 100.0::DOUBLE, 6) AS volatility_pct,
       round(CASE WHEN volume_usd > 0 THEN volume_usd END, 6) AS volume_shown,
       round(CASE WHEN volume_usd > 0 AND market_cap_usd > 0 THEN market_cap_usd END, 6) AS market_cap_shown
FROM k WHERE is_last"""

ORACLE["latest_row"] = with_(*D_ALL) + f"""
SELECT {SERIES_SEL} FROM d QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY event_date DESC) = 1"""

ORACLE["sentiment_latest"] = with_(S_POINTS, S_TABLE) + """
SELECT value FROM s_table ORDER BY event_date DESC LIMIT 1"""

ORACLE["sentiment_last30"] = with_(S_POINTS, S_TABLE) + """
SELECT event_date, value, value_classification FROM s_table ORDER BY event_date DESC LIMIT 30"""

ORACLE["sentiment_band"] = with_(S_POINTS, S_TABLE) + """
SELECT event_date, value, CAST(CASE WHEN value < 25 THEN 0 WHEN value < 50 THEN 1 WHEN value < 75 THEN 2
                                    ELSE 3 END AS INTEGER) AS band
FROM s_table"""

# ---------------------------------------------------------------- stage 4: compare

_PIVOT_COLS = ",\n  ".join(
    f"round(max(CASE WHEN coin_symbol = '{s}' THEN close_price_usd END), 6) AS \"{s}\"" for s in SYMBOLS)

ORACLE["pivot_close"] = with_(*D_ALL) + f"SELECT event_date,\n  {_PIVOT_COLS}\nFROM d GROUP BY event_date"

_SYMS = "syms AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}')" for s in SYMBOLS) + ") t(coin_symbol))"

ORACLE["corr_matrix"] = with_(*D_ALL, _SYMS) + """,
stats AS (
  SELECT a.coin_symbol AS symbol_a, b.coin_symbol AS symbol_b,
         covar_pop(a.close_price_usd, b.close_price_usd)
           / nullif(stddev_pop(a.close_price_usd) * stddev_pop(b.close_price_usd), 0) AS corr
  FROM d a JOIN d b ON a.event_date = b.event_date GROUP BY 1, 2)
SELECT x.coin_symbol AS symbol_a, y.coin_symbol AS symbol_b, round(s.corr, 6) AS corr
FROM syms x CROSS JOIN syms y
LEFT JOIN stats s ON s.symbol_a = x.coin_symbol AND s.symbol_b = y.coin_symbol"""

ORACLE["normalized"] = with_(*D_ALL, _SYMS) + """,
grid AS (SELECT DISTINCT d.event_date, syms.coin_symbol FROM d CROSS JOIN syms),
base AS (SELECT coin_symbol, close_price_usd AS base FROM d WHERE event_date = (SELECT min(event_date) FROM d))
SELECT g.event_date, g.coin_symbol, round((x.close_price_usd - b.base) / b.base * 100.0::DOUBLE, 6) AS value
FROM grid g
LEFT JOIN d x ON x.event_date = g.event_date AND x.coin_symbol = g.coin_symbol
LEFT JOIN base b ON b.coin_symbol = g.coin_symbol"""


# ---------------------------------------------------------------- stage 5: features

_W = "PARTITION BY coin_id ORDER BY event_date"
_C = "close_price_usd"
DBL = "::DOUBLE"


def _frame(n):
    return f"({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _roll(fn, c, n):
    return f"(CASE WHEN count({c}) OVER {_frame(n)} = {n} THEN {fn}({c}) OVER {_frame(n)} END)"


def _lag(c, n):
    return f"lag({c}, {n}) OVER ({_W})"


def _lead(c, n):
    return f"lead({c}, {n}) OVER ({_W})"


def _div(a, b):
    return f"(({a}) / nullif({b}, 0))"


def _pct(c, n):
    return f"({_div(c, _lag(c, n))} - 1.0{DBL})"


def _r(expr, name):
    return f"round({expr}, 6) AS {name}"


LAGS = [1, 2, 3, 5, 7, 14, 21, 30]
MAS = [3, 7, 14, 21, 30]
VOLS = [7, 14, 30]


def _ret_name(p):
    return "daily_return" if p == 1 else f"return_{p}d"


def lag_sql():
    return [_r(_lag(_C, n), f"price_lag_{n}") for n in LAGS]


def ma_sql():
    out = []
    for n in MAS:
        out += [_r(_roll("avg", _C, n), f"ma_{n}"), _r(_div(_C, _roll("avg", _C, n)), f"ma_{n}_ratio")]
    return out


def vol_sql(pct=False):
    out = []
    for n in VOLS:
        out.append(_r(_roll("stddev_samp", _C, n), f"volatility_{n}"))
        if pct:
            out.append(_r(f"{_div(_roll('stddev_samp', _C, n), _C)} * 100.0{DBL}", f"volatility_{n}_pct"))
    return out


def ret_sql(periods=(1, 3, 7, 14, 30), scale=None):
    return [_r(_pct(_C, p) + (f" * {scale}{DBL}" if scale else ""), _ret_name(p)) for p in periods]


def range_sql():
    lo, hi = _roll("min", _C, 7), _roll("max", _C, 7)
    return [_r(lo, "min_7d"), _r(hi, "max_7d"), _r(f"{hi} - {lo}", "range_7d"),
            _r(_div(f"{hi} - {lo}", _C), "range_7d_pct")]


def momentum_sql():
    return [_r(f"{_C} - {_lag(_C, p)}", f"momentum_{p}d") for p in (7, 14)]


def bb_sql():
    mid, sd = _roll("avg", _C, 20), _roll("stddev_samp", _C, 20)
    up, lo = f"({mid} + 2.0{DBL} * {sd})", f"({mid} - 2.0{DBL} * {sd})"
    return [_r(mid, "bb_middle"), _r(sd, "bb_std"), _r(up, "bb_upper"), _r(lo, "bb_lower"),
            _r(_div(f"{_C} - {lo}", f"{up} - {lo}"), "bb_position")]


def cal_sql(dom=True):
    out = ["CAST(isodow(event_date) - 1 AS INTEGER) AS day_of_week", "CAST(month(event_date) AS INTEGER) AS month"]
    if dom:
        out.append("CAST(day(event_date) AS INTEGER) AS day_of_month")
    return out


def target_sql():
    return [_r(_lead(_C, h), f"target_{h}d") for h in (1, 7, 30)]


def _rsi_expr():
    f = _frame(14)
    gain = f"avg(CASE WHEN _d > 0 THEN _d ELSE 0.0{DBL} END) OVER {f}"
    loss = f"avg(CASE WHEN _d < 0 THEN -_d ELSE 0.0{DBL} END) OVER {f}"
    return (f"(CASE WHEN count(*) OVER {f} = 14 THEN CASE WHEN {loss} = 0 THEN CASE WHEN {gain} > 0 THEN 100.0{DBL} END "
            f"ELSE 100.0{DBL} - 100.0{DBL} / (1.0{DBL} + ({gain}) / ({loss})) END END)")


DR = f"dr AS (SELECT *, coalesce({_C} - {_lag(_C, 1)}, 0.0{DBL}) AS _d FROM d)"


def label_sql(c, fut, t=2.0):
    ch = f"(({fut} - {c}) / {c} * 100.0{DBL})"
    return (f"CASE WHEN {fut} IS NULL OR {c} IS NULL THEN NULL "
            f"WHEN {c} = 0 THEN CASE WHEN {fut} > 0 THEN 'UP' WHEN {fut} < 0 THEN 'DOWN' ELSE 'FLAT' END "
            f"WHEN {ch} > {t}{DBL} THEN 'UP' WHEN {ch} < -{t}{DBL} THEN 'DOWN' ELSE 'FLAT' END")


def _feat(cols, src="d", ctes=()):
    return with_(*D_ALL, *ctes) + "SELECT coin_id, event_date,\n  " + ",\n  ".join(cols) + f"\nFROM {src}"


ORACLE["feat_lags"] = _feat(lag_sql())
ORACLE["feat_ma"] = _feat(ma_sql())
ORACLE["feat_volatility"] = _feat(vol_sql(pct=True))
ORACLE["feat_returns"] = _feat(ret_sql())
ORACLE["feat_range"] = _feat(range_sql())
ORACLE["feat_rsi"] = _feat([_r(_rsi_expr(), "rsi_14")], "dr", (DR,))
ORACLE["feat_momentum"] = _feat(momentum_sql())
ORACLE["feat_bollinger"] = _feat(bb_sql())
_MA7, _MA21, _MA30 = _roll("avg", _C, 7), _roll("avg", _C, 21), _roll("avg", _C, 30)
ORACLE["feat_trend"] = _feat([
    _r(f"{_MA7} - {_MA30}", "trend"), _r(_div(f"{_MA7} - {_MA30}", _MA30), "trend_strength_frac"),
    _r(f"{_MA7} - {_MA21}", "trend_7_21"), _r(f"{_MA7} - {_MA30}", "trend_7_30"),
    _r(f"{_div(f'{_MA7} - {_MA30}', _MA30)} * 100.0{DBL}", "trend_strength_pct")])
_VMA = _roll("avg", "volume_usd", 7)
VOLUME_SQL_PRICE = [_r(_VMA, "volume_ma_7"), _r(_div("volume_usd", _VMA), "volume_ratio")]
ORACLE["feat_volume"] = _feat(VOLUME_SQL_PRICE + [
    _r(_pct("market_cap_usd", 1), "mcap_change"),
    _r(f"{_pct('volume_usd', 1)} * 100.0{DBL}", "volume_change")])
ORACLE["feat_calendar"] = _feat(cal_sql())
ORACLE["targets"] = _feat(target_sql())
ORACLE["trend_labels"] = with_(*D_ALL) + f"""
SELECT coin_id, event_date, round({_C}, 6) AS {_C}, round(fut, 6) AS future_price,
       {label_sql(_C, 'fut')} AS trend_label
FROM (SELECT *, {_lead(_C, 7)} AS fut FROM d)"""

for _h in (14, 30):
    ORACLE[f"trend_labels_{_h}"] = with_(*D_ALL) + f"""
SELECT coin_id, event_date, round({_C}, 6) AS {_C}, round(fut, 6) AS future_price,
       {label_sql(_C, 'fut')} AS trend_label
FROM (SELECT *, {_lead(_C, _h)} AS fut FROM d)"""

BASE_SEL = """coin_id, coin_symbol, coin_name, event_date,
  round(open_price_usd, 6) AS open_price_usd, round(close_price_usd, 6) AS close_price_usd,
  round(avg_price_usd, 6) AS avg_price_usd, round(max_price_usd, 6) AS max_price_usd,
  round(min_price_usd, 6) AS min_price_usd, round(volume_usd, 6) AS volume_usd,
  round(market_cap_usd, 6) AS market_cap_usd, samples_per_day"""

def _price_features_sql(r):
    return [
        *[r(_lag(_C, n), f"price_lag_{n}") for n in LAGS],
        *[x for n in MAS for x in (r(_roll("avg", _C, n), f"ma_{n}"), r(_div(_C, _roll("avg", _C, n)), f"ma_{n}_ratio"))],
        *[r(_roll("stddev_samp", _C, n), f"volatility_{n}") for n in VOLS],
        *[r(_pct(_C, p), _ret_name(p)) for p in (1, 3, 7, 14, 30)],
        r(_roll("min", _C, 7), "min_7d"), r(_roll("max", _C, 7), "max_7d"),
        r(f"{_roll('max', _C, 7)} - {_roll('min', _C, 7)}", "range_7d"),
        r(_div(f"{_roll('max', _C, 7)} - {_roll('min', _C, 7)}", _C), "range_7d_pct"),
        r(_rsi_expr(), "rsi_14"), *cal_sql(),
        r(f"{_MA7} - {_MA30}", "trend"), r(_div(f"{_MA7} - {_MA30}", _MA30), "trend_strength"),
        r(_VMA, "volume_ma_7"), r(_div("volume_usd", _VMA), "volume_ratio"),
        r(_pct("market_cap_usd", 1), "mcap_change"),
        *[r(_lead(_C, h), f"target_{h}d") for h in (1, 7, 30)]]


def _trend_features_sql(r):
    mid, sd = _roll("avg", _C, 20), _roll("stddev_samp", _C, 20)
    up, lo = f"({mid} + 2.0{DBL} * {sd})", f"({mid} - 2.0{DBL} * {sd})"
    return [
        *[r(_lag(_C, n), f"price_lag_{n}") for n in LAGS],
        *[x for n in MAS for x in (r(_roll("avg", _C, n), f"ma_{n}"), r(_div(_C, _roll("avg", _C, n)), f"ma_{n}_ratio"))],
        *[x for n in VOLS for x in (r(_roll("stddev_samp", _C, n), f"volatility_{n}"),
                                    r(f"{_div(_roll('stddev_samp', _C, n), _C)} * 100.0{DBL}", f"volatility_{n}_pct"))],
        *[r(f"{_pct(_C, p)} * 100.0{DBL}", _ret_name(p)) for p in (1, 3, 7, 14)],
        *[r(f"{_C} - {_lag(_C, p)}", f"momentum_{p}d") for p in (7, 14)],
        r(_rsi_expr(), "rsi_14"),
        r(mid, "bb_middle"), r(sd, "bb_std"), r(up, "bb_upper"), r(lo, "bb_lower"),
        r(_div(f"{_C} - {lo}", f"{up} - {lo}"), "bb_position"),
        r(f"{_MA7} - {_MA21}", "trend_7_21"), r(f"{_MA7} - {_MA30}", "trend_7_30"),
        r(f"{_div(f'{_MA7} - {_MA30}', _MA30)} * 100.0{DBL}", "trend_strength"),
        r(_VMA, "volume_ma_7"), r(_div("volume_usd", _VMA), "volume_ratio"),
        r(f"{_pct('volume_usd', 1)} * 100.0{DBL}", "volume_change"), *cal_sql(dom=False),
        r("_fut", "future_price"), f"{label_sql(_C, '_fut')} AS trend_label"]


def _raw(expr, name):
    return f"{expr} AS {name}"


def _names(cols):
    return [c.rsplit(" AS ", 1)[1].strip() for c in cols]


BASE_RAW = """coin_id, coin_symbol, coin_name, event_date, open_price_usd, close_price_usd, avg_price_usd,
  max_price_usd, min_price_usd, volume_usd, market_cap_usd, samples_per_day"""
BASE_FEATURES = ["open_price_usd", "close_price_usd", "avg_price_usd", "max_price_usd", "min_price_usd",
                 "volume_usd", "market_cap_usd", "samples_per_day"]

PRICE_FRAME = f"pf AS (SELECT {BASE_SEL},\n  " + ",\n  ".join(_price_features_sql(_r)) + "\nFROM dr)"
TREND_FRAME = (f"tf AS (SELECT {BASE_SEL},\n  " + ",\n  ".join(_trend_features_sql(_r))
               + f"\nFROM (SELECT *, {_lead(_C, 7)} AS _fut FROM dr))")
PRICE_RAW = f"pfr AS (SELECT {BASE_RAW},\n  " + ",\n  ".join(_price_features_sql(_raw)) + "\nFROM dr)"
TREND_RAW = (f"tfr AS (SELECT {BASE_RAW},\n  " + ",\n  ".join(_trend_features_sql(_raw))
             + f"\nFROM (SELECT *, {_lead(_C, 7)} AS _fut FROM dr))")

PRICE_COLS = BASE_FEATURES + [n for n in _names(_price_features_sql(_raw)) if not n.startswith("target_")]
TREND_COLS = BASE_FEATURES + [n for n in _names(_trend_features_sql(_raw))
                              if n not in ("future_price", "trend_label", "bb_std", "bb_middle", "bb_upper",
                                           "bb_lower")]

ORACLE["features_price"] = with_(*D_ALL, DR, PRICE_FRAME) + "SELECT * FROM pf"
ORACLE["features_trend"] = with_(*D_ALL, DR, TREND_FRAME) + "SELECT * FROM tf"
ORACLE["features_price_blocks"] = ORACLE["features_price"]
ORACLE["features_trend_blocks"] = ORACLE["features_trend"]

# ---------------------------------------------------------------- stage 6: modeling


def _not_null(cols):
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


_SPLIT = ("CASE WHEN row_number() OVER (PARTITION BY coin_id ORDER BY event_date) <= "
          "floor(count(*) OVER (PARTITION BY coin_id) * (1.0::DOUBLE - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END")
P_CLEAN = f"pclean AS (SELECT * FROM pfr WHERE {_not_null(PRICE_COLS + ['target_1d'])})"
P_SPLIT = f"psplit AS (SELECT *, {_SPLIT} AS split FROM pclean)"
T_CLEAN = f"tclean AS (SELECT * FROM tfr WHERE {_not_null(TREND_COLS + ['trend_label'])})"
T_SPLIT = f"tsplit AS (SELECT *, {_SPLIT} AS split, 'FLAT' AS predicted FROM tclean)"
P_ALL = (*D_ALL, DR, PRICE_RAW, P_CLEAN, P_SPLIT)
T_ALL = (*D_ALL, DR, TREND_RAW, T_CLEAN, T_SPLIT)

ORACLE["clean_rows"] = with_(*D_ALL, DR, PRICE_RAW, P_CLEAN) + """
SELECT coin_id, count(*) AS n_clean, count(*) >= 50 AS enough FROM pclean GROUP BY coin_id"""

ORACLE["chrono_split"] = with_(*P_ALL) + "SELECT coin_id, event_date, split FROM psplit"

_STATS = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in PRICE_COLS)
_SCALED = ",\n  ".join(
    f"round(({c} - mu_{c}) / CASE WHEN sd_{c} = 0 THEN 1.0::DOUBLE ELSE sd_{c} END, 6) AS {c}" for c in PRICE_COLS)
ORACLE["scaled_features"] = with_(*P_ALL) + f""",
st AS (SELECT coin_id, {_STATS} FROM psplit WHERE split = 'train' GROUP BY coin_id)
SELECT coin_id, event_date, split,
  {_SCALED}
FROM psplit JOIN st USING (coin_id)"""

_MEANS = ", ".join(f"avg({c}) OVER (PARTITION BY coin_id) AS m_{c}" for c in PRICE_COLS)
_IMPUTED = ",\n  ".join(f"round(coalesce({c}, m_{c}), 6) AS {c}" for c in PRICE_COLS)
ORACLE["score_row"] = with_(*D_ALL, DR, PRICE_RAW) + f"""
SELECT coin_id, event_date,
  {_IMPUTED}
FROM (SELECT *, {_MEANS}, row_number() OVER (PARTITION BY coin_id ORDER BY event_date DESC) AS _rn FROM pfr)
WHERE _rn = 1"""

ORACLE["metrics_regression"] = with_(*P_ALL) + """
SELECT coin_id, split, count(*) AS n, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
  round(CASE WHEN var_pop(y) = 0 THEN CASE WHEN avg((y - p) * (y - p)) = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
             ELSE 1.0::DOUBLE - avg((y - p) * (y - p)) / var_pop(y) END, 6) AS r2,
  round(CASE WHEN split = 'test' THEN avg(abs((y - p) / nullif(y, 0))) * 100.0::DOUBLE END, 6) AS mape
FROM (SELECT coin_id, split, target_1d AS y, close_price_usd AS p FROM psplit) GROUP BY coin_id, split"""

ORACLE["metrics_trend"] = with_(*T_ALL) + """
SELECT coin_id, split, count(*) AS n,
  round(avg(CASE WHEN trend_label = predicted THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy
FROM tsplit GROUP BY coin_id, split"""

ORACLE["confusion"] = with_(*T_ALL) + """
SELECT c.coin_id, k.true_label, count(CASE WHEN t.predicted = 'DOWN' THEN 1 END) AS pred_down,
  count(CASE WHEN t.predicted = 'FLAT' THEN 1 END) AS pred_flat, count(CASE WHEN t.predicted = 'UP' THEN 1 END) AS pred_up
FROM (SELECT DISTINCT coin_id FROM tsplit WHERE split = 'test') c CROSS JOIN (VALUES ('DOWN'), ('FLAT'), ('UP')) k(true_label)
LEFT JOIN tsplit t ON t.coin_id = c.coin_id AND t.split = 'test' AND t.trend_label = k.true_label
GROUP BY c.coin_id, k.true_label"""

ORACLE["class_distribution"] = with_(*T_ALL) + """
SELECT coin_id, trend_label AS label, count(*) AS n FROM tsplit WHERE split = 'test' GROUP BY coin_id, trend_label"""

ORACLE["label_index"] = with_(*T_ALL) + """
SELECT trend_label, (dense_rank() OVER (ORDER BY trend_label) - 1)::DOUBLE AS label, n
FROM (SELECT trend_label, count(*) AS n FROM tclean GROUP BY trend_label)"""

# What SQL can tell of the fitted models: who gets a forecast (60 rows, 50 clean ones),
# from which price, and the rows of each split (the first 80 % of the clean ones).
_PRICE_CLEAN = " UNION ALL ".join(
    f"SELECT coin_id, {h} AS horizon, count(*) FILTER (WHERE {_not_null(PRICE_COLS + [f'target_{h}d'])}) AS n, "
    f"count(*) AS n_raw, arg_max(close_price_usd, event_date) AS price FROM pfr GROUP BY coin_id" for h in (1, 7, 30))
ORACLE["forecast_price_check"] = with_(*D_ALL, DR, PRICE_RAW) + f"""
SELECT coin_id, horizon, CASE WHEN ok THEN round(price, 6) END AS current_price, ok AS predicted,
  CASE WHEN ok THEN TRUE END AS change_agrees, CASE WHEN ok THEN TRUE END AS confident,
  CASE WHEN ok THEN floor(n * (1.0::DOUBLE - 0.2::DOUBLE))::BIGINT END AS n_train,
  CASE WHEN ok THEN n - floor(n * (1.0::DOUBLE - 0.2::DOUBLE))::BIGINT END AS n_test,
  CASE WHEN ok THEN TRUE END AS mae_within_rmse
FROM (SELECT *, n >= 50 AND n_raw >= 60 AS ok FROM ({_PRICE_CLEAN}))"""

ORACLE["forecast_trend_check"] = with_(*T_ALL) + """
SELECT c.coin_id, CASE WHEN ok THEN round(price, 6) END AS current_price, CASE WHEN ok THEN TRUE END AS sums_to_one,
  CASE WHEN ok THEN TRUE END AS trend_is_likeliest, CASE WHEN ok THEN TRUE END AS confidence_agrees,
  CASE WHEN ok THEN n_train END AS n_train, CASE WHEN ok THEN n_test END AS n_test,
  CASE WHEN ok THEN true_down END AS true_down, CASE WHEN ok THEN true_flat END AS true_flat,
  CASE WHEN ok THEN true_up END AS true_up
FROM (SELECT r.coin_id, price, coalesce(n, 0) >= 50 AND n_raw >= 60 AS ok, n_train, n_test, true_down, true_flat, true_up
      FROM (SELECT coin_id, count(*) AS n_raw, arg_max(close_price_usd, event_date) AS price FROM tfr GROUP BY coin_id) r
      LEFT JOIN (SELECT coin_id, count(*) AS n, count(*) FILTER (WHERE split = 'train') AS n_train,
                   count(*) FILTER (WHERE split = 'test') AS n_test,
                   count(*) FILTER (WHERE split = 'test' AND trend_label = 'DOWN') AS true_down,
                   count(*) FILTER (WHERE split = 'test' AND trend_label = 'FLAT') AS true_flat,
                   count(*) FILTER (WHERE split = 'test' AND trend_label = 'UP') AS true_up
                 FROM tsplit GROUP BY coin_id) s ON s.coin_id = r.coin_id) c"""

ORACLE["importance_check"] = " UNION ALL ".join(
    f"SELECT {h} AS horizon, feature, TRUE AS is_share, TRUE AS sums_to_one FROM (SELECT unnest({PRICE_COLS}) AS feature)"
    for h in (1, 7, 30))


# The first split of a boosted model, by brute force: every boundary between two values of
# every feature, at least 3 of the hessian sum on both sides.

def _root_sql(source, keys, cols, g, h, alpha, out):
    def score(gs, hs):
        return f"pow(greatest(abs({gs}) - {alpha}::DOUBLE, 0), 2) / ({hs} + 1.0::DOUBLE)"

    return f""",
long AS (SELECT {keys}, {g} AS g, {h} AS h, unnest({cols}) AS feature, unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in cols)}]) AS x
         FROM {source}),
vals AS (SELECT {keys}, feature, x, sum(g) AS g, sum(h) AS h FROM long GROUP BY ALL),
sides AS (SELECT {keys}, feature, sum(g) OVER up AS gl, sum(h) OVER up AS hl, sum(g) OVER f AS gt, sum(h) OVER f AS ht,
            lead(x) OVER (PARTITION BY {keys}, feature ORDER BY x) AS next
          FROM vals WINDOW f AS (PARTITION BY {keys}, feature),
                           up AS (PARTITION BY {keys}, feature ORDER BY x ROWS UNBOUNDED PRECEDING)),
best AS (SELECT {keys}, max(ht) AS cover, coalesce(max(CASE WHEN next IS NOT NULL AND hl >= 3 AND ht - hl >= 3
           THEN {score('gl', 'hl')} + {score('gt - gl', 'ht - hl')} - {score('gt', 'ht')} END), 0) AS gain FROM sides GROUP BY {keys})
{out}"""


_STACKED = " UNION ALL ".join(
    f"SELECT coin_id, {h} AS horizon, event_date, target_{h}d AS label, {', '.join(PRICE_COLS)} FROM pfr "
    f"WHERE {_not_null(PRICE_COLS + [f'target_{h}d'])}" for h in (1, 7, 30))
_SERIES_SPLIT = _SPLIT.replace("PARTITION BY coin_id", "PARTITION BY coin_id, horizon")
ORACLE["boost_price_roots"] = with_(*D_ALL, DR, PRICE_RAW, f"""stacked AS (SELECT *, {_SERIES_SPLIT} AS split FROM ({_STACKED})),
train AS (SELECT *, avg(label) OVER (PARTITION BY coin_id, horizon) AS base FROM stacked WHERE split = 'train')""") + _root_sql(
    "train", "coin_id, horizon", PRICE_COLS, "base - label", "1.0::DOUBLE", "0.1", """
SELECT coin_id, horizon, n, round(cover, 6) AS cover, round(base, 6) AS base, round(gain / (var * n), 6) AS gain_share
FROM best JOIN (SELECT coin_id, horizon, count(*) AS n, avg(label) AS base, var_pop(label) AS var FROM train GROUP BY ALL)
  USING (coin_id, horizon)""")

ORACLE["boost_trend_roots"] = with_(*T_ALL, """ttrain AS (
  SELECT t.*, c.cls FROM tsplit t CROSS JOIN (VALUES ('DOWN'), ('FLAT'), ('UP')) c(cls) WHERE split = 'train')""") + _root_sql(
    "ttrain", "coin_id, cls", TREND_COLS, "1.0::DOUBLE / 3 - CASE WHEN trend_label = cls THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
    "2 * (1.0::DOUBLE / 3) * (1 - 1.0::DOUBLE / 3)", "0.0", """
SELECT coin_id, cls AS trend_label, round(cover, 6) AS cover, round(gain, 6) AS gain FROM best""")


# ---------------------------------------------------------------- sign of zero

def _unsigned_zero(sql: str) -> str:
    """Rewrite every ``round(...)`` as ``(round(...) + 0.0::DOUBLE)``: DuckDB
    rounds a tiny negative to -0.0 where Spark's decimal rounding gives 0.0, and
    adding +0.0 turns -0.0 into 0.0 (IEEE) without changing any other value."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _unsigned_zero(sql[j + len(key):k])
        out.append(sql[i:j] + "(round(" + inner + ") + 0.0::DOUBLE)")
        i = k + 1


ORACLE = {name: _unsigned_zero(sql) for name, sql in ORACLE.items()}
