"""The registered queries as SQL over the given tables, written independently of the Spark code."""

from __future__ import annotations

# --- bar tables -----------------------------------------------------------------------

_SUPPLIER_BARS = """
lines AS (
  SELECT l_suppkey AS coin_id, CAST(l_shipdate AS DATE) AS event_date,
         floor(l_extendedprice) AS price, l_quantity AS quantity,
         (l_orderkey * 10 + l_linenumber) * 200000 + CAST(floor(l_extendedprice) AS BIGINT) AS seq
  FROM lineitem),
bars AS (
  SELECT coin_id, event_date, arg_min(price, seq) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, seq) AS close, sum(quantity) AS total_volume_usd, sum(price) AS market_cap_usd
  FROM lines GROUP BY coin_id, event_date)"""

_GAP_BARS = (
    _SUPPLIER_BARS.replace("bars AS (", "full_bars AS (")
    + """,
bars AS (
  SELECT coin_id, event_date, open, high, low,
         CASE WHEN dayofyear(event_date) % 11 <> 0 THEN close END AS close,
         CASE WHEN dayofyear(event_date) % 7 <> 0 THEN total_volume_usd END AS total_volume_usd,
         market_cap_usd
  FROM full_bars)"""
)

_EVENT_BARS = """
bars AS (
  SELECT event_type AS coin_id, CAST(ts AS DATE) AS event_date,
         arg_min(floor(value), event_id) AS open, max(floor(value)) AS high, min(floor(value)) AS low,
         arg_max(floor(value), event_id) AS close, sum(floor(value)) AS total_volume_usd,
         floor(count(DISTINCT user_id) / 20) AS market_cap_usd
  FROM events GROUP BY 1, 2)"""

_EVENT_LOOKUP = """
lookup AS (
  SELECT * FROM (VALUES ('click', 'CLK', 'act', 2009), ('error', 'ERR', 'fault', 2015),
                        ('signup', 'SGN', 'act', 2020), ('view', 'VEW', 'read', 2017))
  AS v(coin_id, ticker, category, launch_year))"""

_SUPPLIER_LOOKUP = """
lookup AS (
  SELECT s_suppkey AS coin_id, s_name AS ticker,
         'nation ' || CAST(s_nationkey AS VARCHAR) AS category
  FROM supplier)"""

_KNOWN_IN_CREDIT = _SUPPLIER_LOOKUP.replace("FROM supplier)", "FROM supplier WHERE s_acctbal > 0)")

_LINE_ROWS = """
lines AS (
  SELECT l_suppkey AS coin_id, CAST(l_shipdate AS DATE) AS event_date,
         floor(l_extendedprice) AS price, l_quantity AS quantity,
         (l_orderkey * 10 + l_linenumber) * 200000 + CAST(floor(l_extendedprice) AS BIGINT) AS seq
  FROM lineitem)"""

_MERGED_BARS = (
    _LINE_ROWS
    + """,
bars AS (
  SELECT coin_id, event_date, arg_min(price, seq) AS open, max(price + quantity) AS high, min(price - quantity) AS low,
         arg_max(price + 1, seq) AS close, arg_max(price * 2, seq) AS market_cap_usd, arg_max(quantity, seq) AS total_volume_usd
  FROM lines GROUP BY coin_id, event_date)"""
)

_ORDER_BARS = """
prices AS (
  SELECT o_orderpriority AS coin_id, CAST(o_orderdate AS DATE) AS event_date,
         arg_min(floor(o_totalprice), o_orderkey) AS open, max(floor(o_totalprice)) AS high,
         min(floor(o_totalprice)) AS low, arg_max(floor(o_totalprice), o_orderkey) AS close
  FROM orders GROUP BY 1, 2),
measures AS (
  SELECT o_orderpriority AS coin_id, CAST(o_orderdate AS DATE) AS event_date,
         sum(floor(l_extendedprice)) AS market_cap_usd, sum(l_quantity) AS total_volume_usd
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
bars AS (SELECT * FROM prices JOIN measures USING (coin_id, event_date))"""

_TIES = "market_cap_usd, total_volume_usd, open, high, low, close"
_LINE_BARS = (
    _LINE_ROWS
    + """,
bars AS (
  SELECT coin_id, event_date, CAST(event_date AS TIMESTAMP) + to_hours(CAST(seq // 200000 % 3 AS INTEGER)) AS event_ts,
         price AS open, price + quantity AS high, price - quantity AS low, price + 1 AS close,
         price * 2 AS market_cap_usd, quantity AS total_volume_usd
  FROM lines)"""
)


def _ordered(sql: str, time: str) -> str:
    """Series that run by ``time`` and then by the measures."""
    return sql.replace("PARTITION BY coin_id ORDER BY event_date", f"PARTITION BY coin_id ORDER BY {time}, {_TIES}")


# --- features -------------------------------------------------------------------------

_SILVER = """
stepped AS (
  SELECT *, row_number() OVER s AS rn, close - lag(close) OVER s AS change,
         lag(close, 1) OVER s AS close_1, lag(close, 7) OVER s AS close_7,
         avg(close) OVER w7 AS avg_close_7d, avg(close) OVER w14 AS avg_close_14d,
         avg(close) OVER w30 AS avg_close_30d, stddev_samp(close) OVER w30 AS stddev_close_30d,
         sum(close * total_volume_usd) OVER w7 / nullif(sum(total_volume_usd) OVER w7, 0) AS vwap_7d,
         rank() OVER d AS rank_by_mcap, dense_rank() OVER d AS dense_rank_by_mcap,
         percent_rank() OVER d AS pct_rank_by_mcap
  FROM bars
  WINDOW s AS (PARTITION BY coin_id ORDER BY event_date),
         w7 AS (PARTITION BY coin_id ORDER BY event_date ROWS 6 PRECEDING),
         w14 AS (PARTITION BY coin_id ORDER BY event_date ROWS 13 PRECEDING),
         w30 AS (PARTITION BY coin_id ORDER BY event_date ROWS 29 PRECEDING),
         d AS (PARTITION BY event_date ORDER BY market_cap_usd DESC NULLS LAST)),
weighted AS (
  SELECT *, (close - close_1) / nullif(close_1, 0) * 100 AS pct_change_1d,
         (close - close_7) / nullif(close_7, 0) * 100 AS pct_change_7d,
         (high - low) / nullif(close, 0) * 100 AS high_low_spread_pct,
         sum(greatest(change, 0) * pow(14.0 / 13, rn)) OVER s AS gain,
         sum(greatest(-change, 0) * pow(14.0 / 13, rn)) OVER s AS loss,
         count(change) OVER s AS changes
  FROM stepped WINDOW s AS (PARTITION BY coin_id ORDER BY event_date)),
indexed AS (
  SELECT *, CASE WHEN changes >= 14 AND gain + loss > 0 THEN 100 * gain / (gain + loss) ELSE 50 END AS rsi_14
  FROM weighted),
silver AS (
  SELECT *, CASE
    WHEN pct_change_7d IS NULL OR high_low_spread_pct IS NULL OR rsi_14 IS NULL THEN 'unknown'
    WHEN abs(pct_change_7d) > 10 AND rsi_14 > 65 THEN 'trending_bullish'
    WHEN abs(pct_change_7d) > 10 AND rsi_14 < 35 THEN 'trending_bearish'
    WHEN high_low_spread_pct > 5 AND abs(pct_change_7d) < 5 THEN 'ranging_volatile'
    WHEN high_low_spread_pct <= 5 AND abs(pct_change_7d) < 2 THEN 'ranging_quiet'
    WHEN pct_change_7d < -10 AND rsi_14 < 30 THEN 'reversing_oversold'
    WHEN pct_change_7d > 10 AND rsi_14 > 70 THEN 'reversing_overbought'
    ELSE 'neutral' END AS market_regime
  FROM indexed)"""

_VOLATILITY = """
banded AS (
  SELECT *, stddev_samp(pct_change_1d) OVER w30 * sqrt(365) AS vol,
         avg(close) OVER w20 AS mid, stddev_samp(close) OVER w20 AS dev
  FROM silver
  WINDOW w20 AS (PARTITION BY coin_id ORDER BY event_date ROWS 19 PRECEDING),
         w30 AS (PARTITION BY coin_id ORDER BY event_date ROWS 29 PRECEDING)),
volatility AS (
  SELECT coin_id, event_date, close, round(vol, 3) AS annualized_vol_pct, vol,
         round(mid, 6) AS bb_sma_20, round(mid + 2 * dev, 3) AS bb_upper, round(mid - 2 * dev, 3) AS bb_lower,
         round((close - (mid - 2 * dev)) / nullif((mid + 2 * dev) - (mid - 2 * dev), 0), 6) AS bb_pct_b,
         round(((mid + 2 * dev) - (mid - 2 * dev)) / nullif(mid, 0), 6) AS bb_bandwidth,
         round(rsi_14, 4) AS rsi_14, market_regime
  FROM banded)"""

_RANKS = """CAST(rank_by_mcap AS INTEGER) AS rank_by_mcap,
       CAST(dense_rank_by_mcap AS INTEGER) AS dense_rank_by_mcap"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_silver = _with(_SUPPLIER_BARS, _SILVER)
_gap_silver = _with(_GAP_BARS, _SILVER)
_event_silver = _with(_EVENT_BARS, _SILVER)

_SILVER_COLUMNS = f"""coin_id, event_date, open, high, low, close, market_cap_usd, total_volume_usd,
       round(avg_close_7d, 6) AS avg_close_7d, round(avg_close_14d, 6) AS avg_close_14d,
       round(avg_close_30d, 6) AS avg_close_30d, round(stddev_close_30d, 3) AS stddev_close_30d,
       round(vwap_7d, 6) AS vwap_7d, round(pct_change_1d, 6) AS pct_change_1d,
       round(pct_change_7d, 6) AS pct_change_7d, round(high_low_spread_pct, 6) AS high_low_spread_pct,
       {_RANKS}, round(pct_rank_by_mcap, 6) AS pct_rank_by_mcap,
       round(rsi_14, 4) AS rsi_14, market_regime"""

_SUMMARY_COLUMNS = f"""coin_id, ticker, category, event_date, open, high, low, close, total_volume_usd, market_cap_usd,
       round(avg_close_7d, 6) AS avg_close_7d, round(avg_close_14d, 6) AS avg_close_14d,
       round(avg_close_30d, 6) AS avg_close_30d, round(vwap_7d, 6) AS vwap_7d,
       round(pct_change_1d, 6) AS pct_change_1d, round(pct_change_7d, 6) AS pct_change_7d,
       round(high_low_spread_pct, 6) AS high_low_spread_pct, round(rsi_14, 4) AS rsi_14, market_regime,
       {_RANKS}"""

_WEEKLY = """
weekly AS (
  SELECT coin_id, CAST(isoyear(event_date) AS INTEGER) AS iso_year, CAST(week(event_date) AS INTEGER) AS iso_week,
         arg_min(open, event_date) FILTER (WHERE open IS NOT NULL) AS week_open,
         arg_max(close, event_date) FILTER (WHERE close IS NOT NULL) AS week_close,
         max(high) AS week_high, min(low) AS week_low,
         sum(total_volume_usd) AS week_total_volume, avg(market_cap_usd) AS week_avg_mcap
  FROM bars GROUP BY 1, 2, 3),
returned AS (
  SELECT *, (week_close - week_open) / nullif(week_open, 0) * 100 AS weekly_return_pct FROM weekly)"""

_WEEKLY_RANKED = """SELECT coin_id, iso_year, iso_week, week_open, week_close, week_high, week_low, week_total_volume,
       round(week_avg_mcap, 6) AS week_avg_mcap, round(weekly_return_pct, 6) AS weekly_return_pct,
       CAST(rank() OVER (PARTITION BY iso_year, iso_week ORDER BY weekly_return_pct DESC NULLS LAST) AS INTEGER)
         AS weekly_rank
FROM returned"""

_RAW_ORDERS = """
raw_orders AS (
  SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_orderpriority || '/' || CAST(o_orderkey AS VARCHAR) END AS coin_id,
         CASE WHEN o_orderkey % 89 <> 0 THEN epoch_ms(o_orderdate) END AS timestamp_ms,
         floor(o_totalprice) + run AS close, '2024010' || CAST(run + 1 AS VARCHAR) || 'T000000' AS _run_id
  FROM orders, (VALUES (0), (1)) AS r(run))"""

_RAW_COLUMNS = """coin_id, timestamp_ms, close, _run_id, CAST(epoch_ms(timestamp_ms) AS DATE) AS event_date,
       CAST(year(epoch_ms(timestamp_ms)) AS INTEGER) AS event_year,
       CAST(month(epoch_ms(timestamp_ms)) AS INTEGER) AS event_month"""

_REGIME_SHARES = """
labels_per_key AS (SELECT coin_id, market_regime, count(*) AS count FROM silver GROUP BY 1, 2),
shares AS (
  SELECT *, CAST(sum(count) OVER (PARTITION BY coin_id) AS BIGINT) AS total,
         count / sum(count) OVER (PARTITION BY coin_id) AS regime_rate
  FROM labels_per_key)"""

# --- quality --------------------------------------------------------------------------

_NULL_CHECKED = (
    "coin_id", "event_date", "open", "high", "low", "close", "total_volume_usd", "market_cap_usd"
)
_SILVER_CHECKED = _NULL_CHECKED + (
    "avg_close_7d", "avg_close_14d", "avg_close_30d", "stddev_close_30d", "vwap_7d", "pct_change_1d",
    "pct_change_7d", "high_low_spread_pct", "rank_by_mcap", "dense_rank_by_mcap", "pct_rank_by_mcap",
    "rsi_14", "market_regime",
)


def _null_rate(column: str, source: str) -> str:
    return f"""SELECT 'null_rate_{column}' AS check_name, avg(CASE WHEN {column} IS NULL THEN 1.0 ELSE 0.0 END) <= 0.05 AS passed,
       round_even(avg(CASE WHEN {column} IS NULL THEN 1.0 ELSE 0.0 END), 4) AS metric_value, CAST(0.05 AS DOUBLE) AS threshold,
       CAST(count(*) - count({column}) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR) || ' nulls in ''{column}''' AS details
FROM {source}"""


def _forbidden(name: str, condition: str, text: str, source: str) -> str:
    return f"""SELECT '{name}' AS check_name, count(*) FILTER (WHERE {condition}) = 0 AS passed,
       CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) AS metric_value, CAST(0 AS DOUBLE) AS threshold,
       CAST(count(*) FILTER (WHERE {condition}) AS VARCHAR) || ' {text}' AS details
FROM {source}"""


def _zero_volume(source: str) -> str:
    bad = "count(*) FILTER (WHERE total_volume_usd IS NULL OR total_volume_usd = 0)"
    return f"""SELECT 'zero_volume_rate' AS check_name, {bad} / count(*) <= 0.02 AS passed,
       round_even({bad} / count(*), 4) AS metric_value, CAST(0.02 AS DOUBLE) AS threshold,
       CAST({bad} AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR) || ' rows with zero/null volume' AS details
FROM {source}"""


def _regime_rows(source: str, limit: float) -> str:
    return f"""SELECT 'regime_distribution_' || coin_id AS check_name, false AS passed, round_even(regime_rate, 4) AS metric_value,
       CAST({limit} AS DOUBLE) AS threshold,
       'Regime ''' || market_regime || ''' dominates ' || printf('%.1f', regime_rate * 100) || '% of days for '
         || coin_id || ' — consider retuning classifier thresholds' AS details
FROM {source} WHERE regime_rate > {limit}"""


_PARTITIONS = """
WITH spread AS (
  SELECT CAST(p AS INTEGER) AS partition, count(o_custkey) AS rows
  FROM range(16) AS r(p) LEFT JOIN orders ON o_custkey % 13 = p GROUP BY p)
"""
_RSI_RANGE = ("rsi_range_validity", "rsi_14 < 0 OR rsi_14 > 100", "rows with RSI outside [0, 100]")
_PRICE_ORDER = (
    "ohlc_consistency",
    "low > open OR low > close OR high < open OR high < close",
    "rows violating low <= OHLC <= high",
)
_SPIKES = ("price_anomaly_detection", "close > 10 * avg_close_30d", "rows where close > 10.0× 30d avg")
_UNION = "\nUNION ALL\n"

ORACLES: dict[str, str] = {
    # rolling features
    "rolling_avg": _silver
    + """SELECT coin_id, event_date, close, round(avg_close_7d, 6) AS avg_close_7d,
       round(avg_close_14d, 6) AS avg_close_14d, round(avg_close_30d, 6) AS avg_close_30d FROM silver""",
    "rolling_stddev": _silver
    + "SELECT coin_id, event_date, close, round(stddev_close_30d, 3) AS stddev_close_30d FROM silver",
    "vwap": _gap_silver + "SELECT coin_id, event_date, close, total_volume_usd, round(vwap_7d, 6) AS vwap_7d FROM silver",
    "momentum": _gap_silver
    + """SELECT coin_id, event_date, close, round(pct_change_1d, 6) AS pct_change_1d,
       round(pct_change_7d, 6) AS pct_change_7d, round(high_low_spread_pct, 6) AS high_low_spread_pct FROM silver""",
    "daily_rankings": _silver
    + f"SELECT coin_id, event_date, market_cap_usd, {_RANKS}, round(pct_rank_by_mcap, 6) AS pct_rank_by_mcap FROM silver",
    "daily_rankings_tied": _event_silver
    + f"SELECT coin_id, event_date, market_cap_usd, {_RANKS}, round(pct_rank_by_mcap, 6) AS pct_rank_by_mcap FROM silver",
    "rsi": _silver + "SELECT coin_id, event_date, close, round(rsi_14, 4) AS rsi_14 FROM silver",
    "rsi_gaps": _gap_silver + "SELECT coin_id, event_date, close, round(rsi_14, 4) AS rsi_14 FROM silver",
    "series_cut": """
WITH series AS (
  SELECT l_returnflag AS coin_id, l_shipdate + to_microseconds(l_orderkey * 8 + l_linenumber) AS event_ts,
         floor(l_extendedprice) AS close
  FROM lineitem),
stepped AS (
  SELECT *, close - lag(close) OVER s AS change, row_number() OVER s AS rn, avg(close) OVER w7 AS avg_close_7d,
         avg(close) OVER w30 AS avg_close_30d, stddev_samp(close) OVER w30 AS stddev_close_30d
  FROM series
  WINDOW s AS (PARTITION BY coin_id ORDER BY event_ts, close), w7 AS (PARTITION BY coin_id ORDER BY event_ts, close ROWS 6 PRECEDING),
         w30 AS (PARTITION BY coin_id ORDER BY event_ts, close ROWS 29 PRECEDING)),
recent AS (
  SELECT *, list(coalesce(change, 0)) OVER (PARTITION BY coin_id ORDER BY event_ts, close ROWS 399 PRECEDING) AS moves FROM stepped),
weighted AS (
  SELECT * EXCLUDE (moves), list_sum(list_transform(moves, lambda x, i: greatest(x, 0) * pow(14.0 / 13, i))) AS gain,
         list_sum(list_transform(moves, lambda x, i: greatest(-x, 0) * pow(14.0 / 13, i))) AS loss
  FROM recent)
SELECT coin_id, event_ts, close, round(avg_close_7d, 6) AS avg_close_7d, round(avg_close_30d, 6) AS avg_close_30d,
       round(stddev_close_30d, 3) AS stddev_close_30d,
       round(CASE WHEN rn > 14 AND gain + loss > 0 THEN 100 * gain / (gain + loss) ELSE 50 END, 4) AS rsi_14
FROM weighted""",
    "ranks_narrow": """
SELECT o_orderpriority, o_orderkey, 1000.0::DOUBLE + o_orderkey / 1000000 AS value, rank() OVER w AS value_rank,
       dense_rank() OVER w AS value_dense_rank
FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey DESC)""",
    "regime": _with(
        """
measured AS (
  SELECT l_orderkey, l_linenumber, CAST(l_partkey % 41 - 20 AS DOUBLE) AS p7,
         CASE WHEN l_suppkey % 13 <> 0 THEN l_tax * 100 END AS spread, l_quantity * 2 AS rsi
  FROM lineitem),
labelled AS (
  SELECT *, CASE
    WHEN spread IS NULL THEN 'unknown'
    WHEN abs(p7) > 10 AND rsi > 65 THEN 'trending_bullish'
    WHEN abs(p7) > 10 AND rsi < 35 THEN 'trending_bearish'
    WHEN spread > 5 AND abs(p7) < 5 THEN 'ranging_volatile'
    WHEN spread <= 5 AND abs(p7) < 2 THEN 'ranging_quiet'
    ELSE 'neutral' END AS market_regime
  FROM measured)"""
    )
    + "SELECT * FROM labelled",
    "abs_change": _silver + "SELECT coin_id, event_date, round(abs(pct_change_1d), 6) AS abs_change FROM silver",
    # joins
    "join_inner_equi": _with(_ORDER_BARS) + "SELECT * FROM bars",
    "join_broadcast_left": _with(_EVENT_BARS, _EVENT_LOOKUP)
    + "SELECT bars.*, ticker, category, launch_year FROM bars LEFT JOIN lookup USING (coin_id)",
    "join_several_per_day": _with(_LINE_ROWS)
    + """SELECT p.coin_id, p.event_date, p.seq AS timestamp_ms, p.price AS open, p.price + p.quantity AS high,
       p.price - p.quantity AS low, p.price + 1 AS close, m.price * 2 AS market_cap_usd, m.quantity AS total_volume_usd
FROM lines p JOIN lines m USING (coin_id, event_date)""",
    "join_merge_left": _with(_SUPPLIER_BARS, _KNOWN_IN_CREDIT)
    + "SELECT coin_id, event_date, close, ticker, category FROM bars LEFT JOIN lookup USING (coin_id)",
    "join_lookup_inner": _with(_SUPPLIER_BARS, _SUPPLIER_LOOKUP)
    + "SELECT coin_id, event_date, close, ticker, category FROM bars JOIN lookup USING (coin_id)",
    # bronze
    "date_columns": """
SELECT event_id, epoch_us(ts) // 1000 AS timestamp_ms, epoch_ms(epoch_us(ts) // 1000) AS event_ts, CAST(ts AS DATE) AS event_date,
       CAST(year(ts) AS INTEGER) AS event_year, CAST(month(ts) AS INTEGER) AS event_month
FROM events""",
    "quarantine_bad": _with(_RAW_ORDERS)
    + f"""SELECT {_RAW_COLUMNS}, 'null_key_field' AS _quarantine_reason FROM raw_orders
WHERE coin_id IS NULL OR timestamp_ms IS NULL""",
    "quarantine_good": _with(_RAW_ORDERS)
    + f"SELECT {_RAW_COLUMNS} FROM raw_orders WHERE coin_id IS NOT NULL AND timestamp_ms IS NOT NULL",
    "dedup_latest": """
SELECT * EXCLUDE (nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
    l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
    l_linestatus DESC) AS nth
  FROM lineitem) WHERE nth = 1""",
    "bronze_orders": _with(_RAW_ORDERS)
    + f"""SELECT {_RAW_COLUMNS} FROM raw_orders
WHERE coin_id IS NOT NULL AND timestamp_ms IS NOT NULL AND _run_id = '20240102T000000'""",
    "payload_ohlc_flatten": """
WITH bodies AS (
  SELECT *, CAST(o_orderkey AS VARCHAR) AS coin_id, floor(o_totalprice) AS price, CASE WHEN o_orderkey % 17 = 0 THEN 'busy'
    WHEN o_orderkey % 19 = 0 THEN 'page' WHEN o_orderkey % 13 = 0 THEN 'damaged' ELSE 'good' END AS kind
  FROM orders)
SELECT coin_id, epoch_ms(o_orderdate) + i * 86400000 AS timestamp_ms, price + i AS open, price + i + 2 AS high,
       price + i - 2 AS low, CASE WHEN o_orderkey % 5 <> 0 OR i < 3 THEN price + i + 1 END AS close,
       NULL AS _body_reason, NULL AS _body
FROM bodies, (VALUES (1), (2), (3)) AS v(i) WHERE kind = 'good' AND i <= o_orderkey % 4
UNION ALL
SELECT coin_id, epoch_ms(o_orderdate), price, NULL, NULL, price, NULL, NULL FROM bodies WHERE kind = 'damaged'
UNION ALL
SELECT coin_id, NULL, 1, 2, 3, 4, NULL, NULL FROM bodies WHERE kind = 'damaged'
UNION ALL
SELECT coin_id, NULL, NULL, NULL, NULL, NULL, 'unreadable_body',
       CASE kind WHEN 'busy' THEN '{"status":{"error_code":429}}' ELSE '<html>busy</html>' END
FROM bodies WHERE kind IN ('busy', 'page')""",
    "payload_market_zip": """
WITH sized AS (
  SELECT *, o_orderkey % 4 AS n_prices, o_orderkey % 3 + 1 AS n_caps,
         CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 2 END AS n_volumes,
         CASE WHEN o_orderkey % 17 = 0 THEN 'body_without_arrays' WHEN o_orderkey % 19 = 0 THEN 'unreadable_body'
              WHEN o_orderkey % 11 = 0 THEN 'body_without_arrays' WHEN o_orderkey % 4 = 0 THEN 'empty_array' END AS reason
  FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS coin_id, epoch_ms(o_orderdate) + i * 86400000 AS timestamp_ms,
       floor(o_totalprice) + i AS price_usd, floor(o_totalprice) * i AS market_cap_usd,
       CAST(o_custkey + i AS DOUBLE) AS total_volume_usd,
       NOT (n_prices = n_caps AND n_caps = n_volumes) AS length_mismatch, reason AS _body_reason, FALSE AS _body
FROM sized, (VALUES (1), (2), (3)) AS v(i) WHERE reason IS NULL AND i <= least(n_prices, n_caps, n_volumes)
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL, NULL,
       o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0, reason, TRUE
FROM sized WHERE reason IS NOT NULL""",
    # aggregates
    "row_counts": _with(_SUPPLIER_BARS)
    + """SELECT 'lineitem' AS name, count(*) AS rows FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'bars', count(*) FROM bars""",
    "rows_per_key": _with(_SUPPLIER_BARS) + "SELECT coin_id, count(*) AS count FROM bars GROUP BY 1",
    "skew_by_key": "SELECT event_type, count(*) AS count FROM events GROUP BY 1",
    "rows_per_partition": _PARTITIONS + "SELECT * FROM spread",
    "skew_by_partition": _PARTITIONS
    + """SELECT count(*) AS partitions, max(rows) AS max_rows, min(rows) AS min_rows,
       CASE WHEN min(rows) > 0 THEN max(rows) / min(rows) ELSE 'inf'::DOUBLE END AS ratio, min(rows) * 5 < max(rows) AS skewed
FROM spread""",
    "avg_close_per_key": _with(_SUPPLIER_BARS) + "SELECT coin_id, round(avg(close), 6) AS avg_close FROM bars GROUP BY 1",
    "distinct_regimes": _silver + "SELECT DISTINCT market_regime FROM silver",
    "filter_partition_key": _event_silver
    + "SELECT coin_id, event_date, open, high, low, close FROM silver WHERE coin_id = 'click'",
    "limit_preview": _silver
    + "SELECT coin_id, event_date, close, market_regime FROM silver ORDER BY coin_id, event_date LIMIT 10",
    # silver and gold
    "silver_enriched": _silver + f"SELECT {_SILVER_COLUMNS} FROM silver",
    "silver_several_per_day": _with(_MERGED_BARS, _SILVER) + f"SELECT {_SILVER_COLUMNS} FROM silver",
    "silver_repeated_days": _with(_LINE_BARS, _ordered(_SILVER, "event_date")) + f"SELECT {_SILVER_COLUMNS} FROM silver",
    "silver_gaps": _gap_silver + f"SELECT {_SILVER_COLUMNS} FROM silver",
    "daily_summary": _with(_SUPPLIER_BARS, _SILVER, _SUPPLIER_LOOKUP)
    + f"SELECT {_SUMMARY_COLUMNS} FROM silver LEFT JOIN lookup USING (coin_id)",
    "daily_summary_events": _with(_EVENT_BARS, _SILVER, _EVENT_LOOKUP)
    + f"SELECT {_SUMMARY_COLUMNS} FROM silver LEFT JOIN lookup USING (coin_id)",
    "weekly_rankings": _with(_SUPPLIER_BARS, _WEEKLY) + _WEEKLY_RANKED,
    "weekly_rankings_gaps": _with(_GAP_BARS, _WEEKLY) + _WEEKLY_RANKED,
    "volatility_report": _with(_SUPPLIER_BARS, _SILVER, _VOLATILITY) + "SELECT * EXCLUDE (vol) FROM volatility",
    "volatility_several_per_day": _with(
        _LINE_BARS,
        _ordered(_SILVER, "event_ts"),
        _ordered(_VOLATILITY, "event_ts").replace("SELECT coin_id, event_date, close, round", "SELECT coin_id, event_date, event_ts, close, round"),
    )
    + "SELECT * EXCLUDE (vol) FROM volatility",
    "weekly_several_per_day": _with(
        _LINE_BARS,
        _WEEKLY.replace("arg_min(open, event_date)", f"arg_min(open, row(event_ts, {_TIES}))").replace(
            "arg_max(close, event_date)", f"arg_max(close, row(event_ts, {_TIES}))"
        ),
    )
    + _WEEKLY_RANKED,
    "topk_volatility": _with(_SUPPLIER_BARS, _SILVER, _VOLATILITY)
    + """SELECT coin_id, event_date, close, annualized_vol_pct, rsi_14, market_regime FROM (
  SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY vol DESC, event_date) AS nth
  FROM volatility WHERE vol IS NOT NULL) WHERE nth <= 5""",
    "regime_summary": _silver
    + """SELECT coin_id, market_regime, count(*) AS days_in_regime,
       round(avg(pct_change_1d), 4) AS avg_daily_return_pct, round(avg(rsi_14), 4) AS avg_rsi,
       round(avg(high_low_spread_pct), 4) AS avg_spread_pct, min(event_date) AS first_occurrence,
       max(event_date) AS last_occurrence,
       round(count(*) / sum(count(*)) OVER (PARTITION BY coin_id) * 100, 6) AS regime_pct_of_history
FROM silver WHERE market_regime <> 'unknown' GROUP BY 1, 2""",
    "regime_summary_basic": _silver
    + """SELECT coin_id, market_regime, count(*) AS days_in_regime,
       round(avg(pct_change_1d), 4) AS avg_daily_return_pct, round(avg(rsi_14), 4) AS avg_rsi
FROM silver WHERE market_regime <> 'unknown' GROUP BY 1, 2""",
    "regime_dominance": _with(_SUPPLIER_BARS, _SILVER, _REGIME_SHARES)
    + """SELECT coin_id, market_regime, count, total, round(regime_rate, 6) AS regime_rate
FROM shares WHERE regime_rate > 0.2""",
    # stored tables
    "filter_stored_key": "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'",
    "pruned_by_lookup": """
SELECT *, sum(CAST(floor(o_totalprice) AS BIGINT)) OVER (PARTITION BY o_orderpriority)::BIGINT AS turnover
FROM orders QUALIFY turnover % 2 = 0""",
    "stored_silver": _with(_ORDER_BARS, _SILVER) + f"SELECT {_SILVER_COLUMNS} FROM silver",
    "stored_weekly": _with(_ORDER_BARS, _WEEKLY) + _WEEKLY_RANKED,
    # quality
    "dq_null_rates": _with(_GAP_BARS) + _UNION.join(_null_rate(c, "bars") for c in _NULL_CHECKED),
    "dq_rsi_range": _with("\nmarked AS (SELECT l_quantity * 3 AS rsi_14 FROM lineitem)") + _forbidden(*_RSI_RANGE, "marked"),
    "dq_ohlc": _with(
        _SUPPLIER_BARS,
        """
shifted AS (
  SELECT * REPLACE (CASE WHEN day(event_date) = 13 THEN high - 5000 ELSE high END AS high,
                    CASE WHEN day(event_date) = 14 THEN NULL ELSE low END AS low)
  FROM bars)""",
    )
    + _forbidden(*_PRICE_ORDER, "shifted"),
    "dq_price_anomaly": _with(
        _SUPPLIER_BARS,
        """
spiked AS (SELECT * REPLACE (CASE WHEN dayofyear(event_date) = 200 THEN close * 100 ELSE close END AS close) FROM bars),
averaged AS (
  SELECT *, avg(close) OVER (PARTITION BY coin_id ORDER BY event_date ROWS 29 PRECEDING) AS avg_close_30d FROM spiked)""",
    )
    + _forbidden(*_SPIKES, "averaged"),
    "dq_zero_volume": _with(
        _GAP_BARS,
        """
emptied AS (
  SELECT * REPLACE (CASE WHEN dayofyear(event_date) % 5 = 0 THEN 0 ELSE total_volume_usd END AS total_volume_usd) FROM bars)""",
    )
    + _zero_volume("emptied"),
    "dq_regime_dominance": _with(_SUPPLIER_BARS, _SILVER, _REGIME_SHARES) + _regime_rows("shares", 0.8),
    "dq_summary": _with(
        _GAP_BARS,
        _SILVER,
        _REGIME_SHARES,
        "\nresults AS (\n"
        + _UNION.join(
            [
                *[_null_rate(c, "silver") for c in _SILVER_CHECKED],
                _forbidden(*_RSI_RANGE, "silver"),
                _forbidden(*_PRICE_ORDER, "silver"),
                _forbidden(*_SPIKES, "silver"),
                _zero_volume("silver"),
                _regime_rows("shares", 0.8),
            ]
        )
        + ")",
    )
    + """SELECT count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
       count(*) AS total FROM results""",
}

# The same results by another plan.
ORACLES["daily_rankings_fitting"] = ORACLES["daily_rankings"]
ORACLES["silver_split"] = ORACLES["silver_enriched"]
