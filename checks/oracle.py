"""The registered queries restated as SQL for DuckDB, independent of the package.

Each query starts from the same chain of views (trades, silver, enriched trades, marts). A
percentage or mean is computed in whole numbers, rounding half up at the digits Spark's
decimals keep, because DuckDB divides in floating point.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, uses: tuple[str, ...], sql: str) -> None:
    VIEWS[name] = (uses, sql)


def _with(*names: str) -> str:
    """A WITH clause of these views and all they use, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for used in VIEWS[name][0]:
            add(used)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS (\n{VIEWS[n][1].strip()}\n)" for n in ordered) + "\n"


def _query(uses: tuple[str, ...] | str, sql: str) -> str:
    return _with(*((uses,) if isinstance(uses, str) else uses)) + sql.strip()


def _whole(amount: str, digits: int) -> str:
    """A decimal as a whole number of its last digit."""
    return f"CAST(({amount}) * {10 ** digits} AS HUGEINT)"


def _half_up(numerator: str, denominator: str) -> str:
    """Whole-number division rounding half away from zero; the denominator is positive."""
    n, d = f"({numerator})", f"({denominator})"
    return f"(CASE WHEN {n} < 0 THEN -((2 * -{n} + {d}) // (2 * {d})) ELSE (2 * {n} + {d}) // (2 * {d}) END)"


def _pct_of_counts(part: str, whole: str) -> str:
    part, whole = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"CASE WHEN {whole} <> 0 THEN CAST({_half_up(f'{part} * 10000', whole)} AS DOUBLE) / 100 END"


def _pct_of_money(part: str, whole: str) -> str:
    """Spark divides to six digits first and rounds those to two."""
    part, whole = _whole(part, 4), _whole(whole, 4)
    six = _half_up(f"{part} * 100000000", whole)
    return f"CASE WHEN {whole} <> 0 THEN CAST({_half_up(six, '10000')} AS DOUBLE) / 100 END"


def _mean(total: str, n: str) -> str:
    """The mean of amounts, to eight digits."""
    eighth = _half_up(f"{_whole(total, 4)} * 10000", f"CAST({n} AS HUGEINT)")
    return f"CAST({eighth} AS DOUBLE) / 100000000"


def _dbl(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


# ---- trades -------------------------------------------------------------------------------

_INSTRUMENTS = "['EURUSD','GBPUSD','USDJPY','USDCHF','AAPL','MSFT','BRENT','GOLD','BMW.DE','SAP.DE']"
_MICROS = "'%Y-%m-%dT%H:%M:%S.%f'"

_view("trades_raw", (), f"""
SELECT event_id,
       'T' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS trade_id,
       'TDR_' || lpad(CAST(user_id % 50 + 1 AS VARCHAR), 3, '0') AS trader_id,
       list_extract({_INSTRUMENTS}, CAST(json_extract_string(props, '$.k') AS INT) % 10 + 1) AS instrument,
       CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS direction,
       CAST(CAST(value AS DECIMAL(18,2)) * 20000 AS DECIMAL(24,4)) AS notional,
       CAST(CAST(value AS DECIMAL(18,2)) + 1 AS DECIMAL(18,6)) AS price,
       CASE r_name WHEN 'AMERICA' THEN 'AMER' WHEN 'ASIA' THEN 'APAC' ELSE 'EMEA' END AS region,
       c_name AS counterparty,
       CASE event_type WHEN 'error' THEN 'CANCELLED' WHEN 'signup' THEN 'PENDING' ELSE 'EXECUTED' END AS status,
       ts AS trade_timestamp,
       event_id % 47 = 0 AS is_anomaly
FROM events
JOIN customer ON user_id = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
""")

_view("trades", ("trades_raw",), """
SELECT event_id, trade_id, trader_id, instrument, direction, notional, price,
       CASE WHEN instrument IN ('EURUSD', 'GBPUSD', 'USDJPY', 'USDCHF') THEN 'FX'
            WHEN instrument IN ('AAPL', 'MSFT', 'BMW.DE', 'SAP.DE') THEN 'Equities'
            ELSE 'Commodities' END AS desk,
       region, counterparty, status, trade_timestamp, is_anomaly
FROM trades_raw
""")

_TRADE = """trade_id, trader_id, instrument, direction, CAST(notional AS DOUBLE) AS notional,
       CAST(price AS DOUBLE) AS price, desk, region, counterparty, status, trade_timestamp, is_anomaly"""

# ---- validation ---------------------------------------------------------------------------

_view("text_trades", ("trades",), f"""
SELECT *, CASE WHEN event_id % 101 = 0 THEN 101 WHEN event_id % 103 = 0 THEN 103
               WHEN event_id % 107 = 0 THEN 107 WHEN event_id % 109 = 0 THEN 109
               WHEN event_id % 113 = 0 THEN 113 WHEN event_id % 127 = 0 THEN 127 ELSE 0 END AS fault
FROM trades
""")

_view("records", ("text_trades",), f"""
SELECT trade_id,
       CASE WHEN fault = 103 THEN replace(trader_id, 'TDR_', 'TRD_') ELSE trader_id END AS trader_id,
       instrument,
       CASE WHEN fault = 107 THEN 'HOLD' ELSE direction END AS direction,
       CASE WHEN fault = 101 THEN '-1' ELSE CAST(notional AS VARCHAR) END AS notional,
       CAST(price AS VARCHAR) AS price,
       desk, region,
       CASE WHEN fault = 127 THEN NULL ELSE counterparty END AS counterparty,
       CASE WHEN fault = 109 THEN 'UNKNOWN' ELSE status END AS status,
       CASE WHEN fault = 113 THEN 'not-a-time' ELSE strftime(trade_timestamp, {_MICROS}) END AS trade_timestamp,
       CASE WHEN is_anomaly THEN 'true' ELSE 'false' END AS is_anomaly
FROM text_trades
""")

_FIELDS = (
    "trade_id", "trader_id", "instrument", "direction", "notional", "price",
    "desk", "region", "counterparty", "status", "trade_timestamp", "is_anomaly",
)
_CASTS = {"notional": "decimal(24,4)", "price": "decimal(18,6)", "trade_timestamp": "timestamp", "is_anomaly": "boolean"}
_RULES = [f"CASE WHEN {f} IS NULL THEN '{f}: missing' END" for f in _FIELDS]
_RULES += [
    f"CASE WHEN {f} IS NOT NULL AND TRY_CAST({f} AS {t}) IS NULL THEN '{f}: not a {t}' END"
    for f, t in _CASTS.items()
]
_RULES += [
    "CASE WHEN direction NOT IN ('BUY', 'SELL') THEN 'direction: not BUY or SELL' END",
    "CASE WHEN status NOT IN ('EXECUTED', 'CANCELLED', 'PENDING') THEN 'status: unknown value' END",
    "CASE WHEN TRY_CAST(notional AS DECIMAL(24,4)) <= 0 THEN 'notional: not positive' END",
    "CASE WHEN NOT starts_with(trader_id, 'TDR_') THEN 'trader_id: does not start with TDR_' END",
]

_view("checked", ("records",), f"""
SELECT *, concat_ws('; ', {', '.join(_RULES)}) AS error FROM records
""")

# Landing lines: the fault of a line follows from its trade's number; blank lines are skipped.
_view("landing", ("records",), """
SELECT * REPLACE (CASE WHEN variant = 3 THEN CAST(number AS VARCHAR) ELSE counterparty END AS counterparty)
FROM (SELECT *, CAST(substr(trade_id, 2) AS BIGINT) AS number,
             CAST(substr(trade_id, 2) AS BIGINT) % 23 AS variant FROM records) AS r
WHERE variant <> 4
""")
_NUMBER_FOR_TEXT = "CASE WHEN variant = 3 THEN 'counterparty: not text' END"
_view("checked_lines", ("landing",), f"""
SELECT trade_id AS line_id,
       CASE WHEN variant IN (1, 2) THEN 'malformed_json'
            ELSE concat_ws('; ', {', '.join(_RULES)}, {_NUMBER_FOR_TEXT}) END AS error
FROM landing
""")

# ---- silver -------------------------------------------------------------------------------


def _cleaned(source: str) -> str:
    return f"""
SELECT trade_id, upper(trim(trader_id)) AS trader_id, upper(trim(instrument)) AS instrument,
       upper(trim(direction)) AS direction, notional, price,
       CASE lower(trim(desk)) WHEN 'fx' THEN 'Fx' WHEN 'equities' THEN 'Equities'
                              WHEN 'commodities' THEN 'Commodities' END AS desk,
       upper(trim(region)) AS region, trim(counterparty) AS counterparty,
       upper(trim(status)) AS status, trade_timestamp, is_anomaly,
       CAST(trade_timestamp AS DATE) AS trade_date, hour(trade_timestamp) AS trade_hour,
       minute(trade_timestamp) AS trade_minute
FROM ({source}) AS s
WHERE trade_id IS NOT NULL AND trader_id IS NOT NULL AND notional IS NOT NULL
  AND trade_timestamp IS NOT NULL
"""


_view("cast_records", ("records",), """
SELECT * REPLACE (TRY_CAST(notional AS DECIMAL(24,4)) AS notional,
                  TRY_CAST(price AS DECIMAL(18,6)) AS price,
                  TRY_CAST(trade_timestamp AS TIMESTAMP) AS trade_timestamp,
                  TRY_CAST(is_anomaly AS BOOLEAN) AS is_anomaly)
FROM records
""")
_view("clean_records", ("cast_records",), _cleaned("SELECT * FROM cast_records"))
_view("clean_trades", ("trades",), _cleaned("SELECT * FROM trades") + "  AND status <> 'CANCELLED'")

_view("converted", ("clean_trades",), """
SELECT *, CAST(round(notional * CAST(CASE instrument WHEN 'GBPUSD' THEN 1.17 WHEN 'USDJPY' THEN 0.0063
                                          WHEN 'USDCHF' THEN 1.08 ELSE 1 END AS DECIMAL(10,6)), 2)
               AS DECIMAL(24,4)) AS notional_eur
FROM clean_trades
""")

_view("featured", ("converted",), """
SELECT *,
       CAST(CASE direction WHEN 'BUY' THEN notional_eur WHEN 'SELL' THEN -notional_eur ELSE 0 END
            AS DECIMAL(24,4)) AS signed_notional_eur,
       notional_eur > 1000000 AS is_large_trade,
       CASE WHEN notional_eur > 5000000 THEN 'HIGH' WHEN notional_eur > 1000000 THEN 'MEDIUM'
            ELSE 'LOW' END AS risk_tier,
       CASE WHEN trade_hour < 8 THEN 'PREMARKET' WHEN trade_hour < 12 THEN 'MORNING'
            WHEN trade_hour < 16 THEN 'AFTERNOON' WHEN trade_hour < 18 THEN 'CLOSE'
            ELSE 'AFTERHOURS' END AS time_of_day
FROM converted
""")

_view("active", ("featured",), """
SELECT *,
       count(trade_id) OVER (PARTITION BY trader_id, trade_date, trade_hour) AS trades_in_hour,
       count(trade_id) OVER (PARTITION BY trader_id, trade_date, trade_hour) > 1 AS velocity_flag,
       sum(notional_eur) OVER (PARTITION BY trader_id, trade_date ORDER BY trade_timestamp, trade_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS trader_daily_notional_run
FROM featured
""")

_view("silver", ("active",), """
SELECT trade_id, trader_id, instrument, direction, desk, region, counterparty, status,
       notional, notional_eur, signed_notional_eur, price, trade_timestamp, trade_date,
       trade_hour, trade_minute, time_of_day, is_large_trade, risk_tier, velocity_flag,
       trades_in_hour, trader_daily_notional_run,
       CASE WHEN is_anomaly AND velocity_flag THEN 'CRITICAL'
            WHEN is_anomaly OR velocity_flag THEN 'WARNING' ELSE 'NORMAL' END AS alert_level,
       is_anomaly, TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at, 'trades_jsonl' AS _source
FROM active
""")

_CALENDAR = """CAST(CASE direction WHEN 'BUY' THEN 1 WHEN 'SELL' THEN -1 ELSE 0 END AS BIGINT) AS direction_multiplier,
       dayofweek(trade_date) + 1 AS day_of_week, dayname(trade_date) AS day_name,
       weekofyear(trade_date) AS week_number, dayofweek(trade_date) IN (0, 6) AS is_weekend"""
_EXPOSURE = """CASE WHEN abs(signed_notional_eur) > 5000000 THEN 'HIGH'
            WHEN abs(signed_notional_eur) > 1000000 THEN 'MEDIUM' ELSE 'LOW' END AS exposure_tier"""
_MARKET = "trade_hour BETWEEN 7 AND 17 AS is_market_hours"

_view("enriched", ("silver",), f"""
SELECT *, {_CALENDAR},
       {_EXPOSURE},
       {_MARKET}
FROM silver WHERE status <> 'CANCELLED'
""")

_MONEY_COLUMNS = ("notional", "notional_eur", "signed_notional_eur", "price", "trader_daily_notional_run")
_AS_DOUBLE = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MONEY_COLUMNS)

# ---- marts --------------------------------------------------------------------------------

_BUY = "CASE WHEN direction = 'BUY' THEN notional_eur ELSE 0 END"
_SELL = "CASE WHEN direction = 'SELL' THEN notional_eur ELSE 0 END"

_view("daily_sums", ("enriched",), f"""
SELECT trade_date, desk, instrument, region, day_name, week_number, is_weekend,
       count(trade_id) AS trade_count, sum(notional_eur) AS total, min(notional_eur) AS low,
       max(notional_eur) AS high, sum({_BUY}) AS bought, sum({_SELL}) AS sold,
       sum(signed_notional_eur) AS net,
       count(*) FILTER (direction = 'BUY') AS buy_count,
       count(*) FILTER (direction = 'SELL') AS sell_count,
       count(*) FILTER (is_large_trade) AS large_trade_count,
       count(*) FILTER (is_anomaly) AS anomaly_count,
       count(*) FILTER (velocity_flag) AS velocity_flagged_count,
       count(*) FILTER (alert_level = 'CRITICAL') AS critical_alert_count,
       count(*) FILTER (alert_level = 'WARNING') AS warning_alert_count,
       count(*) FILTER (is_market_hours) AS market_hours_count,
       count(*) FILTER (NOT is_market_hours) AS after_hours_count
FROM enriched GROUP BY ALL
""")

_view("mart_daily_volume", ("daily_sums",), f"""
SELECT trade_date, desk, instrument, region, day_name, week_number, is_weekend, trade_count,
       {_dbl('total', 'total_notional_eur')}, {_mean('total', 'trade_count')} AS avg_notional_eur,
       {_dbl('low', 'min_notional_eur')}, {_dbl('high', 'max_notional_eur')},
       {_dbl('bought', 'buy_volume_eur')}, {_dbl('sold', 'sell_volume_eur')},
       {_dbl('net', 'net_volume_eur')},
       buy_count, sell_count, large_trade_count, anomaly_count, velocity_flagged_count,
       critical_alert_count, warning_alert_count, market_hours_count, after_hours_count,
       {_pct_of_counts('anomaly_count', 'trade_count')} AS anomaly_rate_pct,
       {_pct_of_counts('buy_count', 'trade_count')} AS buy_pct,
       {_pct_of_counts('sell_count', 'trade_count')} AS sell_pct
FROM daily_sums
""")

_view("risk_sums", ("enriched",), f"""
SELECT trader_id, desk, region, count(trade_id) AS total_trades,
       count(*) FILTER (direction = 'BUY') AS buy_trades,
       count(*) FILTER (direction = 'SELL') AS sell_trades,
       sum(signed_notional_eur) AS net, sum({_BUY}) AS bought, sum({_SELL}) AS sold,
       sum(notional_eur) AS total, max(notional_eur) AS high,
       max(CASE WHEN velocity_flag THEN 1 ELSE 0 END) AS has_velocity_flag,
       max(CASE WHEN is_large_trade THEN 1 ELSE 0 END) AS has_large_trade,
       max(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS has_anomaly,
       count(*) FILTER (velocity_flag) AS velocity_flagged_trades,
       count(*) FILTER (is_anomaly) AS anomaly_trades,
       max(CASE WHEN alert_level = 'CRITICAL' THEN 1 ELSE 0 END) AS has_critical_alert,
       max(CASE WHEN alert_level = 'WARNING' THEN 1 ELSE 0 END) AS has_warning_alert,
       min(trade_date) AS first_trade_date, max(trade_date) AS last_trade_date,
       count(DISTINCT trade_date) AS active_trading_days
FROM enriched GROUP BY trader_id, desk, region
""")

_view("mart_risk_exposure", ("risk_sums",), f"""
SELECT trader_id, desk, region, total_trades, buy_trades, sell_trades,
       {_dbl('net', 'net_exposure_eur')}, {_dbl('bought', 'gross_long_eur')},
       {_dbl('sold', 'gross_short_eur')}, {_dbl('total', 'total_notional_eur')},
       {_mean('total', 'total_trades')} AS avg_trade_size_eur,
       {_dbl('high', 'largest_trade_eur')},
       CAST(has_velocity_flag AS BIGINT) AS has_velocity_flag,
       CAST(has_large_trade AS BIGINT) AS has_large_trade,
       CAST(has_anomaly AS BIGINT) AS has_anomaly,
       velocity_flagged_trades, anomaly_trades,
       CAST(has_critical_alert AS BIGINT) AS has_critical_alert,
       CAST(has_warning_alert AS BIGINT) AS has_warning_alert,
       CASE WHEN has_critical_alert = 1 THEN 'CRITICAL' WHEN has_warning_alert = 1 THEN 'WARNING'
            ELSE 'NORMAL' END AS worst_alert_level,
       first_trade_date, last_trade_date, active_trading_days,
       CASE WHEN abs(net) > 5000000 THEN 'HIGH' WHEN abs(net) > 1000000 THEN 'MEDIUM'
            ELSE 'LOW' END AS exposure_risk_tier,
       CASE WHEN net > 0 THEN 'LONG' WHEN net < 0 THEN 'SHORT' ELSE 'FLAT' END AS position_direction,
       {_pct_of_counts('anomaly_trades', 'total_trades')} AS anomaly_rate_pct
FROM risk_sums
""")

_view("instrument_sums", ("enriched",), f"""
SELECT instrument, desk, count(trade_id) AS trade_count, sum(notional_eur) AS total,
       min(notional_eur) AS low, max(notional_eur) AS high, sum({_BUY}) AS bought,
       sum({_SELL}) AS sold, sum(signed_notional_eur) AS net,
       count(DISTINCT trader_id) AS unique_traders, count(DISTINCT trade_date) AS active_days,
       count(DISTINCT region) AS active_regions,
       count(*) FILTER (is_anomaly) AS anomaly_count,
       count(*) FILTER (velocity_flag) AS velocity_flagged_count,
       count(*) FILTER (is_large_trade) AS large_trade_count,
       count(*) FILTER (alert_level = 'CRITICAL') AS critical_alert_count,
       min(trade_date) AS first_trade_date, max(trade_date) AS last_trade_date
FROM enriched GROUP BY instrument, desk
""")

_view("instrument_market", ("instrument_sums",), """
SELECT *, sum(total) OVER () AS market_total FROM instrument_sums
""")

_view("mart_top_instruments", ("instrument_market",), f"""
SELECT instrument, desk, trade_count, {_dbl('total', 'total_volume_eur')},
       {_mean('total', 'trade_count')} AS avg_trade_size_eur,
       {_dbl('low', 'min_trade_size_eur')}, {_dbl('high', 'max_trade_size_eur')},
       {_dbl('bought', 'buy_volume_eur')}, {_dbl('sold', 'sell_volume_eur')},
       {_dbl('net', 'net_volume_eur')},
       unique_traders, active_days, active_regions, anomaly_count, velocity_flagged_count,
       large_trade_count, critical_alert_count, first_trade_date, last_trade_date,
       {_pct_of_counts('anomaly_count', 'trade_count')} AS anomaly_rate_pct,
       {_pct_of_counts('large_trade_count', 'trade_count')} AS large_trade_rate_pct,
       {_pct_of_money('bought', 'total')} AS buy_volume_pct,
       {_pct_of_money('total', 'market_total')} AS volume_share_pct,
       rank() OVER (ORDER BY total DESC) AS volume_rank,
       rank() OVER (ORDER BY anomaly_count DESC) AS anomaly_rank
FROM instrument_market
""")

# ---- data quality -------------------------------------------------------------------------

_NOT_NULL = {
    "stg_trades": "trade_id trader_id notional_eur desk time_of_day trade_date trade_timestamp",
    "int_trade_enriched": "trade_id direction_multiplier day_of_week exposure_tier is_market_hours is_weekend",
    "mart_daily_volume": "trade_date desk instrument trade_count total_notional_eur anomaly_rate_pct buy_pct sell_pct",
    "mart_risk_exposure": "trader_id net_exposure_eur exposure_risk_tier worst_alert_level position_direction anomaly_rate_pct",
    "mart_top_instruments": "instrument total_volume_eur volume_rank anomaly_rate_pct volume_share_pct",
}
_LEVELS = "'CRITICAL', 'WARNING', 'NORMAL'"
_TIERS = "'HIGH', 'MEDIUM', 'LOW'"
_ACCEPTED = {
    "stg_trades": {
        "direction": "'BUY', 'SELL'",
        "status": "'EXECUTED', 'PENDING'",
        "risk_tier": _TIERS,
        "alert_level": _LEVELS,
        "desk": "'Fx', 'Equities', 'Commodities', 'Fixed Income'",
        "time_of_day": "'PREMARKET', 'MORNING', 'AFTERNOON', 'CLOSE', 'AFTERHOURS'",
    },
    "int_trade_enriched": {"direction_multiplier": "1, -1", "exposure_tier": _TIERS},
    "mart_risk_exposure": {
        "exposure_risk_tier": _TIERS,
        "worst_alert_level": _LEVELS,
        "position_direction": "'LONG', 'SHORT', 'FLAT'",
    },
}
_UNIQUE = (
    ("stg_trades", "trade_id"),
    ("int_trade_enriched", "trade_id"),
    ("mart_risk_exposure", "trader_id"),
    ("mart_risk_exposure", "trader_id, desk, region"),
    ("mart_top_instruments", "instrument"),
    ("mart_top_instruments", "volume_rank"),
)
_RELATION = {"stg_trades": "silver", "int_trade_enriched": "enriched"}


def _rule(kind: str, table: str, columns: str, failing: str) -> str:
    name = f"{kind}:{table}.{columns.replace(', ', '+')}"
    return f"SELECT '{name}' AS rule, CAST(({failing}) AS BIGINT) AS failing_rows"


def _suite(lines: list[str]) -> str:
    tables = ("silver", "enriched", "mart_daily_volume", "mart_risk_exposure", "mart_top_instruments")
    return _query(tables, "\nUNION ALL\n".join(lines))


def _not_null() -> str:
    return _suite([
        _rule("not_null", t, c, f"SELECT count(*) FROM {_RELATION.get(t, t)} WHERE {c} IS NULL")
        for t, columns in _NOT_NULL.items() for c in columns.split()
    ])


def _accepted() -> str:
    return _suite([
        _rule("accepted_values", t, c, f"SELECT count(*) FROM {_RELATION.get(t, t)} WHERE {c} NOT IN ({values})")
        for t, by_column in _ACCEPTED.items() for c, values in by_column.items()
    ])


def _unique() -> str:
    lines = []
    for t, key in _UNIQUE:
        repeated = f"SELECT {key} FROM {_RELATION.get(t, t)} GROUP BY {key} HAVING count(*) > 1"
        lines.append(_rule("unique", t, key, f"SELECT count(*) FROM ({repeated}) AS r"))
    return _suite(lines)


# ---- the queries --------------------------------------------------------------------------


def _breakdown(relation: str, column: str) -> str:
    return _query(relation, f"SELECT {column}, count(*) AS count FROM {relation} GROUP BY {column}")


def _layer(name: str, counted: str) -> str:
    return f"SELECT '{name}' AS layer, count(*) AS n_rows FROM {counted}"


_BUCKETS = 256


def _bucketed(column: str) -> tuple[str, str]:
    """Views that give every value of a column its bucket: quantiles, or a bucket for each."""
    c = column
    return f"{c}_buckets", f"""
WITH counted AS (
  SELECT {c} AS v, count(*) AS n FROM clean_trades WHERE {c} IS NOT NULL GROUP BY {c}
), placed AS (
  SELECT v, n, row_number() OVER (ORDER BY v) AS place, count(*) OVER () AS d, sum(n) OVER () AS total FROM counted
), parts AS (
  SELECT CASE WHEN d < {_BUCKETS} THEN place ELSE (place - 1) * {_BUCKETS} // d END AS part,
         min(v) AS v, sum(n) AS n, any_value(d) AS d, any_value(total) AS total FROM placed GROUP BY 1
), up_to AS (
  SELECT *, coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far FROM parts
), cuts AS (
  SELECT min(v) AS v FROM up_to
  GROUP BY CASE WHEN d < {_BUCKETS} THEN part ELSE so_far * {_BUCKETS - 1} // total END
)
SELECT counted.v, (SELECT count(*) FROM cuts WHERE cuts.v <= counted.v) - 1 AS bucket, (SELECT count(*) FROM cuts) - 1 AS cuts
FROM counted
"""


_Z_COLUMNS = ("trader_id", "instrument", "counterparty")
for _column in _Z_COLUMNS:
    _view(_bucketed(_column)[0], ("clean_trades",), _bucketed(_column)[1])


def _z_key() -> str:
    """The bits of the buckets in turn, each column's spread over all the bits."""
    width = lambda c: f"length(ltrim(bin({c}_buckets.cuts), '0'))"
    most = f"greatest({', '.join(width(c) for c in _Z_COLUMNS)})"
    n = len(_Z_COLUMNS)
    bits = [
        f"((((CAST({c}_buckets.bucket AS BIGINT) << {most}) // ({c}_buckets.cuts + 1)) >> {bit}) & 1) * {1 << (bit * n + n - 1 - place)}"
        for bit in range(8)
        for place, c in enumerate(_Z_COLUMNS)
    ]
    joins = " ".join(f"JOIN {c}_buckets ON {c}_buckets.v = t.{c}" for c in _Z_COLUMNS)
    names = ", ".join(f"{c}_buckets.bucket AS {c}_bucket" for c in _Z_COLUMNS)
    return f"SELECT trade_id, {names}, CAST({' + '.join(bits)} AS BIGINT) AS z_key FROM clean_trades t {joins}"


def oracle_sql() -> dict[str, str]:
    marts = ("mart_daily_volume", "mart_risk_exposure", "mart_top_instruments")
    sql = {
        "bronze_scan": _query("trades", f"SELECT {_TRADE} FROM trades"),
        "bronze_validate": _query("checked", "SELECT trade_id, error = '' AS is_valid, error FROM checked"),
        "bronze_valid": _query("checked", f"SELECT {', '.join(_FIELDS)} FROM checked WHERE error = ''"),
        "bronze_quarantine": _query(
            "checked",
            f"SELECT {', '.join(_FIELDS)}, error AS _error, 'load-1' AS _load_id, "
            "TIMESTAMP '2024-01-01 00:00:00' AS _quarantined_at FROM checked WHERE error <> ''",
        ),
        "bronze_fresh": _query(
            "checked",
            f"SELECT {', '.join(_FIELDS)}, TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at, "
            "'trades_jsonl' AS _source FROM checked WHERE error = '' AND status = 'PENDING'",
        ),
        "landing_parse": _query("landing", f"""
SELECT trade_id AS line_id, variant IN (1, 2) AS malformed,
       CASE WHEN variant = 3 THEN 'counterparty' ELSE '' END AS not_text,
       {', '.join(
           f"CASE WHEN variant NOT IN (1, 2) THEN {f'CAST({f} AS DOUBLE)' if f in ('notional', 'price') else f}"
           f" END AS {f}" for f in _FIELDS
       )}
FROM landing
"""),
        "landing_validate": _query(
            "checked_lines", "SELECT line_id, error = '' AS is_valid, error FROM checked_lines"
        ),
        "table_by_sql_path": "SELECT * REPLACE (CAST(c_nationkey AS BIGINT) AS c_nationkey) FROM customer",
        "staged_view": _query("silver", f"""
SELECT desk, region, count(*) AS trades, {_dbl('sum(notional_eur)', 'eur')} FROM silver
WHERE status <> 'CANCELLED' GROUP BY desk, region
"""),
        "sample_size": "SELECT CAST(10 AS BIGINT) AS n_rows, CAST(10 AS BIGINT) AS n_amounts",
        "fx_conversion_table": _query(("trades", "clean_trades"), f"""
SELECT trade_id, c.instrument, {_dbl('notional', 'notional')},
       {_dbl('CAST(round(notional * rate, 2) AS DECIMAL(24,4))', 'notional_eur')}
FROM clean_trades AS c
JOIN (SELECT instrument, CAST((count(*) % 97 + 1) * 0.01 AS DECIMAL(10,6)) AS rate
      FROM trades GROUP BY instrument) AS r USING (instrument)
"""),
        "velocity_windows": _query("clean_trades", """
SELECT trader_id, date_trunc('hour', trade_timestamp) AS window_start,
       date_trunc('hour', trade_timestamp) + INTERVAL 1 HOUR AS window_end,
       count(DISTINCT trade_id) AS trades_in_window, count(DISTINCT trade_id) > 1 AS velocity_flag
FROM clean_trades GROUP BY ALL
"""),
        "sorted_daily_volume": _query("mart_daily_volume", """
SELECT trade_date, desk, instrument, region, row_number() OVER (
  ORDER BY trade_date DESC, total_notional_eur DESC, desk, instrument, region) AS position
FROM mart_daily_volume
"""),
        "sorted_risk_exposure": _query("mart_risk_exposure", """
SELECT trader_id, desk, region, row_number() OVER (
  ORDER BY abs(net_exposure_eur) DESC, trader_id, desk, region) AS position
FROM mart_risk_exposure
"""),
        "sorted_top_instruments": _query("mart_top_instruments", """
SELECT instrument, desk, row_number() OVER (ORDER BY volume_rank, instrument, desk) AS position
FROM mart_top_instruments
"""),
        "bronze_summary": _query("checked", f"""
SELECT total, valid, quarantined, {_pct_of_counts('valid', 'total')} AS valid_pct,
       {_pct_of_counts('quarantined', 'total')} AS quarantined_pct
FROM (SELECT count(*) AS total, count(*) FILTER (error = '') AS valid,
             count(*) FILTER (error <> '') AS quarantined FROM checked) AS c
"""),
        "bronze_merge_insert": _query(
            "trades",
            f"SELECT {_TRADE}, CASE status WHEN 'PENDING' THEN 'arriving' ELSE 'earlier' END AS _source FROM trades",
        ),
        "silver_clean": _query(
            "clean_records",
            "SELECT * REPLACE (CAST(notional AS DOUBLE) AS notional, CAST(price AS DOUBLE) AS price) FROM clean_records",
        ),
        "silver_not_cancelled": _query(
            "clean_records",
            "SELECT * REPLACE (CAST(notional AS DOUBLE) AS notional, CAST(price AS DOUBLE) AS price) "
            "FROM clean_records WHERE status <> 'CANCELLED'",
        ),
        "fx_conversion": _query("converted", f"""
SELECT trade_id, instrument, {_dbl('notional', 'notional')}, {_dbl('notional_eur', 'notional_eur')} FROM converted
"""),
        "signed_notional": _query("featured", f"""
SELECT trade_id, direction, {_dbl('notional_eur', 'notional_eur')},
       {_dbl('signed_notional_eur', 'signed_notional_eur')} FROM featured
"""),
        "risk_features": _query("featured", f"""
SELECT trade_id, {_dbl('notional_eur', 'notional_eur')}, is_large_trade, risk_tier FROM featured
"""),
        "time_of_day": _query("featured", "SELECT trade_id, trade_hour, time_of_day FROM featured"),
        "velocity": _query("active", """
SELECT trade_id, trader_id, trade_date, trade_hour, trades_in_hour, velocity_flag FROM active
"""),
        "running_notional": _query("active", f"""
SELECT trade_id, trader_id, trade_date, {_dbl('notional_eur', 'notional_eur')},
       {_dbl('trader_daily_notional_run', 'trader_daily_notional_run')} FROM active
"""),
        "alert_level": _query("silver", "SELECT trade_id, is_anomaly, velocity_flag, alert_level FROM silver"),
        "silver_trades": _query("silver", f"SELECT * REPLACE ({_AS_DOUBLE}) FROM silver"),
        "stg_trades": _query("silver", f"SELECT * REPLACE ({_AS_DOUBLE}) FROM silver WHERE status <> 'CANCELLED'"),
        "int_trade_enriched": _query("enriched", f"SELECT * REPLACE ({_AS_DOUBLE}) FROM enriched"),
        "calendar_features": _query("featured", f"SELECT trade_id, {_CALENDAR}, {_MARKET} FROM featured"),
        "exposure_tier": _query("featured", f"""
SELECT trade_id, {_dbl('signed_notional_eur', 'signed_notional_eur')}, {_EXPOSURE} FROM featured
"""),
        "cents_to_euros": _query("trades", f"""
SELECT trade_id, {_dbl('price', 'cents')},
       CAST({_half_up(_whole('price', 6), '1000000')} AS DOUBLE) / 100 AS euros FROM trades
"""),
        "buy_sell_volume": _query("mart_top_instruments", """
SELECT instrument, desk, buy_volume_eur, sell_volume_eur, net_volume_eur FROM mart_top_instruments
"""),
        "conditional_counts": _query("mart_daily_volume", """
SELECT trade_date, desk, instrument, region, buy_count, sell_count, large_trade_count, anomaly_count,
       velocity_flagged_count, critical_alert_count, warning_alert_count, market_hours_count,
       after_hours_count FROM mart_daily_volume
"""),
        "worst_alert": _query("mart_risk_exposure", """
SELECT trader_id, desk, region, has_critical_alert, has_warning_alert, worst_alert_level FROM mart_risk_exposure
"""),
        "distinct_counts": _query("mart_top_instruments", """
SELECT instrument, desk, unique_traders, active_days, active_regions FROM mart_top_instruments
"""),
        "anomaly_rate": _query("mart_risk_exposure", """
SELECT trader_id, desk, region, anomaly_trades, total_trades, anomaly_rate_pct FROM mart_risk_exposure
"""),
        "alert_breakdown": _breakdown("silver", "alert_level"),
        "risk_breakdown": _breakdown("featured", "risk_tier"),
        "status_breakdown": _breakdown("trades", "status"),
        "rows_per_date": _breakdown("clean_trades", "trade_date"),
        "silver_summary": _query("clean_trades", """
SELECT count(*) AS total_rows, min(trade_date) AS first_date, max(trade_date) AS last_date,
       count(DISTINCT trader_id) AS traders, count(DISTINCT instrument) AS instruments FROM clean_trades
"""),
        "top_velocity_traders": _query("silver", """
SELECT trader_id, count(*) AS flagged_trades FROM silver WHERE velocity_flag
GROUP BY trader_id ORDER BY flagged_trades DESC, trader_id LIMIT 10
"""),
        "top_daily_volume": _query("mart_daily_volume", """
SELECT * FROM mart_daily_volume
ORDER BY trade_date DESC, total_notional_eur DESC, desk, instrument, region LIMIT 5
"""),
        "top_risk_traders": _query("mart_risk_exposure", """
SELECT trader_id, desk, net_exposure_eur, exposure_risk_tier, worst_alert_level FROM mart_risk_exposure
ORDER BY abs(net_exposure_eur) DESC, trader_id, desk, region LIMIT 5
"""),
        "instrument_ranking": _query("mart_top_instruments", """
SELECT instrument, desk, trade_count, total_volume_eur, anomaly_rate_pct, volume_rank
FROM mart_top_instruments ORDER BY volume_rank, instrument, desk
"""),
        "layer_reconciliation": _query(("trades", "silver", *marts), "\nUNION ALL\n".join([
            _layer("bronze", "trades"),
            _layer("dropped_incomplete", "trades WHERE trade_id IS NULL OR trader_id IS NULL "
                   "OR notional IS NULL OR trade_timestamp IS NULL"),
            _layer("dropped_cancelled", "trades WHERE status = 'CANCELLED'"),
            _layer("dropped_no_status", "trades WHERE status IS NULL"),
            _layer("silver", "silver"),
            *[_layer(mart, mart) for mart in marts],
        ])),
        "dq_not_null": _not_null(),
        "dq_accepted_values": _accepted(),
        "dq_unique": _unique(),
        "dq_positive_notional": _query("silver", _rule(
            "positive", "stg_trades", "notional_eur", "SELECT count(*) FROM silver WHERE notional_eur <= 0"
        )),
        "dq_trade_count": _query("mart_daily_volume", _rule(
            "positive", "mart_daily_volume", "trade_count",
            "SELECT count(*) FROM mart_daily_volume WHERE trade_count <= 0",
        )),
    }
    for mart in marts:
        sql[mart] = _query(mart, f"SELECT * FROM {mart}")
    # The same marts, by way of their state per date, and with bitmaps for the distinct counts.
    for mart in marts[1:]:
        sql[f"{mart}_merged"] = sql[mart]
    sql["distinct_by_bitmaps"] = _query("enriched", """
SELECT instrument, desk, count(DISTINCT trader_id) AS unique_traders, count(DISTINCT region) AS active_regions
FROM enriched GROUP BY instrument, desk
""")
    sql["silver_zorder"] = _query(tuple(f"{c}_buckets" for c in _Z_COLUMNS), _z_key())
    # Truncated lines and lines with two objects are no records.
    kinds = {"notional": "'number'", "price": "'number'", "is_anomaly": "'boolean'"}
    fields = [
        (f, f, f"CASE WHEN {f} IS NULL THEN 'null' WHEN {'variant = 3' if f == 'counterparty' else 'false'} "
               f"THEN 'number' ELSE {kinds.get(f, chr(39) + 'string' + chr(39))} END",
         "number % 10 <> 7" if f == "price" else "true")
        for f in _FIELDS
    ] + [("px", "price", "'number'", "number % 10 = 7")]
    cells = " UNION ALL ".join(
        f"SELECT '{name}' AS field, {kind} AS kind FROM landing WHERE variant NOT IN (1, 2) AND {there}"
        for name, _, kind, there in fields
    )
    sql["landing_drift"] = _query("landing", f"""
SELECT field, CASE WHEN field = 'px' THEN 'added' WHEN n_present < total THEN 'missing'
                   WHEN n_unexpected > 0 THEN 'retyped' ELSE 'as_declared' END AS status,
       n_present, total - n_present AS n_missing,
       CASE WHEN field <> 'px' THEN n_unexpected END AS n_unexpected, kinds
FROM (SELECT field, count(*) AS n_present, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds,
             count(*) FILTER (field = 'counterparty' AND kind = 'number') AS n_unexpected
      FROM ({cells}) GROUP BY field),
     (SELECT count(*) AS total FROM landing WHERE variant NOT IN (1, 2))
""")
    sql["bronze_insert_pruned"] = _query("trades", f"""
SELECT {_TRADE}, left(md5(trade_id), 1) AS _prefix FROM trades
WHERE status = 'PENDING' AND left(md5(trade_id), 1) = '7'
""")
    sql["velocity_alerts"] = _query("clean_trades", """
SELECT trader_id, trade_date, trade_hour, trade_id, trade_timestamp, trades_in_hour FROM (
  SELECT *, row_number() OVER (PARTITION BY trader_id, trade_date, trade_hour ORDER BY trade_timestamp, trade_id)
    AS trades_in_hour FROM clean_trades)
WHERE trades_in_hour = 2
""")
    sql["cents_to_euros_sql"] = sql["cents_to_euros"]
    sql["fx_conversion_sql"] = sql["fx_conversion"]
    sql["trades_between"] = _query("silver", """
SELECT trade_date, desk, count(*) AS trades, CAST(sum(notional_eur) AS DOUBLE) AS eur FROM silver
WHERE trade_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY trade_date, desk
""")
    return sql
