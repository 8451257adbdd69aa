"""The queries as SQL for DuckDB: an independent statement of what each must return."""

from __future__ import annotations

_PRICES = ("open", "high", "low", "close")

# Feeds, one definition per function of ``workload.feeds``.
_FEEDS = {
    "line_actions": """
        SELECT 'S' || l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date,
               CAST(CASE WHEN l_returnflag = 'R' THEN round(l_discount * 100) ELSE 0 END AS BIGINT) * 10000 AS dividend,
               CAST(CASE WHEN l_tax >= 0.08 AND l_linenumber = 7 THEN 20000
                         WHEN l_tax >= 0.08 AND l_linenumber = 6 THEN 5000
                         WHEN l_tax >= 0.08 AND l_linenumber = 5 THEN 15000 ELSE 10000 END AS BIGINT) AS split_ratio
        FROM lineitem""",
    "ticks": """
        SELECT 'S' || l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date,
               CAST(round(l_extendedprice * 100) AS BIGINT) * 100 AS price,
               CASE WHEN l_returnflag = 'R' THEN round(l_discount * 100) ELSE 0 END AS paid,
               CASE WHEN l_tax >= 0.08 THEN l_linenumber END AS line
        FROM lineitem""",
    "bars": """
        SELECT symbol, date, (min(price) + max(price)) // 2 AS open, max(price) AS high, min(price) AS low,
               CAST(sum(price) // count(*) AS BIGINT) AS close, CAST(max(paid) AS BIGINT) * 10000 AS dividend,
               CAST(CASE max(line) WHEN 7 THEN 20000 WHEN 6 THEN 5000 WHEN 5 THEN 15000 ELSE 10000 END
                    AS BIGINT) AS split_ratio
        FROM ticks GROUP BY symbol, date""",
    "staged": """
        SELECT 'U' || user_id AS symbol, date_trunc('minute', ts) AS date, CAST(ts AS DATE) AS day, price AS open,
               price + event_id % 7 * 100 AS high,
               CASE WHEN price - event_id % 5 * 100 > 0 THEN price - event_id % 5 * 100 ELSE price END AS low,
               price AS close, event_id AS _seq, event_type
        FROM (SELECT *, CAST(round(value * 100) AS BIGINT) * 100 AS price FROM events)""",
    "minutes": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY _seq DESC) AS n FROM staged)
        WHERE n = 1""",
    "rolled": """
        SELECT symbol, day AS date, arg_min(open, m.date) AS open, max(high) AS high, min(low) AS low,
               arg_max(close, m.date) AS close
        FROM minutes m GROUP BY symbol, day""",
    "event_actions": """
        SELECT symbol, date, dividend,
               CAST(CASE kind WHEN 2 THEN 20000 WHEN 1 THEN 5000 ELSE 10000 END AS BIGINT) AS split_ratio
        FROM (SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS date,
                     max(CASE WHEN event_type = 'purchase' THEN event_id % 9 * 100 ELSE 0 END) AS dividend,
                     max(CASE WHEN value >= 40 AND event_type = 'signup' THEN 2
                              WHEN value >= 40 AND event_type = 'error' THEN 1 ELSE 0 END) AS kind
              FROM events GROUP BY ALL)""",
    "order_rows": """
        SELECT 'C' || (o_custkey % 50) AS symbol, CAST(o_orderdate AS DATE) AS date, o_orderstatus AS feed,
               CAST(round(o_totalprice * 100) AS BIGINT) * 100 AS price, o_orderkey AS _seq
        FROM orders""",
    # Stored days first, then bars rolled up from the minutes, then imported daily bars.
    "order_minutes": """
        SELECT * FROM (SELECT symbol, date, price, _seq % 390 AS minute,
                              row_number() OVER (PARTITION BY symbol, date, _seq % 390 ORDER BY _seq DESC) AS n
                       FROM order_rows WHERE feed = 'F') WHERE n = 1""",
    "order_days": """
        SELECT symbol, date, open, high, low, close FROM (
            SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY source, _seq DESC) AS n FROM (
                SELECT symbol, date, price AS open, price AS high, price AS low, price AS close, 0 AS source, _seq
                FROM order_rows WHERE feed = 'P'
                UNION ALL
                SELECT symbol, date, arg_min(price, minute), max(price), min(price), arg_max(price, minute), 1, 0
                FROM order_minutes GROUP BY symbol, date
                UNION ALL
                SELECT symbol, date, price, price, price, price, 2, _seq FROM order_rows WHERE feed = 'O'))
        WHERE n = 1""",
    "order_actions": """
        SELECT o_custkey % 100 AS number, CAST(o_orderdate AS DATE) AS date, o_orderkey % 10 * 1000 AS dividend,
               CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 20000 ELSE 10000 END AS BIGINT) AS split_ratio,
               o_orderkey AS _seq, o_orderstatus AS feed
        FROM orders""",
    "minute_text": """
        SELECT event_id, 'U' || user_id AS symbol, date_trunc('minute', ts) AS date, event_type,
               CAST(value AS DECIMAL(12,2)) AS price
        FROM events""",
}

_ACTION = "(dividend <> 0 OR split_ratio <> 10000)"


def _with(*feeds: str, **more: str) -> str:
    parts = {name: _FEEDS[name] for name in feeds} | more
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in parts.items())


def _adjusted(days: str, actions: str, where: str = "TRUE", times: int = 1) -> dict[str, str]:
    """Common tables that end in ``adjusted``: the adjustment of ``days`` by ``actions``."""
    prices = ", ".join(f"CAST(floor({price} * coefficient) AS BIGINT) AS adjusted_{price}" for price in _PRICES)
    return {
        "enriched": f"""
            SELECT d.symbol, d.date, d.open, d.high, d.low, d.close,
                   COALESCE(a.dividend, 0) * {times} AS dividend, COALESCE(a.split_ratio, 0) AS split_ratio
            FROM (SELECT * FROM {days} WHERE {where}) d
            LEFT JOIN (SELECT * FROM {actions} WHERE {_ACTION}) a USING (symbol, date)""",
        "paired": """
            SELECT *, lag(date) OVER w AS newer_date, lag(dividend, 1, 0) OVER w AS newer_dividend,
                   lag(CASE WHEN split_ratio = 0 THEN 10000 ELSE split_ratio END, 1, 10000) OVER w AS newer_split_ratio
            FROM enriched WINDOW w AS (PARTITION BY symbol ORDER BY date DESC)""",
        "factors": """
            SELECT *, (CASE WHEN newer_split_ratio <> 10000
                            THEN CAST(10000 AS DOUBLE) / newer_split_ratio ELSE CAST(1 AS DOUBLE) END)
                    * (CASE WHEN newer_dividend <> 0 AND newer_dividend < close
                            THEN CAST(1 AS DOUBLE) - newer_dividend / close ELSE CAST(1 AS DOUBLE) END) AS factor
            FROM paired""",
        # Folded from the newest day on, in that order.
        "coefficients": """
            SELECT *, list_reduce(list(factor) OVER (PARTITION BY symbol ORDER BY date DESC
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                                  lambda a, b: a * b) AS coefficient
            FROM factors""",
        "adjusted": f"""
            SELECT symbol, date, CAST(floor(coefficient * 10000) AS BIGINT) AS adjustment_coefficient, {prices}
            FROM coefficients""",
    }


def _descaled(*names: str) -> str:
    decimal = "CAST(CAST({0} AS DECIMAL(20,0)) * CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(20,4)) AS {0}"
    return ", ".join(decimal.format(name) for name in names)


_DESCALED = _descaled(*_PRICES, *(f"adjusted_{price}" for price in _PRICES))

_DAYS_VIEW = """
    SELECT d.symbol, d.date, d.open, d.high, d.low, d.close,
           COALESCE(adjusted_open, 0) AS adjusted_open, COALESCE(adjusted_high, 0) AS adjusted_high,
           COALESCE(adjusted_low, 0) AS adjusted_low, COALESCE(adjusted_close, 0) AS adjusted_close
    FROM {days} d LEFT JOIN adjusted USING (symbol, date)"""

_MINUTES_VIEW = """
    SELECT m.symbol, m.date, m.open, m.high, m.low, m.close, {adjusted}
    FROM minutes m LEFT JOIN (SELECT symbol, date AS day, adjustment_coefficient FROM adjusted) USING (symbol, day)
""".format(
    adjusted=", ".join(
        f"CAST(trunc(m.{price} * COALESCE(adjustment_coefficient, 0) / 10000) AS BIGINT) AS adjusted_{price}"
        for price in _PRICES
    )
)

_LINE_ADJUSTED = _adjusted("bars", "bars")
_BEFORE_2001 = _adjusted("bars", "bars", where="date < DATE '2001-01-01'")
_MINUTE_ADJUSTED = _adjusted("rolled", "event_actions")

_PARSED_MINUTE = """
    symbol, date, CAST(price * 10000 AS BIGINT) AS open, CAST((price + 1) * 10000 AS BIGINT) AS high,
    CAST(price * 10000 AS BIGINT) AS low, CAST(price * 10000 AS BIGINT) AS close"""
_GOOD = "event_type NOT IN ('signup', 'error')"

# 28 years are 336 months.
_OLD_DATE = "CAST(CAST(o_orderdate AS DATE) - INTERVAL 336 MONTH AS DATE)"

_ORDER_ACTIONS = """
    SELECT 'C' || number AS symbol, date, dividend, split_ratio FROM (
        SELECT *, row_number() OVER (PARTITION BY number, date
                                     ORDER BY CASE WHEN feed = 'P' THEN 0 ELSE 1 END, _seq DESC) AS n
        FROM order_actions WHERE """ + _ACTION + """) WHERE n = 1"""

# All factors are 1/2, 2 and 4/5, so a coefficient is a power of two over a power of five.
_EXACT = f"""{_with('ticks', 'bars')}, splits AS (
            SELECT symbol, date, open, high, low, close, split_ratio,
                   sum(CASE split_ratio WHEN 20000 THEN -1 WHEN 5000 THEN 1 WHEN 15000 THEN 2 ELSE 0 END) OVER newer AS twos,
                   sum(CASE split_ratio WHEN 15000 THEN 1 ELSE 0 END) OVER newer AS fives
            FROM bars
            WINDOW newer AS (PARTITION BY symbol ORDER BY date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        powers AS (
            SELECT *, CAST(pow(2, greatest(COALESCE(twos, 0), 0)) AS HUGEINT) AS up,
                   CAST(pow(2, greatest(-COALESCE(twos, 0), 0)) AS HUGEINT)
                   * CAST(pow(5, COALESCE(fives, 0)) AS HUGEINT) AS down
            FROM splits)
        SELECT symbol, date, CAST(CAST(10000 AS HUGEINT) * up // down AS BIGINT) AS adjustment_coefficient,
               {', '.join(f'CAST(CAST({price} AS HUGEINT) * up // down AS BIGINT) AS adjusted_{price}' for price in _PRICES)}
        FROM powers"""

_SEPARATE = """
    SELECT symbol, date, dividend, split_ratio FROM (
        SELECT 'S' || number AS symbol, *, row_number() OVER (PARTITION BY number, date ORDER BY _seq DESC) AS n
        FROM order_actions WHERE """ + _ACTION + """) WHERE n = 1"""

# The actions of a bar in their order: ratios multiply, dividends count in shares before the first split.
_MOVED = """
    SELECT symbol, bar AS date, CAST(sum(dividend * ratio // 10000) AS BIGINT) AS dividend,
           CAST(last(ratio * split_ratio // 10000 ORDER BY date) AS BIGINT) AS split_ratio
    FROM (
        SELECT *, list_reduce(list_concat([CAST(10000 AS HUGEINT)],
                   COALESCE(list(CAST(split_ratio AS HUGEINT)) OVER (PARTITION BY symbol, bar ORDER BY date
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), [])),
                   lambda a, b: a * b // 10000) AS ratio
        FROM (SELECT a.symbol, a.date, a.dividend, a.split_ratio, min(b.date) AS bar
              FROM separate a JOIN bars b ON b.symbol = a.symbol AND b.date >= a.date GROUP BY ALL))
    GROUP BY symbol, bar"""

ORACLES: dict[str, str] = {
    "parse_days": """
        SELECT 'S' || l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, price * 100 AS open,
               price * 100 + 12 AS high, price * 10 AS low, price * 100 AS close,
               CAST(round(l_discount * 100) AS BIGINT) * 100 AS dividend,
               10000 + CAST(round(l_tax * 100) AS BIGINT) * 100 AS split_ratio
        FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS price FROM lineitem)""",
    "parse_minutes": f"{_with('minute_text')} SELECT {_PARSED_MINUTE} FROM minute_text",
    "parse_adjustments": """
        SELECT 'P' || p_partkey AS symbol, CAST(DATE '2000-01-01' + CAST(p_partkey % 5000 AS INTEGER) AS DATE) AS date,
               CAST(round(p_retailprice * 100) AS BIGINT) * 100 AS dividend,
               CAST(CASE WHEN p_partkey % 11 = 0 THEN 0 WHEN p_partkey % 7 = 0 THEN 99 ELSE 1000000 // p_size END
                    AS BIGINT) AS split_ratio
        FROM part""",
    "reject_rows": f"""{_with('minute_text')}
        SELECT symbol, CAST(year(date) AS VARCHAR) || '-' || month(date) || '-' || day(date)
                       || CASE WHEN event_type = 'signup' THEN 'T' ELSE ' ' END
                       || hour(date) || ':' || minute(date) || ':0' AS date,
               CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(price AS VARCHAR) END AS close,
               CAST(event_id AS VARCHAR) AS volume
        FROM minute_text WHERE NOT ({_GOOD})""",
    "skip_errors": f"{_with('minute_text')} SELECT {_PARSED_MINUTE} FROM minute_text WHERE {_GOOD}",
    "import_counts": f"""
        SELECT count(*) FILTER (WHERE {_OLD_DATE} >= DATE '1970-01-01') AS accepted, CAST(0 AS BIGINT) AS rejected,
               count(*) FILTER (WHERE {_OLD_DATE} < DATE '1970-01-01') AS too_old
        FROM orders""",
    "min_date_filter": f"""
        SELECT 'C' || o_custkey AS symbol, {_OLD_DATE} AS date,
               CAST(round(o_totalprice * 100) AS BIGINT) * 100 AS close
        FROM orders WHERE {_OLD_DATE} >= DATE '1970-01-01'""",
    "offset_rows": f"""{_with('minute_text')}
        SELECT {_PARSED_MINUTE}
        FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS n FROM minute_text WHERE {_GOOD}) WHERE n >= 100""",
    "to_date_day": "SELECT event_id, ts, CAST(ts AS DATE) AS day FROM events",
    "descaled_prices": f"""{_with('staged')}
        SELECT symbol, date, {_descaled(*_PRICES)} FROM staged""",
    "distinct_rows": f"{_with('line_actions')} SELECT DISTINCT symbol, date, dividend, split_ratio FROM line_actions",
    "dedup_latest": f"{_with('staged', 'minutes')} SELECT symbol, date, open, high, low, close FROM minutes",
    "anti_new_keys": f"""{_with('staged', 'minutes')}
        SELECT symbol, day, date, open, high, low, close FROM minutes
        WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM staged WHERE event_type IN ('click', 'view'))""",
    "day_bars": f"{_with('staged', 'minutes', 'rolled')} SELECT * FROM rolled",
    "days_merged": f"{_with('order_rows', 'order_minutes', 'order_days')} SELECT * FROM order_days",
    "newest_days_merged": f"""{_with('order_rows', 'order_minutes')}
        SELECT symbol, date, open, high, low, close FROM (
            SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY source, _seq DESC) AS n FROM (
                SELECT symbol, date, arg_min(price, minute) AS open, max(price) AS high, min(price) AS low,
                       arg_max(price, minute) AS close, 0 AS source, 0 AS _seq
                FROM order_minutes GROUP BY symbol, date
                UNION ALL
                SELECT symbol, date, price, price, price, price, CASE feed WHEN 'O' THEN 1 ELSE 2 END, _seq
                FROM order_rows WHERE feed IN ('O', 'P')))
        WHERE n = 1""",
    "refreshed_days": f"""{_with('staged', 'minutes', 'rolled')}
        SELECT * FROM rolled
        WHERE (symbol, date) IN (SELECT (symbol, day) FROM minutes WHERE minute(date) % 3 = 0)""",
    "adjusted_incrementally": f"{_with('ticks', 'bars', **_LINE_ADJUSTED)} SELECT * FROM adjusted",
    "action_filter": f"{_with('line_actions')} SELECT * FROM line_actions WHERE {_ACTION}",
    "actions_merged": f"""{_with('ticks', 'bars', 'order_actions')}
        SELECT symbol, date, dividend, split_ratio FROM (
            SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY source, _seq DESC) AS n FROM (
                SELECT symbol, date, dividend, split_ratio, 0 AS source, 0 AS _seq FROM bars WHERE {_ACTION}
                UNION ALL
                SELECT 'S' || number, date, dividend, split_ratio, 1, _seq FROM order_actions
                WHERE feed IN ('F', 'O') AND {_ACTION}))
        WHERE n = 1 AND (symbol, date) NOT IN (SELECT ('S' || number, date) FROM order_actions WHERE feed = 'P')""",
    "any_left_join": f"{_with('ticks', 'bars', **_LINE_ADJUSTED)} SELECT * FROM enriched",
    "pair_factors": f"""{_with('ticks', 'bars', **_LINE_ADJUSTED)}
        SELECT symbol, date, newer_date, newer_dividend, newer_split_ratio, factor FROM factors""",
    "bad_dividends": f"""{_with('ticks', 'bars', **_adjusted('bars', 'bars', times=1000))}
        SELECT symbol, date, newer_date, newer_dividend, close FROM paired
        WHERE newer_dividend <> 0 AND newer_dividend >= close""",
    "running_coefficient": f"""{_with('ticks', 'bars', **_LINE_ADJUSTED)}
        SELECT symbol, date, adjustment_coefficient FROM adjusted""",
    "adjusted_days": f"{_with('ticks', 'bars', **_LINE_ADJUSTED)} SELECT * FROM adjusted",
    "adjusted_days_skipping":
        f"{_with('ticks', 'bars', **_adjusted('bars', 'bars', times=1000))} SELECT * FROM adjusted",
    "adjusted_days_exact": _EXACT,
    "exact_within_one_unit": f"{_with('ticks', 'bars')} SELECT symbol, date, TRUE AS near FROM bars",
    "days_view": f"{_with('ticks', 'bars', **_BEFORE_2001)} {_DAYS_VIEW.format(days='bars')}",
    "minutes_view": f"""
        {_with('staged', 'minutes', 'rolled', 'event_actions', **_MINUTE_ADJUSTED)} {_MINUTES_VIEW}""",
    "get_day": f"""{_with('ticks', 'bars', **_BEFORE_2001)}
        SELECT symbol, strftime(date, '%Y-%m-%d') AS date, {_DESCALED} FROM ({_DAYS_VIEW.format(days='bars')})
        WHERE symbol = 'S0' AND date = DATE '1996-12-02'""",
    "get_minute": f"""{_with('staged', 'minutes', 'rolled', 'event_actions', **_MINUTE_ADJUSTED)}
        SELECT symbol, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, {_DESCALED} FROM ({_MINUTES_VIEW})
        WHERE symbol = 'U8' AND date = TIMESTAMP '2024-01-01 00:00:00'""",
    "exact_by_segment": _EXACT,
    "segments_within_one_unit": f"{_with('ticks', 'bars')} SELECT symbol, date, TRUE AS near FROM bars",
    "placed_actions": f"""{_with('ticks', 'bars', 'order_actions', separate=_SEPARATE)}
        SELECT a.symbol, a.date, a.dividend, a.split_ratio, min(b.date) AS bar
        FROM separate a LEFT JOIN bars b ON b.symbol = a.symbol AND b.date >= a.date GROUP BY ALL""",
    "adjusted_next_bar": f"""{_with('ticks', 'bars', 'order_actions', separate=_SEPARATE, moved=_MOVED,
                                    **_adjusted('bars', 'moved'))} SELECT * FROM adjusted""",
    "get_days": f"""{_with('ticks', 'bars', 'order_actions', **_BEFORE_2001)}, viewed AS ({_DAYS_VIEW.format(days='bars')})
        SELECT 'S' || a.number AS symbol, strftime(a.date, '%Y-%m-%d') AS date, v.symbol IS NOT NULL AS found, {_DESCALED}
        FROM order_actions a LEFT JOIN viewed v ON v.symbol = 'S' || a.number AND v.date = a.date""",
    "get_minutes": f"""{_with('staged', 'minutes', 'rolled', 'event_actions', **_MINUTE_ADJUSTED)},
        viewed AS ({_MINUTES_VIEW}),
        asked AS (SELECT symbol, CASE WHEN event_type = 'error' THEN date + INTERVAL 1 HOUR ELSE date END AS date FROM staged)
        SELECT a.symbol, strftime(a.date, '%Y-%m-%d %H:%M:%S') AS date, v.symbol IS NOT NULL AS found, {_DESCALED}
        FROM asked a LEFT JOIN viewed v ON v.symbol = a.symbol AND v.date = a.date""",
    "price_history": _with(
        "order_rows", "order_minutes", "order_days", "order_actions",
        history_actions=_ORDER_ACTIONS, **_adjusted("order_days", "history_actions"),
    ) + _DAYS_VIEW.format(days="order_days"),
}
