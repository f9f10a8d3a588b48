"""ANSI SQL with the same meaning as each query, for an independent engine to check against."""

from __future__ import annotations

from collections.abc import Sequence

from marketlake.operators.quality import Suite
from marketlake.plans import queries as q
from marketlake.plans import suites

BARS = """
    SELECT upper(event_type) AS ticker, date_trunc('hour', ts) AS bar_ts,
           first(p ORDER BY ts, event_id) AS open, max(p) AS high, min(p) AS low,
           last(p ORDER BY ts, event_id) AS close, count(*) AS volume
    FROM (SELECT *, CAST(value AS DECIMAL(6,2)) AS p FROM events) GROUP BY 1, 2
"""

OHLCV = """
    SELECT ticker, date, CAST(open AS DOUBLE) AS open,
           CAST(CASE WHEN batch = 7 AND flag = 'R' THEN least(open, close) - down - 0.01
                     ELSE greatest(open, close) + up END AS DOUBLE) AS high,
           CAST(least(open, close) - down AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close,
           volume, insert_datetime, batch
    FROM (
        SELECT *, CAST(open + move AS DECIMAL(12,2)) AS close
        FROM (
            SELECT CASE WHEN l_linenumber % 3 = 0 THEN ' P' || l_partkey || '  '
                        WHEN l_linenumber = 5 AND l_returnflag = 'N' THEN 'p' || l_partkey
                        ELSE 'P' || l_partkey END AS ticker,
                   CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
                   CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                        * CASE WHEN CAST(l_tax AS DECIMAL(12,2)) = 0.08
                               THEN CAST(1.00 AS DECIMAL(3,2)) ELSE CAST(0.05 AS DECIMAL(3,2)) END
                        AS DECIMAL(12,2)) AS open,
                   CAST((CAST(l_quantity AS DECIMAL(12,2)) - 25) * 0.01 AS DECIMAL(12,2)) AS move,
                   CAST(l_discount AS DECIMAL(12,2)) AS up, CAST(l_tax AS DECIMAL(12,2)) AS down,
                   CASE WHEN CAST(l_discount AS DECIMAL(12,2)) <> 0.10 THEN l_quantity * 100 END AS volume,
                   l_shipdate AS insert_datetime, l_linenumber AS batch, l_returnflag AS flag
            FROM lineitem
        )
    )
"""
TRIMMED = f"SELECT * REPLACE (trim(ticker) AS ticker) FROM ({OHLCV})"

COMPANY = """
    SELECT CASE WHEN c_custkey % 10 = 0 THEN c_name ELSE '  ' || replace(c_name, '#', ' ') END AS company_name,
           'C' || (c_custkey & 1023) || ' ' AS ticker,
           CASE WHEN c_custkey % 50 <> 0 THEN c_acctbal END AS price,
           c_acctbal * CAST(100.25 AS DOUBLE) AS market_cap,
           CASE c_mktsegment WHEN 'MACHINERY' THEN 'Technology' WHEN 'FURNITURE' THEN 'Consumer Cyclical'
                WHEN 'HOUSEHOLD' THEN 'Consumer Defensive' WHEN 'BUILDING' THEN 'Financial Services'
                ELSE 'Industrials' END AS sector,
           CASE c_nationkey % 3 WHEN 0 THEN 'Semiconductors' WHEN 1 THEN 'Discount Stores'
                ELSE 'Airlines, Airports & Air Services' END AS industry,
           DATE '2025-12-17' + CAST(c_custkey % 5 AS INTEGER) AS insert_datetime
    FROM customer
"""
COMPANY_TRIMMED = f"""
    SELECT * REPLACE (trim(company_name) AS company_name, trim(ticker) AS ticker,
                      trim(sector) AS sector, trim(industry) AS industry) FROM ({COMPANY})
"""

FX = """
    SELECT CASE WHEN NOT (event_type = 'error' AND value < 1) THEN ts END AS date, value / 8 AS inr_rate,
           CASE WHEN user_id % 19 = 0 THEN CAST(0 AS DOUBLE) WHEN user_id % 17 <> 0 THEN CAST(1 AS DOUBLE) END
               AS usd_amount,
           event_id AS insert_order
    FROM events
"""
FX_DAY = f"SELECT * REPLACE (CAST(date AS DATE) AS date) FROM ({FX})"

MACRO = """
    SELECT CASE WHEN n_nationkey <> 24 THEN 'N' || n_nationkey END AS country_id, ' ' || n_name AS country_name,
           CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS nominal_gdp,
           CASE WHEN (o_orderkey + n_nationkey) % 3 <> 0 THEN o_totalprice - 1000 END AS real_gdp,
           CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 31 - 60 AS DOUBLE) END AS inflation,
           CASE WHEN n_nationkey <> 7 AND o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 110 AS DOUBLE) END
               AS unemployment,
           o_orderdate AS insert_datetime, o_orderkey AS insert_order
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
"""
MACRO_TRIMMED = f"SELECT * REPLACE (trim(country_id) AS country_id, trim(country_name) AS country_name) FROM ({MACRO})"
MACRO_SERIES = f"""
    SELECT country_id AS country_code, trim(country_name) AS country_name, year,
           CAST(sum(CAST(nominal_gdp AS DECIMAL(12,2))) AS DOUBLE) AS nominal_gdp,
           CAST(sum(CAST(real_gdp AS DECIMAL(12,2))) AS DOUBLE) AS real_gdp,
           CAST(CAST(sum(CAST(inflation AS DECIMAL(12,2))) AS BIGINT) % 7 AS DOUBLE) AS inflation,
           CAST(CAST(sum(CAST(unemployment AS DECIMAL(12,2))) AS BIGINT) % 23 AS DOUBLE) AS unemployment
    FROM ({MACRO}) WHERE country_id IS NOT NULL GROUP BY 1, 2, 3
"""

OHLCV_COLS = ("ticker", "date", "open", "high", "low", "close", "volume", "insert_datetime")
COMPANY_COLS = ("company_name", "ticker", "price", "market_cap", "sector", "industry", "insert_datetime")
FX_COLS = ("date", "inr_rate", "usd_amount", "insert_order")
MACRO_COLS = (
    "country_id", "country_name", "year", "nominal_gdp", "real_gdp", "inflation", "unemployment",
    "insert_datetime", "insert_order",
)


def newest(cols: Sequence[str], lead: Sequence[str]) -> str:
    rest = [f"{c} ASC NULLS FIRST" for c in cols if c not in lead]
    return ", ".join([f"{c} DESC NULLS LAST" for c in lead] + rest)


def ranked(source: str, keys: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rank_assigned FROM ({source})"


def first(source: str, keys: str, order: str) -> str:
    return f"SELECT * EXCLUDE (rank_assigned) FROM ({ranked(source, keys, order)}) WHERE rank_assigned = 1"


OHLCV_ORDER = newest((*OHLCV_COLS, "batch"), ["insert_datetime"])
COMPANY_ORDER = newest(COMPANY_COLS, ["insert_datetime"])
FX_ORDER = newest(FX_COLS, ["insert_order"])
MACRO_ORDER = newest(MACRO_COLS, ["insert_datetime", "insert_order"])
CLEAN = first(TRIMMED, "ticker, date", OHLCV_ORDER)
CLEAN_COMPANY = first(COMPANY_TRIMMED, "ticker", COMPANY_ORDER)
CLEAN_FX = first(FX_DAY, "date", FX_ORDER)
CLEAN_MACRO = first(MACRO_TRIMMED, "country_id, year", MACRO_ORDER)


def facts(source: str, time: str, extra: str = "") -> str:
    """Returns and averages as whole millionths, computed in integers."""
    change = "(2 * abs(u - b) * 1000000 + abs(b)) // (2 * abs(b))"
    return f"""
        WITH base AS (
            SELECT *, CAST(close * 100 AS HUGEINT) AS u, lag(close) OVER w AS prev,
                   CAST(lag(close) OVER w * 100 AS HUGEINT) AS b
            FROM ({source}) WINDOW w AS (PARTITION BY ticker ORDER BY {time})
        ), changed AS (
            SELECT *, CASE WHEN b <> 0 THEN CAST(
                CASE WHEN (u - b < 0) = (b < 0) THEN {change} ELSE -({change}) END AS DOUBLE)
                / CAST(1000000 AS DOUBLE) END AS r
            FROM base
        ), framed AS (
            SELECT *, stddev_samp(r) OVER (PARTITION BY ticker ORDER BY {time}
                                           ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS v,
                   sum(u) OVER f AS s, count(u) OVER f AS n
            FROM changed
            WINDOW f AS (PARTITION BY ticker ORDER BY {time} ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)
        )
        SELECT {extra} 'STK_' || ticker AS stock_id, ticker, {time} AS trade_date, open AS open_price,
               high AS high_price, low AS low_price, close AS close_price, volume AS stock_volume,
               prev AS prev_close_price, r AS daily_return, round(v, 8) AS volatility_days_30,
               CAST((2 * s * 1000000 + n * 100) // (2 * n * 100) AS DOUBLE) / CAST(1000000 AS DOUBLE)
                   AS stock_90_day_average
        FROM framed
    """


def macro_facts(unemployment: str, source: str = MACRO_SERIES, extra: str = "", places: int | None = None) -> str:
    def lagged(c):
        return f"lag({c}) OVER (PARTITION BY country_code ORDER BY year)"

    def rate(c):
        return f"CASE WHEN p_{c} IS NULL OR p_{c} = 0 THEN NULL ELSE ({c} - p_{c}) / p_{c} END"

    def difference(c):
        return f"CASE WHEN p_{c} IS NULL OR p_{c} = 0 THEN NULL ELSE {c} - p_{c} END"

    def shown(value, name):
        return f"{value if places is None else f'round({value}, {places})'} AS {name}"

    previous = ", ".join(f"{lagged(c)} AS p_{c}" for c in q.MEASURES)
    return f"""
        WITH p AS (SELECT *, {previous} FROM ({source}))
        SELECT {extra} country_code, country_name, year AS data_point_year,
               {', '.join(shown(c, c) for c in q.MEASURES)},
               {shown(rate('nominal_gdp'), 'year_on_year_gdp_change')},
               {shown(rate('real_gdp'), 'year_on_real_gdp_change')},
               {shown(difference('inflation'), 'inflation_change_year_on_year')},
               {shown(difference(unemployment), 'unemployment_change_year_on_year')}
        FROM p
    """


def filled(source: str, cols: str) -> str:
    """Gaps replaced by the group median, or 0."""
    values = ", ".join(
        f"round(coalesce({c}, median({c}) OVER (PARTITION BY country_id), 0), 4) AS {c}" for c in q.MEASURES
    )
    return f"SELECT {cols}, {values} FROM ({source}) WHERE country_id IS NOT NULL"


SILVER_PRICES = ("open", "high", "low", "close")


def _ohlcv_reasons(longest: int = 10) -> str:
    parts = [f"CASE WHEN length(ticker) > {longest} THEN 'length:ticker' END"]
    for c in SILVER_PRICES:
        parts.append(f"CASE WHEN TRY_CAST({c} AS DECIMAL(6,2)) IS NULL THEN 'type:{c}' END")
    parts.append("CASE WHEN volume IS NULL THEN 'null:volume' END")
    return f"concat_ws(',', {', '.join(parts)})"


SILVER_OHLCV = f"""
    SELECT ticker, date, {', '.join(f'CAST({c} AS DECIMAL(6,2)) AS {c}' for c in SILVER_PRICES)},
           CAST(volume AS BIGINT) AS volume, DATE '{q.LOAD_DATE}' AS insert_datetime
    FROM (SELECT *, {_ohlcv_reasons()} AS reasons FROM ({CLEAN})) WHERE reasons = ''
"""
OHLCV_REJECTS = f"""
    SELECT ticker, date, open, high, low, close, volume, DATE '{q.LOAD_DATE}' AS insert_datetime, reasons
    FROM (SELECT *, {_ohlcv_reasons()} AS reasons FROM ({CLEAN})) WHERE reasons <> ''
"""


# --- validation -------------------------------------------------------------------------------


def checks_sql(suite: Suite, source: str, bad: Sequence[tuple[str, str, str]]) -> str:
    """One SELECT per rule; ``bad`` lists (column, ignored rows, broken rows) in suite order."""
    assert len(bad) == len(suite.expectations)
    rows = []
    for i, (rule, (column, ignored, broken)) in enumerate(zip(suite.expectations, bad)):
        label = rule.rule.replace("'", "''")
        rows.append(f"""
            SELECT {i + 1} AS position, '{label}' AS rule, '{column}' AS col, count(*) AS n,
                   count(*) FILTER (WHERE {ignored}) AS m, count(*) FILTER (WHERE {broken}) AS u
            FROM src""")
    return f"""
        WITH src AS ({source}), counts AS ({' UNION ALL '.join(rows)})
        SELECT '{suite.name}' AS suite, position, rule, col AS "column", u = 0 AS success, n AS element_count,
               m AS missing_count, u AS unexpected_count,
               CASE WHEN n > 0 THEN 100 * m / CAST(n AS DOUBLE) END AS missing_percent,
               CASE WHEN n > 0 THEN 100 * u / CAST(n AS DOUBLE) END AS unexpected_percent_total,
               CASE WHEN n - m > 0 THEN 100 * u / CAST(n - m AS DOUBLE) END AS unexpected_percent
        FROM counts
    """


def _null(c: str) -> tuple[str, str, str]:
    return c, "false", f"{c} IS NULL"


def _row(c: str, broken: str) -> tuple[str, str, str]:
    return c, f"{c} IS NULL", broken


def _pair(a: str, b: str) -> tuple[str, str, str]:
    return a, f"{a} IS NULL AND {b} IS NULL", f"{a} < {b}"


TICKER_CHECKS = [
    _null("ticker"),
    _row("ticker", "NOT length(ticker) BETWEEN 1 AND 7"),
    _row("ticker", "NOT regexp_matches(ticker, '^[A-Z0-9]{1,7}$')"),
]


def bar_checks(low: str, high: str) -> list[tuple[str, str, str]]:
    return [
        *TICKER_CHECKS,
        _null("date"),
        _row("date", f"date < DATE '{low}' OR date > DATE '{high}'"),
        *[_null(c) for c in ("open", "high", "low", "close", "volume")],
        _row("open", "open <= 0"),
        _row("volume", "volume < 0"),
        _pair("high", "low"),
        _pair("high", "open"),
        _pair("close", "low"),
        _pair("high", "close"),
    ]


def fx_checks(low: str, high: str) -> list[tuple[str, str, str]]:
    return [
        _null("date"),
        _row("date", f"date < DATE '{low}' OR date > DATE '{high}'"),
        _null("inr_rate"),
        _row("inr_rate", "inr_rate <= 0"),
        _row("inr_rate", "inr_rate < 0 OR inr_rate <> round(inr_rate, 3)"),
        _null("usd_amount"),
        _row("usd_amount", "usd_amount <= 0"),
    ]


# Fixed values, written out so that the lists of the package are checked too.
SECTORS = "'Technology', 'Consumer Cyclical', 'Financial Services', 'Consumer Defensive'"
INDUSTRIES = """
    'Consumer Electronics', 'Internet Content & Information', 'Semiconductors', 'Auto - Manufacturers',
    'Software - Infrastructure', 'Specialty Retail', 'Financial - Capital Markets', 'Discount Stores',
    'Banks - Diversified', 'Software - Application', 'Information Technology Services',
    'Electronic Gaming & Multimedia'
"""

COMPANY_CHECKS = [
    _null("company_name"),
    _row("company_name", "NOT length(company_name) BETWEEN 1 AND 200"),
    _row(
        "company_name",
        "NOT (length(company_name) BETWEEN 1 AND 200 AND regexp_matches(company_name, '^[A-Za-z0-9,.\\-& ]+$'))",
    ),
    *TICKER_CHECKS,
    _row("price", "price <= 0"),
    _null("market_cap"),
    _row("market_cap", "market_cap < 0"),
    _null("sector"),
    _row("sector", f"sector NOT IN ({SECTORS})"),
    _null("industry"),
    _row("industry", f"industry NOT IN ({INDUSTRIES})"),
]

MACRO_CHECKS = [
    _null("country_id"),
    _row("country_id", "NOT length(country_id) BETWEEN 2 AND 10"),
    _null("year"),
    _row("year", "NOT year BETWEEN 1996 AND 2000"),
    _null("country_name"),
    _row("country_name", "NOT length(country_name) BETWEEN 1 AND 200"),
    _row("country_name", "regexp_matches(country_name, '^\\s*$')"),
    _row("nominal_gdp", "nominal_gdp < 0"),
    _row("real_gdp", "real_gdp < 0"),
    _row("inflation", "inflation < -50 OR inflation > 20000"),
    _row("unemployment", "unemployment < 0 OR unemployment > 100"),
]


def samples_sql(suite: Suite, source: str, bad: Sequence[tuple[str, str, str]]) -> str:
    rows = [
        f"SELECT {i + 1} AS position, '{rule.rule}' AS rule, coalesce(CAST({c} AS VARCHAR), 'null') AS value "
        f"FROM src WHERE {broken}"
        for i, (rule, (c, _, broken)) in enumerate(zip(suite.expectations, bad))
    ]
    return f"""
        WITH src AS ({source}), found AS ({' UNION ALL '.join(rows)})
        SELECT '{suite.name}' AS suite, position, rule, value, sample
        FROM (SELECT *, row_number() OVER (PARTITION BY position ORDER BY value) AS sample FROM found)
        WHERE sample <= 20
    """


def quarantine_sql(source: str, bad: Sequence[tuple[str, str, str]]) -> str:
    total = " + ".join(f"CAST(coalesce({broken}, false) AS INTEGER)" for _, _, broken in bad)
    return f"SELECT * FROM (SELECT *, {total} AS reasons FROM ({source})) WHERE reasons > 0"


def profile_sql(name: str, source: str, cols: Sequence[str]) -> str:
    nulls = " + ".join(f"sum(CAST({c} IS NULL AS INTEGER))" for c in cols)
    return (
        f"SELECT '{name}' AS table_name, count(*) AS total_records, CAST({nulls} AS BIGINT) AS total_null_values "
        f"FROM ({source})"
    )


# --- upsert -----------------------------------------------------------------------------------

BATCH_ORDER = newest(OHLCV_COLS, ["insert_datetime"])
UPSERT_OHLCV = f"""
    WITH rows AS ({TRIMMED}),
    t AS (SELECT *, row_number() OVER (ORDER BY ticker, date) AS id
          FROM ({first('SELECT * EXCLUDE (batch) FROM rows WHERE batch <= 3', 'ticker, date', BATCH_ORDER)})),
    s AS ({first('SELECT * EXCLUDE (batch) FROM rows WHERE batch > 3', 'ticker, date', BATCH_ORDER)}),
    n AS (SELECT ticker, date, (SELECT max(id) FROM t) + row_number() OVER (ORDER BY ticker, date) AS id
          FROM s ANTI JOIN t USING (ticker, date))
    SELECT t.id, ticker, date,
           {', '.join(f'CASE WHEN s.ticker IS NULL THEN t.{c} ELSE s.{c} END AS {c}' for c in OHLCV_COLS[2:])}
    FROM t LEFT JOIN s USING (ticker, date)
    UNION ALL
    SELECT n.id, ticker, date, {', '.join(f's.{c}' for c in OHLCV_COLS[2:])} FROM n JOIN s USING (ticker, date)
"""
FX_BATCH_ORDER = "insert_order DESC, inr_rate"
UPSERT_FX = f"""
    WITH rows AS ({FX_DAY}),
    t AS ({first('SELECT * FROM rows WHERE insert_order % 2 = 0', 'date', FX_BATCH_ORDER)}),
    s AS ({first('SELECT * FROM rows WHERE insert_order % 2 = 1', 'date', FX_BATCH_ORDER)})
    SELECT date,
           {', '.join(f'CASE WHEN s.insert_order IS NULL THEN t.{c} ELSE s.{c} END AS {c}' for c in FX_COLS[1:])}
    FROM t FULL JOIN s USING (date)
"""


# --- flows ------------------------------------------------------------------------------------

VALUES = ("ticker", "date", *SILVER_PRICES, "volume")
VALUE_ORDER = newest(VALUES, [])
FITS = " AND ".join(["length(ticker) <= 10", *[f"TRY_CAST({c} AS DECIMAL(6,2)) IS NOT NULL" for c in SILVER_PRICES]])
TYPED = (
    f"ticker, date, {', '.join(f'CAST({c} AS DECIMAL(6,2)) AS {c}' for c in SILVER_PRICES)}, "
    "CAST(volume AS BIGINT) AS volume"
)
HISTORICAL_SILVER = f"""
    SELECT row_number() OVER (ORDER BY ticker, date) AS stock_id, {TYPED}, DATE '2025-12-17' AS insert_datetime
    FROM ({first(TRIMMED, 'ticker, date', VALUE_ORDER)}) WHERE {FITS} AND volume IS NOT NULL
"""


def batch_rows(where: str, day: str) -> str:
    rows = f"SELECT {', '.join(VALUES)} FROM ({TRIMMED}) WHERE {where} AND volume IS NOT NULL"
    return f"SELECT *, DATE '{day}' AS insert_datetime FROM ({first(rows, 'ticker, date', VALUE_ORDER)})"


def second_over_first(first_batch: str, second_batch: str, keys: str, cols: Sequence[str], always: str) -> str:
    """The second batch over the first; ``always`` is a column that no accepted row leaves NULL."""
    merged = ", ".join(f"CASE WHEN s.{always} IS NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in cols)
    return f"""
        WITH t AS ({first_batch}), s AS ({second_batch})
        SELECT {keys}, {merged} FROM t FULL JOIN s USING ({keys})
    """


#: Among the rows that the contracts accept, in a batch run and in the stream alike.
SILVER_AFTER_TWO = f"""
    SELECT {TYPED}, insert_datetime FROM ({second_over_first(
        batch_rows(f'batch <= 3 AND {FITS}', '2025-12-17'), batch_rows(f'batch > 3 AND {FITS}', '2025-12-18'),
        'ticker, date', (*VALUES[2:], 'insert_datetime'), 'volume')})
"""
TREE_BARS = f"SELECT *, CAST(bar_ts AS DATE) AS date, hour(bar_ts) AS hour FROM ({BARS})"


def tree_batch(where: str, day: str) -> str:
    rows = f"SELECT {', '.join(VALUES)} FROM ({TREE_BARS}) WHERE {where} AND {FITS} AND volume IS NOT NULL"
    return f"SELECT *, DATE '{day}' AS insert_datetime FROM ({first(rows, 'ticker, date', VALUE_ORDER)})"


TREE_AFTER_TWO = f"""
    SELECT {TYPED}, insert_datetime FROM ({second_over_first(
        tree_batch('hour < 12', '2025-12-17'), tree_batch('hour >= 12', '2025-12-18'),
        'ticker, date', (*VALUES[2:], 'insert_datetime'), 'volume')})
"""
TREE_HISTORICAL = f"""
    SELECT row_number() OVER (ORDER BY ticker, date) AS stock_id, {TYPED}, DATE '2025-12-17' AS insert_datetime
    FROM ({first(f"SELECT {', '.join(VALUES)} FROM ({TREE_BARS})", 'ticker, date', VALUE_ORDER)})
    WHERE {FITS} AND volume IS NOT NULL
"""
REJECTS_OF_TWO = f"""
    SELECT ticker, date, reasons FROM (SELECT *, {_ohlcv_reasons(20)} AS reasons FROM ({TRIMMED})) WHERE reasons <> ''
"""


def _money(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(12,2)) AS VARCHAR)"


_FAULT = "CAST(round(close * 100) AS BIGINT) % 50"
#: The planted faults, written out: the whole line and what cannot be read of it.
LANDING_REJECTS = f"""
    SELECT '2025-12-17/run_time=18-00-00' AS snapshot,
           concat_ws(',', CASE WHEN fault = 1 THEN strftime(date, '%d/%m/%Y') ELSE strftime(date, '%Y-%m-%d') END,
                     CASE WHEN fault = 0 THEN 'abc' ELSE {_money('close')} END, {_money('high')}, {_money('low')},
                     CASE WHEN fault = 4 THEN '?' ELSE {_money('open')} END,
                     CASE WHEN fault = 4 THEN '1 lot' ELSE coalesce(CAST(CAST(volume AS BIGINT) AS VARCHAR), '') END,
                     CASE WHEN fault <> 2 THEN ticker END, CASE WHEN fault = 3 THEN 'x' END) AS raw_line,
           CASE fault WHEN 0 THEN 'unreadable:CLOSE' WHEN 1 THEN 'unreadable:Date'
                WHEN 4 THEN 'unreadable:OPEN,unreadable:VOLUME' ELSE 'fields' END AS reasons
    FROM (SELECT *, {_FAULT} AS fault FROM ({OHLCV})) WHERE fault BETWEEN 0 AND 4
"""


def staged_report(suite: Suite, where: str, day: str, batch: str) -> str:
    """The daily rules on the rows of one snapshot that the staging contract accepts."""
    rows = f"""SELECT {TYPED} FROM (SELECT *, {_ohlcv_reasons(20)} AS reasons FROM ({TRIMMED}))
        WHERE reasons = '' AND {where}"""
    return f"SELECT *, '{batch}' AS batch FROM ({checks_sql(suite, rows, bar_checks(day, day))})"


def lineage_batch(where: str, run: str) -> str:
    """The staging contract, on tickers as they were landed."""
    rows = f"""SELECT {', '.join(VALUES)}
        FROM (SELECT *, {_ohlcv_reasons(20)} AS reasons FROM ({OHLCV})) WHERE reasons = '' AND {where}"""
    cols = "* REPLACE (CAST(volume AS BIGINT) AS volume)"
    return f"SELECT {cols}, TIMESTAMP '{run}' AS insert_datetime FROM ({first(rows, 'ticker, date', VALUE_ORDER)})"


LINEAGE_AFTER_TWO = second_over_first(
    lineage_batch("batch <= 3", "2025-12-17 18:00:00"), lineage_batch("batch > 3", "2025-12-18 18:00:00"),
    "ticker, date", (*VALUES[2:], "insert_datetime"), "volume",
)

RATES = ("date", "inr_rate", "usd_amount")
RATE_VALUES = f"SELECT date, inr_rate, usd_amount FROM ({FX_DAY})"
RATE_TYPED = "date, inr_rate, CAST(usd_amount AS SMALLINT) AS usd_amount"


def rate_batch(odd: int, day: str) -> str:
    rows = f"""SELECT date, inr_rate, usd_amount FROM ({FX_DAY})
        WHERE insert_order % 2 = {odd} AND date IS NOT NULL AND usd_amount IS NOT NULL"""
    return f"SELECT {RATE_TYPED}, DATE '{day}' AS insert_datetime FROM ({first(rows, 'date', newest(RATES, []))})"


DAILY_FX = second_over_first(
    rate_batch(0, "2025-12-17"), rate_batch(1, "2025-12-18"), "date", (*RATES[1:], "insert_datetime"), "usd_amount"
)
HISTORICAL_FX = f"""
    SELECT {RATE_TYPED}, DATE '2025-12-17' AS insert_datetime
    FROM ({first(RATE_VALUES, 'date', newest(RATES, []))}) WHERE date IS NOT NULL AND usd_amount IS NOT NULL
"""
#: Gaps are filled before the rows of a country and year are ranked by their values.
HISTORICAL_MACRO = first(
    filled(MACRO_TRIMMED, "country_name, country_id AS country_code, year"), "country_code, year",
    newest(("country_name", *q.MEASURES), []),
)


def oracles() -> dict[str, str]:
    ohlcv, daily = suites.ohlcv_suite(q.NOW), suites.ohlcv_daily_suite(q.TODAY_BARS)
    fx, fx_daily = suites.fx_suite(q.NOW_FX), suites.fx_daily_suite(q.TODAY_FX)
    company = suites.company_suite()
    macro = suites.macro_suite(2000, first_year=1996)
    company_checks = checks_sql(company, COMPANY, COMPANY_CHECKS)
    return {
        "stock_facts": facts(BARS, "bar_ts"),
        "stock_facts_split": facts(BARS, "bar_ts"),
        "stock_facts_silver": facts(
            f"SELECT *, row_number() OVER (ORDER BY ticker, date) AS id FROM ({SILVER_OHLCV})", "date", 'id AS "UUID",'
        ),
        "stock_facts_wide": facts(BARS, "bar_ts"),
        "stock_facts_increment": facts(f"SELECT * EXCLUDE (insert_datetime) FROM ({SILVER_AFTER_TWO})", "date"),
        "macro_facts": macro_facts("unemployment"),
        "macro_facts_compat": macro_facts("inflation"),
        "rank_trim_ohlcv": ranked(TRIMMED, "ticker, date", OHLCV_ORDER),
        "rank_trim_company": ranked(COMPANY_TRIMMED, "ticker", COMPANY_ORDER),
        "rank_trim_fx": ranked(FX_DAY, "date", FX_ORDER),
        "rank_trim_fx_split": ranked(FX_DAY, "date", FX_ORDER),
        "rank_trim_macro": ranked(MACRO_TRIMMED, "country_id, year", MACRO_ORDER),
        "dedup_ohlcv": CLEAN,
        "dedup_company": CLEAN_COMPANY,
        "clean_company": CLEAN_COMPANY,
        "dedup_fx": CLEAN_FX,
        "dedup_macro": CLEAN_MACRO,
        "dedup_daily": f"""
            SELECT * REPLACE (CAST(insert_datetime AS DATE) AS insert_datetime)
            FROM ({first(f'SELECT * EXCLUDE (batch) FROM ({TRIMMED})', 'ticker, date', BATCH_ORDER)})""",
        "macro_median_fill": filled(MACRO, "country_id, year, insert_order"),
        "macro_median_fill_split": filled(MACRO, "country_id, year, insert_order"),
        "macro_median_increment": filled(MACRO, "country_id, year, insert_order"),
        "macro_ungrouped": f"SELECT * FROM ({MACRO}) WHERE country_id IS NULL",
        "year_filter": f"SELECT * FROM ({MACRO}) WHERE year BETWEEN 1996 AND 1999",
        "contract_ohlcv": SILVER_OHLCV,
        "contract_rejects": OHLCV_REJECTS,
        "contract_company": f"""
            SELECT company_name, ticker, CAST(price AS DECIMAL(6,2)) AS price,
                   CAST(round(market_cap) AS BIGINT) AS market_cap, sector, industry
            FROM ({CLEAN_COMPANY}) WHERE price IS NOT NULL""",
        "contract_company_rejects": f"SELECT *, 'null:price' AS reasons FROM ({CLEAN_COMPANY}) WHERE price IS NULL",
        "contract_fx": f"""
            SELECT date, inr_rate, CAST(usd_amount AS SMALLINT) AS usd_amount, DATE '{q.LOAD_DATE}' AS insert_datetime
            FROM ({CLEAN_FX}) WHERE date IS NOT NULL AND usd_amount IS NOT NULL""",
        "contract_macro": filled(CLEAN_MACRO, "country_name, country_id AS country_code, year"),
        "unique_violations": f"""
            SELECT ticker, date, count(*) AS n FROM ({TRIMMED}) GROUP BY ticker, date HAVING count(*) > 1""",
        "surrogate_key": f"SELECT row_number() OVER (ORDER BY ticker, date) AS stock_id, * FROM ({CLEAN})",
        "upsert_ohlcv": UPSERT_OHLCV,
        "upsert_fx": UPSERT_FX,
        "dq_suite_ohlcv": checks_sql(ohlcv, OHLCV, bar_checks("2000-01-01", str(q.NOW))),
        "dq_suite_ohlcv_daily": checks_sql(daily, OHLCV, bar_checks(str(q.TODAY_BARS), str(q.TODAY_BARS))),
        "dq_suite_company": company_checks,
        "dq_suite_fx": checks_sql(fx, FX_DAY, fx_checks("2019-12-01", str(q.NOW_FX))),
        "dq_suite_fx_daily": checks_sql(fx_daily, FX_DAY, fx_checks(str(q.TODAY_FX), str(q.TODAY_FX))),
        "dq_suite_macro": checks_sql(macro, MACRO, MACRO_CHECKS),
        "dq_summary_company": f"""
            SELECT suite, bool_and(success) AS success, count(*) AS evaluated_expectations,
                   count(*) FILTER (WHERE success) AS successful_expectations,
                   count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
                   100 * count(*) FILTER (WHERE success) / CAST(count(*) AS DOUBLE) AS success_percent
            FROM ({company_checks}) GROUP BY suite""",
        "dq_samples_company": samples_sql(company, COMPANY, COMPANY_CHECKS),
        "dq_quarantine_company": quarantine_sql(COMPANY_TRIMMED, COMPANY_CHECKS),
        "null_profile": " UNION ALL ".join(
            [
                profile_sql("ohclv_bronze", OHLCV, OHLCV_COLS[:-1]),
                profile_sql("company_meta_data_bronze", COMPANY, COMPANY_COLS[:-1]),
                profile_sql("macro_economic_data_bronze", MACRO, MACRO_COLS[:-2]),
                profile_sql("exchange_rates_bronze", FX, FX_COLS[:-1]),
            ]
        ),
        "latest_snapshot": """
            SELECT event_id, value, upper(event_type) AS ticker, CAST(ts AS DATE) AS run_day FROM events
            QUALIFY date_trunc('hour', ts)
                    = max(date_trunc('hour', ts)) OVER (PARTITION BY event_type, CAST(ts AS DATE))""",
        "path_parts": """
            SELECT event_id, upper(event_type) AS ticker, CAST(ts AS DATE) AS run_day,
                   date_trunc('hour', ts) AS file_ts FROM events""",
        "json_rates_explode": """
            SELECT CAST(ts AS DATE) AS "Date", value AS "INR_amount", 1 AS "USD_rate" FROM events
            UNION ALL
            SELECT CAST(ts AS DATE) + 1, value + 1, 1 FROM events""",
        "json_rate_flatten": 'SELECT CAST(ts AS DATE) AS date, value AS inr_rate, 1 AS "USD_rate" FROM events',
        "json_variant_rates": """
            SELECT event_id, CASE WHEN event_id % 4 <> 2 THEN CAST(ts AS DATE) END AS date,
                   CASE WHEN event_id % 4 <> 2 THEN value END AS rate,
                   CASE event_id % 4 WHEN 0 THEN 'amount=1' WHEN 1 THEN 'note="n"' WHEN 2 THEN 'base="USD"' ELSE '' END
                       AS other
            FROM events""",
        "json_pick_keys": f"""
            SELECT company_name AS "companyName", ticker AS symbol, price, market_cap AS "marketCap", sector,
                   CASE WHEN industry <> 'Semiconductors' THEN industry END AS industry
            FROM ({COMPANY})""",
        "provider_columns": f"""
            SELECT ticker, bar_ts AS date,
                   {', '.join(f'round(CAST({c} AS DOUBLE), 2) AS {c}' for c in SILVER_PRICES)}, 1 AS "USD_rate"
            FROM ({BARS})""",
        "landing_snapshot": f"""
            SELECT company_name AS "companyName", ticker AS symbol, price, market_cap AS "marketCap", sector, industry
            FROM ({COMPANY})""",
        "landing_tree": f"""
            SELECT CASE ticker WHEN 'VIEW' THEN 'VIEW B' WHEN 'CLICK' THEN '^CLICK' ELSE ticker END AS ticker,
                   CAST(bar_ts AS DATE) AS date, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in SILVER_PRICES)},
                   CAST(volume AS DOUBLE) AS volume
            FROM ({BARS})""",
        "landing_rejects": LANDING_REJECTS,
        "historical_silver": HISTORICAL_SILVER,
        "historical_stock_view": facts(
            f"SELECT * EXCLUDE (insert_datetime) FROM ({HISTORICAL_SILVER})", "date", 'stock_id AS "UUID",'
        ),
        "macro_rejects": f"""
            SELECT * EXCLUDE (insert_datetime, insert_order), 'null:ISO3' AS reasons
            FROM ({MACRO}) WHERE country_id IS NULL""",
        "layer_metrics_report": " UNION ALL ".join(
            [
                profile_sql("ohclv_bronze", OHLCV, OHLCV_COLS[:-1]),
                profile_sql("company_meta_data_bronze", COMPANY, COMPANY_COLS[:-1]),
                profile_sql(
                    "macro_economic_data_bronze", filled(MACRO, "country_name, country_id, year"), MACRO_COLS[:-2]
                ),
                profile_sql("exchange_rates_bronze", FX, FX_COLS[:-1]),
            ]
        ),
        "suite_report": company_checks,
        "historical_gold": macro_facts(
            "unemployment",
            f"""SELECT *, row_number() OVER (ORDER BY country_code, year) AS id
                FROM ({HISTORICAL_MACRO})""",
            'id AS "UUID",',
            places=6,
        ),
        "historical_fx": HISTORICAL_FX,
        "daily_silver": SILVER_AFTER_TWO,
        "daily_fx_silver": DAILY_FX,
        "lineage_ohlcv": LINEAGE_AFTER_TWO,
        "daily_rejects": REJECTS_OF_TWO,
        "daily_tree_silver": TREE_AFTER_TWO,
        "historical_tree_silver": TREE_HISTORICAL,
        "stream_silver": SILVER_AFTER_TWO,
        "stream_rejects": REJECTS_OF_TWO,
        "stream_suite_report": " UNION ALL ".join(
            [
                staged_report(suites.ohlcv_stream_suite(), "batch > 3", "2025-12-18", "bars-0"),
                staged_report(suites.ohlcv_stream_suite(), "batch <= 3", "2025-12-17", "bars-1"),
            ]
        ),
    }
