"""For each query the same question in plain SQL over the source tables."""

from __future__ import annotations

FIRST_DAY = "DATE '2026-04-19'"
SECOND_DAY = "DATE '2026-04-20'"
OPEN_END = "DATE '9999-12-31'"
RELOADED_DAY = "DATE '1998-06-15'"

GEOGRAPHY = "nation JOIN region ON n_regionkey = r_regionkey"


def _numbered(prefix: str, number: str) -> str:
    return f"printf('{prefix}%08d', {number})"


def _with(ctes: dict[str, str], query: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + "\n" + query


# Feeds.

BAND = "CASE WHEN c_acctbal < 3000 THEN 'LOW' WHEN c_acctbal < 7000 THEN 'MEDIUM' ELSE 'HIGH' END"
KYC = "CASE WHEN c_nationkey <> 7 THEN CASE WHEN c_custkey % 10 = 0 THEN 'PENDING' ELSE 'VERIFIED' END END"


def _customers(name: str, band: str, kyc: str, where: str) -> str:
    return f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, {name} AS customer_name,
               'customer' || c_custkey || '@example.com' AS email, '98' || c_custkey AS mobile_number,
               CASE WHEN c_nationkey <> 11 THEN c_mktsegment END AS city_name,
               n_name AS state_name, r_name AS country_name, {band} AS risk_band, {kyc} AS kyc_status
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE {where}"""


CUSTOMERS = _customers("c_name", BAND, KYC, "true")
CUSTOMERS_1 = _customers("c_name", BAND, KYC, "c_acctbal >= 0")
CUSTOMERS_2 = _customers(
    "CASE WHEN c_mktsegment = 'FURNITURE' THEN c_name || ' & Co' ELSE c_name END",
    f"CASE WHEN c_mktsegment <> 'MACHINERY' THEN {BAND} WHEN {BAND} = 'HIGH' THEN 'MEDIUM' ELSE 'HIGH' END",
    f"CASE WHEN c_nationkey <> 3 THEN {KYC} END",
    "c_acctbal <= 9500",
)

SEGMENT = "CASE c_custkey % 3 WHEN 0 THEN 'EQUITY_DELIVERY' WHEN 1 THEN 'INTRADAY' ELSE 'FNO' END"
STATUS = "CASE WHEN c_custkey % 4 = 3 THEN 'DORMANT' ELSE 'ACTIVE' END"


def _accounts(advisor: str, segment: str, status: str) -> str:
    return f"""
        SELECT CAST(c_custkey AS VARCHAR) AS account_id, CAST(c_custkey AS VARCHAR) AS customer_id,
               CAST({advisor} AS VARCHAR) AS advisor_id, {segment} AS account_segment, {status} AS account_status,
               DATE '2024-01-01' + CAST(c_custkey % 366 AS INTEGER) AS opened_date
        FROM customer"""


MOVED = "c_mktsegment = 'HOUSEHOLD'"
ACCOUNTS_1 = _accounts("c_custkey % 10", SEGMENT, STATUS)
ACCOUNTS_2 = _accounts(
    f"CASE WHEN {MOVED} THEN (c_custkey + 1) % 10 ELSE c_custkey % 10 END",
    f"CASE WHEN NOT {MOVED} THEN {SEGMENT} WHEN {SEGMENT} = 'FNO' THEN 'EQUITY_DELIVERY' ELSE 'FNO' END",
    f"CASE WHEN {MOVED} THEN 'ACTIVE' ELSE {STATUS} END",
)


def _advisors(region: str) -> str:
    return f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS advisor_id, s_name AS advisor_name, {region} AS region
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


ADVISORS_1 = _advisors("r_name")
ADVISORS_2 = _advisors("CASE WHEN s_acctbal < 1000 THEN 'HEAD OFFICE' ELSE r_name END")

INSTRUMENTS = """
        SELECT CAST(p_partkey AS VARCHAR) AS instrument_id, 'STK' || p_partkey AS symbol, p_name AS instrument_name,
               p_brand AS company_name, p_type AS sector_name,
               CASE WHEN p_size % 2 = 0 THEN 'NSE' ELSE 'BSE' END AS exchange_code, 'India' AS listing_country
        FROM part"""

ORDERS = """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS business_date,
               CAST(o_custkey AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               CAST(o_orderkey % 200 AS VARCHAR) AS instrument_id,
               o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS INTEGER)) AS order_timestamp,
               CASE WHEN o_orderkey % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS order_side,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'MARKET' ELSE 'LIMIT' END AS order_type,
               CAST(o_orderkey % 50 AS INTEGER) AS ordered_quantity,
               CAST(o_totalprice AS DECIMAL(18,2)) AS limit_price,
               CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'CANCELLED' ELSE 'REJECTED' END AS order_status
        FROM orders"""

RAW_ORDERS = f"""
        SELECT * REPLACE (CAST(ordered_quantity AS VARCHAR) AS ordered_quantity,
                          CASE WHEN order_type = 'MARKET' THEN 'n/a' ELSE CAST(limit_price AS VARCHAR) END AS limit_price)
        FROM ({ORDERS})"""

PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
TRADE_NUMBER = "(l_orderkey * 7 + l_linenumber)"
TRADES = f"""
        SELECT {_numbered('TRD', TRADE_NUMBER)} AS trade_id, CAST(l_shipdate AS DATE) AS business_date,
               CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(o_custkey AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               CAST(l_partkey AS VARCHAR) AS instrument_id,
               CASE WHEN l_returnflag = 'A' THEN 'SELL' ELSE 'BUY' END AS trade_side,
               l_shipdate + to_seconds(CAST({TRADE_NUMBER} % 86400 AS INTEGER)) AS trade_timestamp,
               CAST(l_quantity AS INTEGER) AS executed_quantity, {PRICE} AS executed_price,
               CAST({PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS brokerage_fee,
               CAST({PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS tax_amount,
               {TRADE_NUMBER} AS number, l_linestatus = 'F' AS confirmed
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

GROSS = "CAST(executed_quantity * executed_price AS DECIMAL(18,2))"
NET = "CAST(executed_quantity * executed_price + brokerage_fee + tax_amount AS DECIMAL(18,2))"
MEASURES = f"SELECT * EXCLUDE (number, confirmed), {GROSS} AS gross_trade_amount, {NET} AS net_trade_amount FROM trades"

CASH = f"""
        SELECT {_numbered('FND', 'number')} AS fund_movement_id, business_date, account_id,
               'TRADE_SETTLEMENT' AS movement_type,
               CASE WHEN trade_side = 'SELL' THEN {GROSS} ELSE -{GROSS} END AS amount, 'INR' AS currency_code
        FROM trades"""

SETTLEMENTS = f"""
        SELECT {_numbered('SET', 'number')} AS settlement_id, trade_id, business_date,
               business_date + 1 AS settlement_date,
               CASE WHEN bool_or(confirmed) OVER (PARTITION BY business_date, trade_id) THEN 'SETTLED' ELSE 'PENDING' END AS settlement_status
        FROM trades"""

# Average cost half-up on whole cents: decimal division would go through floating point.
POSITIONS = """
        SELECT business_date, account_id, instrument_id,
               CAST(sum(CASE WHEN trade_side = 'BUY' THEN executed_quantity ELSE -executed_quantity END) AS BIGINT) AS q,
               CAST(sum(CASE WHEN trade_side = 'BUY' THEN executed_quantity ELSE -executed_quantity END
                        * CAST(executed_price * 100 AS BIGINT)) AS BIGINT) AS cents
        FROM trades GROUP BY ALL HAVING q > 0"""
HOLDINGS = """
        SELECT business_date, account_id, instrument_id, CAST(q AS DECIMAL(18,2)) AS holding_quantity,
               CAST(sign(cents) * ((2 * abs(cents) + q) // (2 * q)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS average_cost,
               CAST(p_retailprice AS DECIMAL(18,2)) AS market_price,
               CAST(q * CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS market_value
        FROM positions JOIN part ON instrument_id = CAST(p_partkey AS VARCHAR)"""

TRADE_CTES = {"trades": TRADES}
MEASURED_CTES = {**TRADE_CTES, "measured": MEASURES}
HOLDING_CTES = {**TRADE_CTES, "positions": POSITIONS, "holdings": HOLDINGS}


# Dimensions.


def _keyed(key: str, columns: str, source: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {columns}) AS {key}, {columns} FROM (SELECT DISTINCT {columns} FROM {source})"


GEO_CTES = {
    "stage": CUSTOMERS,
    "dim_country": _keyed("country_key", "country_name", "stage WHERE country_name IS NOT NULL"),
    "dim_state": _keyed("state_key", "state_name, country_key", "stage JOIN dim_country USING (country_name)"),
    "dim_city": _keyed(
        "city_key",
        "city_name, state_key",
        "stage JOIN dim_country USING (country_name) JOIN dim_state USING (state_name, country_key) WHERE city_name IS NOT NULL",
    ),
}
INSTRUMENT_CTES = {
    "stage": INSTRUMENTS,
    "dim_sector": _keyed("sector_key", "sector_name", "stage"),
    "dim_company": _keyed("company_key", "company_name, sector_key", "stage JOIN dim_sector USING (sector_name)"),
    "dim_exchange": _keyed("exchange_key", "exchange_code", "stage"),
    "dim_instrument": _keyed(
        "instrument_key",
        "instrument_id, symbol, instrument_name, company_key, exchange_key, listing_country",
        "stage JOIN dim_sector USING (sector_name) JOIN dim_company USING (company_name, sector_key)"
        " JOIN dim_exchange USING (exchange_code)",
    ),
}


# Second loads.


def _goes_on(key: str, columns: str, first: str, found: str, on: str) -> dict[str, str]:
    """A dimension after a second load: rows that are new by the columns `on` get keys after those of the first."""
    name = key.removesuffix("_key")
    matched = " AND ".join(f"f.{c} = d.{c}" for c in on.split(", "))
    return {
        f"{name}_1": _keyed(key, columns, first),
        f"{name}_2": f"""
            SELECT * FROM {name}_1 UNION ALL BY NAME
            SELECT coalesce((SELECT max({key}) FROM {name}_1), 0) + row_number() OVER (ORDER BY {columns}) AS {key}, {columns}
            FROM (SELECT DISTINCT {columns} FROM {found} f WHERE NOT EXISTS (SELECT 1 FROM {name}_1 d WHERE {matched}))""",
    }


GEO_SECOND_CTES = {
    "everyone": CUSTOMERS,
    "early": "SELECT * FROM everyone WHERE risk_band = 'HIGH' AND country_name <> 'ASIA' AND state_name < 'NATION_15'",
    **_goes_on(
        "country_key",
        "country_name",
        "early",
        "(SELECT country_name FROM everyone WHERE country_name IS NOT NULL)",
        "country_name",
    ),
    **_goes_on(
        "state_key",
        "state_name, country_key",
        "early JOIN country_1 USING (country_name)",
        "(SELECT state_name, country_key FROM everyone JOIN country_2 USING (country_name))",
        "state_name, country_key",
    ),
    **_goes_on(
        "city_key",
        "city_name, state_key",
        "early JOIN country_1 USING (country_name) JOIN state_1 USING (state_name, country_key) WHERE city_name IS NOT NULL",
        """(SELECT city_name, state_key FROM everyone JOIN country_2 USING (country_name)
            JOIN state_2 USING (state_name, country_key) WHERE city_name IS NOT NULL)""",
        "city_name, state_key",
    ),
}
INSTRUMENT_SECOND_CTES = {
    "everything": INSTRUMENTS,
    "early": "SELECT * FROM everything WHERE sector_name > 'M' AND exchange_code = 'NSE'",
    "late": "SELECT * REPLACE (symbol || '-2' AS symbol) FROM everything",
    **_goes_on("sector_key", "sector_name", "early", "(SELECT sector_name FROM late)", "sector_name"),
    **_goes_on(
        "company_key",
        "company_name, sector_key",
        "early JOIN sector_1 USING (sector_name)",
        "(SELECT company_name, sector_key FROM late JOIN sector_2 USING (sector_name))",
        "company_name, sector_key",
    ),
    **_goes_on("exchange_key", "exchange_code", "early", "(SELECT exchange_code FROM late)", "exchange_code"),
    **_goes_on(
        "instrument_key",
        "instrument_id, symbol, instrument_name, company_key, exchange_key, listing_country",
        "early JOIN sector_1 USING (sector_name) JOIN company_1 USING (company_name, sector_key) JOIN exchange_1 USING (exchange_code)",
        """(SELECT * FROM late JOIN sector_2 USING (sector_name) JOIN company_2 USING (company_name, sector_key)
            JOIN exchange_2 USING (exchange_code))""",
        "instrument_id",
    ),
}


def _dimension_rows(table: str, name: str, parent: str = "CAST(NULL AS BIGINT)") -> str:
    return (
        f"SELECT 'dim_{table}' AS table_name, {table}_key AS row_key, {name} AS row_name, {parent} AS parent_key FROM {table}_2"
    )


# Change history.


def _scd2(first: str, second: str, surrogate: str, key: str, tracked: list[str]) -> dict[str, str]:
    differs = " OR ".join(f"c.{t} <> s.{t}" for t in tracked)
    return {
        "s1": first,
        "s2": second,
        "c1": f"SELECT row_number() OVER (ORDER BY {key}) AS {surrogate}, * FROM s1",
        "closed": f"SELECT c.* FROM c1 c WHERE EXISTS (SELECT 1 FROM s2 s WHERE s.{key} = c.{key} AND ({differs}))",
        "kept": f"SELECT * FROM c1 WHERE {surrogate} NOT IN (SELECT {surrogate} FROM closed)",
        "fresh": f"SELECT * FROM s2 WHERE {key} NOT IN (SELECT {key} FROM kept)",
        "opened": f"SELECT (SELECT max({surrogate}) FROM c1) + row_number() OVER (ORDER BY {key}) AS {surrogate}, * FROM fresh",
        "dim": f"""
            SELECT *, {FIRST_DAY} AS record_start_date, {SECOND_DAY} AS record_end_date, 'N' AS is_current FROM closed
            UNION ALL BY NAME
            SELECT *, {FIRST_DAY} AS record_start_date, {OPEN_END} AS record_end_date, 'Y' AS is_current FROM kept
            UNION ALL BY NAME
            SELECT *, {SECOND_DAY} AS record_start_date, {OPEN_END} AS record_end_date, 'Y' AS is_current FROM opened""",
    }


ADVISOR_CTES = _scd2(ADVISORS_1, ADVISORS_2, "advisor_key", "advisor_id", ["advisor_name", "region"])
CUSTOMER_CTES = _scd2(
    CUSTOMERS_1,
    CUSTOMERS_2,
    "customer_key",
    "customer_id",
    ["city_name", "state_name", "country_name", "risk_band", "kyc_status"],
)
ACCOUNT_CTES = _scd2(
    ACCOUNTS_1, ACCOUNTS_2, "account_key", "account_id", ["advisor_id", "account_segment", "account_status"]
)


# Quality rules: (text, column, number of failing rows).


def _complete(column: str) -> tuple[str, str, str]:
    return f'IsComplete "{column}"', column, f"count(*) FILTER ({column} IS NULL)"


def _unique(column: str) -> tuple[str, str, str]:
    return f'IsUnique "{column}"', column, f"count({column}) - count(DISTINCT {column})"


def _allowed(column: str, *values: str) -> tuple[str, str, str]:
    listed = ", ".join(f'"{v}"' for v in values)
    quoted = ", ".join(f"'{v}'" for v in values)
    failing = f"count(*) FILTER (NOT coalesce({column} IN ({quoted}), false))"
    return f'ColumnValues "{column}" in [{listed}]', column, failing


def _compare(column: str, test: str) -> tuple[str, str, str]:
    failing = f"count(*) FILTER (NOT coalesce(TRY_CAST({column} AS DECIMAL(38,10)) {test}, false))"
    return f'ColumnValues "{column}" {test}', column, failing


def _dq(dataset: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{dataset}' AS dataset_name, '{text}' AS rule, '{column}' AS column_name,
                   CASE WHEN {failing} = 0 THEN 'Passed' ELSE 'Failed' END AS "Outcome",
                   count(*) AS rows_total, {failing} AS rows_failed FROM {source}"""
        for text, column, failing in rules
    )


BANDS = _allowed("risk_band", "LOW", "MEDIUM", "HIGH")
KYCS = _allowed("kyc_status", "PENDING", "VERIFIED")
STATUSES = _allowed("account_status", "ACTIVE", "DORMANT")
SEGMENTS = _allowed("account_segment", "EQUITY_DELIVERY", "INTRADAY", "FNO")
ORDER_RULES = [
    *map(_complete, ["order_id", "account_id", "instrument_id"]),
    _unique("order_id"),
    _allowed("order_status", "COMPLETED", "CANCELLED", "REJECTED"),
    _compare("ordered_quantity", "> 0"),
    _compare("limit_price", "> 0"),
]
TRADE_RULES = [
    *map(_complete, ["trade_id", "order_id", "account_id"]),
    _unique("trade_id"),
    _compare("executed_quantity", "> 0"),
    _compare("executed_price", "> 0"),
]

DQ_CTES = {
    "customers_feed": CUSTOMERS,
    "accounts_feed": ACCOUNTS_1,
    "orders_feed": RAW_ORDERS,
    "trades": TRADES,
    "measured": MEASURES,
}
DQ = {
    "dq_customers": _dq(
        "customers",
        "customers_feed",
        [
            *map(_complete, ["customer_id", "customer_name", "risk_band", "kyc_status"]),
            _unique("customer_id"),
            BANDS,
            KYCS,
        ],
    ),
    "dq_accounts": _dq(
        "accounts",
        "accounts_feed",
        [
            *map(_complete, ["account_id", "customer_id", "account_status", "account_segment"]),
            _unique("account_id"),
            STATUSES,
            SEGMENTS,
        ],
    ),
    "dq_orders": _dq("orders", "orders_feed", ORDER_RULES),
    "dq_trades": _dq("trades", "trades", [*TRADE_RULES, _compare("brokerage_fee", ">= 0")]),
    "dq_curated_customers": _dq(
        "curated_customers",
        "customers_feed",
        [*map(_complete, ["customer_id", "customer_name", "risk_band"]), _unique("customer_id"), BANDS, KYCS],
    ),
    "dq_curated_accounts": _dq(
        "curated_accounts",
        "accounts_feed",
        [*map(_complete, ["account_id", "customer_id", "advisor_id"]), _unique("account_id"), STATUSES, SEGMENTS],
    ),
    "dq_curated_orders": _dq("curated_orders", "orders_feed", ORDER_RULES),
    "dq_curated_trades": _dq(
        "curated_trades",
        "measured",
        [*TRADE_RULES, _compare("gross_trade_amount", "> 0"), _compare("net_trade_amount", "> 0")],
    ),
}
SUMMARY_CTES = {
    **DQ_CTES,
    "results": "\nUNION ALL\n".join(sql for name, sql in DQ.items() if name.startswith("dq_curated_")),
    "summary": """
        SELECT dataset_name, count(*) FILTER ("Outcome" <> 'Passed') AS failed_rule_outcomes,
               CASE WHEN count(*) FILTER ("Outcome" <> 'Passed') > 0 THEN 'FAILED_RULES' ELSE 'PASSED_RULES' END AS dataset_status
        FROM results GROUP BY dataset_name""",
}


def _reload(ctes: dict[str, str], rows: str, corrected: str) -> str:
    return _with(
        {**ctes, "loaded": rows},
        f"""SELECT * FROM loaded WHERE business_date <> {RELOADED_DAY}
            UNION ALL BY NAME
            SELECT {corrected} FROM loaded WHERE business_date = {RELOADED_DAY}""",
    )


# The two daily runs: buys and completed orders land on the first day, the rest on the second.

LANDED_CTES = {
    "trades": f"SELECT * REPLACE (CASE WHEN trade_side = 'BUY' THEN {FIRST_DAY} ELSE {SECOND_DAY} END AS business_date) FROM ({TRADES})",
    "measured": MEASURES,
    "positions": POSITIONS,
    "holdings": HOLDINGS,
    "customers_1": CUSTOMERS_1,
    "customers_2": CUSTOMERS_2,
    "customers_both": "SELECT * FROM customers_1 UNION ALL SELECT * FROM customers_2",
    "instruments": INSTRUMENTS,
}


def _history_rows(first: str, second: str, key: str, tracked: list[str]) -> str:
    """Versions after both days, without surrogate keys."""
    differs = " OR ".join(f"a.{t} <> b.{t}" for t in tracked)
    changed = f"EXISTS (SELECT 1 FROM ({second}) b WHERE b.{key} = a.{key} AND ({differs}))"
    return f"""
        SELECT a.*, CASE WHEN {changed} THEN 'N' ELSE 'Y' END AS is_current FROM ({first}) a
        UNION ALL
        SELECT b.*, 'Y' FROM ({second}) b LEFT JOIN ({first}) a ON a.{key} = b.{key}
        WHERE a.{key} IS NULL OR {differs}"""


LANDED_CTES.update(
    {
        "customer_versions": _history_rows(
            CUSTOMERS_1, CUSTOMERS_2, "customer_id", ["city_name", "state_name", "country_name", "risk_band", "kyc_status"]
        ),
        "account_versions": _history_rows(
            ACCOUNTS_1, ACCOUNTS_2, "account_id", ["advisor_id", "account_segment", "account_status"]
        ),
        "advisor_versions": _history_rows(ADVISORS_1, ADVISORS_2, "advisor_id", ["advisor_name", "region"]),
    }
)
_SIZES = {
    "dim_country": "SELECT DISTINCT country_name FROM customers_both WHERE country_name IS NOT NULL",
    "dim_state": "SELECT DISTINCT state_name, country_name FROM customers_both WHERE state_name IS NOT NULL",
    "dim_city": "SELECT DISTINCT city_name, state_name, country_name FROM customers_both WHERE city_name IS NOT NULL",
    "dim_sector": "SELECT DISTINCT sector_name FROM instruments",
    "dim_company": "SELECT DISTINCT company_name, sector_name FROM instruments",
    "dim_exchange": "SELECT DISTINCT exchange_code FROM instruments",
    "dim_instrument": "SELECT * FROM instruments",
    "dim_date": "SELECT DISTINCT business_date FROM trades",
    "dim_advisor_scd2": "SELECT * FROM advisor_versions",
    "dim_customer_scd2": "SELECT * FROM customer_versions",
    "dim_account_scd2": "SELECT * FROM account_versions",
    "fact_orders": "SELECT * FROM orders",
    "fact_trades": "SELECT * FROM trades",
    "fact_fund_movements": "SELECT * FROM trades",
    "fact_settlements": "SELECT * FROM trades",
    "fact_daily_holdings": "SELECT * FROM holdings",
}


def _lines(measure: str, item: str, value: str, source: str) -> str:
    return (
        f"SELECT '{measure}' AS measure, CAST({item} AS VARCHAR) AS item, CAST({value} AS DECIMAL(38,2)) AS value {source}"
    )


LOAD_REPORT = _with(
    LANDED_CTES,
    "\nUNION ALL\n".join(
        [
            _lines(
                "holdings",
                "h.business_date || ' ' || i.sector_name",
                "sum(market_value)",
                "FROM holdings h JOIN instruments i USING (instrument_id) GROUP BY ALL",
            ),
            _lines("gross_volume", "business_date", "sum(gross_trade_amount)", "FROM measured GROUP BY ALL"),
            _lines("orders", "business_date", "count(DISTINCT order_id)", "FROM trades GROUP BY ALL"),
            _lines(
                "customers",
                "risk_band",
                "count(DISTINCT customer_id)",
                "FROM customer_versions WHERE is_current = 'Y' GROUP BY ALL",
            ),
            _lines(
                "changed_accounts",
                "account_segment",
                "count(*)",
                "FROM account_versions WHERE account_id IN (SELECT account_id FROM account_versions GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL",
            ),
            _lines(
                "rejects",
                "'customers_snapshot null city_name'",
                "count(*)",
                "FROM customers_both WHERE city_name IS NULL HAVING count(*) > 0",
            ),
            *[_lines("rows", f"'{name}'", "count(*)", f"FROM ({sql})") for name, sql in _SIZES.items()],
        ]
    ),
)

SECTOR_JOIN = """
    JOIN dim_instrument i ON i.instrument_id = f.instrument_id
    JOIN dim_company c ON c.company_key = i.company_key
    JOIN dim_sector s ON s.sector_key = c.sector_key"""

ORACLE_SQL: dict[str, str] = {
    "daily_trading_volume": _with(
        MEASURED_CTES,
        """SELECT business_date, count(DISTINCT order_id) AS order_count, count(DISTINCT trade_id) AS trade_count,
                  CAST(sum(gross_trade_amount) AS DECIMAL(38,2)) AS gross_volume,
                  CAST(sum(brokerage_fee) AS DECIMAL(38,2)) AS brokerage_revenue
           FROM measured GROUP BY business_date ORDER BY business_date""",
    ),
    "top_instruments": _with(
        {**MEASURED_CTES, **INSTRUMENT_CTES},
        """SELECT i.symbol, i.instrument_name, CAST(sum(f.gross_trade_amount) AS DECIMAL(38,2)) AS gross_volume
           FROM measured f JOIN dim_instrument i ON i.instrument_id = f.instrument_id
           GROUP BY ALL ORDER BY gross_volume DESC, symbol, instrument_name LIMIT 10""",
    ),
    "sector_volume": _with(
        {**MEASURED_CTES, **INSTRUMENT_CTES},
        f"""SELECT s.sector_name, CAST(sum(f.gross_trade_amount) AS DECIMAL(38,2)) AS gross_volume
            FROM measured f {SECTOR_JOIN} GROUP BY s.sector_name ORDER BY gross_volume DESC, sector_name""",
    ),
    "customers_by_risk_band": _with(
        CUSTOMER_CTES,
        """SELECT risk_band, count(DISTINCT customer_id) AS customer_count FROM dim WHERE is_current = 'Y'
           GROUP BY risk_band ORDER BY customer_count DESC, risk_band""",
    ),
    "holdings_by_sector": _with(
        {**HOLDING_CTES, **INSTRUMENT_CTES},
        f"""SELECT f.business_date, s.sector_name, CAST(sum(f.market_value) AS DECIMAL(38,2)) AS total_market_value
            FROM holdings f {SECTOR_JOIN} GROUP BY ALL ORDER BY business_date, total_market_value DESC, sector_name""",
    ),
    "account_history": _with(
        ACCOUNT_CTES,
        """SELECT account_id, account_segment, record_start_date, record_end_date, is_current FROM dim
           WHERE account_id IN (SELECT account_id FROM dim GROUP BY account_id HAVING count(*) > 1)
           ORDER BY account_id, record_start_date, record_end_date""",
    ),
    "trade_measures": _with(TRADE_CTES, MEASURES),
    "trade_charges": _with(
        TRADE_CTES,
        """SELECT trade_id, business_date, executed_quantity, executed_price,
                  CAST(greatest(5.00, executed_quantity * executed_price * 0.0003) AS DECIMAL(18,2)) AS brokerage_fee,
                  CAST(executed_quantity * executed_price * 0.00018 AS DECIMAL(18,2)) AS tax_amount
           FROM trades""",
    ),
    "trade_sequence": _with(
        TRADE_CTES,
        """SELECT trade_id, business_date, instrument_id, executed_quantity, executed_price,
                  row_number() OVER (PARTITION BY business_date
                      ORDER BY trade_timestamp, trade_id, instrument_id, executed_quantity, executed_price) AS day_sequence
           FROM trades""",
    ),
    "holdings_eod": _with(HOLDING_CTES, "SELECT * FROM holdings"),
    "cash_flows": _with(TRADE_CTES, CASH),
    "settlements_t1": _with(TRADE_CTES, SETTLEMENTS),
    "executable_orders": f"""
        SELECT order_id, business_date, account_id, instrument_id, order_side, ordered_quantity FROM ({ORDERS})
        WHERE order_status = 'COMPLETED' AND ordered_quantity > 0""",
    "active_accounts": f"SELECT * FROM ({ACCOUNTS_1}) WHERE account_status = 'ACTIVE'",
    "business_run_dates": f"""
        SELECT CAST(order_timestamp AS DATE) AS utc_date,
               CAST(order_timestamp + INTERVAL '5 hours 30 minutes' AS DATE) AS exchange_date,
               count(*) AS order_count
        FROM ({ORDERS}) GROUP BY ALL""",
    **{name: _with(GEO_CTES, f"SELECT * FROM {name}") for name in ("dim_country", "dim_state", "dim_city")},
    **{
        name: _with(INSTRUMENT_CTES, f"SELECT * FROM {name}")
        for name in ("dim_sector", "dim_company", "dim_exchange", "dim_instrument")
    },
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS business_date,
               CAST(year(d) AS INTEGER) AS year_number, CAST(month(d) AS INTEGER) AS month_number,
               CAST(day(d) AS INTEGER) AS day_number, dayname(d) AS weekday_name
        FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)""",
    "geography_second_load": _with(
        GEO_SECOND_CTES,
        "\nUNION ALL\n".join(
            [
                _dimension_rows("country", "country_name"),
                _dimension_rows("state", "state_name", "country_key"),
                _dimension_rows("city", "city_name", "state_key"),
            ]
        ),
    ),
    "instruments_second_load": _with(
        INSTRUMENT_SECOND_CTES,
        "\nUNION ALL\n".join(
            [
                _dimension_rows("sector", "sector_name"),
                _dimension_rows("company", "company_name", "sector_key"),
                _dimension_rows("exchange", "exchange_code"),
                _dimension_rows("instrument", "instrument_id || ' ' || symbol || ' ' || exchange_key", "company_key"),
            ]
        ),
    ),
    "dim_date_second_load": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS business_date,
               CAST(year(d) AS INTEGER) AS year_number, CAST(month(d) AS INTEGER) AS month_number,
               CAST(day(d) AS INTEGER) AS day_number, dayname(d) AS weekday_name
        FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem)""",
    "scd2_advisor": _with(ADVISOR_CTES, "SELECT * FROM dim"),
    "scd2_customer": _with(CUSTOMER_CTES, "SELECT * FROM dim"),
    "scd2_account": _with(ACCOUNT_CTES, "SELECT * FROM dim"),
    "fact_orders_replace": _reload({}, ORDERS, "* REPLACE ('CANCELLED' AS order_status)"),
    "fact_trades_replace": _reload(
        TRADE_CTES,
        MEASURES,
        """* REPLACE (CAST(executed_quantity + 1 AS INTEGER) AS executed_quantity,
                      CAST(gross_trade_amount + executed_price AS DECIMAL(18,2)) AS gross_trade_amount,
                      CAST(net_trade_amount + executed_price AS DECIMAL(18,2)) AS net_trade_amount)""",
    ),
    "fact_cash_replace": _reload(TRADE_CTES, CASH, "* REPLACE ('USD' AS currency_code)"),
    "fact_settlements_replace": _reload(TRADE_CTES, SETTLEMENTS, "* REPLACE ('SETTLED' AS settlement_status)"),
    "fact_holdings_replace": _reload(
        HOLDING_CTES,
        "SELECT * FROM holdings",
        """* REPLACE (CAST(holding_quantity + 1 AS DECIMAL(18,2)) AS holding_quantity,
                      CAST(market_value + market_price AS DECIMAL(18,2)) AS market_value)""",
    ),
    **{name: _with(DQ_CTES, sql) for name, sql in DQ.items()},
    "dq_summary": _with(SUMMARY_CTES, "SELECT * FROM summary"),
    "pipeline_status": _with(
        SUMMARY_CTES,
        """SELECT CASE WHEN sum(failed_rule_outcomes) > 0 THEN 'DQ_FINDINGS_PRESENT' ELSE 'PASSED' END AS pipeline_status,
                  CAST(sum(failed_rule_outcomes) AS BIGINT) AS total_failed_rule_outcomes FROM summary""",
    ),
    "dq_audit": _with(
        SUMMARY_CTES,
        f"""SELECT {FIRST_DAY} AS business_date, dataset_name, dataset_status AS pipeline_status,
                   CAST(failed_rule_outcomes AS INTEGER) AS finding_count FROM summary""",
    ),
    "dq_published": _with(
        {**SUMMARY_CTES, "all_results": "\nUNION ALL\n".join(DQ.values())},
        """SELECT a.*, s.failed_rule_outcomes, s.dataset_status, p.* FROM all_results a LEFT JOIN summary s USING (dataset_name)
           CROSS JOIN (SELECT CASE WHEN sum(failed_rule_outcomes) > 0 THEN 'DQ_FINDINGS_PRESENT' ELSE 'PASSED' END AS pipeline_status,
                       CAST(sum(failed_rule_outcomes) AS BIGINT) AS total_failed_rule_outcomes FROM summary) p""",
    ),
    "transaction_metrics": _with(
        {
            **TRADE_CTES,
            "o": "SELECT CAST(o_orderdate AS DATE) AS business_date, count(*) AS order_count FROM orders GROUP BY ALL",
            "t": """SELECT business_date, count(*) AS trade_count, CAST(sum(brokerage_fee) AS DECIMAL(38,2)) AS fees
                    FROM trades GROUP BY ALL""",
        },
        """SELECT business_date, coalesce(order_count, 0) AS order_count, coalesce(trade_count, 0) AS trade_count,
                  coalesce(trade_count, 0) AS fund_movement_count,
                  CAST(coalesce(fees, 0) AS DOUBLE) AS brokerage_fee_total
           FROM o FULL JOIN t USING (business_date)""",
    ),
    "daily_load_report": LOAD_REPORT,
}
