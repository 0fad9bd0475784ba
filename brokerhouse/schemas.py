"""Tables of the warehouse and of the daily feeds: columns, types, keys.

The column names and types below are fixed values: they are the data contract.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


TEXT = T.StringType()
DATE = T.DateType()
MOMENT = T.TimestampNTZType()
COUNT = T.IntegerType()
KEY = T.LongType()
MONEY = T.DecimalType(18, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def _required(schema: T.StructType, but: tuple[str, ...] = ()) -> T.StructType:
    """The columns as not null, all of them or all `but` a few."""
    return T.StructType([T.StructField(f.name, f.dataType, f.name in but) for f in schema.fields])


# Daily feeds, dated by folder.
FEEDS: dict[str, T.StructType] = {
    "customers_snapshot": _table(
        customer_id=TEXT, customer_name=TEXT, email=TEXT, mobile_number=TEXT, city_name=TEXT, state_name=TEXT,
        country_name=TEXT, risk_band=TEXT, kyc_status=TEXT,
    ),
    "accounts_snapshot": _table(
        account_id=TEXT, customer_id=TEXT, advisor_id=TEXT, account_segment=TEXT, account_status=TEXT,
        opened_date=DATE,
    ),
    "orders": _table(
        order_id=TEXT, business_date=DATE, account_id=TEXT, customer_id=TEXT, instrument_id=TEXT,
        order_timestamp=MOMENT, order_side=TEXT, order_type=TEXT, ordered_quantity=COUNT, limit_price=MONEY,
        order_status=TEXT,
    ),
    "trades": _table(
        trade_id=TEXT, business_date=DATE, order_id=TEXT, account_id=TEXT, customer_id=TEXT, instrument_id=TEXT,
        trade_side=TEXT, trade_timestamp=MOMENT, executed_quantity=COUNT, executed_price=MONEY,
        brokerage_fee=MONEY, tax_amount=MONEY,
    ),
    "fund_movements": _table(
        fund_movement_id=TEXT, business_date=DATE, account_id=TEXT, movement_type=TEXT, amount=MONEY,
        currency_code=TEXT,
    ),
    "settlements": _table(settlement_id=TEXT, trade_id=TEXT, business_date=DATE, settlement_date=DATE, settlement_status=TEXT),
    "market_prices": _table(business_date=DATE, instrument_id=TEXT, close_price=MONEY),
    "holdings_snapshot": _table(
        account_id=TEXT, instrument_id=TEXT, holding_quantity=MONEY, average_cost=MONEY, market_price=MONEY,
        market_value=MONEY,
    ),
}
MASTER_FEEDS = ("customers_snapshot", "accounts_snapshot")
TRANSACTION_FEEDS = (
    "orders",
    "trades",
    "fund_movements",
    "settlements",
    "market_prices",
    "holdings_snapshot",
)

# Reference files, not dated.
REFERENCES: dict[str, T.StructType] = {
    "advisors": _table(advisor_id=TEXT, advisor_name=TEXT, region=TEXT),
    "instruments": _table(
        instrument_id=TEXT, symbol=TEXT, instrument_name=TEXT, company_name=TEXT, sector_name=TEXT,
        exchange_code=TEXT, listing_country=TEXT,
    ),
}

HOLDINGS_FACT_COLUMNS = (
    "business_date",
    "account_id",
    "instrument_id",
    "holding_quantity",
    "average_cost",
    "market_price",
    "market_value",
)

_VERSION = {"record_start_date": DATE, "record_end_date": DATE, "is_current": TEXT}

_DIMENSIONS: dict[str, T.StructType] = {
    "dim_country": _table(country_key=KEY, country_name=TEXT),
    "dim_state": _table(state_key=KEY, state_name=TEXT, country_key=KEY),
    "dim_city": _table(city_key=KEY, city_name=TEXT, state_key=KEY),
    "dim_sector": _table(sector_key=KEY, sector_name=TEXT),
    "dim_company": _table(company_key=KEY, company_name=TEXT, sector_key=KEY),
    "dim_exchange": _table(exchange_key=KEY, exchange_code=TEXT),
    "dim_instrument": _table(
        instrument_key=KEY, instrument_id=TEXT, symbol=TEXT, instrument_name=TEXT, company_key=KEY,
        exchange_key=KEY, listing_country=TEXT,
    ),
    "dim_date": _table(
        date_key=COUNT, business_date=DATE, year_number=COUNT, month_number=COUNT, day_number=COUNT,
        weekday_name=TEXT,
    ),
    "dim_advisor_scd2": _table(advisor_key=KEY, advisor_id=TEXT, advisor_name=TEXT, region=TEXT, **_VERSION),
    "dim_customer_scd2": _table(
        customer_key=KEY, customer_id=TEXT, customer_name=TEXT, email=TEXT, mobile_number=TEXT, city_name=TEXT,
        state_name=TEXT, country_name=TEXT, risk_band=TEXT, kyc_status=TEXT, **_VERSION,
    ),
    "dim_account_scd2": _table(
        account_key=KEY, account_id=TEXT, customer_id=TEXT, advisor_id=TEXT, account_segment=TEXT,
        account_status=TEXT, opened_date=DATE, **_VERSION,
    ),
}
# What a version describes may be unknown; its keys, dates and flag may not. Everything else is not null.
DIMENSIONS: dict[str, T.StructType] = {
    name: _required(schema, tuple(schema.names[2:-3]) if name.endswith("_scd2") else ())
    for name, schema in _DIMENSIONS.items()
}


@dataclass(frozen=True)
class History:
    """A dimension kept in versions: a change in `tracked` opens one, `carried` only rides along."""

    table: str
    surrogate: str
    key: str
    tracked: tuple[str, ...]
    carried: tuple[str, ...] = ()

    @property
    def staged(self) -> list[str]:
        """Staged columns in table order."""
        return [c for c in DIMENSIONS[self.table].names if c == self.key or c in self.tracked + self.carried]

    @property
    def columns(self) -> list[str]:
        return DIMENSIONS[self.table].names


ADVISOR = History("dim_advisor_scd2", "advisor_key", "advisor_id", ("advisor_name", "region"))
CUSTOMER = History(
    "dim_customer_scd2",
    "customer_key",
    "customer_id",
    ("city_name", "state_name", "country_name", "risk_band", "kyc_status"),
    ("customer_name", "email", "mobile_number"),
)
ACCOUNT = History(
    "dim_account_scd2",
    "account_key",
    "account_id",
    ("advisor_id", "account_segment", "account_status"),
    ("customer_id", "opened_date"),
)
HISTORIES = (ADVISOR, CUSTOMER, ACCOUNT)


@dataclass(frozen=True)
class Fact:
    """A fact table: the curated dataset it loads and the order of rows within a day's files. No column may be null."""

    table: str
    feed: str
    schema: T.StructType
    sort_key: tuple[str, ...]


def _trade_fact() -> T.StructType:
    measures = _table(gross_trade_amount=MONEY, net_trade_amount=MONEY)
    return T.StructType(FEEDS["trades"].fields + measures.fields)


def _holdings_fact() -> T.StructType:
    fields = {f.name: f for f in _table(business_date=DATE).fields + FEEDS["holdings_snapshot"].fields}
    return T.StructType([fields[c] for c in HOLDINGS_FACT_COLUMNS])


FACTS: dict[str, Fact] = {
    f.table: f
    for f in (
        Fact("fact_orders", "orders", _required(FEEDS["orders"]), ("account_id",)),
        Fact("fact_trades", "trades", _required(_trade_fact()), ("trade_timestamp",)),
        Fact("fact_fund_movements", "fund_movements", _required(FEEDS["fund_movements"]), ("account_id",)),
        Fact("fact_settlements", "settlements", _required(FEEDS["settlements"]), ("settlement_date",)),
        Fact("fact_daily_holdings", "holdings_snapshot", _required(_holdings_fact()), ("account_id", "instrument_id")),
    )
}

REJECTS = _table(business_date=DATE, dataset_name=TEXT, reason=TEXT, staged_row=TEXT)
AUDIT = _required(
    _table(audit_run_ts=MOMENT, business_date=DATE, dataset_name=TEXT, pipeline_status=TEXT, finding_count=COUNT), ("audit_run_ts",)
)
