"""Every operator as a query over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerhouse.functions.calendar import run_date
from brokerhouse.functions.money import to_money
from brokerhouse.operators import dimensions as dims
from brokerhouse.operators import lifecycle, quality
from brokerhouse.operators.scd2 import apply_scd2
from brokerhouse.plans import analytics, rulesets
from brokerhouse.plans.landing import load_report
from brokerhouse.plans.pipeline import RESULT_COLUMNS, Places, backfill, check, load_facts, write_curated
from brokerhouse.schemas import ACCOUNT, ADVISOR, CUSTOMER, DIMENSIONS, History
from brokerhouse.sources import tables
from brokerhouse.sources.tables import FIRST_DAY, SECOND_DAY
from brokerhouse.sources.warehouse import open_warehouse
from brokerhouse.sources.work import materialize, new_path, no_rows

Query = Callable[[SparkSession, str], DataFrame]

# The day whose slice the replace queries load again.
RELOADED_DAY = "1998-06-15"
# Which rows a first load sees, before a second one sees all.
FIRST_CUSTOMERS = "risk_band = 'HIGH' and country_name <> 'ASIA' and state_name < 'NATION_15'"
FIRST_INSTRUMENTS = "sector_name > 'M' and exchange_code = 'NSE'"


def empty(spark: SparkSession, name: str) -> DataFrame:
    return no_rows(spark, DIMENSIONS[name])


# Snowflake dimensions, first load. Keyed rows are read from their work table, so a child costs its parents once.


def dim_country(spark: SparkSession, folder: str) -> DataFrame:
    return dims.new_countries(empty(spark, "dim_country"), tables.customers(spark, folder))


def _states(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    found = dims.distinct_places(tables.customers(spark, folder))
    countries = dims.new_countries(empty(spark, "dim_country"), found)
    return dims.new_states(empty(spark, "dim_state"), found, countries), countries, found


def dim_state(spark: SparkSession, folder: str) -> DataFrame:
    return _states(spark, folder)[0]


def dim_city(spark: SparkSession, folder: str) -> DataFrame:
    states, countries, found = _states(spark, folder)
    return dims.new_cities(empty(spark, "dim_city"), found, countries, states)


def _sectors(spark: SparkSession, staged: DataFrame) -> DataFrame:
    return dims.new_sectors(empty(spark, "dim_sector"), staged)


def _companies(spark: SparkSession, staged: DataFrame, sectors: DataFrame) -> DataFrame:
    return dims.new_companies(empty(spark, "dim_company"), staged, sectors)


def _exchanges(spark: SparkSession, staged: DataFrame) -> DataFrame:
    return dims.new_exchanges(empty(spark, "dim_exchange"), staged)


def dim_sector(spark: SparkSession, folder: str) -> DataFrame:
    return _sectors(spark, tables.instruments(spark, folder))


def dim_company(spark: SparkSession, folder: str) -> DataFrame:
    staged = tables.instruments(spark, folder)
    return _companies(spark, staged, _sectors(spark, staged))


def dim_exchange(spark: SparkSession, folder: str) -> DataFrame:
    return _exchanges(spark, tables.instruments(spark, folder))


def dim_instrument(spark: SparkSession, folder: str) -> DataFrame:
    staged = tables.instruments(spark, folder)
    sectors = _sectors(spark, staged)
    companies = _companies(spark, staged, sectors)
    return dims.new_instruments(empty(spark, "dim_instrument"), staged, sectors, companies, _exchanges(spark, staged))


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    days = tables.trades(spark, folder, with_account=False)
    return dims.new_dates(empty(spark, "dim_date"), days)


# Second loads: what the first has left is met by an anti join, and keys go on from its highest.


def _second(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)


def _rows(table: str, df: DataFrame) -> DataFrame:
    """A dimension's rows for a report over several: number, name and parent's number."""
    key, name, *parent = DIMENSIONS[table].names[:3]
    above = F.col(parent[0]) if parent else F.lit(None).cast("bigint")
    return df.select(
        F.lit(table).alias("table_name"), F.col(key).alias("row_key"), F.col(name).alias("row_name"), above.alias("parent_key")
    )


def geography_second_load(spark: SparkSession, folder: str) -> DataFrame:
    """Countries, states and cities after two loads: customers of high balances first, then all."""
    countries, states, cities = (empty(spark, name) for name in ("dim_country", "dim_state", "dim_city"))
    everyone = tables.customers(spark, folder)
    for staged in (everyone.where(FIRST_CUSTOMERS), everyone):
        found = dims.distinct_places(staged)
        countries = materialize(_second(countries, dims.new_countries(countries, found)))
        states = materialize(_second(states, dims.new_states(states, found, countries)))
        cities = materialize(_second(cities, dims.new_cities(cities, found, countries, states)))
    return _rows("dim_country", countries).unionByName(_rows("dim_state", states)).unionByName(_rows("dim_city", cities))


def instruments_second_load(spark: SparkSession, folder: str) -> DataFrame:
    """Sectors, companies, exchanges and instruments after two loads; the second renames instruments that are known already."""
    names = ("dim_sector", "dim_company", "dim_exchange", "dim_instrument")
    sectors, companies, exchanges, instruments = (empty(spark, name) for name in names)
    everything = tables.instruments(spark, folder)
    renamed = everything.withColumn("symbol", F.concat("symbol", F.lit("-2")))
    for staged in (everything.where(FIRST_INSTRUMENTS), renamed):
        sectors = materialize(_second(sectors, dims.new_sectors(sectors, staged)))
        companies = materialize(_second(companies, dims.new_companies(companies, staged, sectors)))
        exchanges = materialize(_second(exchanges, dims.new_exchanges(exchanges, staged)))
        instruments = materialize(
            _second(instruments, dims.new_instruments(instruments, staged, sectors, companies, exchanges))
        )
    report = [_rows(name, df) for name, df in zip(names[:3], (sectors, companies, exchanges), strict=True)]
    own = instruments.select(
        F.lit("dim_instrument").alias("table_name"),
        F.col("instrument_key").alias("row_key"),
        F.concat_ws(" ", "instrument_id", "symbol", F.col("exchange_key").cast("string")).alias("row_name"),
        F.col("company_key").alias("parent_key"),
    )
    return reduce(DataFrame.unionByName, [*report, own])


def dim_date_second_load(spark: SparkSession, folder: str) -> DataFrame:
    """Days of orders first, then days of trades: those that were there stay."""
    first = materialize(dims.new_dates(empty(spark, "dim_date"), tables.orders(spark, folder)))
    return _second(first, dims.new_dates(first, tables.trades(spark, folder, with_account=False)))


# Change history over two daily snapshots.


def _two_days(spark: SparkSession, folder: str, spec: History, feed: Callable[..., DataFrame]) -> DataFrame:
    first = apply_scd2(empty(spark, spec.table), feed(spark, folder, FIRST_DAY), spec, FIRST_DAY)
    return apply_scd2(first, feed(spark, folder, SECOND_DAY), spec, SECOND_DAY)


def scd2_advisor(spark: SparkSession, folder: str) -> DataFrame:
    return _two_days(spark, folder, ADVISOR, tables.advisors)


def scd2_customer(spark: SparkSession, folder: str) -> DataFrame:
    return _two_days(spark, folder, CUSTOMER, tables.customer_days)


def scd2_account(spark: SparkSession, folder: str) -> DataFrame:
    return _two_days(spark, folder, ACCOUNT, tables.accounts)


# Facts and the trade lifecycle.


def trade_measures(spark: SparkSession, folder: str) -> DataFrame:
    return lifecycle.add_trade_measures(tables.trades(spark, folder))


def _measured(spark: SparkSession, folder: str) -> DataFrame:
    return lifecycle.add_trade_measures(tables.trades(spark, folder, with_account=False))


def trade_charges(spark: SparkSession, folder: str) -> DataFrame:
    return lifecycle.trade_charges(tables.trades(spark, folder, with_account=False)).select(
        "trade_id", "business_date", "executed_quantity", "executed_price", "brokerage_fee", "tax_amount"
    )


def cash_flows(spark: SparkSession, folder: str) -> DataFrame:
    return lifecycle.cash_flows(tables.trades(spark, folder))


def settlements_t1(spark: SparkSession, folder: str) -> DataFrame:
    trades = tables.trades(spark, folder, with_account=False)
    return lifecycle.next_day_settlements(trades, tables.settlement_confirmations(spark, folder))


def trade_sequence(spark: SparkSession, folder: str) -> DataFrame:
    order = ["trade_timestamp", "trade_id", "instrument_id", "executed_quantity", "executed_price", "_copy"]
    rows = tables.trades(spark, folder, with_account=False, copy_number="_copy").select("business_date", *order)
    return lifecycle.daily_sequence(rows, order, "day_sequence").drop("_copy", "trade_timestamp")


def holdings_eod(spark: SparkSession, folder: str) -> DataFrame:
    return lifecycle.end_of_day_holdings(
        tables.trades(spark, folder), tables.market_prices(spark, folder), ["instrument_id"]
    )


def executable_orders(spark: SparkSession, folder: str) -> DataFrame:
    feed = tables.orders(spark, folder)
    as_delivered = feed.withColumn("ordered_quantity", F.col("ordered_quantity").cast("double").cast("string"))
    return lifecycle.executable_orders(as_delivered).select(
        "order_id", "business_date", "account_id", "instrument_id", "order_side", "ordered_quantity"
    )


def active_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return lifecycle.active_accounts(tables.accounts(spark, folder))


def business_run_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per run date, by UTC and by exchange time."""
    moment = F.col("order_timestamp")
    return (
        tables.orders(spark, folder)
        .groupBy(run_date(moment).alias("utc_date"), run_date(moment, "Asia/Kolkata").alias("exchange_date"))
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


def _reload(spark: SparkSession, name: str, rows: DataFrame, corrected: DataFrame) -> DataFrame:
    """Fill all days into a warehouse, load one of them, earlier than others, again with corrected rows given as text, and
    read the fact back."""
    root = new_path(spark)
    backfill(spark, root, {name: rows})
    day = F.col("business_date") == F.lit(RELOADED_DAY).cast("date")
    load_facts(spark, root, RELOADED_DAY, {name: tables.as_text(corrected.where(day))})
    return open_warehouse(spark, root).table(name)


def fact_orders_replace(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.orders(spark, folder)
    return _reload(spark, "fact_orders", rows, rows.withColumn("order_status", F.lit("CANCELLED")))


def fact_trades_replace(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.trades(spark, folder)
    corrected = rows.withColumn("executed_quantity", F.col("executed_quantity") + 1)
    return _reload(
        spark, "fact_trades", lifecycle.add_trade_measures(rows), lifecycle.add_trade_measures(corrected)
    )


def fact_cash_replace(spark: SparkSession, folder: str) -> DataFrame:
    rows = cash_flows(spark, folder)
    return _reload(spark, "fact_fund_movements", rows, rows.withColumn("currency_code", F.lit("USD")))


def fact_settlements_replace(spark: SparkSession, folder: str) -> DataFrame:
    rows = settlements_t1(spark, folder)
    return _reload(spark, "fact_settlements", rows, rows.withColumn("settlement_status", F.lit("SETTLED")))


def fact_holdings_replace(spark: SparkSession, folder: str) -> DataFrame:
    rows = holdings_eod(spark, folder)
    corrected = rows.withColumns(
        {
            "holding_quantity": to_money(F.col("holding_quantity") + 1),
            "market_value": to_money(F.col("market_value") + F.col("market_price")),
        }
    )
    return _reload(spark, "fact_daily_holdings", rows, corrected)


# Data quality.


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return tables.customers(spark, folder)


def _accounts(spark: SparkSession, folder: str) -> DataFrame:
    return tables.accounts(spark, folder)


def _raw_trades(spark: SparkSession, folder: str) -> DataFrame:
    return tables.as_text(tables.trades(spark, folder))


def _quality(ruleset: str, rows: Query) -> Query:
    rules = {**rulesets.RAW, **rulesets.CURATED}[ruleset]
    return lambda spark, folder: quality.evaluate(rows(spark, folder), {ruleset: rules})


QUALITY: dict[str, Query] = {
    "dq_customers": _quality("customers", _customers),
    "dq_accounts": _quality("accounts", _accounts),
    "dq_orders": _quality("orders", tables.raw_orders),
    "dq_trades": _quality("trades", _raw_trades),
    "dq_curated_customers": _quality("curated_customers", _customers),
    "dq_curated_accounts": _quality("curated_accounts", _accounts),
    "dq_curated_orders": _quality("curated_orders", tables.raw_orders),
    "dq_curated_trades": _quality("curated_trades", trade_measures),
}


def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    results = [query(spark, folder) for name, query in QUALITY.items() if name.startswith("dq_curated_")]
    union = results[0]
    for more in results[1:]:
        union = union.unionByName(more)
    return quality.summarize(union)


def pipeline_status(spark: SparkSession, folder: str) -> DataFrame:
    return quality.pipeline_status(dq_summary(spark, folder))


def dq_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Audit rows without their run time, which no oracle can know."""
    return quality.audit_rows(dq_summary(spark, folder), FIRST_DAY).drop("audit_run_ts")


def dq_published(spark: SparkSession, folder: str) -> DataFrame:
    """Results of both rulesets as a second run has left them in the published files, each with its dataset's summary.

    The first run writes other rows, of which nothing may stay.
    """
    root = new_path(spark)
    places = Places(f"{root}/raw", root, f"{root}/warehouse")
    feeds = {
        "customers_snapshot": _customers(spark, folder),
        "accounts_snapshot": _accounts(spark, folder),
        "orders": tables.raw_orders(spark, folder),
        "trades": lifecycle.add_trade_measures(_raw_trades(spark, folder)),
        "fund_movements": cash_flows(spark, folder),
    }
    for rows in ({name: df.limit(0) for name, df in feeds.items()}, feeds):
        write_curated(spark, places, FIRST_DAY, rows)
        check(spark, places, FIRST_DAY)
    read = lambda name, columns: spark.read.schema(columns).json(places.quality(FIRST_DAY, name))
    summary = read("summary", "dataset_name string, failed_rule_outcomes bigint, dataset_status string")
    status = read("pipeline_status", "pipeline_status string, total_failed_rule_outcomes bigint")  # one row
    of_all = {name: status.select(name).scalar() for name in status.columns}
    return read("results", RESULT_COLUMNS).join(summary, "dataset_name", "left").withColumns(of_all)


def transaction_metrics(spark: SparkSession, folder: str) -> DataFrame:
    trades = tables.trades(spark, folder, with_account=False)
    return quality.transaction_metrics(tables.orders(spark, folder), trades, cash_flows(spark, folder))


# Analytics.


def daily_trading_volume(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.daily_trading_volume(_measured(spark, folder))


def _named_branch(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Instruments, companies and sectors under their names as keys: no answer shows a number, so none is given out."""
    staged = tables.instruments(spark, folder)
    company = F.struct("company_name", "sector_name").alias("company_key")
    companies = staged.select(company).distinct().select("company_key", F.col("company_key.sector_name").alias("sector_key"))
    sectors = staged.select("sector_name").distinct().select(F.col("sector_name").alias("sector_key"), "sector_name")
    return staged.select("instrument_id", "symbol", "instrument_name", company), companies, sectors


def top_instruments(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.top_instruments(_measured(spark, folder), _named_branch(spark, folder)[0])


def sector_volume(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.sector_volume(_measured(spark, folder), *_named_branch(spark, folder))


def customers_by_risk_band(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.customers_by_risk_band(scd2_customer(spark, folder))


def holdings_by_sector(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.holdings_by_sector(holdings_eod(spark, folder), *_named_branch(spark, folder))


def account_history(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.account_history(scd2_account(spark, folder))


QUERIES: dict[str, Query] = {
    "daily_trading_volume": daily_trading_volume,
    "top_instruments": top_instruments,
    "sector_volume": sector_volume,
    "customers_by_risk_band": customers_by_risk_band,
    "holdings_by_sector": holdings_by_sector,
    "account_history": account_history,
    "trade_measures": trade_measures,
    "trade_charges": trade_charges,
    "trade_sequence": trade_sequence,
    "holdings_eod": holdings_eod,
    "cash_flows": cash_flows,
    "settlements_t1": settlements_t1,
    "executable_orders": executable_orders,
    "active_accounts": active_accounts,
    "business_run_dates": business_run_dates,
    "dim_country": dim_country,
    "dim_state": dim_state,
    "dim_city": dim_city,
    "dim_sector": dim_sector,
    "dim_company": dim_company,
    "dim_exchange": dim_exchange,
    "dim_instrument": dim_instrument,
    "dim_date": dim_date,
    "geography_second_load": geography_second_load,
    "instruments_second_load": instruments_second_load,
    "dim_date_second_load": dim_date_second_load,
    "scd2_advisor": scd2_advisor,
    "scd2_customer": scd2_customer,
    "scd2_account": scd2_account,
    "fact_orders_replace": fact_orders_replace,
    "fact_trades_replace": fact_trades_replace,
    "fact_cash_replace": fact_cash_replace,
    "fact_settlements_replace": fact_settlements_replace,
    "fact_holdings_replace": fact_holdings_replace,
    **QUALITY,
    "dq_summary": dq_summary,
    "pipeline_status": pipeline_status,
    "dq_audit": dq_audit,
    "dq_published": dq_published,
    "transaction_metrics": transaction_metrics,
    "daily_load_report": load_report,
}
