"""Brokerage feeds read off the order and line-item tables of a TPC-H-like folder.

Every feed is a projection (with joins to the two tiny geography tables, and to the
orders for the account of a trade), so its size grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerhouse.functions.calendar import plus_seconds
from brokerhouse.functions.identifiers import TRADE_ID, numbered_id
from brokerhouse.functions.money import to_money
from brokerhouse.sources.work import with_copy_number

FIRST_DAY = "2026-04-19"
SECOND_DAY = "2026-04-20"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _geography(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customer snapshot of the first day: the whole table."""
    return _customer_rows(spark, folder, FIRST_DAY)


def customer_days(spark: SparkSession, folder: str, day: str = FIRST_DAY) -> DataFrame:
    """Customer snapshot of one of two days, for the history scenario alone: customers in debt come, rich ones go."""
    balance = F.col("c_acctbal")
    return _customer_rows(spark, folder, day, balance >= 0 if day == FIRST_DAY else balance <= 9500)


def _customer_rows(spark: SparkSession, folder: str, day: str, there: Column | None = None) -> DataFrame:
    """Customers as of a day.

    Between the days the machinery segment changes its risk band, the furniture segment only its
    names, and nation 3 loses its KYC status. Nation 7 never has one; nation 11 has no city.
    """
    source = table(spark, folder, "customer").join(
        _geography(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")
    )
    balance, nation, segment = F.col("c_acctbal"), F.col("c_nationkey"), F.col("c_mktsegment")
    key = _text("c_custkey")
    name = F.col("c_name")
    band = F.when(balance < 3000, "LOW").when(balance < 7000, "MEDIUM").otherwise("HIGH")
    kyc = F.when(nation != 7, F.when(F.col("c_custkey") % 10 == 0, "PENDING").otherwise("VERIFIED"))
    if there is not None:
        source = source.where(there)
    if day != FIRST_DAY:
        name = F.when(segment == "FURNITURE", F.concat(name, F.lit(" & Co"))).otherwise(name)
        changed = F.when(band == "HIGH", "MEDIUM").otherwise("HIGH")
        band = F.when(segment == "MACHINERY", changed).otherwise(band)
        kyc = F.when(nation != 3, kyc)
    return source.select(
        key.alias("customer_id"),
        name.alias("customer_name"),
        F.concat(F.lit("customer"), key, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("98"), key).alias("mobile_number"),
        F.when(nation != 11, segment).alias("city_name"),
        F.col("n_name").alias("state_name"),
        F.col("r_name").alias("country_name"),
        band.alias("risk_band"),
        kyc.alias("kyc_status"),
    )


def accounts(spark: SparkSession, folder: str, day: str = FIRST_DAY) -> DataFrame:
    """One account per customer; on the second day the household segment is reactivated and reassigned."""
    source = table(spark, folder, "customer")
    number = F.col("c_custkey")
    advisor = number % 10
    segment = F.when(number % 3 == 0, "EQUITY_DELIVERY").when(number % 3 == 1, "INTRADAY").otherwise("FNO")
    status = F.when(number % 4 == 3, "DORMANT").otherwise("ACTIVE")
    if day != FIRST_DAY:
        moved = F.col("c_mktsegment") == "HOUSEHOLD"
        advisor = F.when(moved, (number + 1) % 10).otherwise(advisor)
        segment = F.when(moved, F.when(segment == "FNO", "EQUITY_DELIVERY").otherwise("FNO")).otherwise(segment)
        status = F.when(moved, "ACTIVE").otherwise(status)
    return source.select(
        _text("c_custkey").alias("account_id"),
        _text("c_custkey").alias("customer_id"),
        advisor.cast("string").alias("advisor_id"),
        segment.alias("account_segment"),
        status.alias("account_status"),
        F.date_add(F.lit("2024-01-01").cast("date"), (number % 366).cast("int")).alias("opened_date"),
    )


def advisors(spark: SparkSession, folder: str, day: str = FIRST_DAY) -> DataFrame:
    """Suppliers as advisors; on the second day those with balances under 1,000 move to head office."""
    source = table(spark, folder, "supplier").join(
        _geography(spark, folder), F.col("s_nationkey") == F.col("n_nationkey")
    )
    region = F.col("r_name")
    if day != FIRST_DAY:
        region = F.when(F.col("s_acctbal") < 1000, "HEAD OFFICE").otherwise(region)
    return source.select(
        _text("s_suppkey").alias("advisor_id"), F.col("s_name").alias("advisor_name"), region.alias("region")
    )


def instruments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        _text("p_partkey").alias("instrument_id"),
        F.concat(F.lit("STK"), _text("p_partkey")).alias("symbol"),
        F.col("p_name").alias("instrument_name"),
        F.col("p_brand").alias("company_name"),
        F.col("p_type").alias("sector_name"),
        F.when(F.col("p_size") % 2 == 0, "NSE").otherwise("BSE").alias("exchange_code"),
        F.lit("India").alias("listing_country"),
    )


def market_prices(spark: SparkSession, folder: str) -> DataFrame:
    """One close price per instrument, for all days."""
    return table(spark, folder, "part").select(
        _text("p_partkey").alias("instrument_id"), to_money(F.col("p_retailprice")).alias("close_price")
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "CANCELLED")
    return table(spark, folder, "orders").select(
        _text("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("business_date"),
        _text("o_custkey").alias("account_id"),
        _text("o_custkey").alias("customer_id"),
        (number % 200).cast("string").alias("instrument_id"),
        plus_seconds(F.col("o_orderdate"), number % 86400).alias("order_timestamp"),
        F.when(number % 2 == 0, "BUY").otherwise("SELL").alias("order_side"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "MARKET").otherwise("LIMIT").alias("order_type"),
        (number % 50).cast("int").alias("ordered_quantity"),
        to_money(F.col("o_totalprice")).alias("limit_price"),
        status.otherwise("REJECTED").alias("order_status"),
    )


def trades(
    spark: SparkSession, folder: str, with_account: bool = True, copy_number: str | None = None
) -> DataFrame:
    """Line items as trades. The orders are read only when the account is asked for.

    `copy_number` names a column that tells equal trades apart, taken straight from the files.
    """
    items = table(spark, folder, "lineitem")
    extra = []
    if copy_number is not None:
        items, extra = with_copy_number(items, copy_number), [copy_number]
    price = to_money(F.col("l_extendedprice"))
    number = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    account = []
    if with_account:
        accounts_of_orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
        items = items.join(accounts_of_orders, F.col("l_orderkey") == F.col("o_orderkey"))
        account = [_text("o_custkey").alias("account_id"), _text("o_custkey").alias("customer_id")]
    return items.select(
        numbered_id(TRADE_ID, number).alias("trade_id"),
        F.to_date("l_shipdate").alias("business_date"),
        _text("l_orderkey").alias("order_id"),
        *account,
        _text("l_partkey").alias("instrument_id"),
        F.when(F.col("l_returnflag") == "A", "SELL").otherwise("BUY").alias("trade_side"),
        plus_seconds(F.col("l_shipdate"), number % 86400).alias("trade_timestamp"),
        F.col("l_quantity").cast("int").alias("executed_quantity"),
        price.alias("executed_price"),
        to_money(price * F.col("l_discount").cast("decimal(4,2)")).alias("brokerage_fee"),
        to_money(price * F.col("l_tax").cast("decimal(4,2)")).alias("tax_amount"),
        *extra,
    )


def settlement_confirmations(spark: SparkSession, folder: str) -> DataFrame:
    """Line items that are finished as confirmed settlements of their trades; the others have none."""
    number = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    return table(spark, folder, "lineitem").where(F.col("l_linestatus") == "F").select(
        numbered_id(TRADE_ID, number).alias("trade_id"),
        F.to_date("l_shipdate").alias("business_date"),
        F.lit("SETTLED").alias("settlement_status"),
    )


def as_text(df: DataFrame) -> DataFrame:
    """The feed as its raw file has it: every column text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text; market orders come without a readable limit price."""
    price = F.when(F.col("order_type") == "MARKET", "n/a").otherwise(F.col("limit_price"))
    return as_text(orders(spark, folder)).withColumn("limit_price", price)
