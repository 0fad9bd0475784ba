"""Operators on small literal frames, expected rows written by hand or worked out row by row."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brokerhouse.functions.calendar import date_parts, plus_seconds, run_date
from brokerhouse.functions.identifiers import TRADE_ID, id_number, numbered_id, whole_number
from brokerhouse.operators import dimensions as dims
from brokerhouse.operators import lifecycle, quality
from brokerhouse.operators.facts import day_slice, replace_day
from brokerhouse.operators.numbering import assign_keys, number_rows, number_rows_within
from brokerhouse.operators.scd2 import apply_scd2, one_row_per_key
from brokerhouse.plans import rulesets
from brokerhouse.schemas import ACCOUNT, ADVISOR, DIMENSIONS, FACTS, FEEDS, HOLDINGS_FACT_COLUMNS
from brokerhouse.sources import curated, feeds
from brokerhouse.sources.work import materialize, no_rows, with_copy_number, work_dir

D1, D2 = "2026-04-19", "2026-04-20"


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def money(text: str) -> Decimal:
    return Decimal(text)


# Functions.


def test_identifiers_keep_long_numbers_whole(spark):
    df = spark.createDataFrame([(12,), (1234567890,)], "n bigint").select(numbered_id(TRADE_ID, F.col("n")).alias("t"))
    assert rows(df) == [("TRD00000012",), ("TRD1234567890",)]
    assert rows(df.select(id_number(TRADE_ID, F.col("t")))) == [(12,), (1234567890,)]


def test_whole_number_cuts(spark):
    df = spark.createDataFrame([("12.0",), ("7",), ("3.9",)], "t string")
    assert rows(df.select(whole_number(F.col("t")))) == [(12,), (3,), (7,)]


def test_run_date_by_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 4, 19, 18, 29, 59),), (dt.datetime(2026, 4, 19, 18, 30),)], "t timestamp_ntz")
    got = rows(df.select(run_date(F.col("t")), run_date(F.col("t"), "Asia/Kolkata")))
    assert got == [(dt.date(2026, 4, 19), dt.date(2026, 4, 19)), (dt.date(2026, 4, 19), dt.date(2026, 4, 20))]


def test_plus_seconds_passes_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 4, 19, 23, 59, 59), 2)], "t timestamp_ntz, s bigint")
    assert rows(df.select(plus_seconds(F.col("t"), F.col("s")))) == [(dt.datetime(2026, 4, 20, 0, 0, 1),)]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2026, 4, 19),)], "d date").select(*date_parts(F.col("d")))
    assert rows(df) == [(20260419, dt.date(2026, 4, 19), 2026, 4, 19, "Sunday")]


# Sources.


def test_reference_root():
    assert feeds.reference_root("s3://b/raw") == "s3://b/reference"
    assert feeds.reference_root("/data/myraw") == "/data/myreference"
    assert feeds.reference_root("/data/in/") == "/data/in/reference"
    assert feeds.reference_root("/data/raw/") == "/data/raw/reference"


def test_require_columns_names_what_is_missing(spark):
    df = spark.createDataFrame([("1", "n")], "customer_id string, customer_name string")
    with pytest.raises(RuntimeError, match=r"customers.*risk_band"):
        feeds.require_columns(df, ["customer_id", "risk_band"], "customers")
    assert feeds.require_columns(df, ["customer_name"], "customers") is df


def test_csv_is_text_and_empty_is_null(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("close_price,instrument_id,business_date,extra\n1.50,I1,2026-04-19,x\n,I2,2026-04-19,\n")
    df = feeds.read_text_csv(spark, str(path), FEEDS["market_prices"], "market_prices")
    assert {t for _, t in df.dtypes} == {"string"}
    good = feeds.typed(df.where("instrument_id = 'I1'"), FEEDS["market_prices"])
    assert rows(good) == [(dt.date(2026, 4, 19), "I1", money("1.50"))]
    with pytest.raises(Exception, match="bad close_price: empty"):
        feeds.typed(df, FEEDS["market_prices"]).collect()


def test_typed_load_fails_on_malformed(spark):
    df = spark.createDataFrame([("2026-04-19", "I1", "n/a")], "business_date string, instrument_id string, close_price string")
    with pytest.raises(Exception, match="bad close_price: n/a"):
        feeds.typed(df, FEEDS["market_prices"]).collect()


def test_sinks_replace_their_folder(spark, tmp_path):
    for write, read in (
        (curated.write_csv, lambda p: spark.read.option("header", True).csv(p)),
        (curated.write_json, spark.read.json),
        (curated.write_parquet, spark.read.parquet),
    ):
        path = str(tmp_path / write.__name__)
        write(spark.createDataFrame([("a",), ("b",)], "x string"), path)
        write(spark.createDataFrame([("c",)], "x string"), path)
        assert rows(read(path)) == [("c",)]


def test_write_by_day(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.createDataFrame([(dt.date(2026, 4, 19), 1), (dt.date(2026, 4, 19), 2), (dt.date(2026, 4, 21), 3)], "business_date date, x int")
    curated.write_by_day(df, path)
    assert sorted(p.name for p in (tmp_path / "days").glob("business_date=*")) == ["business_date=2026-04-19", "business_date=2026-04-21"]
    assert spark.read.parquet(path).count() == 3
    empty = tmp_path / "none"
    curated.write_by_day(df.where("x > 9"), str(empty))
    assert not list(empty.glob("business_date=*"))


def test_work_tables(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    assert rows(materialize(df)) == rows(df)
    assert work_dir(spark) == work_dir(spark)
    assert no_rows(spark, df.schema).count() == 0


# Numbering.


def test_numbers_equal_a_global_row_number(spark):
    df = spark.range(0, 20000, 1, 7).select((F.hash("id").cast("bigint") * 100000 + F.col("id")).alias("k"))
    got = {r.k: r.n for r in number_rows(df, ["k"], "n", after=5).collect()}
    assert [got[k] for k in sorted(got)] == list(range(6, 20006))


def test_numbers_within_groups_with_one_hot_group(spark):
    df = spark.range(0, 9000, 1, 5).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 50).alias("k"),
        "id",
    )
    df = df.withColumn("g", F.when(F.col("id") % 11 != 0, F.col("g")))  # a null group is a group
    got = number_rows_within(df, ["g"], ["k", "id"], "n").collect()
    assert len(got) == 9000
    groups: dict = {}
    for r in got:
        groups.setdefault(r.g, []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: (r.k is not None, r.k, r.id))
        assert [r.n for r in members] == list(range(1, len(members) + 1))


def test_copies_get_distinct_numbers(spark):
    df = with_copy_number(materialize(spark.range(0, 3000, 1, 3).select(F.lit("same").alias("x"))))
    got = number_rows(df, ["x", "_copy"], "n")
    assert sorted(r.n for r in got.collect()) == list(range(1, 3001))


def test_no_rows_no_numbers(spark):
    df = spark.createDataFrame([], "k string")
    assert number_rows(df, ["k"], "n").collect() == []
    assert number_rows_within(df.withColumn("g", F.lit(1)), ["g"], ["k"], "n").collect() == []


def test_keys_go_on_from_the_highest(spark):
    existing = spark.createDataFrame([(7, "a")], "key bigint, name string")
    new = spark.createDataFrame([("c",), ("b",)], "name string")
    assert rows(assign_keys(new, existing, "key", ["name"])) == [("b", 8), ("c", 9)]


# Dimensions.


def test_only_missing_names_are_added_and_nulls_left_out(spark):
    dim = spark.createDataFrame([(1, "India")], DIMENSIONS["dim_country"])
    staged = spark.createDataFrame([("India",), ("Nepal",), ("Nepal",), (None,)], "country_name string")
    assert rows(dims.new_countries(dim, staged)) == [(2, "Nepal")]


def test_same_state_name_in_two_countries(spark):
    countries = spark.createDataFrame([(1, "X"), (2, "Y")], DIMENSIONS["dim_country"])
    dim = spark.createDataFrame([(1, "Delta", 1)], DIMENSIONS["dim_state"])
    staged = spark.createDataFrame([("Delta", "X"), ("Delta", "Y"), ("Lost", "Z")], "state_name string, country_name string")
    assert rows(dims.new_states(dim, staged, countries)) == [(2, "Delta", 2)]


def test_instrument_changes_are_ignored(spark):
    sectors = spark.createDataFrame([(1, "IT")], DIMENSIONS["dim_sector"])
    companies = spark.createDataFrame([(1, "Acme", 1)], DIMENSIONS["dim_company"])
    exchanges = spark.createDataFrame([(1, "NSE")], DIMENSIONS["dim_exchange"])
    dim = spark.createDataFrame([(1, "I1", "S1", "One", 1, 1, "India")], DIMENSIONS["dim_instrument"])
    from brokerhouse.schemas import REFERENCES

    staged = spark.createDataFrame(
        [("I1", "S1", "Renamed", "Acme", "IT", "NSE", "India"), ("I2", "S2", "Two", "Acme", "IT", "NSE", "India")],
        REFERENCES["instruments"],
    )
    assert rows(dims.new_instruments(dim, staged, sectors, companies, exchanges)) == [(2, "I2", "S2", "Two", 1, 1, "India")]


def test_dates_once(spark):
    dim = spark.createDataFrame([(20260419, dt.date(2026, 4, 19), 2026, 4, 19, "Sunday")], DIMENSIONS["dim_date"])
    days = spark.createDataFrame([(dt.date(2026, 4, 19),), (dt.date(2026, 4, 20),), (dt.date(2026, 4, 20),)], "business_date date")
    assert rows(dims.new_dates(dim, days)) == [(20260420, dt.date(2026, 4, 20), 2026, 4, 20, "Monday")]


# History.


def _advisor_stage(spark, *staged):
    return spark.createDataFrame(list(staged), "advisor_id string, advisor_name string, region string")


def _versions(df):
    return [(r[1], r[2], r[3], str(r[4]), str(r[5]), r[6]) for r in sorted(df.collect(), key=lambda r: r[0])]


def test_history_of_an_advisor(spark):
    dim = materialize(
        apply_scd2(no_rows(spark, DIMENSIONS["dim_advisor_scd2"]), _advisor_stage(
            spark, ("a", "Asha", "WEST"), ("b", "Bina", "WEST"), ("c", "Chand", "WEST"), (None, "Nobody", "WEST")
        ), ADVISOR, D1)
    )
    after = apply_scd2(dim, _advisor_stage(spark, ("a", "Asha", "NORTH"), ("b", None, "WEST"), ("d", "Dev", "WEST")), ADVISOR, D2)
    assert _versions(after) == [
        ("a", "Asha", "WEST", D1, D2, "N"),
        ("b", "Bina", "WEST", D1, "9999-12-31", "Y"),  # a change to null is none
        ("c", "Chand", "WEST", D1, "9999-12-31", "Y"),
        ("a", "Asha", "NORTH", D2, "9999-12-31", "Y"),
        ("d", "Dev", "WEST", D2, "9999-12-31", "Y"),
    ]


def test_repeated_keys_are_all_opened_unless_reduced(spark):
    stage = _advisor_stage(spark, ("a", "Asha", "WEST"), ("a", "Asha", "EAST"), ("a", "Asha", "EAST"))
    dim = no_rows(spark, DIMENSIONS["dim_advisor_scd2"])
    assert len(_versions(apply_scd2(dim, stage, ADVISOR, D1))) == 3
    assert rows(one_row_per_key(stage, "advisor_id")) == [("a", "Asha", "EAST")]


def _sequential(dim: list[dict], stage: list[dict], day: str) -> list[dict]:
    """Update, then insert, row by row as SQL would."""
    tracked, differ = ACCOUNT.tracked, lambda a, b: a is not None and b is not None and a != b
    out = [dict(r) for r in dim]
    for r in out:
        if r["is_current"] == "Y" and any(
            s["account_id"] == r["account_id"] and any(differ(r[t], s[t]) for t in tracked) for s in stage
        ):
            r["record_end_date"], r["is_current"] = day, "N"
    current = [r for r in out if r["is_current"] == "Y"]
    for s in stage:
        same = [r for r in current if r["account_id"] == s["account_id"]]
        if not same:
            out.append({**s, "record_start_date": day, "record_end_date": "9999-12-31", "is_current": "Y"})
        for r in same:
            if any(differ(r[t], s[t]) for t in tracked):
                out.append({**s, "record_start_date": day, "record_end_date": "9999-12-31", "is_current": "Y"})
    return out


def test_history_equals_update_then_insert_on_random_loads(spark):
    draw = random.Random(5)
    expected: list[dict] = []
    dim = no_rows(spark, DIMENSIONS["dim_account_scd2"])
    for day in (D1, D2, D2, "2026-04-23"):
        stage = []
        for key in draw.sample(range(30), 20):
            for _ in range(draw.choice([1, 1, 1, 2, 3])):
                stage.append({
                    "account_id": str(key), "customer_id": str(draw.randrange(3)),
                    "advisor_id": draw.choice(["x", "y", None]), "account_segment": draw.choice(["p", "q", None]),
                    "account_status": draw.choice(["ACTIVE", "DORMANT"]), "opened_date": dt.date(2024, 1, 1),
                })
        expected = _sequential(expected, stage, day)
        frame = spark.createDataFrame([tuple(s[c] for c in FEEDS["accounts_snapshot"].names) for s in stage], FEEDS["accounts_snapshot"])
        dim = materialize(apply_scd2(dim, frame, ACCOUNT, day))
        got = sorted(str(tuple(map(str, r[1:]))) for r in dim.collect())
        columns = DIMENSIONS["dim_account_scd2"].names[1:]
        assert got == sorted(str(tuple(str(e[c]) for c in columns)) for e in expected)
        keys = sorted(r.account_key for r in dim.collect())
        assert keys == list(range(1, len(keys) + 1))


# Facts.


def test_a_day_is_replaced_whole(spark):
    schema = FACTS["fact_settlements"].schema
    day1, day2 = dt.date(2026, 4, 19), dt.date(2026, 4, 20)
    existing = spark.createDataFrame([("S1", "T1", day1, day2, "SETTLED"), ("S1", "T1", day2, day2, "SETTLED")], schema)
    text = "settlement_id string, trade_id string, business_date string, settlement_date string, settlement_status string"
    incoming = spark.createDataFrame([("S9", "T9", D1, D2, "PENDING")], text)
    undated = existing.limit(1).withColumn("business_date", F.lit(None).cast("date"))
    assert replace_day(undated, incoming.where("false"), schema, D1).count() == 1
    assert rows(replace_day(existing, incoming, schema, D1)) == [
        ("S1", "T1", day2, day2, "SETTLED"),
        ("S9", "T9", day1, day2, "PENDING"),
    ]
    assert rows(replace_day(existing, incoming.where("false"), schema, D1)) == [("S1", "T1", day2, day2, "SETTLED")]
    with pytest.raises(Exception, match="row of another day in 2026-04-20"):
        day_slice(incoming, schema, D2).drop("business_date").collect()


# Lifecycle.

TRADE_SCHEMA = (
    "trade_id string, business_date date, account_id string, instrument_id string, trade_side string,"
    " executed_quantity int, executed_price decimal(18,2), brokerage_fee decimal(18,2), tax_amount decimal(18,2)"
)


def _trades(spark, *staged):
    day = dt.date(2026, 4, 19)
    full = [(t, day, a, i, s, q, money(p), money("5.00"), money("0.10")) for t, a, i, s, q, p in staged]
    return spark.createDataFrame(full, TRADE_SCHEMA)


def test_measures_add_charges_for_both_sides(spark):
    df = lifecycle.add_trade_measures(_trades(spark, ("TRD1", "a", "i", "BUY", 3, "10.01"), ("TRD2", "a", "i", "SELL", 1, "2.00")))
    assert rows(df.select("gross_trade_amount", "net_trade_amount")) == [
        (money("2.00"), money("7.10")),
        (money("30.03"), money("35.13")),
    ]


def test_measures_of_text_round_once_and_malformed_is_null(spark):
    text = "executed_quantity string, executed_price string, brokerage_fee string, tax_amount string"
    df = spark.createDataFrame([("3", "1.115", "0", "0"), ("x", "1", "0", "0"), ("1", "1.00", "", "0")], text)
    got = lifecycle.add_trade_measures(df).select("gross_trade_amount", "net_trade_amount")
    assert rows(got) == [(money("1.00"), None), (money("3.35"), money("3.35")), (None, None)]


def test_charges_have_a_floor(spark):
    df = lifecycle.trade_charges(_trades(spark, ("TRD1", "a", "i", "BUY", 1, "100.00"), ("TRD2", "a", "i", "BUY", 100, "2000.00")))
    assert rows(df.select("brokerage_fee", "tax_amount")) == [(money("5.00"), money("0.02")), (money("60.00"), money("36.00"))]


def test_cash_and_settlements(spark):
    df = _trades(spark, ("TRD00000010", "a", "i", "BUY", 2, "1.50"), ("TRD00000011", "b", "i", "SELL", 1, "4.00"))
    day = dt.date(2026, 4, 19)
    assert rows(lifecycle.cash_flows(df)) == [
        ("FND00000010", day, "a", "TRADE_SETTLEMENT", money("-3.00"), "INR"),
        ("FND00000011", day, "b", "TRADE_SETTLEMENT", money("4.00"), "INR"),
    ]
    other_day = dt.date(2026, 4, 18)  # trade numbers start again each day
    confirmed = [(day, "TRD00000011", "PENDING"), (day, "TRD00000011", "SETTLED"), (other_day, "TRD00000010", "SETTLED"), (day, None, "SETTLED")]
    told = spark.createDataFrame(confirmed, "business_date date, trade_id string, settlement_status string")
    assert rows(lifecycle.next_day_settlements(df, told)) == [
        ("SET00000010", "TRD00000010", day, dt.date(2026, 4, 20), "PENDING"),
        ("SET00000011", "TRD00000011", day, dt.date(2026, 4, 20), "SETTLED"),
    ]


def test_holdings(spark):
    df = _trades(
        spark,
        ("1", "a", "i", "BUY", 10, "1.00"), ("2", "a", "i", "SELL", 7, "0.99"), ("3", "a", "j", "SELL", 1, "5.00"),
        ("4", "b", "j", "BUY", 1, "5.00"), ("5", "b", "j", "SELL", 1, "5.00"), ("6", "c", "j", "BUY", 8, "0.01"),
        ("7", "c", "j", "SELL", 7, "0.01"), ("8", "d", "i", "BUY", 3, "0.01"), ("9", "d", "i", "SELL", 1, "9.00"),
    )
    prices = spark.createDataFrame(
        [(dt.date(2026, 4, 19), "i", money("2.50")), (dt.date(2026, 4, 19), "j", money("7.00"))], FEEDS["market_prices"]
    )
    got = lifecycle.end_of_day_holdings(df, prices)
    assert got.columns == list(HOLDINGS_FACT_COLUMNS)
    assert [r[1:] for r in rows(got)] == [
        ("a", "i", money("3.00"), money("1.02"), money("2.50"), money("7.50")),
        ("c", "j", money("1.00"), money("0.01"), money("7.00"), money("7.00")),
        ("d", "i", money("2.00"), money("-4.49"), money("2.50"), money("5.00")),  # -4.485 away from zero
    ]
    with pytest.raises(Exception, match="no close price for instrument j"):
        lifecycle.end_of_day_holdings(df, prices.where("instrument_id = 'i'")).collect()


def test_joins_within_a_day_sort_by_the_id_first(spark):
    df = _trades(spark, ("TRD00000010", "a", "i", "BUY", 2, "1.50"), ("TRD00000011", "b", "j", "BUY", 1, "4.00"))
    told = df.select("business_date", "trade_id", F.lit("SETTLED").alias("settlement_status"))
    prices = df.select("business_date", "instrument_id", F.lit("1.00").cast("decimal(18,2)").alias("close_price"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for got, key in (
            (lifecycle.next_day_settlements(df, told), "trade_id"),
            (lifecycle.end_of_day_holdings(df, prices), "instrument_id"),
        ):
            plan = got._jdf.queryExecution().executedPlan().toString()
            sorts = [line.split("Sort [")[1] for line in plan.splitlines() if "Sort [" in line]
            assert "SortMergeJoin" in plan and sorts and all(order.startswith(key) for order in sorts)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_executable_orders_and_active_accounts(spark):
    orders = spark.createDataFrame(
        [("1", "COMPLETED", "5.0"), ("2", "COMPLETED", "0"), ("3", "CANCELLED", "5"), ("4", "COMPLETED", "0.9")],
        "order_id string, order_status string, ordered_quantity string",
    )
    assert rows(lifecycle.executable_orders(orders)) == [("1", "COMPLETED", 5)]
    accounts = spark.createDataFrame([("1", "ACTIVE"), ("2", "DORMANT"), ("3", None)], "account_id string, account_status string")
    assert rows(lifecycle.active_accounts(accounts)) == [("1", "ACTIVE")]


# Quality.


def _failed(df, *rules) -> list[int]:
    return [r.rows_failed for r in quality.evaluate(df, {"d": rules}).collect()]


def test_rules_on_nulls_duplicates_and_malformed(spark):
    df = spark.createDataFrame(
        [("a", "LOW", "1"), ("a", "low", "0"), (None, None, "x"), (None, "HIGH", None), ("b", "HIGH", "NaN")],
        "k string, band string, n string",
    )
    got = _failed(
        df,
        quality.IsComplete("k"),
        quality.IsUnique("k"),
        quality.AllowedValues("band", ("LOW", "HIGH")),
        quality.AllowedValues("band", ("LOW", "HIGH"), null_ok=True),
        quality.Above("n", 0),
        quality.Above("n", 0, inclusive=True),
        quality.Above("n", 0, null_ok=True),
    )
    assert got == [2, 1, 2, 1, 4, 3, 3]


def test_small_fractions_are_above_zero(spark):
    assert _failed(spark.createDataFrame([("0.001",)], "n string"), quality.Above("n", 0)) == [0]


def test_numbers_are_compared_as_they_are(spark):
    df = spark.createDataFrame([(1, money("0.00")), (0, money("0.01"))], "n int, m decimal(18,2)")
    assert _failed(df, quality.Above("n", 0), quality.Above("m", 0)) == [1, 1]


def test_an_empty_dataset_passes(spark):
    df = spark.createDataFrame([], "k string")
    got = quality.evaluate(df, {"d": [quality.IsComplete("k"), quality.IsUnique("k")]}).collect()
    assert [(r.Outcome, r.rows_total) for r in got] == [("Passed", 0), ("Passed", 0)]


def test_result_row(spark):
    df = spark.createDataFrame([("a",), ("z",)], "s string")
    got = quality.evaluate(df, {"d": [quality.AllowedValues("s", ("a", "b"))]}).collect()
    assert tuple(got[0]) == ("d", 'ColumnValues "s" in ["a", "b"]', "s", "Failed", 2, 1)


def test_several_unique_columns_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), (None, 2, "x"), (None, 2, None)], "k string, n int, s string")
    rules = [quality.IsUnique("k"), quality.IsComplete("s"), quality.IsUnique("n"), quality.IsUnique("s"), quality.IsComplete("k")]
    assert _failed(df, *rules) == [1, 1, 2, 2, 2]
    assert _failed(df.where("false"), *rules) == [0] * 5
    assert [r.rows_total for r in quality.evaluate(df.where("false"), {"d": rules}).collect()] == [0] * 5
    assert _failed(df.select("k"), quality.IsUnique("k")) == [1]


def test_rows_counted_while_written_give_the_same_results(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("a", "-2"), (None, "x"), ("b", None)], "k string, n string").repartition(3)
    rules = {
        "raw": [quality.IsUnique("k"), quality.IsComplete("k"), quality.Above("n", 0)],
        "curated": [quality.Above("n", 0, inclusive=True), quality.IsUnique("k"), quality.IsUnique("n")],
    }
    for rows_, path in ((df, tmp_path / "some"), (df.where("false"), tmp_path / "none")):
        watched, counts = quality.watch_rows(rows_, rules)
        watched.write.parquet(str(path))
        written = spark.read.parquet(str(path))
        once, scanned = quality.evaluate(written, rules, counts()), quality.evaluate(written, rules)
        assert rows(once) == rows(scanned)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_two_rulesets_share_their_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "x")], "k string, unused string").write.parquet(path)
    both = quality.evaluate(
        spark.read.parquet(path),
        {"raw": [quality.IsUnique("k")], "curated": [quality.IsUnique("k"), quality.IsComplete("k")]},
    )
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1 and "unused" not in plan
    assert [r.dataset_name for r in both.collect()] == ["raw", "curated", "curated"]


def test_summary_and_status(spark):
    results = spark.createDataFrame(
        [("a", "Passed"), ("a", "Failed"), ("a", "Error"), ("b", "Passed"), ("c", None)], "dataset_name string, Outcome string"
    )
    summary = quality.summarize(results)
    assert rows(summary) == [("a", 2, "FAILED_RULES"), ("b", 0, "PASSED_RULES"), ("c", 0, "PASSED_RULES")]
    assert rows(quality.pipeline_status(summary)) == [("DQ_FINDINGS_PRESENT", 2)]
    assert rows(quality.pipeline_status(summary.where("dataset_name <> 'a'"))) == [("PASSED", 0)]
    assert [r[1:] for r in rows(quality.audit_rows(summary, D1))][0] == (dt.date(2026, 4, 19), "a", "FAILED_RULES", 2)
    with pytest.raises(RuntimeError, match="Outcome"):
        quality.summarize(results.drop("Outcome"))


def test_metrics_of_nothing(spark):
    text = "business_date string, brokerage_fee string"
    empty = spark.createDataFrame([], text)
    assert rows(quality.transaction_metrics(empty, empty, empty, D1)) == [(dt.date(2026, 4, 19), 0, 0, 0, 0.0)]
    assert rows(quality.transaction_metrics(empty, empty, empty)) == []
    trades = spark.createDataFrame([(D1, "1.005"), (D1, "2"), (D2, None)], text)
    got = rows(quality.transaction_metrics(empty, trades, trades))
    assert got == [(D1, 0, 2, 2, 3.01), (D2, 0, 1, 1, 0.0)]


def test_rulesets_have_their_rules():
    sizes = {name: len(rules) for name, rules in {**rulesets.RAW, **rulesets.CURATED}.items()}
    assert sum(sizes.values()) == 55
    texts = [str(rule) for rule in rulesets.RAW["accounts"]]
    assert 'ColumnValues "account_status" in ["ACTIVE", "DORMANT"]' in texts
    assert 'ColumnValues "brokerage_fee" >= 0' in [str(r) for r in rulesets.RAW["trades"]]
    assert 'ColumnValues "gross_trade_amount" > 0' in [str(r) for r in rulesets.CURATED["curated_trades"]]
