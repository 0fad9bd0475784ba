"""The daily run over files: three days, a rerun, a correction, failures."""

from __future__ import annotations

import csv
import datetime as dt
import json
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from brokerhouse.plans import analytics
from brokerhouse.operators import quality
from brokerhouse.plans.pipeline import (
    RESULT_COLUMNS,
    Places,
    backfill,
    check,
    curate,
    curated,
    load,
    load_facts,
    reload_facts,
    replay,
    row_counts,
    rules_of,
    run_day,
)
from brokerhouse.schemas import DIMENSIONS, FACTS, FEEDS, HISTORIES
from brokerhouse.sources.warehouse import open_warehouse

D1, D2, D3 = "2026-04-19", "2026-04-20", "2026-04-21"


def _write(path: Path, rows: list[dict], header: list[str]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as handle:
        writer = csv.DictWriter(handle, fieldnames=header)
        writer.writeheader()
        writer.writerows(rows)


def _customer(key: str, band: str = "LOW", city: str = "Pune", name: str | None = None) -> dict:
    state = {"Pune": "Maharashtra", "Mumbai": "Maharashtra", "Chennai": "Tamil Nadu"}[city]
    return {
        "customer_id": key, "customer_name": name or f"Name {key}", "email": f"{key}@example.com",
        "mobile_number": "98", "city_name": city, "state_name": state, "country_name": "India",
        "risk_band": band, "kyc_status": "VERIFIED",
    }


def _account(key: str, segment: str = "FNO", advisor: str = "ADV001") -> dict:
    return {
        "account_id": key, "customer_id": f"C{key}", "advisor_id": advisor, "account_segment": segment,
        "account_status": "ACTIVE", "opened_date": "2024-05-01",
    }


def _trade(day: str, number: int, side: str, quantity: str, price: str, instrument: str, account: str = "A1") -> dict:
    return {
        "trade_id": f"TRD{number:08d}", "business_date": day, "order_id": f"ORD{number}", "account_id": account,
        "customer_id": "C1", "instrument_id": instrument, "trade_side": side,
        "trade_timestamp": f"{day}T09:15:{number:02d}", "executed_quantity": quantity, "executed_price": price,
        "brokerage_fee": "5.00", "tax_amount": "0.10",
    }


def _order(day: str, key: str, quantity: str = "10") -> dict:
    return {
        "order_id": key, "business_date": day, "account_id": "A1", "customer_id": "C1", "instrument_id": "INS1",
        "order_timestamp": f"{day}T09:15:00", "order_side": "BUY", "order_type": "LIMIT",
        "ordered_quantity": quantity, "limit_price": "100.00", "order_status": "COMPLETED",
    }


def write_day(raw: Path, day: str, customers: list[dict], accounts: list[dict], trades: list[dict], **other) -> None:
    datasets = {
        "customers_snapshot": customers,
        "accounts_snapshot": accounts,
        "orders": [_order(day, "ORD1"), _order(day, "ORD2"), _order(day, "ORD1", "0")],
        "trades": trades,
        "fund_movements": [
            {"fund_movement_id": f"FND{i:08d}", "business_date": day, "account_id": "A1",
             "movement_type": "DEPOSIT", "amount": "5000.00", "currency_code": "INR"} for i in (1, 2)
        ],
        "settlements": [
            {"settlement_id": "SET00000001", "trade_id": "TRD00000001", "business_date": day,
             "settlement_date": day, "settlement_status": "SETTLED"}
        ],
        "market_prices": [{"business_date": day, "instrument_id": "INS1", "close_price": "101.00"}],
        "holdings_snapshot": [
            {"account_id": "A1", "instrument_id": i, "holding_quantity": "10", "average_cost": "100.00",
             "market_price": "101.00", "market_value": v} for i, v in (("INS1", "1010.00"), ("INS2", "40.00"))
        ],
        **other,
    }
    for name, rows in datasets.items():
        _write(raw / f"business_date={day}" / f"{name}.csv", rows, FEEDS[name].names)


def write_reference(root: Path, advisors: list[tuple[str, str, str]]) -> None:
    _write(
        root / "reference" / "advisors.csv",
        [dict(zip(("advisor_id", "advisor_name", "region"), row)) for row in advisors],
        ["advisor_id", "advisor_name", "region"],
    )
    header = ["instrument_id", "symbol", "instrument_name", "company_name", "sector_name", "exchange_code", "listing_country"]
    rows = [
        ("INS1", "STK1", "One", "Acme", "IT", "NSE", "India"),
        ("INS2", "STK2", "Two", "Acme", "AUTO", "BSE", "India"),
        ("INS3", "STK3", "Three", "Brio", "IT", "NSE", "India"),
    ]
    _write(root / "reference" / "instruments.csv", [dict(zip(header, r)) for r in rows], header)


def places(root: Path, **other) -> Places:
    return Places(str(root / "raw"), str(root / "out"), str(root / "warehouse"), **other)


ADVISORS = [("ADV001", "Asha", "WEST"), ("ADV002", "Ravi", "NORTH")]


@pytest.fixture(scope="module")
def three_days(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("three")
    raw = root / "raw"
    write_reference(root, ADVISORS)
    trades = lambda day: [
        _trade(day, 1, "BUY", "10", "100.00", "INS1"),
        _trade(day, 2, "SELL", "4", "10.00", "INS2"),
        _trade(day, 3, "BUY", "1", "0.01", "INS3"),
    ]
    write_day(raw, D1, [_customer("C1"), _customer("C2", city="Mumbai"), _customer("C3")],
              [_account("A1"), _account("A2")], trades(D1))
    write_day(raw, D2, [_customer("C1", "HIGH", "Chennai"), _customer("C2", city="Mumbai", name="Renamed"),
                        _customer("C4")], [_account("A1"), _account("A2")], trades(D2))
    write_day(raw, D3, [_customer("C1", "HIGH", "Chennai"), _customer("C2", "HIGH", city="Mumbai", name="Renamed"),
                        _customer("C4")], [_account("A1", "INTRADAY"), _account("A2")], trades(D3))
    where = places(root)
    for day in (D1, D2, D3):
        run_day(spark, where, day)
    return where, open_warehouse(spark, where.warehouse)


def test_every_table_has_its_schema(three_days):
    _, now = three_days
    for name, schema in {**DIMENSIONS, **{f: spec.schema for f, spec in FACTS.items()}}.items():
        assert now.table(name).dtypes == [(f.name, f.dataType.simpleString()) for f in schema.fields], name


def test_customer_history(three_days):
    _, now = three_days
    rows = now.table("dim_customer_scd2").orderBy("customer_id", "record_start_date").collect()
    got = [
        (r.customer_id, r.risk_band, r.customer_name, str(r.record_start_date), str(r.record_end_date), r.is_current)
        for r in rows
    ]
    assert got == [
        ("C1", "LOW", "Name C1", D1, D2, "N"),
        ("C1", "HIGH", "Name C1", D2, "9999-12-31", "Y"),
        ("C2", "LOW", "Name C2", D1, D3, "N"),  # the new name alone opened no version
        ("C2", "HIGH", "Renamed", D3, "9999-12-31", "Y"),
        ("C3", "LOW", "Name C3", D1, "9999-12-31", "Y"),  # vanished, stays current
        ("C4", "LOW", "Name C4", D2, "9999-12-31", "Y"),
    ]


def test_keys_are_dense(three_days):
    _, now = three_days
    for name, schema in DIMENSIONS.items():
        if name == "dim_date":
            continue
        key = schema.names[0]
        keys = sorted(r[key] for r in now.table(name).select(key).collect())
        assert keys == list(range(1, len(keys) + 1)), name


def test_geography_branch(three_days):
    _, now = three_days
    joined = (
        now.table("dim_city").join(now.table("dim_state"), "state_key").join(now.table("dim_country"), "country_key")
    )
    got = sorted((r.city_name, r.state_name, r.country_name) for r in joined.collect())
    assert got == [("Chennai", "Tamil Nadu", "India"), ("Mumbai", "Maharashtra", "India"), ("Pune", "Maharashtra", "India")]


def test_companies_are_per_sector(three_days):
    _, now = three_days
    joined = now.table("dim_company").join(now.table("dim_sector"), "sector_key")
    assert sorted((r.company_name, r.sector_name) for r in joined.collect()) == [
        ("Acme", "AUTO"),
        ("Acme", "IT"),
        ("Brio", "IT"),
    ]


def test_dates(three_days):
    _, now = three_days
    rows = now.table("dim_date").orderBy("date_key").collect()
    assert [tuple(r) for r in rows][0] == (20260419, dt.date(2026, 4, 19), 2026, 4, 19, "Sunday")
    assert len(rows) == 3


def test_bad_order_reaches_the_fact_and_the_report(three_days):
    where, now = three_days
    assert now.table("fact_orders").where("ordered_quantity = 0").count() == 3
    failed = now.spark.read.json(where.quality(D1, "results")).where("Outcome <> 'Passed'").collect()
    assert sorted((r.dataset_name, r.rule, r.rows_failed) for r in failed) == [
        ("curated_orders", 'ColumnValues "ordered_quantity" > 0', 1),
        ("curated_orders", 'IsUnique "order_id"', 1),
        ("orders", 'ColumnValues "ordered_quantity" > 0', 1),
        ("orders", 'IsUnique "order_id"', 1),
    ]
    status = now.spark.read.json(where.quality(D1, "pipeline_status")).first()
    assert (status.pipeline_status, status.total_failed_rule_outcomes) == ("DQ_FINDINGS_PRESENT", 2)


def test_results_hold_all_rules(three_days):
    where, now = three_days
    results = now.spark.read.json(where.quality(D1, "results"))
    counts = {r.dataset_name: r["count"] for r in results.groupBy("dataset_name").count().collect()}
    assert counts == {
        "customers": 7, "accounts": 7, "orders": 7, "trades": 7, "curated_customers": 6, "curated_accounts": 6,
        "curated_orders": 7, "curated_trades": 8,
    }


def test_metrics(three_days):
    where, now = three_days
    row = now.spark.read.json(where.quality(D1, "transaction_metrics")).first()
    assert (row.business_date, row.order_count, row.trade_count, row.fund_movement_count, row.brokerage_fee_total) == (
        D1, 3, 3, 2, 15.0,
    )


def test_audit_has_a_row_per_dataset_and_day(three_days):
    _, now = three_days
    rows = now.table("audit_dq_results").where(f"business_date = '{D2}'").collect()
    assert sorted((r.dataset_name, r.pipeline_status, r.finding_count) for r in rows) == [
        ("curated_accounts", "PASSED_RULES", 0),
        ("curated_customers", "PASSED_RULES", 0),
        ("curated_orders", "FAILED_RULES", 2),
        ("curated_trades", "PASSED_RULES", 0),
    ]


def test_rows_that_get_no_key_are_kept_counted_and_stay_in_the_totals(spark, tmp_path):
    raw = tmp_path / "raw"
    write_reference(tmp_path, [*ADVISORS, ("", "Nameless", "EAST")])
    with (tmp_path / "reference" / "instruments.csv").open("a") as handle:
        handle.write("INS4,STK4,Four,Brio,,NSE,India\nINS5,STK5,Five,,,,India\n")
    trades = [_trade(D1, k, "BUY", "10", "100.00", f"INS{k}") for k in range(1, 7)]  # INS6 is in no reference
    held = [{"account_id": "A1", "instrument_id": f"INS{k}", "holding_quantity": "10", "average_cost": "1.00",
             "market_price": "1.00", "market_value": "10.00"} for k in (1, 4)]
    write_day(raw, D1, [_customer("C1"), {**_customer("C2"), "city_name": ""}], [_account("A1")], trades, holdings_snapshot=held)
    now = run_day(spark, places(tmp_path), D1)
    rejects = now.table("load_rejects").collect()
    assert sorted((r.dataset_name, r.reason) for r in rejects) == [
        ("advisors", "null advisor_id"),
        ("customers_snapshot", "null city_name"),
        ("instruments", "null company_name, sector_name, exchange_code"),
        ("instruments", "null sector_name"),
    ]
    assert {json.loads(r.staged_row).get("instrument_id") for r in rejects} == {None, "INS4", "INS5"}
    audit = now.table("audit_dq_results").where("pipeline_status like 'REJECTED%'").collect()
    assert {(r.dataset_name, r.pipeline_status, r.finding_count) for r in audit} == {
        ("advisors", "REJECTED", 1), ("customers_snapshot", "REJECTED", 1), ("instruments", "REJECTED", 2),
    }
    assert len(audit) == 3 and now.table("dim_instrument").count() == 3
    branch = [now.table(t) for t in ("dim_instrument", "dim_company", "dim_sector")]
    top = analytics.top_instruments(now.table("fact_trades"), branch[0]).collect()
    assert [(r.symbol, r.instrument_name) for r in top] == [
        ("INS4", None), ("INS5", None), ("INS6", None), ("STK1", "One"), ("STK2", "Two"), ("STK3", "Three"),
    ]
    sectors = analytics.sector_volume(now.table("fact_trades"), *branch).collect()
    assert {r.sector_name: r.gross_volume for r in sectors} == {None: 3000, "IT": 2000, "AUTO": 1000}
    values = analytics.holdings_by_sector(now.table("fact_daily_holdings"), *branch).collect()
    assert {r.sector_name: r.total_market_value for r in values} == {None: 10, "IT": 10}


def test_analytics_over_the_warehouse(three_days):
    _, now = three_days
    volume = analytics.daily_trading_volume(now.table("fact_trades")).collect()
    assert [tuple(r) for r in volume][0] == (dt.date(2026, 4, 19), 3, 3, Decimal("1040.01"), Decimal("15.00"))
    assert len(volume) == 3
    top = analytics.top_instruments(now.table("fact_trades"), now.table("dim_instrument"), 2).collect()
    assert [tuple(r) for r in top] == [("STK1", "One", Decimal("3000.00")), ("STK2", "Two", Decimal("120.00"))]
    branch = [now.table(t) for t in ("dim_instrument", "dim_company", "dim_sector")]
    sectors = analytics.sector_volume(now.table("fact_trades"), *branch).collect()
    assert [tuple(r) for r in sectors] == [("IT", Decimal("3000.03")), ("AUTO", Decimal("120.00"))]
    held = analytics.holdings_by_sector(now.table("fact_daily_holdings"), *branch).collect()
    assert [tuple(r)[1:] for r in held][:2] == [("IT", Decimal("1010.00")), ("AUTO", Decimal("40.00"))]
    bands = analytics.customers_by_risk_band(now.table("dim_customer_scd2")).collect()
    assert [tuple(r) for r in bands] == [("HIGH", 2), ("LOW", 2)]
    history = analytics.account_history(now.table("dim_account_scd2")).collect()
    assert [(r.account_id, r.account_segment, r.is_current) for r in history] == [
        ("A1", "FNO", "N"),
        ("A1", "INTRADAY", "Y"),
    ]


def test_fact_days_can_be_chosen(three_days):
    _, now = three_days
    days = lambda **limits: sorted(str(r[0]) for r in now.fact("fact_trades", **limits).select("business_date").distinct().collect())
    assert days() == [D1, D2, D3]
    assert days(since=D2) == [D2, D3]
    assert days(since=D2, until=D2) == [D2]
    assert days(since="2027-01-01") == []


def test_facts_hold_what_was_curated(three_days):
    where, now = three_days
    total = F.sum("gross_trade_amount").alias("s")
    for day in (D1, D2, D3):
        curated_sum = now.spark.read.parquet(where.dataset(day, "trades")).agg(total).first().s
        assert now.fact("fact_trades", day, day).agg(total).first().s == curated_sum


def test_as_of_an_earlier_load(three_days):
    _, now = three_days
    first = now.as_of(1)
    assert first.table("dim_customer_scd2").where("is_current = 'Y'").count() == 3
    assert first.table("fact_trades").count() == 3


def _contents(snapshot) -> dict[str, list]:
    tables = [*DIMENSIONS, *FACTS]
    return {t: sorted(map(str, snapshot.table(t).collect())) for t in tables}


def test_same_day_rerun_changes_nothing(spark, tmp_path):
    write_reference(tmp_path, ADVISORS)
    write_day(tmp_path / "raw", D1, [_customer("C1"), _customer("C2")], [_account("A1")],
              [_trade(D1, 1, "BUY", "10", "100.00", "INS1")])
    where = places(tmp_path)
    once = _contents(run_day(spark, where, D1))
    twice = run_day(spark, where, D1)
    assert twice.last_load == 2
    assert _contents(twice) == once


def test_same_day_correction_and_emptied_slice(spark, tmp_path):
    write_reference(tmp_path, ADVISORS)
    raw = tmp_path / "raw"
    trade = _trade(D1, 1, "BUY", "10", "100.00", "INS1")
    write_day(raw, D1, [_customer("C1")], [_account("A1")], [trade])
    where = places(tmp_path, curated_format="csv")
    run_day(spark, where, D1)
    write_day(raw, D1, [_customer("C1", "HIGH")], [_account("A1")], [trade], settlements=[])
    now = run_day(spark, where, D1)
    rows = now.table("dim_customer_scd2").orderBy("customer_key").collect()
    assert [(r.customer_key, r.risk_band, str(r.record_start_date), str(r.record_end_date)) for r in rows] == [
        (1, "LOW", D1, D1),
        (2, "HIGH", D1, "9999-12-31"),
    ]
    assert now.table("fact_settlements").count() == 0
    assert now.table("fact_trades").count() == 1


def test_failed_load_leaves_the_warehouse_as_it_was(spark, tmp_path):
    write_reference(tmp_path, ADVISORS)
    raw = tmp_path / "raw"
    where = places(tmp_path)
    write_day(raw, D1, [_customer("C1")], [_account("A1")], [_trade(D1, 1, "BUY", "10", "100.00", "INS1")])
    before = _contents(run_day(spark, where, D1))
    write_day(raw, D2, [_customer("C1", "HIGH")], [_account("A1")], [_trade(D2, 1, "BUY", "ten", "1.00", "INS1")])
    curate(spark, where, D2)
    check(spark, where, D2)
    with pytest.raises(Exception, match="bad executed_quantity: ten"):
        load(spark, where, D2)
    assert _contents(open_warehouse(spark, where.warehouse)) == before
    failed = spark.read.json(where.quality(D2, "results")).where("dataset_name = 'curated_trades' AND Outcome <> 'Passed'")
    assert sorted(r.rule for r in failed.collect()) == [
        'ColumnValues "executed_quantity" > 0',
        'ColumnValues "gross_trade_amount" > 0',
        'ColumnValues "net_trade_amount" > 0',
    ]
    # Repaired and run again, the load takes the same number.
    write_day(raw, D2, [_customer("C1", "HIGH")], [_account("A1")], [_trade(D2, 1, "BUY", "10", "1.00", "INS1")])
    now = run_day(spark, where, D2)
    assert now.last_load == 2
    assert now.table("dim_customer_scd2").count() == 2
    assert now.table("fact_trades").count() == 2


def test_rows_of_another_day_and_older_dates_are_refused(spark, tmp_path):
    write_reference(tmp_path, ADVISORS)
    where = places(tmp_path)
    stray = _trade(D1, 1, "BUY", "10", "100.00", "INS1")
    write_day(tmp_path / "raw", D2, [_customer("C1")], [_account("A1")], [stray])
    with pytest.raises(Exception, match="row of another day"):
        run_day(spark, where, D2)
    write_day(tmp_path / "raw", D2, [_customer("C1")], [_account("A1")], [])
    run_day(spark, where, D2)
    with pytest.raises(ValueError, match="is before"):
        load(spark, where, D1)


def test_facts_of_an_earlier_day_are_reloaded_alone(spark, tmp_path):
    write_reference(tmp_path, ADVISORS)
    raw, where = tmp_path / "raw", places(tmp_path)
    trade = lambda day, price: [_trade(day, 1, "BUY", "10", price, "INS1")]
    for day, band in ((D1, "LOW"), (D2, "HIGH"), (D3, "LOW")):
        write_day(raw, day, [_customer("C1", band)], [_account("A1")], trade(day, "100.00"))
        run_day(spark, where, day)
    before = open_warehouse(spark, where.warehouse)
    old = _contents(before)
    write_day(raw, D1, [_customer("C1", "HIGH")], [_account("A1", "INTRADAY")], [*trade(D1, "90.00"), _trade(D1, 2, "BUY", "1", "5.00", "INS2")],
              settlements=[])
    curate(spark, where, D1)
    now = reload_facts(spark, where, D1, ["fact_trades", "fact_settlements"])
    assert now.last_load == 4 and open_warehouse(spark, where.warehouse).loads == now.loads
    new = _contents(now)
    touched = {"fact_trades", "fact_settlements"}
    assert {name for name in old if old[name] != new[name]} == touched
    for name in touched:  # later days are as they were
        assert sorted(map(str, now.fact(name, D2).collect())) == sorted(map(str, before.fact(name, D2).collect()))
    assert sorted((r.executed_price, r.executed_quantity) for r in now.fact("fact_trades", D1, D1).collect()) == [(5, 1), (90, 10)]
    assert now.fact("fact_settlements", D1, D1).count() == 0
    assert _contents(now.as_of(3)) == old
    # the daily run goes on, and is still refused for an earlier day
    after = run_day(spark, where, D3)
    assert after.last_load == 5 and after.fact("fact_trades", D1, D1).count() == 2
    assert {name: rows for name, rows in _contents(after).items() if name != "fact_trades"} == {
        name: rows for name, rows in new.items() if name != "fact_trades"
    }
    with pytest.raises(ValueError, match="2026-04-20 is before 2026-04-21"):
        load(spark, where, D2)


def _four_days(spark, root, second, days=(D1, D2, D3, "2026-04-22")):
    write_reference(root, ADVISORS)
    raw = root / "raw"
    trade = lambda day, price: [_trade(day, 1, "BUY", "10", price, "INS1")]
    write_day(raw, days[0], [_customer("C1"), _customer("C2")], [_account("A1")], trade(days[0], "1.00"))
    second(raw)
    write_day(raw, days[2], [_customer("C1", "HIGH"), _customer("C3", city="Mumbai")], [_account("A1"), _account("A3")], trade(days[2], "3.00"))
    write_day(raw, days[3], [_customer("C1"), _customer("C2", "HIGH")], [_account("A1", "INTRADAY")], trade(days[3], "4.00"))
    return days


def test_days_are_loaded_again_from_a_corrected_one_on(spark, tmp_path):
    wrong = lambda raw: write_day(raw, D2, [_customer("C1", "HIGH"), _customer("C9", city="Chennai")], [_account("A1", "FNO", "ADV002")], [])
    right = lambda raw: write_day(raw, D2, [_customer("C1", "MEDIUM"), _customer("C2")], [_account("A1")], [_trade(D2, 1, "BUY", "1", "2.00", "INS1")])
    ours, fresh = places(tmp_path / "ours"), places(tmp_path / "fresh")
    for day in _four_days(spark, tmp_path / "ours", wrong):
        run_day(spark, ours, day)
    corrected = _trade(D1, 1, "BUY", "10", "0.50", "INS1")  # facts loaded alone since then stay
    write_day(tmp_path / "ours" / "raw", D1, [_customer("C1"), _customer("C2")], [_account("A1")], [corrected])
    curate(spark, ours, D1)
    old = reload_facts(spark, ours, D1, ["fact_trades"])
    before = _contents(old)
    right(tmp_path / "ours" / "raw")
    curate(spark, ours, D2)
    check(spark, ours, D2)
    now = replay(spark, ours, D2)
    for day in _four_days(spark, tmp_path / "fresh", right):
        expected = run_day(spark, fresh, day)
    found, wanted = _contents(now), _contents(expected)
    assert found["fact_trades"] != wanted.pop("fact_trades") and len(found.pop("fact_trades")) == 4
    assert found == wanted and found != {n: rows for n, rows in before.items() if n != "fact_trades"}
    assert now.fact("fact_trades", D1, D1).first().executed_price == Decimal("0.50")
    again = open_warehouse(spark, ours.warehouse)
    assert again.loads == now.loads and again.last_load == 8 and again.whole_loads == [1, 6, 7, 8]
    assert _contents(again.as_of(5)) == before  # what was there before the correction
    assert run_day(spark, ours, "2026-04-22").whole_loads == [1, 6, 7, 8, 9]


def test_a_replay_that_fails_changes_nothing(spark, tmp_path):
    where = places(tmp_path)
    for day in _four_days(spark, tmp_path, lambda raw: write_day(raw, D2, [_customer("C1")], [_account("A1")], []))[:3]:
        run_day(spark, where, day)
    before = _contents(open_warehouse(spark, where.warehouse))
    write_day(tmp_path / "raw", D3, [_customer("C1")], [_account("A1")], [_trade(D3, 1, "BUY", "ten", "1.00", "INS1")])
    curate(spark, where, D3)
    with pytest.raises(Exception, match="bad executed_quantity: ten"):
        replay(spark, where, D2)
    now = open_warehouse(spark, where.warehouse)
    assert _contents(now) == before and now.last_load == 3


def test_histories_may_take_one_row_of_a_repeated_key(spark, tmp_path):
    write_reference(tmp_path, ADVISORS)
    write_day(tmp_path / "raw", D1, [_customer("C1", "HIGH"), _customer("C1", "LOW"), _customer("C2")], [_account("A1")], [])
    curate(spark, places(tmp_path), D1)
    check(spark, places(tmp_path), D1)
    now = load(spark, places(tmp_path, unique_keys=True), D1)
    assert sorted((r.customer_id, r.risk_band) for r in now.table("dim_customer_scd2").collect()) == [("C1", "HIGH"), ("C2", "LOW")]


def _fact_row(name: str, day: str, k: int) -> dict:
    values = {"string": f"v{k}", "date": day, "timestamp_ntz": f"{day} 10:00:00", "int": str(k), "decimal(18,2)": f"{k}.50"}
    row = {f.name: values[f.dataType.simpleString()] for f in FACTS[name].schema.fields}
    return {**row, "business_date": day}


def _text_rows(spark, name: str, dicts: list[dict]):
    columns = FACTS[name].schema.names
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in dicts], ", ".join(f"{c} string" for c in columns))


@pytest.mark.parametrize("name", list(FACTS))
def test_a_null_in_any_column_of_a_fact_fails_the_load(spark, tmp_path, name):
    root, columns = str(tmp_path / "warehouse"), [c for c in FACTS[name].schema.names if c != "business_date"]
    fine = [_fact_row(name, D1, k) for k in range(3)]
    load_facts(spark, root, D1, {name: _text_rows(spark, name, fine)})
    broken = [{**_fact_row(name, D1, k), c: None} for k, c in enumerate(columns)] + [{**fine[0], columns[0]: None}]
    listed = ", ".join(f"{c} ({1 + (c == columns[0])})" for c in sorted(columns))
    for write in (lambda df: load_facts(spark, root, D1, {name: df}), lambda df: backfill(spark, root, {name: df})):
        with pytest.raises(ValueError) as failed:
            write(_text_rows(spark, name, [*fine, *broken]))
        assert str(failed.value) == f"{name}: nulls in columns that must have values: {listed}"
    with pytest.raises(Exception, match="row of another day in 2026-04-19: no date"):
        load_facts(spark, root, D1, {name: _text_rows(spark, name, [{**fine[0], "business_date": None}])})
    now = open_warehouse(spark, root)
    assert now.last_load == 1 and now.table(name).count() == 3
    assert now.table(name).dtypes == [(f.name, f.dataType.simpleString()) for f in FACTS[name].schema.fields]


def test_years_of_days_are_filled_in_at_once(spark, tmp_path):
    root, name = str(tmp_path / "warehouse"), "fact_orders"
    first = dt.date(2024, 1, 1)
    days = [str(first + dt.timedelta(k)) for k in range(500)]
    rows = [_fact_row(name, day, k) for k, day in enumerate(days)] + [_fact_row(name, days[3], k) for k in range(3000)]
    load_facts(spark, root, days[7], {name: _text_rows(spark, name, [_fact_row(name, days[7], k) for k in range(50)])})
    load_facts(spark, root, D1, {name: _text_rows(spark, name, [_fact_row(name, D1, 1)])})
    now = backfill(spark, root, {name: _text_rows(spark, name, rows).repartition(6)})
    assert now.last_load == 3 and len(now.loads) == 502
    counts = {str(r[0]): r[1] for r in now.table(name).groupBy("business_date").count().collect()}
    assert counts == {**dict.fromkeys(days, 1), days[3]: 3001, D1: 1}
    files = [len(list((tmp_path / "warehouse" / name / f"business_date={d}" / "load_id=3").glob("*.parquet"))) for d in days]
    assert min(files) == 1 and sum(files) <= 520  # not a file per task and day
    assert now.as_of(2).table(name).count() == 51
    again = backfill(spark, root, {name: _text_rows(spark, name, rows[:10]).where("order_id <> 'v3'")})
    assert again.last_load == 4 and again.table(name).count() == 499 + 3001 + 1
    nothing = backfill(spark, root, {name: _text_rows(spark, name, rows[:1]).where("false")})
    assert nothing.last_load == 4 and open_warehouse(spark, root).loads == again.loads


def test_ids_and_amounts_are_written_without_a_dictionary(spark, tmp_path):
    root, plain = tmp_path / "warehouse", {"trade_id", "order_id", "account_id", "trade_timestamp", "executed_price", "net_trade_amount"}
    rows = lambda day: _text_rows(spark, "fact_trades", [_fact_row("fact_trades", day, k % 4) for k in range(400)]).coalesce(1)
    backfill(spark, str(root), {"fact_trades": rows(D1)})
    load_facts(spark, str(root), D2, {"fact_trades": rows(D2)})
    files = list((root / "fact_trades").glob("*/*/*.parquet"))
    assert len(files) == 2
    for file in files:
        group = pq.ParquetFile(file).metadata.row_group(0)
        columns = [group.column(i) for i in range(group.num_columns)]
        encoded = {c.path_in_schema for c in columns if any("DICTIONARY" in e for e in c.encodings)}
        assert not encoded & plain and "trade_side" in encoded


def test_missing_column_stops_before_anything_is_written(spark, tmp_path):
    write_reference(tmp_path, ADVISORS)
    raw = tmp_path / "raw"
    write_day(raw, D1, [_customer("C1")], [_account("A1")], [])
    _write(raw / f"business_date={D1}" / "orders.csv", [{"order_id": "1"}], ["order_id"])
    where = places(tmp_path)
    with pytest.raises(RuntimeError, match="orders.*limit_price"):
        run_day(spark, where, D1)
    assert not (tmp_path / "out").exists()


def test_row_rules_are_counted_as_the_files_are_written(three_days, spark):
    where, _ = three_days
    counted = row_counts(spark, where, D1)
    assert set(counted) == {"customers_snapshot", "accounts_snapshot", "orders", "trades"}
    assert counted["orders"]["None"] == 3 and sum(counted["orders"].values()) == 4  # a quantity of 0
    for name in counted:
        scanned = quality.evaluate(curated(spark, where, D1, name), rules_of(name)).collect()
        written = spark.read.schema(RESULT_COLUMNS).json(where.quality(D1, "results"))
        own = written.where(F.col("dataset_name").isin(*rules_of(name))).select(*scanned[0].__fields__).collect()
        assert sorted(map(tuple, scanned)) == sorted(map(tuple, own))


def test_a_second_check_leaves_only_its_own_output(spark, tmp_path):
    write_reference(tmp_path, ADVISORS)
    where = places(tmp_path)
    write_day(tmp_path / "raw", D1, [_customer("C1"), _customer("C1")], [_account("A1")], [])
    curate(spark, where, D1)
    check(spark, where, D1)
    first = sorted(map(tuple, spark.read.schema(RESULT_COLUMNS).json(where.quality(D1, "results")).collect()))
    write_day(tmp_path / "raw", D1, [_customer("C1"), _customer("C2", "ODD")], [_account("A1")], [])
    curate(spark, where, D1)
    check(spark, where, D1)
    second = spark.read.schema(RESULT_COLUMNS).json(where.quality(D1, "results")).collect()
    failed = {(r.dataset_name, r.rule) for r in second if r.Outcome == "Failed" and "customers" in r.dataset_name}
    assert len(second) == len(first) == 55
    assert failed == {(n, 'ColumnValues "risk_band" in ["LOW", "MEDIUM", "HIGH"]') for n in ("customers", "curated_customers")}
    assert spark.read.json(where.quality(D1, "pipeline_status")).count() == 1


def test_status_file_is_json(three_days):
    where, _ = three_days
    files = list(Path(where.quality(D1, "summary")).glob("*.json"))
    rows = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    assert {"dataset_name", "failed_rule_outcomes", "dataset_status"} == set(rows[0])


def test_one_current_row_per_key_and_no_overlap(three_days):
    _, now = three_days
    for spec in HISTORIES:
        rows = now.table(spec.table)
        assert rows.where("is_current = 'Y'").groupBy(spec.key).count().where("count > 1").count() == 0
        spans = {}
        for r in rows.collect():
            spans.setdefault(r[spec.key], []).append((r.record_start_date, r.record_end_date))
        for versions in spans.values():
            versions.sort()
            assert all(a[1] <= b[0] for a, b in zip(versions, versions[1:]))
