"""Declarative data quality: rules in, one result row per rule out. Findings never filter rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from brokerhouse.functions.money import TOTAL, number

PASSED = "Passed"
FAILED = "Failed"


@dataclass(frozen=True)
class IsComplete:
    """No nulls."""

    column: str

    def __str__(self) -> str:
        return f'IsComplete "{self.column}"'

    def fails(self, df: DataFrame) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class IsUnique:
    """No value twice; nulls are not compared. Failing rows are those beyond the first of each value."""

    column: str

    def __str__(self) -> str:
        return f'IsUnique "{self.column}"'


@dataclass(frozen=True)
class AllowedValues:
    """Only these values; null fails unless `null_ok`."""

    column: str
    values: tuple[str, ...]
    null_ok: bool = False

    def __str__(self) -> str:
        listed = ", ".join(f'"{v}"' for v in self.values)
        return f'ColumnValues "{self.column}" in [{listed}]'

    def fails(self, df: DataFrame) -> Column:
        return _not_true(F.col(self.column).isin(*self.values), self, F.col(self.column))


@dataclass(frozen=True)
class Above:
    """Numbers above `bound`, or also equal to it when `inclusive`; malformed text and null fail."""

    column: str
    bound: int
    inclusive: bool = False
    null_ok: bool = False

    def __str__(self) -> str:
        return f'ColumnValues "{self.column}" {">=" if self.inclusive else ">"} {self.bound}'

    def fails(self, df: DataFrame) -> Column:
        value = number(df, self.column, "decimal(38,10)")
        return _not_true(value >= self.bound if self.inclusive else value > self.bound, self, F.col(self.column))


Rule = IsComplete | IsUnique | AllowedValues | Above


def _not_true(test: Column, rule: AllowedValues | Above, value: Column) -> Column:
    holds = F.coalesce(test, F.lit(False))
    return ~(holds | value.isNull()) if rule.null_ok else ~holds


Rulesets = Mapping[str, Sequence[Rule]]
#: How many rows there are, and how many fail each rule.
Counts = Mapping[Rule | None, int]


def _distinct(rulesets: Rulesets) -> tuple[list[Rule], list[IsUnique]]:
    """Rules on single rows, and rules that compare rows; those shared by several rulesets once."""
    rules = list(dict.fromkeys(rule for own in rulesets.values() for rule in own))
    return [r for r in rules if not isinstance(r, IsUnique)], [r for r in rules if isinstance(r, IsUnique)]


def row_rules(rulesets: Rulesets) -> list[Rule]:
    """The rules that `watch_rows` counts."""
    return _distinct(rulesets)[0]


def watch_rows(df: DataFrame, rulesets: Rulesets) -> tuple[DataFrame, Callable[[], Counts]]:
    """The rows, and a function that tells the counts of all row rules once the rows have been written.

    The rows are counted as they pass, so the rules cost no scan of their own; uniqueness needs one afterwards.
    """
    seen = Observation()
    slots = {rule: f"_failed_{i}" for i, rule in enumerate(row_rules(rulesets))}
    counted = [F.count_if(rule.fails(df)).alias(slot) for rule, slot in slots.items()]

    def counts() -> Counts:
        found = seen.get
        return {None: found.get("_total", 0), **{rule: found.get(slot, 0) for rule, slot in slots.items()}}

    return df.observe(seen, F.count(F.lit(1)).alias("_total"), *counted), counts


def evaluate(df: DataFrame, rulesets: Rulesets, counted: Counts | None = None) -> DataFrame:
    """Check one dataset against named rulesets, in one scan. Rules shared by them are counted once.

    The grouping sets are the whole (for row rules and the number of rows) and each column that must be unique, so each
    row goes once into the whole, which is combined to one row per task, and once into the distinct values
    of each such column, repeats combined before the shuffle. With `counted`, from `watch_rows` over the same
    rows, only the columns that must be unique are read.
    """
    single, unique = _distinct(rulesets)
    rules = [*single, *unique]
    slot = {rule: f"_failed_{i}" for i, rule in enumerate(rules)}
    columns = list(dict.fromkeys(rule.column for rule in unique))
    fresh = [] if counted else single
    light = df.select(
        *[F.col(c).alias(f"_value_{k}") for k, c in enumerate(columns)], *[rule.fails(df).alias(slot[rule]) for rule in fresh]
    )
    values = [f"_value_{k}" for k in range(len(columns))]
    failed = [F.count_if(F.col(slot[rule])).alias(slot[rule]) for rule in fresh]
    if counted and not columns:
        counts = df.sparkSession.range(1)
    elif not columns:
        counts = light.agg(F.count(F.lit(1)).alias("_total"), *failed)
    else:
        sets = [[v] for v in values] + ([] if counted else [[]])
        parts = light.groupingSets(sets, *values).agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"), *failed)
        # a column's bit is set where it is not grouped by; the first column has the highest bit
        whole = (1 << len(columns)) - 1
        none, is_whole = F.lit(0).cast("bigint"), F.col("_set") == whole
        total = lambda of: F.coalesce(F.sum(F.when(is_whole, of)), none)
        surplus = {
            c: F.coalesce(
                F.sum(F.when((F.col("_set") == whole - (1 << (len(columns) - 1 - k))) & F.col(v).isNotNull(), F.col("_n") - 1)), none
            )
            for k, (c, v) in enumerate(zip(columns, values, strict=True))
        }
        counts = parts.agg(
            total(F.col("_n")).alias("_total"),
            *[total(F.col(slot[rule])).alias(slot[rule]) for rule in fresh],
            *[surplus[rule.column].alias(slot[rule]) for rule in unique],
        )
    if counted:
        known = {"_total": counted[None], **{slot[rule]: counted[rule] for rule in single}}
        counts = counts.withColumns({name: F.lit(n).cast("bigint") for name, n in known.items()})
    results = [
        F.struct(
            F.lit(dataset).alias("dataset_name"),
            F.lit(str(rule)).alias("rule"),
            F.lit(rule.column).alias("column_name"),
            F.when(F.col(slot[rule]) == 0, PASSED).otherwise(FAILED).alias("Outcome"),
            F.col("_total").alias("rows_total"),
            F.col(slot[rule]).alias("rows_failed"),
        )
        for dataset, own in rulesets.items()
        for rule in own
    ]
    return counts.select(F.inline(F.array(*results)))


def summarize(results: DataFrame) -> DataFrame:
    """Per dataset: number of rules with an outcome other than passed, and a status."""
    if "Outcome" not in results.columns:
        raise RuntimeError(f"quality results lack column 'Outcome'; they have {results.columns}")
    return (
        results.groupBy("dataset_name")
        .agg(F.count_if(F.col("Outcome") != PASSED).alias("failed_rule_outcomes"))
        .withColumn(
            "dataset_status",
            F.when(F.col("failed_rule_outcomes") > 0, "FAILED_RULES").otherwise("PASSED_RULES"),
        )
    )


def pipeline_status(summary: DataFrame) -> DataFrame:
    """One row over all datasets."""
    findings = F.coalesce(F.sum("failed_rule_outcomes"), F.lit(0))
    return summary.agg(findings.alias("total_failed_rule_outcomes")).select(
        F.when(F.col("total_failed_rule_outcomes") > 0, "DQ_FINDINGS_PRESENT").otherwise("PASSED").alias("pipeline_status"),
        "total_failed_rule_outcomes",
    )


def audit_rows(summary: DataFrame, business_date: str) -> DataFrame:
    """Rows for the audit table."""
    return summary.select(
        F.current_timestamp().cast("timestamp_ntz").alias("audit_run_ts"),
        F.lit(business_date).cast("date").alias("business_date"),
        "dataset_name",
        F.col("dataset_status").alias("pipeline_status"),
        F.col("failed_rule_outcomes").cast("int").alias("finding_count"),
    )


def reject_rows(rejects: DataFrame, business_date: str) -> DataFrame:
    """Audit rows of the rows that a load has rejected, one for each feed; the reasons stay with the rows."""
    counts = rejects.groupBy("dataset_name").agg(F.count(F.lit(1)).alias("failed_rule_outcomes"))
    return audit_rows(counts.withColumn("dataset_status", F.lit("REJECTED")), business_date)


def transaction_metrics(
    orders: DataFrame, trades: DataFrame, fund_movements: DataFrame, business_date: str | None = None
) -> DataFrame:
    """Row counts and the fee total: per business date found, or of all rows for a given date.

    Each table is reduced to one row per date before they meet. A given date gets its
    row even when all three tables are empty.
    """
    fee = number(trades, "brokerage_fee", "decimal(22,6)")
    count, none = F.count(F.lit(1)), F.lit(0).cast("bigint")
    fees, no_fees = F.coalesce(F.sum(fee).cast(TOTAL), F.lit(0).cast(TOTAL)), F.lit(0).cast(TOTAL)
    names = ("order_count", "trade_count", "fund_movement_count", "fees")

    def reduced(df: DataFrame, **measures: Column) -> DataFrame:
        aggregates = [measure.alias(name) for name, measure in measures.items()]
        if business_date is None:
            part = df.groupBy("business_date").agg(*aggregates)
        else:
            part = df.agg(*aggregates).withColumn("business_date", F.lit(business_date).cast("date"))
        rest = [(no_fees if n == "fees" else none).alias(n) for n in names if n not in measures]
        return part.select("business_date", *measures, *rest)

    parts = (
        reduced(orders, order_count=count)
        .unionByName(reduced(trades, trade_count=count, fees=fees))
        .unionByName(reduced(fund_movements, fund_movement_count=count))
    )
    return parts.groupBy("business_date").agg(
        *[F.sum(n).alias(n) for n in names if n != "fees"],
        F.sum("fees").cast("double").alias("brokerage_fee_total"),
    )
