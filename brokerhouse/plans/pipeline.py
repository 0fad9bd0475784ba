"""The daily run: curate the raw feeds, check their quality, load the warehouse."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brokerhouse.operators import dimensions as dims
from brokerhouse.operators import quality
from brokerhouse.operators.constraints import require_no_nulls, watch_nulls
from brokerhouse.operators.facts import day_slice
from brokerhouse.operators.lifecycle import add_business_date, add_trade_measures
from brokerhouse.operators.scd2 import carry_over, fresh_rows, one_row_per_key, open_versions
from brokerhouse.plans import rulesets
from brokerhouse.schemas import (
    ACCOUNT,
    ADVISOR,
    AUDIT,
    CUSTOMER,
    DIMENSIONS,
    FACTS,
    FEEDS,
    MASTER_FEEDS,
    REFERENCES,
    REJECTS,
    TRANSACTION_FEEDS,
    Fact,
    History,
)
from brokerhouse.sources.curated import write_by_day, write_csv, write_json, write_parquet
from brokerhouse.sources.feeds import day_path, read_text_csv, reference_root, typed
from brokerhouse.sources.warehouse import Snapshot, open_warehouse
from brokerhouse.sources.work import materialize

# Which curated dataset each pair of rulesets (raw, curated) checks.
CHECKED = {
    "customers_snapshot": ("customers", "curated_customers"),
    "accounts_snapshot": ("accounts", "curated_accounts"),
    "orders": ("orders", "curated_orders"),
    "trades": ("trades", "curated_trades"),
}
_COUNT_COLUMNS = "dataset string, rule string, n bigint"
RESULT_COLUMNS = "dataset_name string, rule string, column_name string, Outcome string, rows_total bigint, rows_failed bigint"


@dataclass(frozen=True)
class Places:
    """Where a run reads and writes; all folders every executor can reach."""

    raw: str
    curated: str
    warehouse: str
    curated_format: str = "parquet"
    #: Whether histories take one row of each key from a snapshot that repeats keys, the least one, or all of them.
    unique_keys: bool = False

    @property
    def reference(self) -> str:
        return reference_root(self.raw)

    def dataset(self, business_date: str, name: str) -> str:
        area = "master" if name in MASTER_FEEDS else "transactions"
        return day_path(f"{self.curated.rstrip('/')}/curated", business_date, area, name)

    def quality(self, business_date: str, name: str) -> str:
        return day_path(f"{self.curated.rstrip('/')}/curated", business_date, "dq", name)


def together(*jobs: Callable[[], None]) -> None:
    """Run independent writes side by side, so small ones do not wait for each other; the first error is raised."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


# Curate.


def raw_feed(spark: SparkSession, places: Places, business_date: str, name: str) -> DataFrame:
    return read_text_csv(spark, day_path(places.raw, business_date, f"{name}.csv"), FEEDS[name], name)


def curated_rows(raw: DataFrame, name: str, business_date: str) -> DataFrame:
    """Rows pass through whole; trades get their measures, holdings their date."""
    if name == "trades":
        return add_trade_measures(raw)
    if name == "holdings_snapshot":
        return add_business_date(raw, business_date)
    return raw


def curate(spark: SparkSession, places: Places, business_date: str) -> None:
    """Read each raw feed once and write it curated. All headers are checked before anything is written."""
    raw = {name: raw_feed(spark, places, business_date, name) for name in (*MASTER_FEEDS, *TRANSACTION_FEEDS)}
    write_curated(spark, places, business_date, {name: curated_rows(df, name, business_date) for name, df in raw.items()})


def rules_of(name: str) -> dict[str, tuple[quality.Rule, ...]]:
    """Both rulesets of a dataset: curated rows are the raw rows."""
    raw, checked = CHECKED[name]
    return {raw: rulesets.RAW[raw], checked: rulesets.CURATED[checked]}


def write_curated(spark: SparkSession, places: Places, business_date: str, rows: Mapping[str, DataFrame]) -> None:
    """Write curated datasets, and beside them how many of their rows fail each row rule, counted as they are written."""
    write = write_csv if places.curated_format == "csv" else write_parquet
    watched = {name: quality.watch_rows(df, rules_of(name)) for name, df in rows.items() if name in CHECKED}
    together(
        *[partial(write, watched[n][0] if n in watched else df, places.dataset(business_date, n)) for n, df in rows.items()]
    )
    counted = [(name, repr(rule), n) for name, (_, counts) in watched.items() for rule, n in counts().items()]
    if counted:
        write_json(spark.createDataFrame(counted, _COUNT_COLUMNS), places.quality(business_date, "row_counts"))


def row_counts(spark: SparkSession, places: Places, business_date: str) -> dict[str, dict[str, int]]:
    """What `write_curated` has counted, by dataset and rule; empty where nothing is there."""
    try:
        found = spark.read.schema(_COUNT_COLUMNS).json(places.quality(business_date, "row_counts")).collect()  # a row a rule
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    out: dict[str, dict[str, int]] = {}
    for row in found:
        out.setdefault(row["dataset"], {})[row["rule"]] = row["n"]
    return out


def curated(spark: SparkSession, places: Places, business_date: str, name: str) -> DataFrame:
    path = places.dataset(business_date, name)
    if places.curated_format == "csv":
        return spark.read.option("header", True).csv(path)
    return spark.read.parquet(path)


# Check.


def check(spark: SparkSession, places: Places, business_date: str) -> None:
    """Write rule results, their summary, the run's status and its metrics. Findings never stop the run.

    Curated rows are the raw rows, so both rulesets of a dataset go by the curated files. Their row rules were counted when
    the files were written, so only the columns that must be unique are read again; where no counts lie
    beside the files, one pass over the columns the rules name makes all of them.
    """
    known = row_counts(spark, places, business_date)

    def results(name: str) -> DataFrame:
        rules, counted = rules_of(name), known.get(name, {})
        by_rule = {rule: counted.get(repr(rule)) for rule in (None, *quality.row_rules(rules))}
        whole = None if None in by_rule.values() else by_rule
        return quality.evaluate(curated(spark, places, business_date, name), rules, whole)

    def write_results() -> None:
        union = reduce(DataFrame.unionByName, [results(name) for name in CHECKED])
        path = places.quality(business_date, "results")
        write_json(union, path, by=("dataset_name",))
        written = spark.read.schema(RESULT_COLUMNS).json(path)
        summary = quality.summarize(written.where(F.col("dataset_name").isin(*rulesets.CURATED)))
        write_json(summary, places.quality(business_date, "summary"))
        status = quality.pipeline_status(summary).withColumn("business_date", F.lit(business_date))
        write_json(status, places.quality(business_date, "pipeline_status"))

    def write_metrics() -> None:
        feeds = [curated(spark, places, business_date, n) for n in ("orders", "trades", "fund_movements")]
        metrics = quality.transaction_metrics(*feeds, business_date=business_date)
        write_json(metrics, places.quality(business_date, "transaction_metrics"))

    together(write_results, write_metrics)


# Load.


def publish(rows: DataFrame, path: str, schema: T.StructType, table: str) -> None:
    """Write rows of a load; nulls where the table has none fail it, by column and count, before it is visible."""
    watched, nulls = watch_nulls(rows, schema)
    write_parquet(watched, path)
    require_no_nulls(nulls, schema, table)


def write_slice(after: Snapshot, spec: Fact, rows: DataFrame, business_date: str) -> None:
    """The slice of one day, from rows as they were curated."""
    typed_rows = day_slice(rows, spec.schema, business_date).sortWithinPartitions(*spec.sort_key)
    path = after.path(spec.table, f"business_date={business_date}", f"load_id={after.last_load}")
    watched, nulls = watch_nulls(typed_rows, spec.schema)
    write_parquet(watched.drop("business_date"), path)
    require_no_nulls(nulls, spec.schema, spec.table)


def load_facts(spark: SparkSession, warehouse: str, business_date: str, rows: Mapping[str, DataFrame]) -> Snapshot:
    """Replace a day's slice of some facts, whichever days were loaded since.

    Other days, other facts, dimensions and histories stay as they are.
    """
    after = open_warehouse(spark, warehouse).next_facts({business_date: tuple(rows)})
    together(*[partial(write_slice, after, FACTS[name], df, business_date) for name, df in rows.items()])
    return after.finish()


def reload_facts(spark: SparkSession, places: Places, business_date: str, names: Sequence[str] = tuple(FACTS)) -> Snapshot:
    """Take corrected curated files of an earlier (or the same) day into some facts."""
    rows = {name: curated(spark, places, business_date, FACTS[name].feed) for name in names}
    return load_facts(spark, places.warehouse, business_date, rows)


def backfill(spark: SparkSession, warehouse: str, rows: Mapping[str, DataFrame]) -> Snapshot:
    """Fill many days of facts in at once, one write a fact; of every day found, the fact's whole slice is replaced."""
    before = open_warehouse(spark, warehouse)
    load_id, days = before.last_load + 1, {}

    def fill(spec: Fact, df: DataFrame) -> None:
        # as many as there will be folders; collected as numbers, so that rows need no text of their date
        found = F.transform(F.collect_set(F.unix_date("business_date")), lambda n: F.date_from_unix_date(n).cast("string"))
        watched, nulls = watch_nulls(typed(df, spec.schema, empty_ok=True), spec.schema, _days=found)
        dated = watched.withColumn("load_id", F.lit(load_id))
        write_by_day(dated, before.path(spec.table), below=("load_id",), order=spec.sort_key)
        require_no_nulls(nulls, spec.schema, spec.table)
        days[spec.table] = set(nulls.get.get("_days") or ())

    together(*[partial(fill, FACTS[name], df) for name, df in rows.items()])
    covered = {day: tuple(sorted(n for n in days if day in days[n])) for day in set().union(*days.values())}
    return before.next_facts(covered).finish() if covered else before


def load(spark: SparkSession, places: Places, business_date: str) -> Snapshot:
    """Load one day: dimensions parents first, histories and facts beside them, the log row last."""
    return load_day(spark, places, business_date, open_warehouse(spark, places.warehouse)).finish()


def replay(spark: SparkSession, places: Places, business_date: str) -> Snapshot:
    """Load a date that has been corrected and every later one again, from what was there before it.

    Histories, dimensions and facts are then as if the days had been loaded with these curated files at first. Readers
    see the old loads until all days are done, and then all new ones; a replay that fails changes nothing.
    """
    now = open_warehouse(spark, places.warehouse)
    days = sorted({x.business_date for x in now.loads if not x.facts and x.business_date >= business_date} | {business_date})
    snapshot = now.before(business_date)
    for day in days:
        snapshot = load_day(spark, places, day, snapshot)
    return snapshot.finish()


def load_day(spark: SparkSession, places: Places, business_date: str, before: Snapshot) -> Snapshot:
    """Write the tables of one day after `before`; nothing of it is visible until the snapshot is finished."""
    after = before.next(business_date)
    load_id = f"load_id={after.last_load}"

    def staged(name: str) -> DataFrame:
        return typed(curated(spark, places, business_date, name), FEEDS[name])

    def reference(name: str) -> DataFrame:
        path = f"{places.reference}/{name}.csv"
        return typed(read_text_csv(spark, path, REFERENCES[name], name), REFERENCES[name])

    stages_of = {name: staged if name in FEEDS else reference for name in dims.REQUIRED}

    def add(table: str, rows: DataFrame) -> DataFrame:
        publish(rows, after.path(table, load_id), DIMENSIONS.get(table, AUDIT), table)
        return after.table(table)

    def dates() -> None:
        day = spark.range(1).select(F.lit(business_date).cast("date").alias("business_date"))
        add("dim_date", dims.new_dates(before.table("dim_date"), day))

    def geography() -> None:
        rows = dims.distinct_places(staged("customers_snapshot"))
        countries = add("dim_country", dims.new_countries(before.table("dim_country"), rows))
        states = add("dim_state", dims.new_states(before.table("dim_state"), rows, countries))
        add("dim_city", dims.new_cities(before.table("dim_city"), rows, countries, states))

    def instruments() -> None:
        rows = materialize(reference("instruments"))  # four loads read it: the text is parsed once
        sectors = add("dim_sector", dims.new_sectors(before.table("dim_sector"), rows))
        companies = add("dim_company", dims.new_companies(before.table("dim_company"), rows, sectors))
        exchanges = add("dim_exchange", dims.new_exchanges(before.table("dim_exchange"), rows))
        add("dim_instrument", dims.new_instruments(before.table("dim_instrument"), rows, sectors, companies, exchanges))

    def history(spec: History, stage: DataFrame) -> None:
        if places.unique_keys:
            stage = one_row_per_key(stage.select(*spec.staged), spec.key)
        carried = carry_over(before.current(spec.table), stage, spec, business_date)
        path = after.path(spec.table, "carried", load_id)
        carried.write.mode("overwrite").partitionBy("is_current").parquet(path)
        fresh = fresh_rows(stage, after.kept(spec.table), spec)
        opened = open_versions(fresh, spec, business_date, before.latest_opened(spec.table))
        publish(opened, after.path(spec.table, "opened", load_id), DIMENSIONS[spec.table], spec.table)

    def fact(spec: Fact) -> None:
        write_slice(after, spec, curated(spark, places, business_date, spec.feed), business_date)

    def audit() -> None:
        summary = spark.read.schema("dataset_name string, failed_rule_outcomes bigint, dataset_status string").json(
            places.quality(business_date, "summary")
        )
        stages = [dims.rejected(stage(name), name, business_date) for name, stage in stages_of.items()]
        write_parquet(reduce(DataFrame.unionByName, stages), after.path("load_rejects", load_id))
        written = spark.read.schema(REJECTS).parquet(after.path("load_rejects", load_id))
        rows = quality.audit_rows(summary, business_date)
        add("audit_dq_results", rows.unionByName(quality.reject_rows(written, business_date)))

    together(
        partial(history, CUSTOMER, staged("customers_snapshot")),
        partial(history, ACCOUNT, staged("accounts_snapshot")),
        partial(history, ADVISOR, reference("advisors")),
        *[partial(fact, spec) for spec in FACTS.values()],
        geography,
        instruments,
        dates,
        audit,
    )
    return after


def run_day(spark: SparkSession, places: Places, business_date: str) -> Snapshot:
    """The whole run for one business date; running it again replaces the day."""
    curate(spark, places, business_date)
    check(spark, places, business_date)
    return load(spark, places, business_date)
