"""Dense row numbers 1..N without pulling all rows into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brokerhouse.sources.work import materialize

# monotonically_increasing_id keeps the partition above bit 33, the position below.
_PARTITION_BITS = 33


def _placed(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """The rows sorted over all partitions and written once, each with its place.

    What one task sorts is a range of rows. Rows equal in `order_by` stay in one range;
    add a stable column that tells copies apart where they may be many.
    """
    ordered = df.orderBy(*order_by).withColumn("_position", F.monotonically_increasing_id())
    return materialize(ordered).withColumn("_partition", F.shiftright("_position", _PARTITION_BITS))


def _spans(placed: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Per group and partition: the first place and the number of rows."""
    return placed.groupBy(*group_by, "_partition").agg(
        F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )


def number_rows(df: DataFrame, order_by: Sequence[str], name: str, after: Column | int = 0) -> DataFrame:
    """Add `name`: after+1, after+2, ... in `order_by` order.

    Only one row per partition goes through the driver: how many rows each holds.
    """
    placed = _placed(df, order_by)
    shifts, before = [], 0
    for span in _spans(placed).orderBy("_partition").collect():
        shifts.append((span["_partition"], before + 1 - span["_first"]))
        before += span["_rows"]
    number = F.col("_position") + F.col("_shift") + after
    if len(shifts) <= 1:
        only = shifts[0][1] if shifts else 0
        numbered = placed.withColumn("_shift", F.lit(only))
    else:
        # As many rows as partitions, so the broadcast is always small.
        by_partition = df.sparkSession.createDataFrame(shifts, "_partition bigint, _shift bigint")
        numbered = placed.join(F.broadcast(by_partition), "_partition")
    return numbered.select(*df.columns, number.cast("bigint").alias(name))


def number_rows_within(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], name: str) -> DataFrame:
    """Add `name`: 1, 2, ... in `order_by` order, restarting in each `group_by` group.

    A group holding most rows is spread over many ranges like any other. The table of
    spans has at most one row per partition and one per group; it stays distributed.
    """
    group_by = list(group_by)
    placed = _placed(df, [*group_by, *order_by])
    earlier = Window.partitionBy(*group_by).orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    shifts = _spans(placed, group_by).select(
        *[F.col(c).alias(f"_group_{c}") for c in group_by],
        F.col("_partition").alias("_span"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + 1 - F.col("_first")).alias("_shift"),
    )
    same_span = reduce(
        and_,
        [F.col(c).eqNullSafe(F.col(f"_group_{c}")) for c in group_by],
        F.col("_partition") == F.col("_span"),
    )
    return placed.join(shifts, same_span).select(*df.columns, (F.col("_position") + F.col("_shift")).alias(name))


def highest(df: DataFrame, key: str) -> Column:
    """Highest key so far, 0 for none, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(key), F.lit(0).cast("bigint"))).scalar()


def assign_keys(new_rows: DataFrame, existing: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Surrogate keys for new rows, going on from the highest existing key."""
    return number_rows(new_rows, order_by, key, after=highest(existing, key))
