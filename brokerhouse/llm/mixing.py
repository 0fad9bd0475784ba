"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations alone.

Each source has a target of words. Complete epochs come first: every document of the source is taken as many whole
times as fit into the target. What is left of the target is filled in the order of exponential keys: each document
draws -ln(u) / w from a uniform hash u of its id and its quality weight w, the keys are sorted within the source and
their sizes are summed up; a document is taken once more if the middle of its words lies within what is left, so a
source misses its target by half a document at most.

The sums run in two steps, so that no source, however large, is sorted in one task: keys fall into a fixed number of
bins, bins are summed up first, and only the bin in which the target is reached is put in order.

Defined results: a null text has size 0; a null id draws as the text `null`; rows of equal key go by id and size, and
rows equal in all three are alike; null sources form a source that comes last; an empty table gives an empty result; a
source without words has target 0 (when it is full it has no more to give). A null, infinite or not positive quality
counts as 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brokerhouse.llm.common import materialize

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Bins of the keys within a source.
BINS = 2048
#: Words are runs of other characters than these.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(id_: Column) -> Column:
    """A number in (0, 1) that follows from the id: the first 48 bits of its MD5."""
    digest = F.md5(F.coalesce(id_.cast("string"), F.lit("null")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """`_source`, `_source_size` and `_target` from one row per source.

    Sharing the excess by weight again and again ends where each source has weight times one rate, or its cap if that
    is less. Sources sorted by cap over weight: a prefix is capped, and the rate is what is left over for the others.
    """
    place = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    capped = sizes.withColumn("_weight", weight).withColumn("_cap", F.col("_source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    words = F.sum("_source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    rate = words / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    rated = capped.withColumn("_rate", rate).withColumn("_open", F.col("_rate") * F.col("_weight") <= F.col("_cap"))
    # the rate of the first source that stays under its cap holds for all after it
    final = F.first(F.when(F.col("_open"), F.col("_rate")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least("_cap", F.coalesce(final * F.col("_weight"), F.col("_cap")))
    return rated.select("_source", "_source_size", target.alias("_target"))


def mix(
    docs: DataFrame,
    quality: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_EPOCHS,
    bins: int = BINS,
    size: Column | None = None,
) -> DataFrame:
    """One row per document: id, `size`, `source_size`, `target` of its source, `taken` words, `source`, `times`.

    `size` is the number of words where the caller has counted them already.
    """
    good = F.lit(1.0) if quality is None else quality.cast("double")
    good = F.when((good > 0) & (good < F.lit(float("inf"))), good).otherwise(F.lit(1.0))
    light = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).cast("string").alias("_source"),
        (word_count(F.col(text_col)) if size is None else size).alias("_size"),
        good.alias("_quality"),
    )
    drawn = materialize(light.withColumn("_key", -F.log(uniform(F.col("_id"))) / F.col("_quality")))
    # keys follow 1 - exp(-key) roughly evenly, so bins do not grow uneven with the number of documents
    drawn = drawn.withColumn("_bin", F.least(F.lit(bins - 1), F.floor((1 - F.exp(-F.col("_key"))) * bins)).cast("int"))
    binned = materialize(drawn.groupBy("_source", "_bin").agg(F.sum("_size").alias("_words")))
    sizes = binned.groupBy("_source").agg(F.sum("_words").alias("_source_size"))
    plan = targets(sizes, weights, most).withColumn(
        "_epochs",
        F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size") + F.lit(1e-9)))
        .otherwise(F.lit(0))
        .cast("long"),
    )
    plan = plan.withColumn("_left", F.greatest(F.col("_target") - F.col("_epochs") * F.col("_source_size"), F.lit(0.0)))
    along = Window.partitionBy("_source").orderBy("_bin")
    ends = binned.withColumn("_end", F.sum("_words").over(along)).withColumnRenamed("_source", "_s")
    split = (
        ends.join(plan, F.col("_s").eqNullSafe(F.col("_source")))
        .where(F.col("_end") > F.col("_left"))
        .groupBy("_source")
        .agg(F.min(F.struct("_bin", (F.col("_end") - F.col("_words")).alias("_begin"))).alias("_at"))
        .select(F.col("_source").alias("_s"), F.col("_at._bin").alias("_last"), F.col("_at._begin").alias("_begin"))
    )
    plan = materialize(
        plan.join(split, F.col("_source").eqNullSafe(F.col("_s")), "left")
        .select(F.col("_source").alias("_of"), "_source_size", "_target", "_epochs", "_left", "_last", "_begin")
    )
    dealt = drawn.join(plan, F.col("_source").eqNullSafe(F.col("_of")))
    within = F.col("_bin").eqNullSafe(F.col("_last"))
    reached = dealt.where(within).withColumn(
        "_sum",
        F.col("_begin")
        + F.sum("_size").over(
            Window.partitionBy("_source", "_bin")
            .orderBy("_key", F.col("_id").cast("string"), "_size")
            .rowsBetween(Window.unboundedPreceding, 0)
        ),
    )
    more = F.when(F.col("_sum") - F.col("_size") / 2 < F.col("_left"), 1).otherwise(0)
    others = dealt.where(~within).withColumn(
        "_more", F.when(F.coalesce(F.col("_bin") < F.col("_last"), F.lit(True)) & (F.col("_left") > 0), 1).otherwise(0)
    )
    both = reached.withColumn("_more", more).drop("_sum").unionByName(others)
    times = F.least(F.col("_epochs") + F.col("_more"), F.lit(most)).cast("long")
    return both.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (times * F.col("_size")).alias("taken"),
        F.col("_source").alias("source"),
        times.alias("times"),
    )
