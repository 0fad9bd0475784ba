"""Work tables: intermediate results written to shared storage.

A written table cuts lineage, survives the loss of executors and is read back by
columns, so later stages see one fixed result however often they are recomputed.
Each application has its own folder, which may be deleted once it has ended.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brokerhouse.sources.curated import parquet_writer

_SETTING = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Folder for work tables: the one the cluster names, else (local mode only) a temporary one."""
    context = spark.sparkContext
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return f"{configured.rstrip('/')}/brokerhouse-{context.applicationId}"
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="brokerhouse-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to a new work table and return that table."""
    spark = df.sparkSession
    path = new_path(spark)
    parquet_writer(df).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table without rows, known as such to the optimizer, which then drops joins against it."""
    return spark.createDataFrame([], schema).limit(0)


def with_copy_number(df: DataFrame, name: str = "_copy") -> DataFrame:
    """Tell copies apart by where they lie; `df` must come straight from files, so that reruns agree."""
    return df.withColumn(name, F.monotonically_increasing_id())
