"""Steps written to the cluster's shared folder and read back: lineage ends there, so a lost executor costs no earlier work."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's own setting: an execution's shuffle files go when it ends.  A staged step's result is in the shared folder by then.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared checkpoint folder.

    Where that is not set, a local session gets a temporary folder and any other one the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
            root = tempfile.mkdtemp(prefix="spark-")
        else:
            root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back.  The shuffle files of the step are deleted when it has been written."""
    spark = df.sparkSession
    path, before = scratch(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, name: str) -> DataFrame:
    """A table that is small beside the rows it was made from (distinct units, a row per key), staged so that joins know its size.

    Planned from those rows it would count as large as they are: a join would exchange all rows by its key, and a few frequent keys
    would draw them to as many tasks.
    """
    return stage(df, name)
