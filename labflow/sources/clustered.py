"""Releases that are stored in the order later jobs need, and distinct counts that outlive them.

``write_clustered`` deals rows into buckets by a key and sorts each: a keyed de-duplication, a window per key, or a join of two tables with
the same key and number of buckets then reads bucket by bucket, without an exchange.  ``release_sketches`` stores a mergeable sketch
of each concept's persons beside the exact numbers, so that releases are compared, and merged, without reading them again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import scratch

#: Logarithm of a sketch's registers: its standard error is about 1.04 / sqrt(2 ** 12), 1.6 %.
SKETCH_BITS = 12


def write_clustered(df: DataFrame, keys: Sequence[str], buckets: int, name: str = "release", path: str | None = None) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``keys`` as an external Parquet table, and read it back.

    One exchange here takes the place of one in every later job.  A hot key is one bucket's: choose a key whose rows fit a task.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.option("path", path or scratch(spark, name)).option("compression", "zstd").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table)


def release_sketches(df: DataFrame, person: str = "person", concept: str = "concept") -> DataFrame:
    """concept, n_rows, persons (exact) and a sketch of the persons; concept null is the whole release."""
    aggs = [F.count("*").alias("n_rows"), F.count_distinct(person).alias("persons"), F.hll_sketch_agg(F.col(person).cast("string"), F.lit(SKETCH_BITS)).alias("sketch")]
    own = df.groupBy(F.col(concept).cast("string").alias("concept")).agg(*aggs)
    return own.unionByName(df.agg(*aggs).withColumn("concept", F.lit("ALL")))


def compare_sketches(new: DataFrame, old: DataFrame) -> DataFrame:
    """Two releases from what ``release_sketches`` stored: rows, estimated persons of each, of both together and new ones per concept."""
    a = new.select(F.col("concept"), F.col("n_rows").alias("new_rows"), F.col("persons").alias("new_exact"), F.col("sketch").alias("__a"))
    b = old.select(F.col("concept").alias("__concept"), F.col("n_rows").alias("old_rows"), F.col("persons").alias("old_exact"), F.col("sketch").alias("__b"))
    both = a.join(b, F.col("concept").eqNullSafe(F.col("__concept")), "left").drop("__concept")
    union = F.when(F.col("__b").isNull(), F.col("__a")).otherwise(F.hll_union("__a", "__b"))
    est = {"new_persons": F.hll_sketch_estimate("__a"), "old_persons": F.hll_sketch_estimate("__b"), "all_persons": F.hll_sketch_estimate(union)}
    out = both.withColumns(est).withColumn("appeared", F.greatest(F.lit(0), F.col("all_persons") - F.coalesce("old_persons", F.lit(0))))
    ratios = {f"{c}_ratio": F.round(F.try_divide(f"new_{c}", f"old_{c}"), 3) for c in ("rows", "persons")}
    return out.withColumns(ratios).drop("__a", "__b")
