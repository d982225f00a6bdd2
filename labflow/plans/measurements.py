"""The driver's tables seen as measurements, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

M_SQL = """m AS (SELECT o_custkey AS person, p_size AS concept, p_type AS test, p_brand AS unit, l_quantity AS value, l_returnflag AS outcome,
 l_shipdate AS ts, l_orderkey AS order_id, l_linenumber AS line_no, l_extendedprice AS price, l_tax AS tax, l_discount AS discount
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """person, concept, test, unit, value, outcome, time and order columns of every line item."""
    line, orders, part = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    both = line.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(part.select("p_partkey", "p_size", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return both.select(
        F.col("o_custkey").alias("person"), F.col("p_size").alias("concept"), F.col("p_type").alias("test"), F.col("p_brand").alias("unit"), F.col("l_quantity").alias("value"), F.col("l_returnflag").alias("outcome"),
        F.col("l_shipdate").alias("ts"), F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"), F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("tax"), F.col("l_discount").alias("discount"),
    )


def inline(spark: SparkSession, rows: str, columns: str) -> DataFrame:
    """A small dictionary written as SQL VALUES, so that the SQL twin can use the same text."""
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")
