"""Abnormality limits of each concept from how outcomes lie along its values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import group_quantiles

LOW, HIGH, OK = ("A", "AA", "L", "LL"), ("A", "AA", "H", "HH"), ("N",)


def _side(blocks: DataFrame, low: bool, threshold: float, walk: float) -> DataFrame:
    """Walk from one end.  Rows are (concept, value, outcome, k): inside a block the ratio moves one way, so its first and
    last row suffice and a concept with millions of rows costs its distinct values."""
    num, den = (LOW, (*LOW, *OK, "H", "HH")) if low else (HIGH, (*HIGH, *OK, "L", "LL"))
    by = [F.col("value") if low else F.col("value").desc(), F.col("outcome")]
    w = Window.partitionBy("concept").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("concept")
    b = blocks.withColumns({"n": F.floor(F.sum("k").over(whole) * walk), "before": F.coalesce(F.sum("k").over(w), F.lit(0))})
    b = b.withColumns({"num0": F.coalesce(F.sum(F.when(F.col("outcome").isin(*num), F.col("k")).otherwise(0)).over(w), F.lit(0)), "den0": F.coalesce(F.sum(F.when(F.col("outcome").isin(*den), F.col("k")).otherwise(0)).over(w), F.lit(0))})
    b = b.filter(F.col("before") < F.col("n")).withColumn("k", F.least("k", F.col("n") - F.col("before")))
    is_num, is_den = F.col("outcome").isin(*num).cast("int"), F.col("outcome").isin(*den).cast("int")

    def ratio(steps):
        return (F.col("num0") + is_num * steps) / (F.col("den0") + is_den * steps + 0.0001)

    known = F.col("outcome") != "NA"
    last_ratio = ratio(F.col("k"))
    bad = known & ((ratio(F.lit(1)) > threshold) | (last_ratio > threshold))
    out = b.groupBy("concept").agg(
        F.max_by("value", F.col("before")).alias("walked"),
        F.max_by(F.when(bad, F.col("value")), F.when(bad, F.col("before"))).alias("last_bad"),
        F.max_by(F.when(known, last_ratio), F.when(known, F.col("before"))).alias("final"),
    )
    settled = F.coalesce(F.col("final") <= threshold, F.lit(True))
    side = "low" if low else "high"
    return out.select("concept", F.when(settled, F.col("last_bad")).otherwise(F.col("walked")).alias(side), (~settled).alias(f"{side}_problem"))


def walk_limits(df: DataFrame, threshold: float, min_count: int = 1, walk: float = 0.5) -> DataFrame:
    """concept, low, high and their problem flags ("not converged") at one threshold."""
    rows = df.filter("value is not null").withColumn("outcome", F.coalesce("outcome", F.lit("NA")))
    blocks = rows.groupBy("concept", "value", "outcome").agg(F.count("*").alias("k"))
    enough = blocks.groupBy("concept").agg(F.sum("k").alias("n_rows")).filter(F.col("n_rows") >= min_count)
    blocks = blocks.join(enough.select("concept"), "concept", "left_semi")
    return reduce(lambda a, b: a.join(b, "concept", "left"), [enough, _side(blocks, True, threshold, walk), _side(blocks, False, threshold, walk)])


def percentile_limits(df: DataFrame) -> DataFrame:
    """The 95th percentile of low values and the 5th of high ones."""
    side = F.when(F.col("outcome").isin("L", "LL"), "low").when(F.col("outcome").isin("H", "HH"), "high")
    q = group_quantiles(df.withColumn("__side", side).filter("__side is not null"), ["concept", "__side"], [0.05, 0.95])
    both = q.groupBy("concept").agg(F.max(F.when(F.col("__side") == "low", F.col("quantiles")[1])).alias("low_p95"), F.max(F.when(F.col("__side") == "high", F.col("quantiles")[0])).alias("high_p05"))
    return df.select("concept").distinct().join(both, "concept", "left")


def choose_limits(strict: DataFrame, loose: DataFrame, many: int = 100_000) -> DataFrame:
    """0.99 limits for concepts with many rows; else those at 0.95, unless they didn't converge.  No limit is infinity."""
    l = loose.select("concept", *[F.col(c).alias(f"l_{c}") for c in ("low", "high", "low_problem", "high_problem")])
    both = strict.join(l, "concept")
    out = ["concept"]
    for side, none in (("low", "-Infinity"), ("high", "Infinity")):
        use = (F.col("n_rows") > many) | F.coalesce(f"l_{side}_problem", F.lit(False))
        out += [F.coalesce(F.when(use, F.col(side)).otherwise(F.col(f"l_{side}")), F.lit(none).cast("double")).alias(side), F.coalesce(F.when(use, F.col(f"{side}_problem")).otherwise(F.col(f"l_{side}_problem")), F.lit(False)).alias(f"{side}_problem")]
    return both.select(*out)
