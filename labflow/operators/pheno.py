"""Phenotypes: medians per person, covariate screens, regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import group_quantiles


def person_median(df: DataFrame, concept, min_rows: int = 1) -> DataFrame:
    """Median value and age of each person for one concept, from rows that passed the checks."""
    own = df.filter((F.col("concept") == concept) & (F.col("qc_pass") == 1) & F.col("value").isNotNull())
    half = [group_quantiles(own, ["person"], [0.5], c).select("person", F.col("quantiles")[0].alias(c), F.col("n").alias(f"n_{c}")) for c in ("value", "age")]
    return half[0].join(half[1], "person", "left").select("person", "value", "age", F.col("n_value").alias("n_rows")).filter(F.col("n_rows") >= min_rows)


def with_covariates(phenotype: DataFrame, covariates: DataFrame, key: str = "person") -> DataFrame:
    return phenotype.join(covariates, key)


def covariate_screen(df: DataFrame, phenotypes: Sequence[str], covariates: Sequence[str], group: str, threshold: int) -> DataFrame:
    """Usable rows of each phenotype and covariate: the least over groups must reach the threshold.  One pass."""
    names = [(p, c) for p in phenotypes for c in covariates]
    agg = df.groupBy(group).agg(*[F.count_if(F.col(p).isNotNull() & (F.abs(F.col(c)) > 0)).alias(f"{p}|{c}") for p, c in names])
    long = agg.unpivot(group, [f"{p}|{c}" for p, c in names], "pair", "n")
    out = long.groupBy("pair").agg(F.min("n").alias("n_least"))
    return out.select(F.split("pair", r"\|")[0].alias("phenotype"), F.split("pair", r"\|")[1].alias("covariate"), "n_least", (F.col("n_least") >= threshold).alias("usable"))


def binary_screen(df: DataFrame, covariates: Sequence[str], threshold: int) -> DataFrame:
    """Binary covariates need enough zeros and ones; quantitative ones pass."""
    states = [F.struct(F.lit(c).alias("covariate"), F.count_if(F.col(c) == 0).alias("zeros"), F.count_if(F.col(c) == 1).alias("ones"), F.coalesce(F.bool_or(~F.col(c).isin(0, 1)), F.lit(False)).alias("quantitative")) for c in covariates]
    out = df.agg(F.array(*states).alias("all")).select(F.inline("all"))  # one pass for all covariates
    return out.withColumn("usable", F.col("quantitative") | ((F.col("zeros") > threshold) & (F.col("ones") > threshold)))


def region_hits(hits: DataFrame, regions: DataFrame) -> DataFrame:
    """Each hit's first region (by seq) that holds its position on its chromosome.

    Chromosomes are cut into bins of the regions' mean length.  A region stands in each bin that it reaches, which are at most
    three times as many rows as regions however unequal these are; a hit meets the regions of its own bin only.
    """
    wide = max(1, int(regions.agg(F.avg(F.col("end") - F.col("start") + 1)).first()[0] or 1))
    bins = F.sequence(F.floor(F.col("start") / wide), F.floor(F.col("end") / wide))
    r = regions.filter("start <= end").select(F.col("chrom").alias("__c"), "start", "end", "region", "seq", F.explode(bins).alias("__b"))
    both = hits.withColumn("__at", F.floor(F.col("pos") / wide)).join(r, (F.col("chrom") == F.col("__c")) & (F.col("__at") == F.col("__b")) & F.col("pos").between(F.col("start"), F.col("end")))
    return both.withColumn("__n", F.row_number().over(Window.partitionBy("hit").orderBy("seq", "region"))).filter("__n = 1").drop("__n", "__c", "__b", "__at", "start", "end", "seq")


def best_hit(hits: DataFrame) -> DataFrame:
    """The hit with the largest score in each region; ties go to the least hit."""
    top = hits.groupBy("region").agg(F.min(F.struct((-F.col("mlogp")).alias("m"), "hit", "pos")).alias("b"))
    return top.select("region", F.col("b.hit").alias("hit"), F.col("b.pos").alias("pos"), (-F.col("b.m")).alias("mlogp"))


def summary_statistics(df: DataFrame) -> DataFrame:
    """Nine columns of association results; the p-value from its negative logarithm."""
    return df.select("chrom", "pos", "ref", "alt", "beta", "sebeta", "af", F.pow(F.lit(10.0), -F.col("mlogp")).alias("pval"), "mlogp")
