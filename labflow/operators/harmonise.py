"""Units to one unit per concept: validity, fixes by test, concept mapping, conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import number
from ..sources.readers import unique
from . import formulas


def unit_valid(df: DataFrame, approved: DataFrame, unit: str = "clean_unit") -> DataFrame:
    """``unit_valid``: "1" if the unit is in the approved list, else "0"."""
    codes = approved.select(F.col("unit").alias("__ok")).distinct()
    return df.join(codes, F.col(unit) == F.col("__ok"), "left").withColumn("unit_valid", F.when(F.col("__ok").isNotNull(), "1").otherwise("0")).drop("__ok")


def unit_fix(df: DataFrame, fixes: DataFrame) -> DataFrame:
    """Replace units by (test, unit): a real target needs a value, target NA always applies.  Of several fixes the least one counts."""
    first = unique(fixes.select("test", "unit", "fix"), ["test", "unit"]).select(F.col("test").alias("__test"), F.col("unit").alias("__unit"), F.col("fix").alias("__fix"))
    both = df.join(first, (F.col("test") == F.col("__test")) & F.col("clean_unit").eqNullSafe(F.col("__unit")), "left")
    applies = F.coalesce((F.col("__fix") == "NA") | (F.col("__fix").isNotNull() & F.col("value").isNotNull()), F.lit(False))
    return both.withColumns({"unit_before_fix": F.col("clean_unit"), "unit_valid": F.when(applies, "unit_fixed").otherwise(F.col("unit_valid")), "clean_unit": F.when(applies, F.nullif("__fix", F.lit("NA"))).otherwise(F.col("clean_unit"))}).drop("__test", "__unit", "__fix")


def concept_map(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Concept and quantity of (test, unit) from approved rows; unmapped is -1.  Of several approved rows the least concept counts."""
    approved = unique(mapping.filter(F.col("status") == "APPROVED").select("test", "unit", "concept", "quantity"), ["test", "unit"]).select(F.col("test").alias("__test"), F.col("unit").alias("__unit"), F.col("concept").alias("__concept"), F.col("quantity").alias("quantity"))
    both = df.join(approved, (F.col("test") == F.col("__test")) & F.col("clean_unit").eqNullSafe(F.col("__unit")), "left")
    return both.withColumn("concept", F.coalesce("__concept", F.lit(-1))).drop("__test", "__unit", "__concept")


def conversion_table(conversions: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per (concept, quantity, source unit): the concept's own conversion before the general one.

    Conversion text is a factor (``a``) or a formula in X (``program``); it is read here, once per entry, so no row evaluates text.
    ``known`` tells whether it is either.
    """
    own = conversions.select("quantity", "source_unit", "target_unit", "conversion", "only_concept")
    both = own.join(targets.select("concept", "quantity", "target_unit").distinct(), ["quantity", "target_unit"]).filter(F.col("only_concept").isNull() | (F.col("only_concept") == F.col("concept")))
    best = Window.partitionBy("concept", "quantity", "source_unit").orderBy(F.col("only_concept").isNull(), "conversion", "target_unit")
    return (
        both.withColumn("__rank", F.row_number().over(best)).filter("__rank = 1")
        .withColumns({"program": formulas.programs("conversion"), "a": number(F.replace("conversion", F.lit(","), F.lit("."))), "restricted": F.col("only_concept").isNotNull()})
        .withColumns({"is_formula": F.col("program").isNotNull(), "known": F.col("program").isNotNull() | F.col("a").isNotNull()})
        .select("concept", "quantity", "source_unit", "target_unit", "conversion", "is_formula", "a", "program", "known", "restricted")
    )


def conversion_of(df: DataFrame, table: DataFrame) -> DataFrame:
    """Each row's conversion: ``harm_unit``, ``factor``, and what ``converted`` works with.  It needs no value."""
    t = table.select(F.col("concept").alias("__c"), F.col("quantity").alias("__q"), F.col("source_unit").alias("__u"), F.when(F.col("known"), F.col("target_unit")).alias("harm_unit"), F.when(F.col("known"), F.col("conversion")).alias("factor"), "a", "program", F.col("conversion").alias("__text"))
    both = df.join(t, (F.col("concept") == F.col("__c")) & F.col("quantity").eqNullSafe(F.col("__q")) & F.col("clean_unit").eqNullSafe(F.col("__u")), "left")
    return both.drop("__c", "__q", "__u")


def converted(df: DataFrame, failed: str | None = None) -> DataFrame:
    """``harm_value`` of rows that have their conversion; see ``convert``."""
    both = df.withColumn("__v", number("value"))
    both = both.withColumn("harm_value", F.when(F.col("program").isNotNull(), F.bround(formulas.run(F.col("program"), F.col("__v")), 2)).otherwise(F.col("a") * F.col("__v")))
    if failed:
        both = both.withColumn(failed, F.when(F.col("__text").isNotNull() & F.col("__v").isNotNull() & F.col("harm_value").isNull(), F.col("__text")))
    return both.drop("__text", "__v", "a", "program")


def convert(df: DataFrame, table: DataFrame, failed: str | None = None) -> DataFrame:
    """Harmonised value, unit and factor; formulas round to two decimals, factors don't round.

    A conversion that is neither a number nor a formula gives no unit, one that divides by zero no value; the column ``failed``
    then holds its text.
    """
    return converted(conversion_of(df, table), failed)
