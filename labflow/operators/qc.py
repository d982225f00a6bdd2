"""Ordered quality rules.  A concept's rules are one array, folded in rule order with ``aggregate``; no row visits the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import append_note
from ..sources.readers import unique

CONFLICTS = (("N", "1"), ("A", "0"))


def is_date(value: Column) -> Column:
    """DDMMYY read as a number: six digits, day to 31, month 1 to 12."""
    month = F.floor(value / 100) % 100
    return F.coalesce((value == F.floor(value)) & value.between(100000, 999999) & (F.floor(value / 10000) <= 31) & month.between(1, 12), F.lit(False))


def start(df: DataFrame) -> DataFrame:
    return df.withColumns({"qc_pass": F.lit(2), "qc_note": F.lit(None).cast("string")})


FIX, LIMIT = "struct<seq:int,column:string,side:string,limit:double,factor:double,note:string>", "struct<seq:int,side:string,limit:double,note:string>"


def _rules(df: DataFrame, rules: DataFrame, fields: list[str], out: str) -> DataFrame:
    """Each row with its concept's rules in order."""
    grouped = rules.groupBy("concept").agg(F.array_sort(F.collect_list(F.struct("seq", *fields))).alias(out))
    return df.join(grouped.withColumnRenamed("concept", "__c"), F.col("concept") == F.col("__c"), "left").drop("__c")


def fixes_of(df: DataFrame, rules: DataFrame) -> DataFrame:
    return _rules(df, rules, ["column", "side", "limit", "factor", "note"], "__fixes")


def thresholds_of(df: DataFrame, rules: DataFrame) -> DataFrame:
    return _rules(df, rules, ["side", "limit", "note"], "__thresholds")


def listed_of(df: DataFrame, concepts: DataFrame) -> DataFrame:
    t = unique(concepts.select("concept", "note"), ["concept"]).select(F.col("concept").alias("__c"), F.struct("note").alias("__listed"))
    return df.join(t, F.col("concept") == F.col("__c"), "left").drop("__c")


def limits_of(df: DataFrame, limits: DataFrame) -> DataFrame:
    t = unique(limits.select("concept", "low", "high", "low_problem", "high_problem"), ["concept"]).withColumnRenamed("concept", "__c")
    return df.join(t, F.col("concept") == F.col("__c"), "left").drop("__c")


def compare(value: Column, side: Column, limit: Column) -> Column:
    hit = F.when(side == "<", value < limit).when(side == "<=", value <= limit).when(side == ">", value > limit).when(side == ">=", value >= limit).when(side == "==", value == limit).when(side == "!=", value != limit)
    return F.coalesce(hit, F.lit(False))


def fix_values(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules (concept, seq, column, side, limit, factor, note) multiply the merged value; later rules see the result."""
    return fixed(fixes_of(df, rules))


def fixed(df: DataFrame) -> DataFrame:
    """``fix_values`` of rows that have their rules; rows without any are not folded."""
    def step(state: Column, r: Column) -> Column:
        value = F.when(r["column"] == "merged", state["v"]).when(r["column"] == "extracted", F.col("extracted_value")).when(r["column"] == "harmonised", F.col("harm_value"))
        hit = compare(value, r["side"], r["limit"])
        return F.struct(F.when(hit, state["v"] * r["factor"]).otherwise(state["v"]).alias("v"), F.when(hit, append_note(state["note"], r["note"])).otherwise(state["note"]).alias("note"))

    first = F.struct(F.col("merged_value").cast("double").alias("v"), F.col("qc_note").cast("string").alias("note"))
    done = df.withColumn("__s", F.when(F.col("__fixes").isNotNull(), F.aggregate(F.col("__fixes").cast(f"array<{FIX}>"), first, step)))
    some = F.col("__s").isNotNull()
    return done.withColumns({"merged_value": F.when(some, F.col("__s.v")).otherwise(F.col("merged_value").cast("double")), "qc_note": F.when(some, F.col("__s.note")).otherwise(F.col("qc_note"))}).drop("__s", "__fixes")


def threshold_qc(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules (concept, seq, side, limit, note): a listed concept passes (1) unless a rule hits (0); each hit leaves its note."""
    return judged(thresholds_of(df, rules))


def judged(df: DataFrame) -> DataFrame:
    """``threshold_qc`` of rows that have their rules."""
    rules = F.col("__thresholds").cast(f"array<{LIMIT}>")
    both = df.withColumn("__hits", F.when(F.col("__thresholds").isNotNull(), F.filter(rules, lambda r: compare(F.col("merged_value"), r["side"], r["limit"]))))
    some = F.coalesce(F.size("__hits") > 0, F.lit(False))
    notes = F.when(some, F.nullif(F.concat_ws("; ", F.transform("__hits", lambda r: r["note"])), F.lit("")))
    state = F.when(some, 0).when(F.col("__thresholds").isNotNull(), 1).otherwise(F.col("qc_pass"))
    return both.withColumns({"qc_pass": state, "qc_note": append_note(F.col("qc_note"), notes)}).drop("__hits", "__thresholds")


def outcome_conflict(df: DataFrame) -> DataFrame:
    """An outcome that contradicts the extracted flag fails."""
    bad = F.lit(False)
    for outcome, flag in CONFLICTS:
        bad = bad | ((F.col("outcome") == outcome) & (F.col("is_pos") == flag))
    bad = F.coalesce(bad, F.lit(False))
    return df.withColumns({"qc_pass": F.when(bad, 0).otherwise(F.col("qc_pass")), "qc_note": F.when(bad, append_note(F.col("qc_note"), F.lit("OUTCOME_EXTRACT_CONFLICT"))).otherwise(F.col("qc_note"))})


def blacklist(df: DataFrame, concepts: DataFrame) -> DataFrame:
    """Concepts whose extracted values aren't trusted: merged value off, fail, note."""
    return distrusted(listed_of(df, concepts))


def distrusted(df: DataFrame) -> DataFrame:
    """``blacklist`` of rows that know whether their concept is on it."""
    bad = F.col("__listed").isNotNull() & F.col("extracted_value").isNotNull()
    return df.withColumns({"merged_value": F.when(~bad, F.col("merged_value")), "qc_pass": F.when(bad, 0).otherwise(F.col("qc_pass")), "qc_note": F.when(bad, append_note(F.col("qc_note"), F.col("__listed.note"))).otherwise(F.col("qc_note"))}).drop("__listed")


def impute_outcome(df: DataFrame, limits: DataFrame) -> DataFrame:
    """L, H or N from the concept's limits (concept, low, high, low_problem, high_problem); "*" marks an unsure limit."""
    return imputed(limits_of(df, limits))


def imputed(df: DataFrame) -> DataFrame:
    """``impute_outcome`` of rows that have their limits."""
    v = F.col("merged_value")
    out = F.when(v.between(F.col("low"), F.col("high")), "N").when((v > F.col("high")) & F.col("high_problem"), "H*").when(v > F.col("high"), "H").when((v < F.col("low")) & F.col("low_problem"), "L*").when(v < F.col("low"), "L")
    return df.withColumn("imputed_outcome", out).drop("low", "high", "low_problem", "high_problem")
