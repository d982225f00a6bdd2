"""Release checks, comparisons and audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from . import stats
from .quantiles import group_quantiles

TENTHS = tuple(i / 10 for i in range(11))
# The election's notes.
NOTE_SAME = "Injected matches Source"
NOTE_MOVED = "INJECTION CHANGE: Source mode was '%s'"
NOTE_DIFFERS = " | REF DIFF: ref was %s"
NOTE_NEW = " | NEW MAPPING"
NOTE_LOCKED = "MANUAL MAPPING (locked) - Current data suggests: %s"


def null_report(df: DataFrame) -> DataFrame:
    """column, n_null, percent (null for an empty table), from one pass."""
    one = df.agg(F.count("*").alias("__n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    long = one.unpivot("__n", df.columns, "column", "n_null")
    return long.select("column", "n_null", F.round(F.try_divide(100 * F.col("n_null"), F.col("__n")), 2).alias("percent"))


def release_summary(df: DataFrame, person: str = "person", concept: str = "concept") -> DataFrame:
    one = df.agg(F.count("*").alias("rows"), F.count_distinct(person).alias("persons"), F.count_distinct(concept).alias("concepts"))
    return one.unpivot([], ["rows", "persons", "concepts"], "metric", "n")


def concept_counts(df: DataFrame, counted: Sequence[str], binary: Sequence[str] = (), person: str = "person", concept: str = "concept") -> DataFrame:
    """Persons, rows, non-nulls and zeros per concept, and an ALL row over rows with a person."""
    aggs = [F.count_distinct(person).alias("persons"), F.count("*").alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in counted], *[F.count_if(F.col(c) == 0).alias(f"zero_{c}") for c in binary]]
    # one scan: a concept's rows, and all rows with a person, are levels of one roll-up; rows without a person count in theirs only
    named = df.withColumns({"__name": F.col(concept).cast("string"), "__person": F.col(person).isNotNull()})
    levels = named.groupingSets([[F.col("__name")], [F.col("__person")]], "__name", "__person").agg(F.grouping("__name").alias("__all"), *aggs)
    return levels.filter("__all = 0 or __person").withColumn("concept", F.when(F.col("__all") == 1, "ALL").otherwise(F.col("__name"))).drop("__name", "__person", "__all")


def version_compare(new: DataFrame, old: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """new / old per column to three decimals and the growth over all keys; null without an old count."""
    o = old.select(key, *[F.col(c).alias(f"old_{c}") for c in columns])
    growth = new.agg(F.sum(columns[0]).alias("a")).crossJoin(old.agg(F.sum(columns[0]).alias("b"))).select(F.round(F.try_divide("a", "b"), 3).alias("growth"))  # one row each
    ratios = [F.when(F.col(f"old_{c}") > 0, F.round(F.col(c) / F.col(f"old_{c}"), 3)).alias(f"{c}_ratio") for c in columns]
    return new.join(o, key, "left").select(key, *columns, *ratios).crossJoin(F.broadcast(growth))


def appeared(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    a, b = new.select(key).distinct(), old.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("change", F.lit("APPEARED")).unionByName(b.join(a, key, "left_anti").withColumn("change", F.lit("DISAPPEARED")))


def dictionary_diff(new: DataFrame, old: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that only one side has, and those whose value differs; a null is a value like any other."""
    o = old.select(F.col(key), F.col(value).alias("old"), F.lit(True).alias("__o"))
    both = new.select(F.col(key), F.col(value).alias("new"), F.lit(True).alias("__n")).join(o, key, "full_outer")
    change = F.when(F.col("__o").isNull(), "NEW").when(F.col("__n").isNull(), "REMOVED").when(~F.col("old").eqNullSafe(F.col("new")), "CHANGED")
    return both.withColumn("change", change).filter("change is not null").drop("__o", "__n")


def affected_tests(diff: DataFrame, counts: DataFrame, mapped: DataFrame, key: str) -> DataFrame:
    flag = mapped.select(key).distinct().withColumn("already_mapped", F.lit(True))
    return diff.join(counts, key).join(flag, key, "left").withColumn("already_mapped", F.coalesce("already_mapped", F.lit(False))).orderBy(F.desc("n_rows"), key)


def reconcile(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts against a prior table: ratios (null without an old count), whether a row is new, and carried notes."""
    o = old.dropDuplicates(list(keys)).select(*keys, F.col("n_rows").alias("old_rows"), F.col("people").alias("old_people"), "note")
    return new.join(o, list(keys), "left").select(*keys, "n_rows", "people", F.round(F.try_divide("n_rows", "old_rows"), 3).alias("rows_ratio"), F.round(F.try_divide("people", "old_people"), 3).alias("people_ratio"), F.col("old_rows").isNull().alias("is_new"), "note")


def unmapped_counts(df: DataFrame, mapped: DataFrame, min_count: int) -> DataFrame:
    """Unmapped (test, unit) pairs with a count, and whether the test is mapped with another unit."""
    has = mapped.select("test").distinct().withColumn("test_mapped", F.lit(True))
    counts = df.filter("concept is null").groupBy("test", "unit").agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") >= min_count)
    return counts.join(has, "test", "left").withColumn("test_mapped", F.coalesce("test_mapped", F.lit(False)))


def reference_stats(df: DataFrame) -> DataFrame:
    """Per concept: rows, most frequent unit, eleven quantiles."""
    top = df.groupBy("concept", "unit").agg(F.count("*").alias("k")).groupBy("concept").agg(F.min(F.struct((-F.col("k")).alias("k"), "unit"))["unit"].alias("top_unit"))
    own = group_quantiles(df, ["concept"], TENTHS).withColumnRenamed("n", "n_rows")
    return top.join(own, "concept", "left").select("concept", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), "quantiles", "top_unit")


def with_reference(candidates: DataFrame, reference: DataFrame, targets: DataFrame) -> DataFrame:
    """Candidates beside their concept's reference (rows, top unit, quantiles) and target unit; those without one keep nulls."""
    ref = reference.select("concept", F.col("n_rows").alias("ref_rows"), F.col("top_unit").alias("ref_unit"), F.col("quantiles").alias("ref_quantiles"))
    return candidates.join(ref, "concept", "left").join(targets.select("concept", "target_unit"), "concept", "left")


def candidates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups with a source value but no harmonised one, with their deciles."""
    return group_quantiles(df.filter("value is not null and harm_value is null"), keys, TENTHS).withColumnRenamed("n", "n_rows")


def elect_unit(df: DataFrame, locks: DataFrame | None = None) -> DataFrame:
    """Target unit per (concept, quantity): the most frequent unit of source rows and of injected rows, shares, lock, note.

    Rows: concept, quantity, unit (null: NA), origin in {"source", "injected"}.
    """
    counts = df.groupBy("concept", "quantity", "origin", "unit").agg(F.count("*").alias("k"))
    keys = ["concept", "quantity"]
    real = F.col("unit").isNotNull()

    def side(origin: str) -> DataFrame:
        own = counts.filter(F.col("origin") == origin)
        total = F.sum("k")
        return own.groupBy(*keys).agg(F.min(F.when(real, F.struct((-F.col("k")).alias("k"), "unit")))["unit"].alias(f"{origin}_unit"), F.round(F.max(F.when(real, F.col("k"))) / total, 4).alias(f"{origin}_share"))

    both = side("source").join(side("injected"), keys, "full_outer")
    if locks is not None:
        both = both.join(locks.select(*keys, F.col("unit").alias("lock")), keys, "left")
    else:
        both = both.withColumn("lock", F.lit(None).cast("string"))
    target = F.coalesce("lock", "source_unit", "injected_unit")
    note = F.when(F.col("lock").isNotNull() & (F.col("lock") != F.coalesce("source_unit", "injected_unit")), "LOCKED").when(F.col("source_unit") != F.col("injected_unit"), "DIFFERS")
    return both.select(*keys, "source_unit", "source_share", "injected_unit", "injected_share", target.alias("target_unit"), note.alias("note"))


def elect_units(df: DataFrame, reference: DataFrame | None = None, min_count: int = 1) -> DataFrame:
    """The unit of each (concept, quantity) from rows that have a ``source`` and an ``injected`` unit, against a prior table.

    ``reference``: concept, quantity, unit, manual.  A manual entry is locked: it stays, whatever the rows say.  ``changed`` marks
    what differs from the source's mode or from the reference, or is new: the subset to look at.  Combinations of both units with fewer
    than ``min_count`` rows don't count; equal modes go to the least unit.
    """
    keys = ["concept", "quantity"]
    counts = df.groupBy(*keys, "source", "injected").agg(F.count("*").alias("k")).filter(F.col("k") >= min_count)

    def side(name: str) -> DataFrame:
        unit = F.coalesce(F.nullif(name, F.lit("")), F.lit("NA"))
        own = counts.groupBy(*keys, unit.alias("unit")).agg(F.sum("k").alias("k"))
        real = F.col("unit") != "NA"
        mode = F.min(F.when(real, F.struct((-F.col("k")).alias("k"), "unit")))["unit"]
        each = F.array_sort(F.collect_list(F.struct("unit", "k")))  # a row per unit
        all_ = own.groupBy(*keys).agg(F.coalesce(mode, F.lit("NA")).alias(f"{name}_unit"), each.alias("each"), F.sum("k").alias("n"))
        share = F.transform("each", lambda x: F.concat(F.lit("'"), x["unit"], F.lit("': "), F.round(x["k"] / F.col("n"), 4).cast("string")))
        return all_.select(*keys, f"{name}_unit", F.concat(F.lit("{"), F.concat_ws(", ", share), F.lit("}")).alias(f"{name}_shares"), F.col("n").alias(f"n_{name}"))

    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    b = side("injected").withColumnsRenamed({k: f"__{k}" for k in keys})
    both = side("source").join(b, same[0] & same[1]).drop(*[f"__{k}" for k in keys], "n_injected").withColumnRenamed("n_source", "n_rows")
    if reference is None:
        both = both.withColumns({"ref": F.lit(None).cast("string"), "manual": F.lit(False), "__has": F.lit(False)})
    else:
        r = reference.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min("unit").alias("ref"), F.bool_or("manual").alias("manual"), F.lit(True).alias("__has"))
        both = both.join(r, same[0] & same[1], "left").drop(*[f"__{k}" for k in keys])
    locked, moved = F.coalesce("manual", F.lit(False)), F.lower("injected_unit") != F.lower("source_unit")
    has = F.coalesce("__has", F.lit(False))
    differs, new = has & (F.lower("injected_unit") != F.lower(F.coalesce("ref", F.lit("NA")))), ~has & (F.col("injected_unit") != "NA")
    first = F.when(moved, F.format_string(NOTE_MOVED, "source_unit")).otherwise(F.lit(NOTE_SAME))
    note = F.concat(first, F.when(differs, F.format_string(NOTE_DIFFERS, F.coalesce("ref", F.lit("NA")))).when(new, NOTE_NEW).otherwise(""))
    note = F.when(locked, F.format_string(NOTE_LOCKED, "injected_unit")).otherwise(note)
    return both.select(
        *keys, F.when(locked, F.col("ref")).otherwise(F.col("injected_unit")).alias("target_unit"), F.when(locked, "MANUAL").when(moved, "INJECTED").otherwise("SOURCE").alias("unit_source"),
        note.alias("note"), "source_shares", "injected_shares", "n_rows", (~locked & (moved | differs | new)).alias("changed"),
    )


def with_names(counts: DataFrame, names: DataFrame, key: str = "concept") -> DataFrame:
    """Counts with their concepts' descriptions (key, name)."""
    return counts.join(names.select(key, "name"), key, "left")


def as_json(df: DataFrame, keys: Sequence[str], name: str, value: str) -> DataFrame:
    """keys, json: each group's names and values as one JSON object, in order of names (a row per group and name comes in)."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(name).alias("k"), F.col(value).alias("v"))))
    return df.groupBy(*keys).agg(F.to_json(F.map_from_entries(pairs)).alias("json"))


def content_hash(df: DataFrame, columns: Sequence[str], out: str = "hash") -> DataFrame:
    """A row's content as one SHA-256, nulls told apart from empty text."""
    return df.withColumn(out, F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))


def text_counts(df: DataFrame, pattern: str, keys: Sequence[str], people: int = 5) -> DataFrame:
    """Texts that match a pattern: rows and people per group, at least ``people`` of them."""
    return df.filter(F.col("text").rlike(pattern)).groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_distinct("person").alias("people")).filter(F.col("people") >= people)


def spreadsheet_safe(c):
    return F.when(c.rlike("^[+=-]"), F.concat(F.lit("'"), c)).otherwise(c)


def job_account(counts: dict[str, int], spark: SparkSession) -> DataFrame:
    """One row from a job's observed counts: rows in, rows out, rows set aside, and whether they add up.  Nothing is read again."""
    gone = sum(v for k, v in counts.items() if k not in ("rows_in", "rows_out"))
    row = (counts["rows_in"], counts["rows_out"], gone, counts["rows_in"] == counts["rows_out"] + gone)
    return spark.createDataFrame([row], "n_in long, n_out long, n_quarantined long, balanced boolean")


def row_accounting(before: DataFrame, after: DataFrame, quarantined: DataFrame) -> DataFrame:
    """One row: rows in, rows out, rows set aside, and whether they add up."""
    names = ("n_in", "n_out", "n_quarantined")
    marked = [df.select(F.lit(name).alias("part")) for df, name in zip((before, after, quarantined), names, strict=True)]
    counts = marked[0].unionByName(marked[1]).unionByName(marked[2]).agg(*[F.count_if(F.col("part") == name).alias(name) for name in names])
    return counts.withColumn("balanced", F.col("n_in") == F.col("n_out") + F.col("n_quarantined"))


def injection_audit(df: DataFrame, rules: DataFrame, alpha: float = 0.05, exact_rows: int = stats.EXACT_ROWS) -> DataFrame:
    """For each fix rule (rule, test, unit) the rows it made against the rest of their concept.

    Rows: concept, test, unit, fixed, value.  One histogram per concept serves all rules: the rest is the concept minus the rule.
    """
    made = df.filter("fixed").join(rules.select("rule", "test", "unit"), ["test", "unit"])
    per_rule = made.groupBy("rule", "concept").agg(F.count("*").alias("n"), F.count("value").alias("n_value"))
    own = made.filter("value is not null").groupBy("rule", "concept", "value").agg(F.count("*").alias("c"))
    whole = df.filter("value is not null").groupBy("concept", "value").agg(F.count("*").alias("all"))
    grid = per_rule.select("rule", "concept").join(whole, "concept").join(own, ["rule", "concept", "value"], "left").withColumn("c", F.coalesce("c", F.lit(0))).withColumn("t", F.col("all") - F.col("c"))
    w = Window.partitionBy("rule", "concept")
    run = w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    d = grid.withColumns({"cc": F.sum("c").over(run), "ct": F.sum("t").over(run), "n1": F.sum("c").over(w), "n2": F.sum("t").over(w)}).groupBy("rule", "concept").agg(F.max("n1").alias("n1"), F.max("n2").alias("n2"), F.max(F.abs(F.try_divide("cc", "n1") - F.try_divide("ct", "n2"))).alias("ks"))
    out = rules.select("rule").join(per_rule, "rule", "left").join(d, ["rule", "concept"], "left")
    tests = F.greatest(F.count("*").over(Window.partitionBy(F.lit(1))), F.lit(1))  # a row per rule
    out = out.withColumn("p", stats.ks_p(F.col("ks"), F.col("n1"), F.col("n2"), exact_rows))
    status = F.when(F.col("n").isNull(), "NO_DATA").when(F.coalesce("n1", F.lit(0)) == 0, "NO_HARMONIZED_DATA").when(F.coalesce("n2", F.lit(0)) == 0, "NO_OMOP_DATA").when(F.col("p") < alpha / tests, "FAILED_KS").otherwise("SUCCESS")
    return out.select("rule", "concept", F.col("n1").alias("n_rule"), F.col("n2").alias("n_rest"), "ks", "p", F.when(F.col("p").isNotNull(), stats.log_p(F.col("p"))).alias("mlogp"), status.alias("status"))


def unharmonised_audit(samples: DataFrame, keys: Sequence[str], units: DataFrame, min_rows: int = 10, limit: float = 0.3, exact_rows: int = stats.EXACT_ROWS) -> DataFrame:
    """Groups without a harmonised value against their concept's reference pool: target unit if the distributions agree.

    ``samples``: keys, side, value; ``units``: concept, target_unit.
    """
    sizes = samples.groupBy(*keys).agg(F.count_if(F.col("side") == "cand").alias("n_cand"), F.count_if(F.col("side") == "targ").alias("n_targ"))
    test = stats.ks(samples, keys, exact_rows).select(*keys, "ks", "ks_p")
    out = sizes.join(test, list(keys), "left").join(units, "concept", "left").filter("n_cand > 0")
    status = F.when(F.col("n_targ") == 0, "NO_REF_DATA").when(F.least("n_cand", "n_targ") < min_rows, "INSUFFICIENT_DATA").when(F.col("ks") < limit, "SUCCESS").otherwise("KS_FAIL")
    out = out.withColumn("ks_mlogp", F.when(F.col("ks_p").isNotNull(), stats.log_p(F.col("ks_p"))))
    return out.withColumns({"status": status, "proposed_unit": F.when(status == "SUCCESS", F.col("target_unit"))}).drop("target_unit")


def extracted_audit(df: DataFrame) -> DataFrame:
    """Extracted against harmonised values per concept: sizes, KS, medians, deciles, rank by disagreement.

    Rows: concept, side ("cand" extracted, "targ" harmonised), value.
    """
    kept = stats.sigma_filter(stage(df, "audit-rows"), ["concept", "side"]).filter("kept")
    k = stats.ks(kept, ["concept"]).select("concept", "n_cand", "n_targ", "ks")
    sides = ("cand", "targ")
    q = group_quantiles(kept, ["concept", "side"], TENTHS)
    med = q.groupBy("concept").agg(*[F.max(F.when(F.col("side") == s, F.col("quantiles"))).alias(f"deciles_{s}") for s in sides]).withColumns({f"median_{s}": F.col(f"deciles_{s}")[5] for s in sides})
    out = k.join(med, "concept").withColumn("n_ratio", F.round(F.try_divide("n_cand", "n_targ"), 4))
    return out.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc(F.round("ks", 9)), "concept")))  # a row per concept
