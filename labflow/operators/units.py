"""Missing units inferred from value distributions, for all tests at once.

Input rows: test, unit (null if missing), value (harmonised text source), extracted, concept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import sized, stage
from . import stats


def targets(df: DataFrame, min_count: int = 500) -> DataFrame:
    """Tests that have values without a unit: how many, and their least concept."""
    return df.filter("unit is null and value is not null").groupBy("test").agg(F.count("*").alias("n_rows"), F.min("concept").alias("concept")).filter(F.col("n_rows") > min_count)


def prevalence(df: DataFrame, top: int = 3) -> DataFrame:
    """test, unit, cnt, pct (two decimals), rn of the ``top`` units of each test."""
    counts = df.filter("unit is not null and value is not null").groupBy("test", "unit").agg(F.count("*").alias("cnt"))
    w = Window.partitionBy("test")
    return counts.withColumns({"rn": F.row_number().over(w.orderBy(F.desc("cnt"), "unit")), "pct": F.round(100 * F.col("cnt") / F.sum("cnt").over(w), 2)}).filter(F.col("rn") <= top)


def prevalence_text(top: DataFrame) -> DataFrame:
    """test, units ("{a:98.1,b:1.9}"), dominant and its share."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("rn", "unit", "pct"))), lambda x: F.concat_ws(":", x["unit"], x["pct"].cast("string")))
    return top.groupBy("test").agg(F.concat(F.lit("{"), F.concat_ws(",", parts), F.lit("}")).alias("units"), F.max_by("unit", -F.col("rn")).alias("dominant"), F.max("pct").alias("share"))


def classify(targets_: DataFrame, top: DataFrame, threshold: float = 98.0) -> DataFrame:
    share = top.filter("rn = 1").select("test", F.col("unit").alias("dominant"), F.col("pct").alias("share"))
    category = F.when(F.col("share").isNull(), "NO_DATA").when(F.col("share") >= threshold, "UNAMBIGUOUS").otherwise("AMBIGUOUS")
    return targets_.join(share, "test", "left").withColumn("category", category)


def category_summary(targets_: DataFrame, top: DataFrame, thresholds=(95.0, 98.0, 99.0, 100.0)) -> DataFrame:
    """Tests and rows of each category at several thresholds, in one pass."""
    share = top.filter("rn = 1").select("test", F.col("pct").alias("share"))
    each = targets_.join(share, "test", "left").withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    category = F.when(F.col("share").isNull(), "NO_DATA").when(F.col("share") >= F.col("threshold"), "UNAMBIGUOUS").otherwise("AMBIGUOUS")
    agg = each.withColumn("category", category).groupBy("threshold", "category").agg(F.count("*").alias("tests"), F.sum("n_rows").alias("n_rows"))
    w = Window.partitionBy("threshold")
    return agg.withColumns({"tests_pct": F.round(100 * F.col("tests") / F.sum("tests").over(w), 2), "rows_pct": F.round(100 * F.col("n_rows") / F.sum("n_rows").over(w), 2)})


def assignment_summary(results: DataFrame) -> DataFrame:
    """Tests and rows with an assigned unit, over all tests and over those with a concept.  Rows: test, n_rows, concept, unit."""
    sets = results.withColumn("subset", F.explode(F.when(F.col("concept").isNotNull(), F.array(F.lit("all"), F.lit("mapped"))).otherwise(F.array(F.lit("all")))))
    done = F.col("unit").isNotNull()
    return sets.groupBy("subset").agg(F.count_distinct("test").alias("tests"), F.count_distinct(F.when(done, F.col("test"))).alias("tests_assigned"), F.sum("n_rows").alias("n_rows"), F.coalesce(F.sum(F.when(done, F.col("n_rows"))), F.lit(0)).alias("rows_assigned"))


def coverage(expected: DataFrame, got: DataFrame, key: str = "test") -> DataFrame:
    """Counts of expected, covered, missing and extra keys."""
    e, g = expected.select(key).distinct().withColumn("e", F.lit(True)), got.select(key).distinct().withColumn("g", F.lit(True))
    both = e.join(g, key, "full_outer")
    return both.agg(F.count_if("e").alias("expected"), F.count_if("g").alias("covered"), F.count_if(F.col("e") & F.col("g").isNull()).alias("missing"), F.count_if(F.col("g") & F.col("e").isNull()).alias("extra"), F.count_if(F.col("e") & F.col("g")).alias("overlap"))


def concept_units(mapping: DataFrame, conversions: DataFrame) -> DataFrame:
    """SINGLE, EQUIVALENT, AMBIGUOUS, NO_CONV or NO_QUANTITY per concept, and the canonical unit.

    ``mapping``: concept, quantity, unit; ``conversions``: quantity, source_unit, target_unit, factor.
    """
    units = mapping.filter("unit is not null").select("concept", "quantity", "unit").distinct()
    size = mapping.groupBy("concept").agg(F.count_distinct("unit").alias("n_units"), F.max("quantity").alias("quantity"), F.min("unit").alias("canonical"))
    a, b = units.select("concept", "quantity", F.col("unit").alias("source_unit")), units.select("concept", "quantity", F.col("unit").alias("target_unit"))
    pairs = a.join(b, ["concept", "quantity"]).filter(F.col("source_unit") < F.col("target_unit"))  # units of one concept
    f1 = conversions.select("quantity", "source_unit", "target_unit", F.col("factor").alias("f1"))
    f2 = conversions.select("quantity", F.col("source_unit").alias("target_unit"), F.col("target_unit").alias("source_unit"), F.try_divide(F.lit(1), "factor").alias("f2"))
    known = pairs.join(f1, ["quantity", "source_unit", "target_unit"], "left").join(f2, ["quantity", "source_unit", "target_unit"], "left").withColumn("f", F.coalesce("f1", "f2"))
    same = known.groupBy("concept").agg(F.bool_and(F.col("f").isNotNull()).alias("all_known"), F.bool_and(F.coalesce(F.abs(F.col("f") - 1) < 1e-9, F.lit(False))).alias("all_one"))
    status = F.when(F.col("quantity").isNull(), "NO_QUANTITY").when(F.col("n_units") <= 1, "SINGLE").when(F.col("all_one"), "EQUIVALENT").when(F.col("all_known"), "AMBIGUOUS").otherwise("NO_CONV")
    return size.join(same, "concept", "left").select("concept", "quantity", "n_units", status.alias("status"), F.when(status.isin("SINGLE", "EQUIVALENT"), F.col("canonical")).alias("canonical"))


def rescue(no_data: DataFrame, concept_table: DataFrame) -> DataFrame:
    """Tests without data take their concept's canonical unit, where there is just one."""
    c = concept_table.select("concept", "status", "canonical")
    return no_data.join(c, "concept", "left").withColumn("unit", F.when(F.col("status").isin("SINGLE", "EQUIVALENT"), F.col("canonical")))


def samples(df: DataFrame) -> DataFrame:
    """Candidate values (no unit: extracted, else source) and target values (source, per unit)."""
    cand = df.filter("unit is null").select("test", F.lit(None).cast("string").alias("unit"), F.lit("cand").alias("side"), F.coalesce("extracted", "value").alias("value"))
    targ = df.filter("unit is not null").select("test", "unit", F.lit("targ").alias("side"), "value")
    return cand.unionByName(targ).filter("value is not null")


def paired(sample: DataFrame, units: DataFrame) -> DataFrame:
    """Candidate and target values of each (test, unit) in ``units``: every unit meets the test's candidates."""
    u = units.select("test", "unit").distinct()
    cand = sample.filter("side = 'cand'").drop("unit").join(u, "test")
    targ = sample.filter("side = 'targ'").join(u, ["test", "unit"])
    return cand.select("test", "unit", "side", "value").unionByName(targ.select("test", "unit", "side", "value"))


#: What a comparison of a test's candidates with a unit's values leaves in the result tables.
FOUND = ("n_cand", "n_targ", "cand_deciles", "targ_deciles", "ks", "ks_mlogp", "ks_pass", "t", "t_mlogp", "t_pass", "mad_dist", "mad_threshold", "mad_pass", "verdict", "decided_by", "tests_passed")


def compared(pairs: DataFrame, keys: list[str], exact_rows: int = stats.EXACT_ROWS) -> DataFrame:
    """The three tests' findings and both sides' deciles for every key."""
    q = sized(stats.deciles(pairs, [*keys, "side"]), "pair-deciles")
    sides = q.groupBy(*keys).agg(*[F.max(F.when(F.col("side") == s, F.col("deciles"))).alias(f"{s}_deciles") for s in ("cand", "targ")])
    return stats.decide(pairs, keys, exact_rows=exact_rows, half=q.withColumn("median", F.col("deciles")[4])).join(sides, keys, "left").select(*keys, *FOUND)


def unambiguous_pass(sample: DataFrame, classified: DataFrame, exact_rows: int = stats.EXACT_ROWS) -> DataFrame:
    """Candidates against the dominant unit; fewer than two rows on a side is SKIP."""
    own = sized(classified.filter("category = 'UNAMBIGUOUS'").select("test", F.col("dominant").alias("unit"), F.col("share").alias("unit_prevalence")), "dominant-units")
    verdict = compared(stage(paired(sample, own), "unit-pairs"), ["test", "unit"], exact_rows)
    skip = (F.col("n_cand") < 2) | (F.col("n_targ") < 2) | F.col("n_cand").isNull()
    return own.join(verdict, ["test", "unit"], "left").withColumn("status", F.when(skip, "SKIP").otherwise(F.col("verdict")))


def ambiguous_pass(sample: DataFrame, classified: DataFrame, top: DataFrame, min_rows: int = 30, min_pct: float = 1.0, gain: float = 0.15) -> DataFrame:
    """Best unit of each ambiguous test, for the whole sample or for its two halves, with everything that led to it.

    The halves are cut at the crossing of the better two-component mixture (linear or logarithmic); they count if they fit
    different units clearly better, or if no unit fits the whole and the sample is bimodal.  A half of one row is left out.  Shape,
    separator and overlap are null where a unit already fits the whole and decides (status "skipped").
    """
    top, tests = sized(top, "unit-shares"), sized(classified.filter("category = 'AMBIGUOUS'").select("test"), "ambiguous-tests")
    units = top.join(tests, "test", "left_semi").filter((F.col("pct") > min_pct) & (F.col("cnt") >= min_rows)).select("test", "unit", "pct")
    cand = sample.filter("side = 'cand'").join(tests, "test", "left_semi")
    shape = stage(stats.bimodal_check(cand, ["test"]).select("test", F.col("separator").alias("cutoff"), "shape", "bc", "dip", "dip_p", "overlap_pct"), "sample-shapes")
    sub = cand.join(shape.select("test", "cutoff"), "test").withColumn("sub", F.explode(F.array(F.lit("all"), F.when(F.col("value") <= F.col("cutoff"), "low").otherwise("high"))))
    enough = sized(sub.groupBy("test", "sub").agg(F.count("*").alias("k")).filter("k >= 2").select("test", "sub"), "sample-halves")
    left = sub.select("test", "sub", "value").join(enough, ["test", "sub"], "left_semi").join(units.select("test", "unit"), "test").select("test", "sub", "unit", F.lit("cand").alias("side"), "value")
    right = sample.filter("side = 'targ'").join(units.select("test", "unit"), ["test", "unit"]).join(enough, "test").select("test", "sub", "unit", "side", "value")
    pairs = stage(left.unionByName(right), "unit-samples")
    verdict = stage(compared(pairs, ["test", "sub", "unit"]).join(units, ["test", "unit"]), "unit-verdicts")
    score = stats.split_score(verdict.select("test", "sub", "unit", "ks", F.col("n_cand").alias("n")), ["test"]).join(shape, "test", "left")
    whole = verdict.groupBy("test").agg(F.bool_or((F.col("sub") == "all") & (F.col("verdict") == "PASS")).alias("any_pass"), F.bool_or(F.col("sub") != "all").alias("has_part"))
    prefer = F.coalesce((F.col("improvement") > gain) & ~F.col("same_unit"), F.lit(False))
    halves = prefer | (~F.col("any_pass") & (F.col("shape") != "unimodal"))
    skipped = F.col("any_pass") & ~prefer
    status = F.when(skipped, "skipped").when(F.col("shape") != "unimodal", F.col("shape")).when(prefer, "split_by_score").otherwise(F.col("shape"))
    seen = [F.when(~skipped, F.col(c)).alias(n) for c, n in (("cutoff", "separator"), ("bc", "bc"), ("dip_p", "dip_p"), ("overlap_pct", "overlap_pct"))]
    plan = whole.join(score, "test", "left").select("test", "cutoff", (halves & F.col("has_part")).alias("split"), status.alias("status"), *seen, F.col("ks_all").alias("score_global"), F.col("ks_split").alias("score_split"), F.col("improvement").alias("score_improvement"))
    rows = verdict.join(plan, "test").filter(F.col("split") == (F.col("sub") != "all"))
    quality = F.when(F.col("decided_by") == "KS", 0).when(F.col("decided_by") == "T", 1).otherwise(2) + F.when(F.col("verdict") == "PASS", 0).otherwise(3)
    w = Window.partitionBy("test", "sub").orderBy(quality, "ks", F.desc("pct"), "unit")
    best = rows.withColumn("rn", F.row_number().over(w)).filter("rn = 1").join(prevalence_text(top).select("test", F.col("units").alias("prevalence")), "test", "left")
    cutoff = F.when(F.col("sub") == "low", F.col("cutoff")).otherwise(F.lit(float("inf"))).alias("cutoff")
    return best.select("test", "status", "separator", "bc", "dip_p", "overlap_pct", "score_global", "score_split", "score_improvement", "sub", "unit", F.col("pct").alias("unit_prevalence"), "prevalence", *FOUND, cutoff)


def unified(*parts: DataFrame) -> DataFrame:
    """One result table of several passes, with a note on splits."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    note = F.when(F.col("sub") == "low", F.format_string("value <= %s", F.col("cutoff").cast("string"))).when(F.col("sub") == "high", F.lit("above the lower part"))
    return out.withColumns({"cutoff": F.coalesce("cutoff", F.lit(float("inf"))), "note": note})
