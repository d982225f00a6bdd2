"""Queries of joins, duplicates, aggregates, windows, statistics and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import audit, dedup, limits, pheno, qc, release, stats, units
from ..sources import readers
from ..sources.staging import stage
from .measurements import M_SQL, inline, measurements, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def _log10(p: str) -> str:
    """-log10 of a p-value (as ``_p`` has it) in SQL, to four decimals."""
    p = p.removeprefix("round(").removesuffix(", 6)")
    return f"round(least(300.0, CASE WHEN {p} > 0 THEN -log10({p}) ELSE 300.0 END), 4)"


def r6(*columns: str):
    return {c: F.round(c, 6) for c in columns}


# ------------------------------------------------------------------------------------------------ limits
CODED = "CASE outcome WHEN 'R' THEN CASE WHEN line_no % 2 = 0 THEN 'L' ELSE 'H' END WHEN 'A' THEN CASE WHEN line_no = 7 THEN NULL ELSE 'N' END ELSE 'N' END"


def _walk_sql(low: bool, t: float) -> str:
    num, den = ("'A','AA','L','LL'", "'A','AA','L','LL','N','H','HH'") if low else ("'A','AA','H','HH'", "'A','AA','H','HH','N','L','LL'")
    d = "" if low else " DESC"
    s = "low" if low else "high"
    return f"""w_{s} AS (SELECT concept, value, o, row_number() OVER w AS rn, count(*) OVER (PARTITION BY concept) AS n, sum(CASE WHEN o IN ({num}) THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) / (sum(CASE WHEN o IN ({den}) THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) + 0.0001) AS ratio
 FROM c WINDOW w AS (PARTITION BY concept ORDER BY value{d}, o)), k_{s} AS (SELECT * FROM w_{s} WHERE rn <= floor(n * 0.5)),
 l_{s} AS (SELECT concept, CASE WHEN coalesce(arg_max(ratio, rn) FILTER (WHERE o <> 'NA') <= {t}, true) THEN arg_max(value, rn) FILTER (WHERE o <> 'NA' AND ratio > {t}) ELSE arg_max(value, rn) END AS {s}, NOT coalesce(arg_max(ratio, rn) FILTER (WHERE o <> 'NA') <= {t}, true) AS {s}_problem FROM k_{s} GROUP BY concept)"""


def _limits_sql(t: float) -> str:
    return f"WITH {M_SQL}, c AS (SELECT concept, value, coalesce({CODED}, 'NA') AS o FROM m), {_walk_sql(True, t)}, {_walk_sql(False, t)}, lim AS (SELECT a.concept, n_rows, low, low_problem, high, high_problem FROM (SELECT concept, count(*) AS n_rows FROM c GROUP BY 1) a LEFT JOIN l_low USING (concept) LEFT JOIN l_high USING (concept))"


def _coded(spark, sf_dir):
    return measurements(spark, sf_dir).withColumn("outcome", F.expr(CODED))


@query("abnormal_limits", _limits_sql(0.2) + " SELECT * FROM lim")
def abnormal_limits(spark, sf_dir):
    return limits.walk_limits(_coded(spark, sf_dir), 0.2)


#: Rows from which a concept takes the strict limits, so that both kinds occur at every size of the tables.
MANY = 150


def _choice_sql() -> str:
    """``ch``: concept, low, low_problem, high, high_problem by strict (0.3) and loose (0.2) limits."""
    both = [_limits_sql(t).removeprefix(f"WITH {M_SQL}, c AS (SELECT concept, value, coalesce({CODED}, 'NA') AS o FROM m), ") for t in (0.3, 0.2)]
    for word in ("w_low", "w_high", "k_low", "k_high", "l_low", "l_high", "lim"):
        both[1] = both[1].replace(f"{word} ", f"{word}2 ")

    def pick(side: str, none: str) -> str:
        use = f"(s.n_rows > {MANY} OR coalesce(o.{side}_problem, false))"
        return f"coalesce(CASE WHEN {use} THEN s.{side} ELSE o.{side} END, '{none}'::DOUBLE) AS {side}, coalesce(CASE WHEN {use} THEN s.{side}_problem ELSE o.{side}_problem END, false) AS {side}_problem"

    return f"WITH {M_SQL}, c AS (SELECT concept, value, coalesce({CODED}, 'NA') AS o FROM m), {both[0]}, {both[1]}, ch AS (SELECT concept, {pick('low', '-inf')}, {pick('high', 'inf')} FROM lim s JOIN lim2 o USING (concept))"


@query("impute_outcome", _choice_sql() + """ SELECT m.concept, CASE WHEN value BETWEEN low AND high THEN 'N' WHEN value > high THEN CASE WHEN high_problem THEN 'H*' ELSE 'H' END WHEN value < low THEN CASE WHEN low_problem THEN 'L*' ELSE 'L' END END AS imputed_outcome, count(*) AS n_rows FROM m JOIN ch USING (concept) GROUP BY ALL""")
def impute_outcome(spark, sf_dir):
    df = _coded(spark, sf_dir)
    chosen = limits.choose_limits(limits.walk_limits(df, 0.3), limits.walk_limits(df, 0.2), MANY)
    out = qc.impute_outcome(df.withColumn("merged_value", F.col("value")), chosen)
    return out.groupBy("concept", "imputed_outcome").agg(F.count("*").alias("n_rows"))


@query("percentile_limits", f"WITH {M_SQL} SELECT concept, round(quantile_cont(value, 0.95) FILTER (WHERE {CODED} = 'L'), 6) AS low_p95, round(quantile_cont(value, 0.05) FILTER (WHERE {CODED} = 'H'), 6) AS high_p05 FROM m GROUP BY 1")
def percentile_limits(spark, sf_dir):
    return limits.percentile_limits(_coded(spark, sf_dir)).withColumns(r6("low_p95", "high_p05"))


# ------------------------------------------------------------------------------------------------ duplicates, order
@query("keyed_dedup", "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def keyed_dedup(spark, sf_dir):
    return dedup.keyed_dedup(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), ["user_id", "event_type"])


_ADJ = "f AS (SELECT event_id, user_id % 3 AS g, event_type, coalesce(lag(event_id) OVER (PARTITION BY user_id % 3, event_type ORDER BY event_id) + 1 = event_id, false) AS duplicate FROM events)"


def _adjacent(spark, sf_dir):
    return dedup.adjacent_flags(table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 3).alias("g"), "event_type"), ["g", "event_type"], "event_id")


@query("adjacent_dedup", f"WITH {_ADJ} SELECT event_id, g, event_type FROM f WHERE NOT duplicate")
def adjacent_dedup(spark, sf_dir):
    return dedup.split_duplicates(_adjacent(spark, sf_dir))[0]


@query("dup_rate", f"WITH {_ADJ} SELECT count(*) AS n_rows, count(*) FILTER (WHERE duplicate) AS n_duplicates, round(100.0 * count(*) FILTER (WHERE duplicate) / count(*), 4) AS percent FROM f")
def dup_rate(spark, sf_dir):
    return dedup.duplicate_rate(_adjacent(spark, sf_dir))


@query("sorted_dedup", "WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber = 7 AS bad FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY bad, l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) AS k FROM l) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN bad THEN 'malformed' WHEN k = 1 THEN 'unique' ELSE 'duplicate' END AS part FROM n")
def sorted_dedup(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_linenumber") == 7, "line").alias("bad"))
    parts = dedup.sorted_dedup(line, ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"], "bad")
    return reduce(DataFrame.unionByName, [p.drop("bad").withColumn("part", F.lit(name)) for p, name in zip(parts, ("unique", "duplicate", "malformed"), strict=True)])


@query("row_numbers", "SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS row_id FROM orders")
def row_numbers(spark, sf_dir):
    return dedup.number_rows(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"]).select("o_orderkey", "row_id")


@query("order_check", "WITH e AS (SELECT event_id, user_id % 4 AS f, event_id AS i, CASE WHEN event_id % 97 = 0 THEN event_id - 50 ELSE event_id END AS id FROM events), g AS (SELECT *, lag(id) OVER (PARTITION BY f ORDER BY i) AS p FROM e), h AS (SELECT f, min(id) AS lo, lag(max(id)) OVER (ORDER BY f) AS p FROM e GROUP BY f) SELECT f, i, id, p AS previous FROM g WHERE id <= p UNION ALL SELECT f, -1, lo, p FROM h WHERE lo <= p")
def order_check(spark, sf_dir):
    df = table(spark, sf_dir, "events").select((F.col("user_id") % 4).alias("f"), F.col("event_id").alias("i"), F.when(F.col("event_id") % 97 == 0, F.col("event_id") - 50).otherwise(F.col("event_id")).alias("id"))
    return dedup.order_breaks(df, "f", "i", "id")


@query("limit_by_group", "SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) <= 5")
def limit_by_group(spark, sf_dir):
    return dedup.limit_by_group(table(spark, sf_dir, "events").select("event_type", "event_id"), ["event_type"], 5, "event_id")


@query("random_keys", "SELECT DISTINCT user_id FROM events ORDER BY md5(CAST(user_id AS VARCHAR)), user_id LIMIT 10")
def random_keys(spark, sf_dir):
    return dedup.random_keys(table(spark, sf_dir, "events"), "user_id", 10)


@query("top_counts", "SELECT user_id, count(*) AS n_rows FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_counts(spark, sf_dir):
    return dedup.top_by_count(table(spark, sf_dir, "events"), "user_id", 10)


@query("rank_sample", "WITH r AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1 AS rank, count(*) OVER (PARTITION BY event_type) AS n FROM events) SELECT event_type, event_id, value, rank FROM r WHERE rank IN (SELECT CAST(floor(i * (n - 1) / 9) AS BIGINT) FROM range(10) AS t(i))")
def rank_sample(spark, sf_dir):
    return dedup.rank_sample(table(spark, sf_dir, "events").select("event_type", "event_id", "value"), ["event_type"], "value", "event_id")


@query("set_operations", "SELECT 'except' AS op, count(*) AS n FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders) UNION ALL SELECT 'union', count(*) FROM (SELECT c_custkey FROM customer UNION ALL SELECT o_custkey FROM orders)")
def set_operations(spark, sf_dir):
    a, b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    parts = [(name, df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n")) for name, df in (("except", a.subtract(b)), ("intersect", a.intersect(b)), ("union", a.unionByName(b)))]
    return parts[0][1].unionByName(parts[1][1]).unionByName(parts[2][1])


# ------------------------------------------------------------------------------------------------ intake joins
def _pairs(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    main = conv.filter("role = 'user'").select("conv_id", "turn", F.length("text").alias("size"))
    free = conv.filter("role <> 'user'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.length("text").alias("size"))
    return main.withColumnsRenamed({"conv_id": "pair_id", "turn": "row_no"}), free.withColumnsRenamed({"conv_id": "pair_id", "turn": "row_no"})


_ZIP = "z AS (SELECT coalesce(a.conv_id, b.conv_id) AS pair_id, coalesce(a.turn, b.turn - 1) AS row_no, length(a.text) AS s1, length(b.text) AS s2 FROM (SELECT * FROM conversations WHERE role = 'user') a FULL JOIN (SELECT * FROM conversations WHERE role <> 'user') b ON a.conv_id = b.conv_id AND a.turn = b.turn - 1)"


@query("zip_join", f"WITH {_ZIP} SELECT pair_id, row_no, s1 AS main_size, s2 AS free_size FROM z")
def zip_join(spark, sf_dir):
    z = readers.zip_join(*_pairs(spark, sf_dir))
    return z.select("pair_id", "row_no", F.col("`main.size`").alias("main_size"), F.col("`freetext.size`").alias("free_size"))


@query("merge_check", f"WITH {_ZIP} SELECT count(*) AS n_rows, count(*) FILTER (WHERE s1 IS NULL OR s2 IS NULL) AS n_without_id, count(*) FILTER (WHERE s1 IS DISTINCT FROM s2) AS differs_size FROM z")
def merge_check(spark, sf_dir):
    return readers.merge_check(readers.zip_join(*_pairs(spark, sf_dir)), ["size"])


@query("left_dim", "SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON o_custkey = c_custkey")
def left_dim(spark, sf_dir):
    dim = table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return readers.left_dimension(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), dim, "o_custkey").select("o_orderkey", "c_mktsegment")


@query("rollup_reports", "WITH c AS (SELECT conv_id, role, string_agg(text, '::' ORDER BY turn) AS t, count(*) AS n FROM conversations GROUP BY 1, 2) SELECT conv_id, role, md5(CASE WHEN n > 1 THEN concat('HUOM::', n, '::', t) ELSE t END) AS report, n AS n_parts FROM c")
def rollup_reports(spark, sf_dir):
    return readers.roll_up_reports(table(spark, sf_dir, "conversations"), ["conv_id", "role"], "turn", "text").withColumn("report", F.md5("report"))


# ------------------------------------------------------------------------------------------------ release
@query("release_core", f"WITH {M_SQL} SELECT order_id AS \"ROW_ID\", CAST(person AS VARCHAR) AS \"PERSON_ID\", test AS \"TEST_NAME\", CASE WHEN concept > 1 THEN CAST(concept AS VARCHAR) END AS \"OMOP_CONCEPT_ID\", CASE WHEN line_no > 3 THEN value END AS \"MEASUREMENT_VALUE_HARMONIZED\" FROM m")
def release_core(spark, sf_dir):
    m = measurements(spark, sf_dir).select(F.col("order_id").alias("row_id"), "person", "test", F.when(F.col("concept") == 1, -1).otherwise(F.col("concept")).alias("concept"), F.when(F.col("line_no") > 3, F.col("value").cast("string")).otherwise("NA").alias("harm_value"))
    return release.project(m).select("ROW_ID", "PERSON_ID", "TEST_NAME", "OMOP_CONCEPT_ID", "MEASUREMENT_VALUE_HARMONIZED")


@query("null_report", "SELECT 'a' AS \"column\", count(*) FILTER (WHERE user_id % 3 = 0) AS n_null, round(100.0 * count(*) FILTER (WHERE user_id % 3 = 0) / count(*), 2) AS percent FROM events UNION ALL SELECT 'event_id', 0, 0.0 FROM (SELECT 1)")
def null_report(spark, sf_dir):
    return audit.null_report(table(spark, sf_dir, "events").select("event_id", F.when(F.col("user_id") % 3 != 0, F.col("value")).alias("a")))


@query("release_summary", f"WITH {M_SQL} SELECT 'rows' AS metric, count(*) AS n FROM m UNION ALL SELECT 'persons', count(DISTINCT person) FROM m UNION ALL SELECT 'concepts', count(DISTINCT concept) FROM m")
def release_summary(spark, sf_dir):
    return audit.release_summary(measurements(spark, sf_dir))


@query("concept_counts", f"WITH {M_SQL}, a AS (SELECT CAST(concept AS VARCHAR) AS concept, person, CASE WHEN line_no > 2 THEN value END AS v, line_no % 2 AS b FROM m) SELECT concept, count(DISTINCT person) AS persons, count(*) AS n_rows, count(v) AS n_v, count(*) FILTER (WHERE b = 0) AS zero_b FROM a GROUP BY 1 UNION ALL SELECT 'ALL', count(DISTINCT person), count(*), count(v), count(*) FILTER (WHERE b = 0) FROM a")
def concept_counts(spark, sf_dir):
    df = measurements(spark, sf_dir).select("concept", "person", F.when(F.col("line_no") > 2, F.col("value")).alias("v"), (F.col("line_no") % 2).alias("b"))
    return audit.concept_counts(df, ["v"], ["b"])


_YEARS = "y AS (SELECT o_custkey AS person, o_orderpriority AS concept, year(o_orderdate) AS yr FROM orders), a AS (SELECT concept, count(*) AS n_rows, count(DISTINCT person) AS people FROM y WHERE yr >= 1995 GROUP BY 1), b AS (SELECT concept, count(*) AS n_rows, count(DISTINCT person) AS people FROM y WHERE yr < 1995 GROUP BY 1)"


def _years(spark, sf_dir):
    y = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("person"), F.col("o_orderpriority").alias("concept"), F.year("o_orderdate").alias("yr"))
    return [y.filter(part).groupBy("concept").agg(F.count("*").alias("n_rows"), F.count_distinct("person").alias("people")) for part in ("yr >= 1995", "yr < 1995")], y


@query("version_compare", f"WITH {_YEARS} SELECT a.concept, a.n_rows, a.people, round(a.n_rows / b.n_rows, 3) AS n_rows_ratio, round(a.people / b.people, 3) AS people_ratio, (SELECT round(sum(n_rows) / (SELECT sum(n_rows) FROM b), 3) FROM a) AS growth FROM a LEFT JOIN b USING (concept)")
def version_compare(spark, sf_dir):
    (new, old), _ = _years(spark, sf_dir)
    return audit.version_compare(new, old, "concept", ["n_rows", "people"])


@query("appeared_ids", f"WITH {_YEARS} SELECT person, 'APPEARED' AS change FROM (SELECT person FROM y WHERE yr >= 1995 EXCEPT SELECT person FROM y WHERE yr < 1995) UNION ALL SELECT person, 'DISAPPEARED' FROM (SELECT person FROM y WHERE yr < 1995 EXCEPT SELECT person FROM y WHERE yr >= 1995)")
def appeared_ids(spark, sf_dir):
    _, y = _years(spark, sf_dir)
    return audit.appeared(y.filter("yr >= 1995"), y.filter("yr < 1995"), "person")


@query("dict_diff", "WITH a AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN upper(p_type) ELSE p_type END AS v FROM part WHERE p_partkey % 7 <> 0), b AS (SELECT p_partkey AS k, p_type AS v FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 5 <> 1) SELECT k, a.v AS new, b.v AS old, CASE WHEN b.v IS NULL THEN 'NEW' WHEN a.v IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change FROM a FULL JOIN b USING (k) WHERE a.v IS DISTINCT FROM b.v")
def dict_diff(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.concat("p_type", F.lit("")).alias("v"))
    return audit.dictionary_diff(p.filter("k % 7 <> 0").withColumn("v", F.when(F.col("k") % 5 == 0, F.concat(F.lower("v"), F.lit("x"))).otherwise(F.col("v"))), p.filter("k % 11 <> 0 AND k % 5 <> 1"), "k", "v")


SQL["dict_diff"] = SQL["dict_diff"].replace("upper(p_type)", "concat(lower(p_type), 'x')")


@query("reconcile", f"WITH {_YEARS} SELECT a.concept, a.n_rows, a.people, round(a.n_rows / b.n_rows, 3) AS rows_ratio, round(a.people / b.people, 3) AS people_ratio, b.n_rows IS NULL AS is_new, CASE WHEN b.n_rows IS NOT NULL THEN 'kept' END AS note FROM a LEFT JOIN (SELECT * FROM b WHERE concept <> '2-HIGH') b USING (concept)")
def reconcile(spark, sf_dir):
    (new, old), _ = _years(spark, sf_dir)
    return audit.reconcile(new, old.filter("concept <> '2-HIGH'").withColumn("note", F.lit("kept")), ["concept"])


@query("affected_tests", f"WITH {M_SQL}, c AS (SELECT test, count(*) AS n_rows FROM m GROUP BY 1) SELECT test, 'NEW' AS change, n_rows, test IN ('SMALL', 'LARGE') AS already_mapped FROM c WHERE test <> 'PROMO'")
def affected_tests(spark, sf_dir):
    counts = measurements(spark, sf_dir).groupBy("test").agg(F.count("*").alias("n_rows"))
    diff = counts.filter("test <> 'PROMO'").select("test", F.lit("NEW").alias("change"))
    return audit.affected_tests(diff, counts, counts.filter("test IN ('SMALL', 'LARGE')"), "test").select("test", "change", "n_rows", "already_mapped")


@query("unmapped_counts", f"WITH {M_SQL} SELECT test, unit, count(*) AS n_rows, test IN ('SMALL', 'LARGE') AS test_mapped FROM m WHERE concept > 10 GROUP BY 1, 2 HAVING count(*) >= 20")
def unmapped_counts(spark, sf_dir):
    m = measurements(spark, sf_dir).withColumn("concept", F.when(F.col("concept") <= 10, F.col("concept")))
    return audit.unmapped_counts(m, m.filter("test IN ('SMALL', 'LARGE')"), 20)


@query("text_counts", "SELECT lang, source, count(*) AS n_rows, count(DISTINCT doc_id % 40) AS people FROM documents WHERE regexp_matches(text, '(?i)idiot|license') GROUP BY 1, 2 HAVING count(DISTINCT doc_id % 40) >= 2")
def text_counts(spark, sf_dir):
    return audit.text_counts(table(spark, sf_dir, "documents").select("lang", "source", "text", (F.col("doc_id") % 40).alias("person")), "(?i)idiot|license", ["lang", "source"], 2)


@query("reference_stats", f"WITH {M_SQL}, t AS (SELECT concept, unit, count(*) AS k FROM m GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY concept ORDER BY count(*) DESC, unit) = 1) SELECT concept, count(value) AS n_rows, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50, max(t.unit) AS top_unit FROM m JOIN t USING (concept) GROUP BY 1")
def reference_stats(spark, sf_dir):
    out = audit.reference_stats(measurements(spark, sf_dir))
    return out.select("concept", "n_rows", F.round(F.col("quantiles")[1], 6).alias("p10"), F.round(F.col("quantiles")[5], 6).alias("p50"), "top_unit")


@query("audit_candidates", f"WITH {M_SQL} SELECT test, unit, count(*) AS n_rows, round(quantile_cont(value, 0.5), 6) AS median FROM m WHERE concept > 25 GROUP BY 1, 2")
def audit_candidates(spark, sf_dir):
    m = measurements(spark, sf_dir).withColumn("harm_value", F.when(F.col("concept") <= 25, F.col("value")))
    return audit.candidates(m, ["test", "unit"]).select("test", "unit", "n_rows", F.round(F.col("quantiles")[5], 6).alias("median"))


# ------------------------------------------------------------------------------------------------ units
@query("unit_election", f"""WITH {M_SQL}, c AS (SELECT concept, CASE WHEN line_no % 2 = 0 THEN 'source' ELSE 'injected' END AS origin, CASE WHEN line_no = 3 THEN NULL ELSE unit END AS unit, count(*) AS k FROM m GROUP BY ALL),
 s AS (SELECT concept, origin, arg_min(unit, (-k, unit)) FILTER (WHERE unit IS NOT NULL) AS u, round(max(k) FILTER (WHERE unit IS NOT NULL) / sum(k), 4) AS share FROM c GROUP BY 1, 2)
 SELECT concept, a.u AS source_unit, a.share AS source_share, b.u AS injected_unit, b.share AS injected_share, coalesce(a.u, b.u) AS target_unit, CASE WHEN a.u <> b.u THEN 'DIFFERS' END AS note FROM (SELECT * FROM s WHERE origin = 'source') a FULL JOIN (SELECT * FROM s WHERE origin = 'injected') b USING (concept)""")
def unit_election(spark, sf_dir):
    df = measurements(spark, sf_dir).select("concept", F.lit("q").alias("quantity"), F.when(F.col("line_no") % 2 == 0, "source").otherwise("injected").alias("origin"), F.when(F.col("line_no") != 3, F.col("unit")).alias("unit"))
    return audit.elect_unit(df).drop("quantity")


_U = "u AS (SELECT test, concept, CASE WHEN line_no = 1 THEN NULL WHEN test = 'SMALL' THEN 'Brand#1' WHEN test = 'PROMO' THEN NULL ELSE unit END AS unit, value FROM m), tg AS (SELECT test, count(*) AS n_rows, min(concept) AS concept FROM u WHERE unit IS NULL AND value IS NOT NULL GROUP BY 1 HAVING count(*) > 10), pv AS (SELECT test, unit, cnt, rn, pct FROM (SELECT test, unit, count(*) AS cnt, row_number() OVER (PARTITION BY test ORDER BY count(*) DESC, unit) AS rn, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY test), 2) AS pct FROM u WHERE unit IS NOT NULL GROUP BY 1, 2) WHERE rn <= 3)"


def _u(spark, sf_dir):
    m = measurements(spark, sf_dir)
    unit = F.when((F.col("line_no") == 1) | (F.col("test") == "PROMO"), None).when(F.col("test") == "SMALL", "Brand#1").otherwise(F.col("unit"))
    return m.select("test", "concept", unit.alias("unit"), "value", F.lit(None).cast("double").alias("extracted"))


@query("unit_prevalence", f"WITH {M_SQL}, {_U} SELECT * FROM pv")
def unit_prevalence(spark, sf_dir):
    return units.prevalence(_u(spark, sf_dir)).select("test", "unit", "cnt", "rn", "pct")


@query("injection_targets", f"WITH {M_SQL}, {_U} SELECT * FROM tg")
def injection_targets(spark, sf_dir):
    return units.targets(_u(spark, sf_dir), 10)


@query("classify_tests", f"WITH {M_SQL}, {_U} SELECT tg.*, pv.unit AS dominant, pct AS share, CASE WHEN pct IS NULL THEN 'NO_DATA' WHEN pct >= 98 THEN 'UNAMBIGUOUS' ELSE 'AMBIGUOUS' END AS category FROM tg LEFT JOIN pv ON tg.test = pv.test AND rn = 1")
def classify_tests(spark, sf_dir):
    u = _u(spark, sf_dir)
    return units.classify(units.targets(u, 10), units.prevalence(u))


@query("category_summary", f"WITH {M_SQL}, {_U}, e AS (SELECT threshold, tg.*, CASE WHEN pct IS NULL THEN 'NO_DATA' WHEN pct >= threshold THEN 'UNAMBIGUOUS' ELSE 'AMBIGUOUS' END AS category FROM tg LEFT JOIN pv ON tg.test = pv.test AND rn = 1 CROSS JOIN (VALUES (95.0::DOUBLE), (98.0), (99.0), (100.0)) AS t(threshold)) SELECT threshold, category, count(*) AS tests, sum(n_rows)::BIGINT AS n_rows, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY threshold), 2) AS tests_pct, round(100.0 * sum(n_rows) / sum(sum(n_rows)) OVER (PARTITION BY threshold), 2) AS rows_pct FROM e GROUP BY 1, 2")
def category_summary(spark, sf_dir):
    u = _u(spark, sf_dir)
    return units.category_summary(units.targets(u, 10), units.prevalence(u))


@query("assignment_summary", f"WITH {M_SQL}, {_U}, r AS (SELECT tg.test, n_rows, CASE WHEN tg.test <> 'LARGE' THEN concept END AS concept, pv.unit FROM tg LEFT JOIN pv ON tg.test = pv.test AND rn = 1) SELECT s.subset, count(DISTINCT test) AS tests, count(DISTINCT CASE WHEN unit IS NOT NULL THEN test END) AS tests_assigned, sum(n_rows)::BIGINT AS n_rows, coalesce(sum(CASE WHEN unit IS NOT NULL THEN n_rows END), 0)::BIGINT AS rows_assigned FROM r JOIN (VALUES ('all'), ('mapped')) AS s(subset) ON s.subset = 'all' OR concept IS NOT NULL GROUP BY 1")
def assignment_summary(spark, sf_dir):
    c = classify_tests(spark, sf_dir)
    return units.assignment_summary(c.select("test", "n_rows", F.when(F.col("test") != "LARGE", F.col("concept")).alias("concept"), F.col("dominant").alias("unit")))


@query("coverage", "WITH e AS (SELECT DISTINCT c_custkey AS k FROM customer), g AS (SELECT DISTINCT o_custkey + 5 AS k FROM orders) SELECT (SELECT count(*) FROM e) AS expected, (SELECT count(*) FROM g) AS covered, (SELECT count(*) FROM e ANTI JOIN g USING (k)) AS missing, (SELECT count(*) FROM g ANTI JOIN e USING (k)) AS extra, (SELECT count(*) FROM e SEMI JOIN g USING (k)) AS overlap")
def coverage(spark, sf_dir):
    return units.coverage(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("test")), table(spark, sf_dir, "orders").select((F.col("o_custkey") + 5).alias("test")))


CONV = "('STANDARD', 'Brand#1', 'Brand#2', 1.0D), ('STANDARD', 'Brand#2', 'Brand#3', 1.0D), ('ECONOMY', 'Brand#1', 'Brand#2', 10.0D)"


def _concept_units(spark, sf_dir):
    mapping = table(spark, sf_dir, "part").select((F.col("p_size") * 10 + F.length("p_type")).alias("concept"), F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("quantity"), F.col("p_brand").alias("unit"))
    return units.concept_units(mapping.groupBy("concept", "unit").agg(F.min("quantity").alias("quantity")), inline(spark, CONV, "quantity, source_unit, target_unit, factor"))


@query("concept_unit_table", f"""WITH p AS (SELECT p_size * 10 + length(p_type) AS concept, p_brand AS unit, min(CASE WHEN p_type <> 'PROMO' THEN p_type END) AS quantity FROM part GROUP BY 1, 2),
 s AS (SELECT concept, max(quantity) AS quantity, count(DISTINCT unit) AS n_units, min(unit) AS c FROM p GROUP BY 1), v AS (SELECT * FROM (VALUES {CONV.replace('D)', ')')}) AS v(q, a, b, f)),
 pr AS (SELECT x.concept, coalesce(v1.f, 1 / v2.f) AS f FROM p x JOIN p y ON x.concept = y.concept AND x.quantity = y.quantity AND x.unit < y.unit LEFT JOIN v v1 ON v1.q = x.quantity AND v1.a = x.unit AND v1.b = y.unit LEFT JOIN v v2 ON v2.q = x.quantity AND v2.a = y.unit AND v2.b = x.unit),
 g AS (SELECT concept, bool_and(f IS NOT NULL) AS known, bool_and(coalesce(abs(f - 1) < 1e-9, false)) AS one FROM pr GROUP BY 1), st AS (SELECT concept, quantity, n_units, c, CASE WHEN quantity IS NULL THEN 'NO_QUANTITY' WHEN n_units <= 1 THEN 'SINGLE' WHEN one THEN 'EQUIVALENT' WHEN known THEN 'AMBIGUOUS' ELSE 'NO_CONV' END AS status FROM s LEFT JOIN g USING (concept)) SELECT concept, quantity, n_units, status, CASE WHEN status IN ('SINGLE', 'EQUIVALENT') THEN c END AS canonical FROM st""")
def concept_unit_table(spark, sf_dir):
    return _concept_units(spark, sf_dir)


# ------------------------------------------------------------------------------------------------ statistics
def _samples(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", F.when(F.col("user_id") % 3 == 0, "cand").otherwise("targ").alias("side"), "value")


_S = "s AS (SELECT event_type, CASE WHEN user_id % 3 = 0 THEN 'cand' ELSE 'targ' END AS side, value FROM events)"
_KS = "h AS (SELECT event_type, value, count(*) FILTER (WHERE side = 'cand') AS c, count(*) FILTER (WHERE side = 'targ') AS t FROM s GROUP BY 1, 2), d AS (SELECT event_type, sum(c) OVER w AS cc, sum(t) OVER w AS ct, sum(c) OVER (PARTITION BY event_type) AS n, sum(t) OVER (PARTITION BY event_type) AS m FROM h WINDOW w AS (PARTITION BY event_type ORDER BY value ROWS UNBOUNDED PRECEDING)), k AS (SELECT event_type, max(n)::BIGINT AS n_cand, max(m)::BIGINT AS n_targ, max(abs(cc / n - ct / m)) AS ks FROM d GROUP BY 1)"


def _p(d: str, n: str, m: str) -> str:
    size = f"sqrt({n} * {m} / ({n} + {m}))"
    lam = f"({d} * ({size} + 0.12 + 0.11 / {size}))"
    return f"round(CASE WHEN {lam} < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, (SELECT sum(2 * (CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * i * i * {lam} * {lam})) FROM range(1, 101) AS t(i)))) END, 6)"


@query("ks_test", f"WITH {_S}, {_KS} SELECT event_type, n_cand, n_targ, round(ks, 6) AS ks, {_p("ks", "n_cand", "n_targ")} AS ks_p FROM k")
def ks_test(spark, sf_dir):
    return stats.ks(_samples(spark, sf_dir), ["event_type"], exact_rows=0).withColumns(r6("ks", "ks_p"))


@query("ks_exact")
def ks_exact(spark, sf_dir):
    return stats.ks(_samples(spark, sf_dir), ["event_type"])


@query("ks_binned", f"WITH e AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1), s AS (SELECT v.event_type, CASE WHEN user_id % 3 = 0 THEN 'cand' ELSE 'targ' END AS side, least(floor((value - lo) / ((hi - lo) / 64)) + 1, 64) AS value FROM events v JOIN e USING (event_type)), {_KS} SELECT event_type, n_cand, n_targ, round(ks, 6) AS ks FROM k")
def ks_binned(spark, sf_dir):
    return stats.ks(stats.binned(_samples(spark, sf_dir), ["event_type"], 64, 100), ["event_type"]).select("event_type", "n_cand", "n_targ", F.round("ks", 6).alias("ks"))


@query("mad_test", f"WITH {_S}, md AS (SELECT event_type, quantile_cont(value, 0.5) FILTER (WHERE side = 'cand') AS a, quantile_cont(value, 0.5) FILTER (WHERE side = 'targ') AS b FROM s GROUP BY 1), dv AS (SELECT event_type, quantile_cont(abs(value - b), 0.5) AS d FROM s JOIN md USING (event_type) WHERE side = 'targ' GROUP BY 1) SELECT event_type, round(a, 6) AS median_cand, round(b, 6) AS median_targ, round(d, 6) AS mad_targ, abs(a - b) <= 3 * d AS mad_pass FROM md JOIN dv USING (event_type)")
def mad_test(spark, sf_dir):
    return stats.mad(_samples(spark, sf_dir), ["event_type"]).withColumns(r6("median_cand", "median_targ", "mad_targ"))


_W = "w AS (SELECT event_type, avg(value) FILTER (WHERE side = 'cand') AS m1, var_samp(value) FILTER (WHERE side = 'cand') / count(*) FILTER (WHERE side = 'cand') AS a, count(*) FILTER (WHERE side = 'cand') AS n1, avg(value) FILTER (WHERE side = 'targ') AS m2, var_samp(value) FILTER (WHERE side = 'targ') / count(*) FILTER (WHERE side = 'targ') AS b, count(*) FILTER (WHERE side = 'targ') AS n2 FROM s GROUP BY 1)"


@query("welch_stat", f"WITH {_S}, {_W} SELECT event_type, round((m1 - m2) / sqrt(a + b), 6) AS t, round((a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1)), 4) AS df FROM w")
def welch_stat(spark, sf_dir):
    return stats.welch(_samples(spark, sf_dir), ["event_type"]).select("event_type", F.round("t", 6).alias("t"), F.round("df", 4).alias("df"))


@query("welch_p")
def welch_p(spark, sf_dir):
    return stats.welch(_samples(spark, sf_dir), ["event_type"])


@query("bimodality", "WITH a AS (SELECT event_type, count(*) AS n, avg(value) AS mu FROM events GROUP BY 1), g AS (SELECT event_type, n, avg(pow(value - mu, 3)) / pow(avg(pow(value - mu, 2)), 1.5) AS g1, avg(pow(value - mu, 4)) / pow(avg(pow(value - mu, 2)), 2) - 3 AS g2 FROM events JOIN a USING (event_type) GROUP BY 1, 2) SELECT event_type, n, round((g1 * g1 + 1) / (g2 + 3.0 * (n - 1) * (n - 1) / ((n - 2) * (n - 3))), 6) AS bc FROM g")
def bimodality(spark, sf_dir):
    return stats.bimodality(table(spark, sf_dir, "events"), ["event_type"]).withColumns(r6("bc"))


@query("sigma_filter", "WITH a AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1) SELECT event_type, count(*) FILTER (WHERE abs(value - m) <= 3 * s) AS n_kept, round(100.0 * count(*) FILTER (WHERE abs(value - m) > 3 * s) / count(*), 4) AS rejected_pct FROM events JOIN a USING (event_type) GROUP BY 1")
def sigma_filter(spark, sf_dir):
    return stats.sigma_filter(table(spark, sf_dir, "events"), ["event_type"]).groupBy("event_type").agg(F.count_if("kept").alias("n_kept"), F.round(100 * F.count_if(~F.col("kept")) / F.count("*"), 4).alias("rejected_pct"))


@query("deciles", "SELECT event_type, round(quantile_cont(value, 0.1), 6) AS d1, round(quantile_cont(value, 0.5), 6) AS d5, round(quantile_cont(value, 0.9), 6) AS d9 FROM events GROUP BY 1")
def deciles(spark, sf_dir):
    return stats.deciles(table(spark, sf_dir, "events"), ["event_type"]).select("event_type", *[F.round(F.col("deciles")[i], 6).alias(n) for i, n in ((0, "d1"), (4, "d5"), (8, "d9"))])


@query("average_rank", "WITH h AS (SELECT event_type, value, count(*) AS k FROM events GROUP BY 1, 2) SELECT event_type, value, k, sum(k) OVER (PARTITION BY event_type)::BIGINT AS n, sum(k) OVER (PARTITION BY event_type ORDER BY value ROWS UNBOUNDED PRECEDING) - (k - 1) / 2 AS rank FROM h")
def average_rank(spark, sf_dir):
    return stats.average_rank(table(spark, sf_dir, "events"), "value", ["event_type"])


@query("rint")
def rint(spark, sf_dir):
    return stats.inverse_normal(table(spark, sf_dir, "events"), "value", ["event_type"])


@query("mixture")
def mixture(spark, sf_dir):
    return stats.mixture(table(spark, sf_dir, "events"), ["event_type"], log10=True)


@query("bimodal_check")
def bimodal_check(spark, sf_dir):
    return stats.bimodal_check(measurements(spark, sf_dir), ["test"])


_SPLIT = f"""s AS (SELECT test AS t0, unit AS u0, unnest(['all', CASE WHEN line_no <= 3 THEN 'low' ELSE 'high' END]) AS sub, CASE WHEN order_id % 2 = 0 THEN 'cand' ELSE 'targ' END AS side, value FROM m),
 hk AS (SELECT t0, u0, sub, value, count(*) FILTER (WHERE side = 'cand') AS c, count(*) FILTER (WHERE side = 'targ') AS t FROM s GROUP BY ALL), dk AS (SELECT t0, u0, sub, sum(c) OVER w AS cc, sum(t) OVER w AS ct, sum(c) OVER (PARTITION BY t0, u0, sub) AS n, sum(t) OVER (PARTITION BY t0, u0, sub) AS m FROM hk WINDOW w AS (PARTITION BY t0, u0, sub ORDER BY value ROWS UNBOUNDED PRECEDING)),
 x AS (SELECT t0 AS test, u0 AS unit, sub, max(n) AS n, max(abs(cc / n - ct / m)) AS ks FROM dk WHERE n > 0 AND m > 0 GROUP BY ALL)"""


@query("split_score", f"WITH {M_SQL}, {_SPLIT}, b AS (SELECT test, sub, min(ks) AS ks, arg_min(unit, (ks, unit)) AS unit, max(n) AS n FROM x GROUP BY 1, 2), q AS (SELECT a.test, a.ks AS ks_all, (l.ks * l.n + h.ks * h.n) / (l.n + h.n) AS ks_split, l.unit = h.unit AS same_unit FROM b a JOIN b l ON a.test = l.test AND l.sub = 'low' JOIN b h ON a.test = h.test AND h.sub = 'high' WHERE a.sub = 'all') SELECT test, round(ks_all, 6) AS ks_all, round(ks_split, 6) AS ks_split, round(CASE WHEN ks_all > 0 THEN (ks_all - ks_split) / ks_all ELSE 0 END, 6) AS improvement, same_unit FROM q")
def split_score(spark, sf_dir):
    sub = F.explode(F.array(F.lit("all"), F.when(F.col("line_no") <= 3, "low").otherwise("high"))).alias("sub")
    m = measurements(spark, sf_dir).select("test", "unit", sub, F.when(F.col("order_id") % 2 == 0, "cand").otherwise("targ").alias("side"), "value")
    x = stats.ks(m, ["test", "unit", "sub"], exact_rows=0).select("test", "unit", "sub", "ks", F.col("n_cand").alias("n"))
    return stats.split_score(x, ["test"]).withColumns(r6("ks_all", "ks_split", "improvement"))


@query("unambiguous_pass")
def unambiguous_pass(spark, sf_dir):
    return _unambiguous(stage(_u(spark, sf_dir), "unit-rows"))


def _unambiguous(u):
    return units.unambiguous_pass(units.samples(u), units.classify(units.targets(u, 10), units.prevalence(u)))


@query("ambiguous_pass")
def ambiguous_pass(spark, sf_dir):
    return _ambiguous(stage(_u(spark, sf_dir), "unit-rows"))


def _ambiguous(u):
    top = units.prevalence(u)
    return units.ambiguous_pass(units.samples(u), units.classify(units.targets(u, 10), top), top)


@query("unharmonised_audit", f"WITH {M_SQL}, s AS (SELECT concept AS event_type, CASE WHEN unit = 'Brand#1' THEN 'cand' ELSE 'targ' END AS side, value FROM m), {_KS}, z AS (SELECT event_type AS concept, count(*) FILTER (WHERE side = 'cand') AS n_cand, count(*) FILTER (WHERE side = 'targ') AS n_targ FROM s GROUP BY 1), r AS (SELECT z.*, round(ks, 6) AS ks, CASE WHEN ks IS NOT NULL THEN {_p('ks', 'z.n_cand', 'z.n_targ')} END AS ks_p, CASE WHEN ks IS NOT NULL THEN {_log10(_p('ks', 'z.n_cand', 'z.n_targ'))} END AS ks_mlogp, CASE WHEN z.n_targ = 0 THEN 'NO_REF_DATA' WHEN least(z.n_cand, z.n_targ) < 10 THEN 'INSUFFICIENT_DATA' WHEN ks < 0.3 THEN 'SUCCESS' ELSE 'KS_FAIL' END AS status FROM z LEFT JOIN k ON z.concept = k.event_type WHERE z.n_cand > 0) SELECT r.*, CASE WHEN status = 'SUCCESS' THEN u.unit END AS proposed_unit FROM r LEFT JOIN (VALUES (1, 'g'), (2, 'mg')) AS u(concept, unit) USING (concept)")
def unharmonised_audit(spark, sf_dir):
    m = measurements(spark, sf_dir).select("concept", F.when(F.col("unit") == "Brand#1", "cand").otherwise("targ").alias("side"), "value")
    return audit.unharmonised_audit(m, ["concept"], inline(spark, "(1, 'g'), (2, 'mg')", "concept, target_unit"), exact_rows=0).withColumns(r6("ks", "ks_p") | {"ks_mlogp": F.round("ks_mlogp", 4)})


_RULES = "(1, 'SMALL', 'Brand#1'), (2, 'LARGE', 'Brand#9'), (3, 'NONE', 'Brand#1')"


@query("injection_audit", f"WITH {M_SQL}, f AS (SELECT rule, concept, value, count(*) AS c FROM m JOIN (VALUES {_RULES}) AS r(rule, t, u) ON test = t AND unit = u AND line_no > 1 GROUP BY ALL), g AS (SELECT DISTINCT rule, concept FROM f), w AS (SELECT concept, value, count(*) AS k FROM m GROUP BY ALL), x AS (SELECT g.rule, g.concept, w.value, coalesce(f.c, 0) AS c, k - coalesce(f.c, 0) AS t FROM g JOIN w USING (concept) LEFT JOIN f ON f.rule = g.rule AND f.concept = g.concept AND f.value = w.value), d AS (SELECT rule, concept, sum(c) OVER o AS cc, sum(t) OVER o AS ct, sum(c) OVER (PARTITION BY rule, concept) AS n, sum(t) OVER (PARTITION BY rule, concept) AS m FROM x WINDOW o AS (PARTITION BY rule, concept ORDER BY value ROWS UNBOUNDED PRECEDING)), k AS (SELECT rule, concept, max(n)::BIGINT AS n_rule, max(m)::BIGINT AS n_rest, max(abs(cc / n - ct / m)) AS ks FROM d GROUP BY 1, 2), a AS (SELECT r.rule, concept, n_rule, n_rest, ks, CASE WHEN ks IS NOT NULL THEN {_p('ks', 'n_rule', 'n_rest')} END AS p, CASE WHEN ks IS NOT NULL THEN {_log10(_p('ks', 'n_rule', 'n_rest'))} END AS mlogp, count(*) OVER () AS tests FROM (VALUES {_RULES}) AS r(rule, t, u) LEFT JOIN k USING (rule)) SELECT rule, concept, n_rule, n_rest, round(ks, 6) AS ks, p, mlogp, CASE WHEN n_rule IS NULL THEN 'NO_DATA' WHEN n_rest = 0 THEN 'NO_OMOP_DATA' WHEN p < 0.05 / tests THEN 'FAILED_KS' ELSE 'SUCCESS' END AS status FROM a")
def injection_audit(spark, sf_dir):
    m = measurements(spark, sf_dir).withColumn("fixed", F.col("line_no") > 1)
    return audit.injection_audit(m, inline(spark, _RULES, "rule, test, unit"), exact_rows=0).withColumns(r6("ks", "p") | {"mlogp": F.round("mlogp", 4)})


@query("extracted_audit", f"WITH {M_SQL}, a AS (SELECT concept, CASE WHEN line_no <= 2 THEN 'cand' ELSE 'targ' END AS side, value FROM m), g AS (SELECT concept, side, avg(value) AS mu, stddev_samp(value) AS sd FROM a GROUP BY 1, 2), s AS (SELECT concept AS event_type, side, value FROM a JOIN g USING (concept, side) WHERE abs(value - mu) <= 3 * sd OR coalesce(sd, 0) = 0), {_KS}, md AS (SELECT event_type, quantile_cont(value, 0.5) FILTER (WHERE side = 'cand') AS median_cand, quantile_cont(value, 0.5) FILTER (WHERE side = 'targ') AS median_targ, round(quantile_cont(value, 0.1) FILTER (WHERE side = 'cand'), 6) AS cand_d1, round(quantile_cont(value, 0.9) FILTER (WHERE side = 'targ'), 6) AS targ_d9 FROM s GROUP BY 1) SELECT event_type AS concept, n_cand, n_targ, round(ks, 6) AS ks, median_cand, median_targ, cand_d1, targ_d9, round(n_cand / n_targ, 4) AS n_ratio, row_number() OVER (ORDER BY round(ks, 9) DESC, event_type) AS rank FROM k JOIN md USING (event_type)")
def extracted_audit(spark, sf_dir):
    m = measurements(spark, sf_dir).select("concept", F.when(F.col("line_no") <= 2, "cand").otherwise("targ").alias("side"), "value")
    out = audit.extracted_audit(m).withColumns({"cand_d1": F.round(F.col("deciles_cand")[1], 6), "targ_d9": F.round(F.col("deciles_targ")[9], 6)})
    return out.drop("deciles_cand", "deciles_targ").withColumns(r6("ks"))


@query("audit_reference", f"WITH {M_SQL}, r AS (SELECT concept, count(value) AS ref_rows, quantile_cont(value, 0.5) AS ref_median FROM m WHERE line_no <= 3 GROUP BY 1), t AS (SELECT concept, unit FROM m WHERE line_no <= 3 GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY concept ORDER BY count(*) DESC, unit) = 1), c AS (SELECT concept, test, count(*) AS n_rows FROM m WHERE line_no > 3 GROUP BY 1, 2) SELECT c.*, ref_rows, t.unit AS ref_unit, round(ref_median, 6) AS ref_median, u.unit AS target_unit FROM c LEFT JOIN r USING (concept) LEFT JOIN t USING (concept) LEFT JOIN (VALUES (1, 'g'), (2, 'mg')) AS u(concept, unit) USING (concept)")
def audit_reference(spark, sf_dir):
    m = measurements(spark, sf_dir)
    found = audit.candidates(m.filter("line_no > 3").withColumn("harm_value", F.lit(None).cast("double")), ["concept", "test"])
    out = audit.with_reference(found, audit.reference_stats(m.filter("line_no <= 3")), inline(spark, "(1, 'g'), (2, 'mg')", "concept, target_unit"))
    return out.select("concept", "test", "n_rows", "ref_rows", "ref_unit", F.round(F.col("ref_quantiles")[5], 6).alias("ref_median"), "target_unit")


@query("units_json", f"WITH {M_SQL}, c AS (SELECT concept, unit, count(*) AS n FROM m GROUP BY 1, 2) SELECT concept, concat('{{', string_agg(concat('\"', unit, '\":', n), ',' ORDER BY unit), '}}') AS json FROM c GROUP BY 1")
def units_json(spark, sf_dir):
    counts = measurements(spark, sf_dir).groupBy("concept", "unit").agg(F.count("*").alias("n"))
    return audit.as_json(counts, ["concept"], "unit", "n")


@query("content_hash", "SELECT c_custkey, sha256(concat('{\"c_name\":\"', c_name, '\",\"c_mktsegment\":', CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE concat('\"', c_mktsegment, '\"') END, '}')) AS hash FROM customer")
def content_hash(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    return audit.content_hash(df, ["c_name", "c_mktsegment"]).select("c_custkey", "hash")


@query("multi_key_sort", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders ORDER BY o_orderpriority, o_custkey DESC, o_orderkey")
def multi_key_sort(spark, sf_dir):
    return dedup.sort_by(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), "o_orderpriority", "-o_custkey", "o_orderkey")


@query("left_reports", "SELECT o_orderkey, o_custkey, CASE WHEN c_custkey IS NULL THEN 'NA' ELSE coalesce(c_mktsegment, 'NA') END AS report FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON o_custkey = c_custkey")
def left_reports(spark, sf_dir):
    reports = table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("report"))
    return readers.left_reports(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), reports, ["o_custkey"])


@query("rule_vocabulary", "WITH v AS (SELECT lower(trim(p_type)) AS t, lower(trim(p_brand)) AS u, arg_min(p_name, p_partkey) AS name FROM part GROUP BY 1, 2), r AS (SELECT p_partkey AS rule, concat(' ', upper(p_type)) AS test, p_brand AS unit FROM part WHERE p_size <> 1) SELECT rule, test, unit, name FROM r LEFT JOIN v ON lower(trim(test)) = t AND lower(trim(unit)) = u")
def rule_vocabulary(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    rules = p.filter("p_size <> 1").select(F.col("p_partkey").alias("rule"), F.concat(F.lit(" "), F.upper("p_type")).alias("test"), F.col("p_brand").alias("unit"))
    words = p.select(F.col("p_type").alias("test"), F.col("p_brand").alias("unit"), F.col("p_name").alias("name"), F.col("p_partkey").alias("at"))
    return readers.rules_with_vocabulary(rules, words, "at").select("rule", "test", "unit", "name")


# ------------------------------------------------------------------------------------------------ phenotypes
@query("person_median", f"WITH {M_SQL} SELECT person, quantile_cont(value, 0.5) AS value, quantile_cont(line_no, 0.5) AS age, count(*) AS n_rows FROM m WHERE concept = 7 AND line_no > 1 GROUP BY 1")
def person_median(spark, sf_dir):
    m = measurements(spark, sf_dir).withColumns({"qc_pass": F.when(F.col("line_no") > 1, 1).otherwise(0), "age": F.col("line_no")})
    return pheno.person_median(m, 7)


@query("covariate_screen", f"WITH {M_SQL}, g AS (SELECT outcome, count(*) FILTER (WHERE concept <= 20 AND abs(tax) > 0) AS a, count(*) FILTER (WHERE concept <= 20 AND abs(discount) > 0) AS b FROM m GROUP BY 1) SELECT 'ph' AS phenotype, 'tax' AS covariate, min(a) AS n_least, min(a) >= 7000 AS usable FROM g UNION ALL SELECT 'ph', 'discount', min(b), min(b) >= 7000 FROM g")
def covariate_screen(spark, sf_dir):
    m = measurements(spark, sf_dir).withColumn("ph", F.when(F.col("concept") <= 20, F.col("value")))
    return pheno.covariate_screen(m, ["ph"], ["tax", "discount"], "outcome", 7000)


@query("binary_screen", f"WITH {M_SQL} SELECT 'b' AS covariate, count(*) FILTER (WHERE line_no % 2 = 0) AS zeros, count(*) FILTER (WHERE line_no % 2 = 1) AS ones, false AS quantitative, true AS usable FROM m UNION ALL SELECT 'value', count(*) FILTER (WHERE value = 0), count(*) FILTER (WHERE value = 1), true, true FROM m")
def binary_screen(spark, sf_dir):
    return pheno.binary_screen(measurements(spark, sf_dir).withColumn("b", F.col("line_no") % 2), ["b", "value"], 100)


REGIONS = "(0, 100, 3000, 'r1', 1), (0, 2000, 6000, 'r2', 2), (1, 0, 100000, 'r3', 3)"
_HITS = f"h AS (SELECT event_id AS hit, user_id % 3 AS chrom, event_id AS pos, value AS mlogp FROM events), j AS (SELECT hit, h.chrom, pos, mlogp, region FROM h JOIN (VALUES {REGIONS}) AS r(chrom, s, e, region, seq) ON h.chrom = r.chrom AND pos BETWEEN s AND e QUALIFY row_number() OVER (PARTITION BY hit ORDER BY seq) = 1)"


def _hits(spark, sf_dir):
    h = table(spark, sf_dir, "events").select(F.col("event_id").alias("hit"), (F.col("user_id") % 3).alias("chrom"), F.col("event_id").alias("pos"), F.col("value").alias("mlogp"))
    return pheno.region_hits(h, inline(spark, REGIONS, "chrom, start, end, region, seq"))


@query("region_hits", f"WITH {_HITS} SELECT region, count(*) AS n_hits FROM j GROUP BY 1")
def region_hits(spark, sf_dir):
    return _hits(spark, sf_dir).groupBy("region").agg(F.count("*").alias("n_hits"))


@query("region_top_hit", f"WITH {_HITS} SELECT region, hit, pos, mlogp FROM j QUALIFY row_number() OVER (PARTITION BY region ORDER BY mlogp DESC, hit) = 1")
def region_top_hit(spark, sf_dir):
    return pheno.best_hit(_hits(spark, sf_dir))


@query("running_ratio", "SELECT event_id, round(sum(CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END) OVER w / count(*) OVER w, 9) AS ratio FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)")
def running_ratio(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("user_id") % 2 == 0).alias("even"))
    return stats.running_ratio(df, ["event_type"], ["event_id"], "even").select("event_id", F.round("ratio", 9).alias("ratio"))


_PUBLISHED = "CAST(person AS VARCHAR) AS \"PERSON_ID\", test AS \"TEST_NAME\", CASE WHEN concept > 1 THEN CAST(concept AS VARCHAR) END AS \"OMOP_CONCEPT_ID\""


def _working(spark, sf_dir):
    m = measurements(spark, sf_dir)
    odd = F.col("line_no") % 2 == 1
    return m.select(
        F.col("order_id").alias("row_id"), "person", "test", F.when(F.col("concept") == 1, 0).otherwise(F.col("concept")).alias("concept"), F.concat(F.lit("T"), "line_no").alias("test_id"), F.when(odd, "1").otherwise("0").alias("is_national"), F.when(odd, F.col("unit")).otherwise("NA").alias("source_unit"),
        F.when(odd, F.col("value").cast("string")).otherwise("x").alias("range_low"), F.lit("F").alias("status"), F.col("unit").alias("clean_unit"), F.when(odd, F.col("value")).alias("extracted_value"), F.col("value").cast("string").alias("value"), F.lit("secret").alias("text"),
    )


@query("release_extended", f"WITH {M_SQL} SELECT order_id AS \"ROW_ID\", {_PUBLISHED}, concat('T', line_no) AS \"TEST_ID\", line_no % 2 = 1 AS \"TEST_ID_IS_NATIONAL\", CASE WHEN line_no % 2 = 1 THEN unit END AS \"MEASUREMENT_UNIT_SOURCE\", CASE WHEN line_no % 2 = 1 THEN value END AS \"REFERENCE_RANGE_LOWER_VALUE\" FROM m")
def release_extended(spark, sf_dir):
    out = release.project(release.without(_working(spark, sf_dir)), release.EXTENDED)
    return out.select("ROW_ID", "PERSON_ID", "TEST_NAME", "OMOP_CONCEPT_ID", "TEST_ID", "TEST_ID_IS_NATIONAL", "MEASUREMENT_UNIT_SOURCE", "REFERENCE_RANGE_LOWER_VALUE")


@query("release_munged", f"WITH {M_SQL} SELECT order_id AS \"ROW_ID\", {_PUBLISHED}, 'F' AS \"MEASUREMENT_STATUS\", 'secret' AS \"MEASUREMENT_FREE_TEXT\" FROM m")
def release_munged(spark, sf_dir):
    return release.project(release.last(_working(spark, sf_dir)), release.MUNGED).select("ROW_ID", "PERSON_ID", "TEST_NAME", "OMOP_CONCEPT_ID", "MEASUREMENT_STATUS", "MEASUREMENT_FREE_TEXT")


@query("release_units", f"WITH {M_SQL} SELECT test AS \"TEST_NAME\", CASE WHEN concept > 1 THEN CAST(concept AS VARCHAR) END AS \"OMOP_CONCEPT_ID\", unit AS \"MEASUREMENT_UNIT\", value AS \"MEASUREMENT_VALUE\", CASE WHEN line_no % 2 = 1 THEN value END AS \"MEASUREMENT_VALUE_EXTRACTED\" FROM m")
def release_units(spark, sf_dir):
    return release.project(_working(spark, sf_dir), release.UNITS_INPUT)


# ------------------------------------------------------------------------------------------------ smaller operators
@query("summary_statistics", "SELECT user_id % 3 AS chrom, event_id AS pos, 'A' AS ref, 'C' AS alt, value AS beta, value / 2 AS sebeta, 0.5::DOUBLE AS af, round(pow(10.0, -value / 100), 9) AS pval, value / 100 AS mlogp FROM events")
def summary_statistics(spark, sf_dir):
    df = table(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("chrom"), F.col("event_id").alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"), F.col("value").alias("beta"), (F.col("value") / 2).alias("sebeta"), F.lit(0.5).alias("af"), (F.col("value") / 100).alias("mlogp"))
    return pheno.summary_statistics(df).withColumn("pval", F.round("pval", 9))


@query("genomic_sort", "SELECT event_id, CAST(user_id % 22 AS VARCHAR) AS chrom FROM events ORDER BY user_id % 22, event_id")
def genomic_sort(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 22).cast("string").alias("chrom"))
    return dedup.genomic_sort(df, "chrom", "event_id")


@query("prevalence_text", f"WITH {M_SQL}, {_U} SELECT test, concat('{{', string_agg(concat(unit, ':', pct), ',' ORDER BY rn), '}}') AS units, arg_min(unit, rn) AS dominant, max(pct) AS share FROM pv GROUP BY 1")
def prevalence_text(spark, sf_dir):
    return units.prevalence_text(units.prevalence(_u(spark, sf_dir)))


@query("no_data_rescue", f"WITH {M_SQL}, {_U}, r AS (SELECT tg.* FROM tg LEFT JOIN pv ON tg.test = pv.test AND rn = 1 WHERE pct IS NULL) SELECT test, n_rows, r.concept, t.s AS status, CASE WHEN t.s IN ('SINGLE', 'EQUIVALENT') THEN t.u END AS unit FROM r LEFT JOIN (VALUES (1, 'SINGLE', 'mg'), (2, 'AMBIGUOUS', 'g')) AS t(c, s, u) ON r.concept = t.c")
def no_data_rescue(spark, sf_dir):
    none = classify_tests(spark, sf_dir).filter("category = 'NO_DATA'").select("test", "n_rows", "concept")
    return units.rescue(none, inline(spark, "(1, 'SINGLE', 'mg'), (2, 'AMBIGUOUS', 'g')", "concept, status, canonical")).select("test", "n_rows", "concept", "status", "unit")


@query("unified_results")
def unified_results(spark, sf_dir):
    u = stage(_u(spark, sf_dir), "unit-rows")
    return units.unified(_unambiguous(u).select("test", "unit", "ks", "status"), _ambiguous(u))


@query("decision")
def decision(spark, sf_dir):
    return stats.decide(_samples(spark, sf_dir), ["event_type"])


@query("first_per_key", "SELECT user_id, arg_min(event_type, event_id) AS event_type, min(event_id) AS event_id FROM events GROUP BY 1")
def first_per_key(spark, sf_dir):
    return readers.first_per_key(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), ["user_id"], "event_id")


@query("unit_log", "SELECT p_partkey AS row_id, CAST(NULL AS VARCHAR) AS event_datetime, p_type AS test, p_brand AS old, CASE WHEN p_size % 4 = 0 THEN lower(p_brand) WHEN p_size % 4 = 1 THEN NULL ELSE p_brand END AS new, 'regex' AS source FROM part WHERE p_size % 4 IN (0, 1)")
def unit_log(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.lit(None).cast("timestamp").alias("at"), F.col("p_type").alias("test"), "p_brand", F.when(F.col("p_size") % 4 == 0, F.lower("p_brand")).when(F.col("p_size") % 4 != 1, F.col("p_brand")).alias("fixed"))
    return readers.unit_log(p, "p_brand", "fixed", "regex", "p_partkey", "at")


@query("tidy_rows", f"WITH {_ZIP} SELECT z.pair_id, z.s1 AS size, z.s2 AS free_size, c_mktsegment AS sex FROM z LEFT JOIN customer ON z.pair_id = c_custkey AND c_custkey % 2 = 0")
def tidy_rows(spark, sf_dir):
    main, free = _pairs(spark, sf_dir)
    z = readers.zip_join(main, free.withColumnRenamed("size", "free_size")).withColumn("main.pair_id", F.col("pair_id"))
    rows = readers.consolidate(z, ["pair_id", "size"], ["free_size"])
    sex = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("pair_id"), F.col("c_mktsegment").alias("sex"))
    return readers.tidy(rows, sex, ["sex"], ["pair_id", "size", "free_size", "sex"], person="pair_id")


@query("phenotype_covariates", f"WITH {M_SQL}, p AS (SELECT person, quantile_cont(value, 0.5) AS value FROM m WHERE concept = 7 GROUP BY 1) SELECT person, value, c_acctbal AS covariate FROM p JOIN customer ON person = c_custkey")
def phenotype_covariates(spark, sf_dir):
    m = measurements(spark, sf_dir).withColumns({"qc_pass": F.lit(1), "age": F.col("line_no")})
    cov = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("person"), F.col("c_acctbal").alias("covariate"))
    return pheno.with_covariates(pheno.person_median(m, 7).select("person", "value"), cov)


@query("limit_choice", _choice_sql() + " SELECT * FROM ch")
def limit_choice(spark, sf_dir):
    df = _coded(spark, sf_dir)
    return limits.choose_limits(limits.walk_limits(df, 0.3), limits.walk_limits(df, 0.2), MANY)


@query("spreadsheet_text", "SELECT event_id, CASE WHEN user_id % 3 = 0 THEN concat('''=', event_type) ELSE event_type END AS text FROM events")
def spreadsheet_text(spark, sf_dir):
    raw = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("="), "event_type")).otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", audit.spreadsheet_safe(raw).alias("text"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, check, find limits, impute outcomes, and count per concept."""
    df = _coded(spark, sf_dir).withColumns({"merged_value": F.col("value"), "harm_value": F.col("value"), "extracted_value": F.lit(None).cast("double")})
    rules = inline(spark, "(1, 1, '<', 5.0D, 'low'), (2, 1, '>', 45.0D, 'high')", "concept, seq, side, limit, note")
    checked = qc.threshold_qc(qc.start(df), rules)
    strict, loose = limits.walk_limits(df, 0.99), limits.walk_limits(df, 0.95)
    out = qc.impute_outcome(checked, limits.choose_limits(strict, loose))
    return out.groupBy("concept", "qc_pass", "imputed_outcome").agg(F.count("*").alias("n_rows"), F.count_distinct("person").alias("persons"), F.round(F.avg("merged_value"), 6).alias("mean_value"))
