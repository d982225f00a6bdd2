"""Queries of formulas, job variants, elections, decisions, round trips through files and stored releases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit, clean, dedup, harmonise, jobs, stats, units
from ..sources import clustered, readers, split_scan
from ..sources.staging import scratch, stage
from . import aggregate_queries as aq
from . import job_queries as jq
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


# ------------------------------------------------------------------------------------------------ conversions
#: Formula text of each unit, and the same in SQL; the last two aren't formulas.
FORMULAS = (
    ("Brand#1", "(X-32)*0.5", "(v - 32) * 0.5"),
    ("Brand#2", "X*2+1", "v * 2 + 1"),
    ("Brand#3", "-2.15+0.0916*X", "-2.15 + 0.0916 * v"),
    ("Brand#4", "0,704*X", "0.704 * v"),
    ("Brand#5", "1e1*X-1", "10.0 * v - 1"),
    ("Brand#6", "-(X+1)/(X-20)", "CASE WHEN v <> 20 THEN -(v + 1) / (v - 20) END"),
    ("Brand#7", "2X", "NULL"),
    ("Brand#8", "eleven", "NULL"),
)
_SHAPES = "CASE unit " + " ".join(f"WHEN '{u}' THEN CAST({sql} AS DOUBLE)" for u, _, sql in FORMULAS) + " END"
_TEXTS = "CASE unit " + " ".join(f"WHEN '{u}' THEN '{text}'" for u, text, _ in FORMULAS) + " END"


@query("unit_formulas", f"WITH {M_SQL}, f AS (SELECT *, value::DOUBLE AS v, {_TEXTS} AS conversion, unit IN ('Brand#7', 'Brand#8') AS bad FROM m) SELECT order_id, line_no, unit, value, CASE WHEN conversion IS NOT NULL AND NOT bad THEN 'g' END AS harm_unit, CASE WHEN NOT bad THEN conversion END AS factor, round_even({_SHAPES}, 2) AS harm_value, CASE WHEN bad OR (conversion IS NOT NULL AND {_SHAPES} IS NULL) THEN conversion END AS failed FROM f")
def unit_formulas(spark, sf_dir):
    rows = ", ".join(f"('q', '{u}', 'g', '{text}', CAST(NULL AS INT))" for u, text, _ in FORMULAS)
    conversions = harmonise.conversion_table(inline(spark, rows, "quantity, source_unit, target_unit, conversion, only_concept"), inline(spark, "(1, 'q', 'g')", "concept, quantity, target_unit"))
    m = measurements(spark, sf_dir).withColumns({"concept": F.lit(1), "quantity": F.lit("q"), "clean_unit": F.col("unit")})
    return harmonise.convert(m, conversions, "failed").select("order_id", "line_no", "unit", "value", "harm_unit", "factor", "harm_value", "failed")


# ------------------------------------------------------------------------------------------------ jobs
@query("provider_map", f"WITH {jq._MUNGED} SELECT row_id, CASE WHEN p_size % 2 = 0 THEN 'y' ELSE concat('P', p_size) END AS provider FROM mu")
def provider_map(spark, sf_dir):
    raw = jq.raw(spark, sf_dir, provider="CASE WHEN p_size % 2 = 0 THEN 'x ' ELSE concat('P', p_size) END")
    return jobs.munge(raw, jq.dictionaries(spark), rebalance=True).rows.select("row_id", "provider")


@query("core_source_values", f"WITH {jq._CORE.replace('coalesce(harm_value, ex) AS m0', 'coalesce(harm_value, ex, CASE WHEN ln <> 4 THEN v END) AS m0')} SELECT row_id, concept, merged_value, qc_pass FROM z")
def core_source_values(spark, sf_dir):
    return jq.cored(spark, sf_dir, source_values=True).rows.select("row_id", "concept", "merged_value", "qc_pass")


@query("munge_account", f"WITH {jq._MUNGED} SELECT (SELECT count(*) FROM r) AS n_in, (SELECT count(*) FROM mu) AS n_out, (SELECT count(*) FROM r) - (SELECT count(*) FROM mu) AS n_quarantined, true AS balanced")
def munge_account(spark, sf_dir):
    return audit.job_account(jq.munged(spark, sf_dir).counts, spark)


@query("munge_trial", "SELECT least(count(*), 5000) AS n_in, true AS balanced FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey")
def munge_trial(spark, sf_dir):
    """A trial run is the operator: the job over its first rows."""
    return audit.job_account(jq.munged(spark, sf_dir, limit=5000).counts, spark).select("n_in", "balanced")


# ------------------------------------------------------------------------------------------------ elections
_REFERENCE = "(1, 'q', 'Brand#1', true), (2, 'q', 'Brand#2', false), (3, 'q', 'Brand#3', false), (4, 'q', 'odd', true)"


@query("unit_election_locked", f"""WITH {M_SQL}, c AS (SELECT concept, CASE WHEN line_no = 3 THEN 'NA' ELSE unit END AS source, CASE WHEN concept % 5 = 0 AND line_no < 4 THEN 'Brand#9' ELSE unit END AS injected, count(*) AS k FROM m WHERE concept > 0 GROUP BY ALL),
 e AS (SELECT concept, 'source' AS side, source AS u, sum(k) AS k FROM c GROUP BY ALL UNION ALL SELECT concept, 'injected', injected, sum(k) FROM c GROUP BY ALL),
 s AS (SELECT concept, side, coalesce(arg_min(u, (-k, u)) FILTER (WHERE u <> 'NA'), 'NA') AS u, concat('{{', string_agg(concat('''', u, ''': ', round(k / n, 4)), ', ' ORDER BY u), '}}') AS shares, any_value(n)::BIGINT AS n FROM (SELECT *, sum(k) OVER (PARTITION BY concept, side) AS n FROM e) GROUP BY 1, 2),
 j AS (SELECT a.concept, a.u AS su, b.u AS iu, a.shares AS ss, b.shares AS js, a.n, r.u AS ref, coalesce(r.manual, false) AS locked, r.c IS NOT NULL AS has FROM s a JOIN s b ON a.concept = b.concept AND a.side = 'source' AND b.side = 'injected' LEFT JOIN (VALUES {_REFERENCE}) AS r(c, q, u, manual) ON r.c = a.concept)
 SELECT concept, CASE WHEN locked THEN ref ELSE iu END AS target_unit, CASE WHEN locked THEN 'MANUAL' WHEN lower(su) <> lower(iu) THEN 'INJECTED' ELSE 'SOURCE' END AS unit_source,
  CASE WHEN locked THEN concat('MANUAL MAPPING (locked) - Current data suggests: ', iu) ELSE concat(CASE WHEN lower(su) <> lower(iu) THEN concat('INJECTION CHANGE: Source mode was ''', su, '''') ELSE 'Injected matches Source' END, CASE WHEN has AND lower(iu) <> lower(ref) THEN concat(' | REF DIFF: ref was ', ref) WHEN NOT has AND iu <> 'NA' THEN ' | NEW MAPPING' ELSE '' END) END AS note,
  ss AS source_shares, js AS injected_shares, n AS n_rows, NOT locked AND (lower(su) <> lower(iu) OR (has AND lower(iu) <> lower(ref)) OR (NOT has AND iu <> 'NA')) AS changed FROM j""")
def unit_election_locked(spark, sf_dir):
    m = measurements(spark, sf_dir).select("concept", F.lit("q").alias("quantity"), F.when(F.col("line_no") != 3, F.col("unit")).alias("source"), F.when((F.col("concept") % 5 == 0) & (F.col("line_no") < 4), "Brand#9").otherwise(F.col("unit")).alias("injected"))
    return audit.elect_units(m, inline(spark, _REFERENCE, "concept, quantity, unit, manual")).drop("quantity")


# ------------------------------------------------------------------------------------------------ decisions
def _student(t: str, df: str) -> str:
    """Two-sided p of Student's t in SQL: one minus the density's integral by Simpson's rule."""
    step = f"(abs({t}) / 2000)"
    total = f"list_sum(list_transform(range(0, 2001), lambda i: (CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * pow(1 + (i * {step}) * (i * {step}) / {df}, -({df} + 1) / 2)))"
    return f"(1 - 2 * exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi()) * {step} / 3 * {total})"


def _mlogp(p: str) -> str:
    return f"least(300.0, CASE WHEN {p} > 0 THEN -log10({p}) ELSE 300.0 END)"


def _decided(key: str, sample: str) -> str:
    """CTEs up to ``dc``: all findings of the three tests per ``key``, from ``sample`` (key as event_type, side, value)."""
    p = aq._p("ks", "n_cand", "n_targ").removeprefix("round(").removesuffix(", 6)")
    return f"""{sample}, {aq._KS}, {aq._W}, kp AS (SELECT *, {p} AS ks_p FROM k), wt AS (SELECT event_type, (m1 - m2) / sqrt(a + b) AS t, (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1)) AS df FROM w WHERE n1 > 1 AND n2 > 1 AND a + b > 0), wp AS (SELECT *, {_student("t", "df")} AS t_p FROM wt),
 md AS (SELECT event_type, quantile_cont(value, 0.5) FILTER (WHERE side = 'cand') AS a, quantile_cont(value, 0.5) FILTER (WHERE side = 'targ') AS b FROM s GROUP BY 1), dv AS (SELECT event_type, quantile_cont(abs(value - b), 0.5) AS d FROM s JOIN md USING (event_type) WHERE side = 'targ' GROUP BY 1),
 dc AS (SELECT kp.event_type AS {key}, n_cand, n_targ, round(ks, 6) AS ks, ks < 0.3 AND ks_p < 0.05 AS ks_pass, round(t, 6) AS t, round({_mlogp("t_p")}, 4) AS t_mlogp, coalesce(t_p >= 0.05, false) AS t_pass, round(abs(md.a - md.b), 6) AS mad_dist, round(3 * d, 6) AS mad_threshold, coalesce(abs(md.a - md.b) <= 3 * d, false) AS mad_pass FROM kp LEFT JOIN wp ON kp.event_type = wp.event_type LEFT JOIN md ON kp.event_type = md.event_type LEFT JOIN dv ON kp.event_type = dv.event_type),
 dd AS (SELECT *, CASE WHEN ks_pass OR t_pass OR mad_pass THEN 'PASS' ELSE 'FAIL' END AS verdict, CASE WHEN ks_pass THEN 'KS' WHEN t_pass THEN 'T' ELSE 'MAD' END AS decided_by, ks_pass::INT + t_pass::INT + mad_pass::INT AS tests_passed FROM dc)"""


_SEEN = ("n_cand", "n_targ", "ks", "ks_pass", "t", "t_mlogp", "t_pass", "mad_dist", "mad_threshold", "mad_pass", "verdict", "decided_by", "tests_passed")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("ks", "t", "mad_dist", "mad_threshold")} | {"t_mlogp": F.round("t_mlogp", 4)})


@query("decision_table", f"WITH {_decided('event_type', aq._S)} SELECT * FROM dd")
def decision_table(spark, sf_dir):
    return _rounded(stats.decide(aq._samples(spark, sf_dir), ["event_type"], exact_rows=0)).select("event_type", *_SEEN)


@query("unambiguous_table", f"WITH {M_SQL}, {aq._U}, own AS (SELECT tg.test, pv.unit, pct FROM tg JOIN pv ON tg.test = pv.test AND rn = 1 WHERE pct >= 98), {_decided('test', "s AS (SELECT own.test AS event_type, CASE WHEN u.unit IS NULL THEN 'cand' ELSE 'targ' END AS side, u.value FROM u JOIN own ON u.test = own.test AND coalesce(u.unit, own.unit) = own.unit WHERE u.value IS NOT NULL)")} SELECT own.test, own.unit, pct AS unit_prevalence, {', '.join(_SEEN)}, CASE WHEN n_cand IS NULL OR n_cand < 2 OR n_targ < 2 THEN 'SKIP' ELSE verdict END AS status FROM own LEFT JOIN dd USING (test)")
def unambiguous_table(spark, sf_dir):
    u = stage(aq._u(spark, sf_dir), "unit-rows")
    found = units.unambiguous_pass(units.samples(u), units.classify(units.targets(u, 10), units.prevalence(u)), exact_rows=0)
    return _rounded(found).select("test", "unit", "unit_prevalence", *_SEEN, "status")


@query("welch_table", f"WITH {aq._S}, {aq._W}, wt AS (SELECT event_type, (m1 - m2) / sqrt(a + b) AS t, (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1)) AS df FROM w) SELECT event_type, round(t, 6) AS t, round({_student('t', 'df')}, 6) AS t_p FROM wt")
def welch_table(spark, sf_dir):
    return stats.welch(aq._samples(spark, sf_dir), ["event_type"]).select("event_type", F.round("t", 6).alias("t"), F.round("t_p", 6).alias("t_p"))


def _quantile_sql(p: str) -> str:
    """The normal quantile by the same rational approximation, as SQL."""
    a = (-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239)
    b = (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0)
    c = (-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783)
    d = (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0)

    def poly(x: str, k: tuple) -> str:
        out = f"{k[0]!r}::DOUBLE"
        for v in k[1:]:
            out = f"({out}) * {x} + {v!r}::DOUBLE"
        return f"({out})"

    low, high, mid = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))", f"({p} - 0.5)"
    return f"CASE WHEN {p} < 0.02425 THEN {poly(low, c)} / {poly(low, d)} WHEN {p} > 0.97575 THEN -{poly(high, c)} / {poly(high, d)} ELSE {poly(f'({mid} * {mid})', a)} * {mid} / {poly(f'({mid} * {mid})', b)} END"


@query("rank_normal", f"WITH h AS (SELECT event_type, value, count(*) AS k FROM events GROUP BY 1, 2), r AS (SELECT event_type, value, k, sum(k) OVER (PARTITION BY event_type)::BIGINT AS n, sum(k) OVER (PARTITION BY event_type ORDER BY value ROWS UNBOUNDED PRECEDING) - (k - 1) / 2 AS rank FROM h), p AS (SELECT *, (rank - 0.375) / (n + 0.25) AS p FROM r) SELECT event_type, value, k, n, rank, round({_quantile_sql('p')}, 6) AS z FROM p")
def rank_normal(spark, sf_dir):
    return stats.inverse_normal(table(spark, sf_dir, "events"), "value", ["event_type"]).withColumn("z", F.round("z", 6))


# ------------------------------------------------------------------------------------------------ files and stored releases
@query("tsv_round_trip", "SELECT row_number() OVER (ORDER BY c_custkey) AS row_no, CAST(c_custkey AS VARCHAR) AS c_custkey, concat(c_name, chr(10), c_mktsegment) AS c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def tsv_round_trip(spark, sf_dir):
    """The customers with line ends in a quoted field, written as one TSV file and read in splits, with their row numbers."""
    path = scratch(spark, "customers-tsv")
    df = table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit("\n"), "c_mktsegment").alias("c_name"), "c_nationkey")
    readers.write_tsv(df.orderBy("c_custkey").coalesce(1), path, gzip=False)
    return split_scan.scan_tsv(spark, path, ["c_custkey", "c_name", "c_nationkey"]).filter(F.col(split_scan.BAD).isNull()).select("row_no", "c_custkey", "c_name", "c_nationkey")


@query("parquet_round_trip", f"WITH {M_SQL} SELECT order_id AS id, value FROM m")
def parquet_round_trip(spark, sf_dir):
    path = scratch(spark, "measurements-parquet")
    readers.write_parquet(measurements(spark, sf_dir), path)
    return clean.rename(readers.read_parquet(spark, path, ["order_id", "value"]), {"order_id": "id"})


@query("schema_rows", "SELECT column_name AS name, CASE WHEN data_type IN ('BIGINT', 'INTEGER') THEN 'INTEGER' WHEN data_type = 'DOUBLE' THEN 'FLOAT' ELSE 'STRING' END AS type, 'NULLABLE' AS mode FROM information_schema.columns WHERE table_name = 'customer'")
def schema_rows(spark, sf_dir):
    return readers.schema_export(table(spark, sf_dir, "customer"))


@query("clustered_release", f"WITH {M_SQL}, d AS (SELECT person, concept, min(price) AS price FROM m GROUP BY 1, 2), c AS (SELECT person, count(*) AS n_concepts, round(sum(price), 2) AS price FROM d GROUP BY 1) SELECT person, n_concepts, price, c_mktsegment AS sex FROM c LEFT JOIN customer ON person = c_custkey")
def clustered_release(spark, sf_dir):
    """A release stored by person: de-duplication, counts and the join with the person table need no exchange."""
    release = clustered.write_clustered(measurements(spark, sf_dir).select("person", "concept", "price"), ["person"], 8)
    people = clustered.write_clustered(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("person"), F.col("c_mktsegment").alias("sex")), ["person"], 8, "people")
    first = dedup.keyed_dedup(release, ["person", "concept"])
    counts = first.groupBy("person").agg(F.count("*").alias("n_concepts"), F.round(F.sum("price"), 2).alias("price"))
    return counts.join(people.hint("merge"), "person", "left").select("person", "n_concepts", "price", "sex")


@query("sketch_compare", f"WITH {M_SQL}, y AS (SELECT CAST(concept AS VARCHAR) AS concept, person, line_no > 3 AS late FROM m), z AS (SELECT * FROM y UNION ALL SELECT 'ALL', person, late FROM y) SELECT concept, count(*) FILTER (WHERE late) AS new_rows, count(DISTINCT person) FILTER (WHERE late) AS new_exact, count(*) FILTER (WHERE NOT late) AS old_rows, count(DISTINCT person) FILTER (WHERE NOT late) AS old_exact, round(count(*) FILTER (WHERE late) / count(*) FILTER (WHERE NOT late), 3) AS rows_ratio, true AS close FROM z GROUP BY 1")
def sketch_compare(spark, sf_dir):
    """Two releases compared by what is stored beside them; the estimates are within a tenth of the exact numbers."""
    m = measurements(spark, sf_dir).select("person", "concept", "line_no")
    stored = []
    for name, part in (("new", "line_no > 3"), ("old", "line_no <= 3")):
        path = scratch(spark, f"sketches-{name}")
        readers.write_parquet(clustered.release_sketches(m.filter(part)), path)
        stored.append(readers.read_parquet(spark, path))
    out = clustered.compare_sketches(*stored)
    near = [F.abs(F.col(f"{s}_persons") - F.col(f"{s}_exact")) <= F.greatest(F.lit(2), 0.1 * F.col(f"{s}_exact")) for s in ("new", "old")]
    return out.select("concept", "new_rows", "new_exact", "old_rows", "old_exact", "rows_ratio", (near[0] & near[1]).alias("close"))
