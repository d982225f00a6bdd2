"""Queries of the two batch jobs over every line item, with the jobs' logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import jobs
from .measurements import inline, table
from .rowwise_queries import RAW_OUTCOME

QUERIES: dict = {}
SQL: dict[str, str] = {}

_TEXT = "CASE l_linenumber % 4 WHEN 0 THEN 'Tulos: 7,5 umol/l' WHEN 1 THEN 'NEG' WHEN 2 THEN '++' ELSE '150203' END"
RAW = {
    "row_id": "l_orderkey * 8 + l_linenumber",
    "person": "CAST(o_custkey AS STRING)",
    "day": "CASE WHEN (l_orderkey * 8 + l_linenumber) % 101 = 0 THEN '1998-13-45' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END",
    "time": "'08:30'",
    "status": "CASE l_linenumber WHEN 6 THEN 'K' WHEN 5 THEN ' F' ELSE 'F' END",
    "national_code": "CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN 'Puuttuu' END",
    "local_code": "concat('L', p_size)",
    "name": "concat(p_type, '_* x')",
    "coding_system": "CASE WHEN p_size % 2 = 0 THEN '1.2.246.10.77.5' ELSE '1.2.246.537.10.88' END",
    "value": "CASE WHEN l_linenumber = 4 THEN 'TYHJÄ' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
    "unit": "CASE p_size % 4 WHEN 0 THEN 'MMOL / L' WHEN 1 THEN 'sek' WHEN 2 THEN 'y/l' ELSE '' END",
    "outcome": RAW_OUTCOME,
    "text": _TEXT,
}


def raw(spark, sf_dir: str, **more: str) -> DataFrame:
    """Raw rows; ``more``: further columns as SQL text."""
    line, orders, part = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    both = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return both.select(*[F.expr(e).alias(c) for c, e in (RAW | more).items()])


def dictionaries(spark) -> jobs.Dictionaries:
    def pairs(rows: str) -> DataFrame:
        return inline(spark, rows, "a, b").toDF("from", "to")

    return jobs.Dictionaries(
        names=pairs("('Brand#1', 'b-one'), ('Brand#2', 'b-two')"),
        systems=pairs("('x', 'y')"),
        organisations=pairs("('77', 'north')"),
        units=pairs("('mmol/l', 'mmol/l'), ('sek', 's')"),
        approved=inline(spark, "('mmol/l'), ('u/l')", "unit"),
        fixes=inline(spark, "('economyx', 's', 'mmol/l'), ('smallx', 'u/l', 'NA')", "test, unit, fix"),
        mapping=inline(spark, "('economyx', 'mmol/l', 11, 'mole', 'APPROVED'), ('largex', 'u/l', 12, 'act', 'APPROVED'), ('b-one', 'mmol/l', 13, 'mole', 'APPROVED'), ('promox', 'u/l', 14, 'act', 'IGNORED')", "test, unit, concept, quantity, status"),
        conversions=inline(spark, "('mole', 'mmol/l', 'umol/l', '1000', CAST(NULL AS INT)), ('act', 'u/l', 'ku/l', '0.5*X+1', NULL)", "quantity, source_unit, target_unit, conversion, only_concept"),
        targets=inline(spark, "(11, 'mole', 'umol/l'), (12, 'act', 'ku/l'), (13, 'mole', 'umol/l')", "concept, quantity, target_unit"),
    )


def core_tables(spark) -> jobs.CoreTables:
    return jobs.CoreTables(
        targets=inline(spark, "(11, 'umol/l'), (12, 'ku/l'), (13, 'umol/l')", "concept, target_unit"),
        posneg=inline(spark, "('NEG', '0'), ('POS', '1')", "text, flag"),
        plus=inline(spark, "('++', 11, '1'), ('++', 12, '2')", "text, concept, flag"),
        units=inline(spark, "('umoll', 'umol/l')", "a, b").toDF("from", "to"),
        approved=inline(spark, "('umol/l')", "unit"),
        value_fixes=inline(spark, "(11, 1, 'merged', '>', 40000.0D, 0.001D, 'scaled')", "concept, seq, column, side, limit, factor, note"),
        thresholds=inline(spark, "(11, 1, '<', 5000.0D, 'low'), (13, 1, 'NA', CAST(NULL AS DOUBLE), 'checked')", "concept, seq, side, limit, note"),
        blacklist=inline(spark, "(13, 'untrusted')", "concept, note"),
        limits=inline(spark, "(11, 2000.0D, 30000.0D, false, true)", "concept, low, high, low_problem, high_problem"),
    )


_MUNGED = f"""r AS (SELECT l_orderkey * 8 + l_linenumber AS row_id, l_linenumber AS ln, p_size, lower(p_type) AS kind, p_brand, o_orderdate, CAST(CAST(l_quantity AS INT) AS DOUBLE) AS v, {RAW_OUTCOME} AS oc, {_TEXT} AS text FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
 a AS (SELECT *, p_size % 3 = 0 AS nat, CASE WHEN p_size % 3 = 0 THEN CASE p_brand WHEN 'Brand#1' THEN 'b-one' WHEN 'Brand#2' THEN 'b-two' END ELSE concat(kind, 'x') END AS test, CASE p_size % 4 WHEN 0 THEN 'mmol/l' WHEN 1 THEN 's' WHEN 2 THEN 'u/l' END AS u, CASE WHEN ln <> 4 THEN v END AS value,
  CASE oc WHEN '<' THEN 'L' WHEN '>' THEN 'H' WHEN 'POS' THEN 'A' WHEN 'NEG' THEN 'N' WHEN 'HH' THEN 'HH' END AS outcome FROM r WHERE row_id % 101 <> 0 AND ln <> 6),
 f AS (SELECT *, test = 'economyx' AND u = 's' AND value IS NOT NULL AS to_mmol, test = 'smallx' AND u = 'u/l' AS to_none FROM a),
 g AS (SELECT *, CASE WHEN to_mmol THEN 'mmol/l' WHEN to_none THEN NULL ELSE u END AS clean_unit, CASE WHEN to_mmol OR to_none THEN 'unit_fixed' WHEN u IN ('mmol/l', 'u/l') THEN '1' ELSE '0' END AS unit_valid FROM f),
 c AS (SELECT *, CASE WHEN test = 'economyx' AND clean_unit = 'mmol/l' THEN 11 WHEN test = 'largex' AND clean_unit = 'u/l' THEN 12 WHEN test = 'b-one' AND clean_unit = 'mmol/l' THEN 13 ELSE -1 END AS concept FROM g),
 mu AS (SELECT *, CASE WHEN concept IN (11, 13) THEN 1000 * value WHEN concept = 12 THEN round_even(0.5 * value + 1, 2) END AS harm_value, CASE WHEN concept IN (11, 13) THEN 'umol/l' WHEN concept = 12 THEN 'ku/l' END AS harm_unit FROM c)"""
_MUNGED = _MUNGED.replace("STRING", "VARCHAR")

SQL["munge_job"] = f"WITH {_MUNGED} SELECT row_id, CASE WHEN nat THEN p_brand ELSE concat('L', p_size) END AS test_id, CASE WHEN nat THEN '1' ELSE '0' END AS is_national, test, CASE WHEN p_size % 2 = 0 THEN 'north' END AS coding_system_map, outcome, clean_unit, u AS unit_before_fix, unit_valid, concept, harm_value, harm_unit FROM mu"


def munged(spark, sf_dir: str, **more) -> jobs.Result:
    return jobs.munge(raw(spark, sf_dir), dictionaries(spark), rebalance=True, **more)


def munge_job(spark, sf_dir: str) -> DataFrame:
    rows = munged(spark, sf_dir).rows
    return rows.select("row_id", "test_id", "is_national", "test", "coding_system_map", "outcome", "clean_unit", "unit_before_fix", "unit_valid", "concept", "harm_value", "harm_unit")


SQL["munge_log"] = f"""WITH {_MUNGED} SELECT row_id, 'DATE' AS kind, '1998-13-45 08:30' AS old, NULL AS new FROM r WHERE row_id % 101 = 0 UNION ALL SELECT row_id, 'measurement_status', 'K', NULL FROM r WHERE row_id % 101 <> 0 AND ln = 6
 UNION ALL SELECT row_id, 'lab_mapping', p_brand, NULL FROM a WHERE nat AND test IS NULL UNION ALL SELECT row_id, 'unit map', 'sek', 's' FROM a WHERE u = 's' UNION ALL SELECT row_id, 'unit regex', 'y/l', 'u/l' FROM a WHERE u = 'u/l'
 UNION ALL SELECT row_id, 'name', concat(kind, '_*x'), test FROM a WHERE NOT nat"""


def munge_log(spark, sf_dir: str) -> DataFrame:
    out = munged(spark, sf_dir)
    none = F.lit(None).cast("string").alias("new")
    parts = [x.select("row_id", F.col("err").alias("kind"), F.col("err_value").alias("old"), none) for x in (out.errors, out.warnings)]
    parts.append(out.units.select("row_id", F.concat_ws(" ", F.lit("unit"), "source").alias("kind"), "old", "new"))
    parts.append(out.names.select("row_id", F.lit("name").alias("kind"), "old", "new"))
    return reduce(DataFrame.unionByName, parts)


_CORE = f"""{_MUNGED}, x AS (SELECT *, CASE WHEN ln % 4 = 3 THEN 150203.0 WHEN ln % 4 = 0 AND concept IN (11, 13) THEN 7.5 END AS ex, CASE WHEN ln % 4 = 1 THEN '0' WHEN ln % 4 = 2 AND concept = 11 THEN '1' END AS is_pos, CASE WHEN ln % 4 = 2 AND concept = 11 THEN '++' END AS outcome_text FROM mu),
 q AS (SELECT *, coalesce(harm_value, ex) AS m0 FROM x WHERE ln % 4 <> 3), v AS (SELECT *, concept = 11 AND m0 > 40000 AS scaled, CASE WHEN concept = 11 AND m0 > 40000 THEN m0 * CAST(0.001 AS DOUBLE) ELSE m0 END AS m1 FROM q),
 w AS (SELECT *, coalesce(concept = 11 AND m1 < 5000, false) AS low, coalesce((outcome = 'N' AND is_pos = '1') OR (outcome = 'A' AND is_pos = '0'), false) AS conflict, concept = 13 AND ex IS NOT NULL AS listed FROM v),
 z AS (SELECT *, CASE WHEN NOT listed THEN m1 END AS merged_value, CASE WHEN low OR conflict OR listed THEN 0 WHEN concept IN (11, 13) THEN 1 ELSE 2 END AS qc_pass,
  nullif(concat_ws('; ', CASE WHEN scaled THEN 'scaled' END, CASE WHEN low THEN 'low' END, CASE WHEN conflict THEN 'OUTCOME_EXTRACT_CONFLICT' END, CASE WHEN listed THEN 'untrusted' END), '') AS qc_note FROM w)"""
SQL["core_job"] = f"WITH {_CORE} SELECT row_id, concept, ex AS extracted_value, merged_value, is_pos, outcome_text, qc_pass, qc_note, CASE WHEN concept = 11 THEN CASE WHEN merged_value BETWEEN 2000 AND 30000 THEN 'N' WHEN merged_value > 30000 THEN 'H*' WHEN merged_value < 2000 THEN 'L' END END AS imputed_outcome FROM z"


def cored(spark, sf_dir: str, **more) -> jobs.Result:
    return jobs.munge_and_core(raw(spark, sf_dir), dictionaries(spark), core_tables(spark), rebalance=True, **more)[1]


def core_job(spark, sf_dir: str) -> DataFrame:
    return cored(spark, sf_dir, drop=("text",)).rows.select("row_id", "concept", "extracted_value", "merged_value", "is_pos", "outcome_text", "qc_pass", "qc_note", "imputed_outcome")


SQL["core_log"] = f"""WITH {_CORE}, n AS (SELECT *, nullif(concat_ws('; ', CASE WHEN scaled THEN 'scaled' END, CASE WHEN low THEN 'low' END, CASE WHEN conflict THEN 'OUTCOME_EXTRACT_CONFLICT' END), '') AS note FROM z)
 SELECT row_id, 'DATE_IN_MEASUREMENT' AS err, concat_ws('::', coalesce(test, 'NA'), coalesce(CASE WHEN harm_value IS NOT NULL THEN concat(CAST(CAST(floor(harm_value) AS BIGINT) AS VARCHAR), CASE WHEN harm_value = floor(harm_value) THEN '.0' ELSE '.5' END) END, 'NA'), text, '150203.0') AS err_value FROM x WHERE ln % 4 = 3
 UNION ALL SELECT row_id, 'QC_CONVERT', concat(coalesce(test, ''), ';scaled') FROM z WHERE scaled UNION ALL SELECT row_id, 'QC_NOTE_APPENDED', concat(coalesce(test, ''), ';', note) FROM n WHERE conflict UNION ALL SELECT row_id, 'QC_NOTE_APPENDED', concat(coalesce(test, ''), ';', qc_note) FROM n WHERE listed"""


def core_log(spark, sf_dir: str) -> DataFrame:
    out = cored(spark, sf_dir, drop=("text",))
    return out.errors.unionByName(out.warnings).select("row_id", "err", "err_value")


QUERIES |= {"munge_job": munge_job, "munge_log": munge_log, "core_job": core_job, "core_log": core_log}
