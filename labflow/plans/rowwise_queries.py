"""Queries of the row-wise operators: cleaning, harmonising, extraction, ordered rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, extract, formulas, harmonise, qc
from ..sources import readers
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


RAW_UNIT = "CASE p_size % 12 WHEN 9 THEN '10e9 / L' WHEN 10 THEN '5E6/l' WHEN 11 THEN 'mmo/l' WHEN 0 THEN 'MMOL / L' WHEN 1 THEN 'y/l' WHEN 2 THEN 'kpl' WHEN 3 THEN 'Indeksi' WHEN 4 THEN '(mg.l)' WHEN 5 THEN 'sek' WHEN 6 THEN ' - ' WHEN 7 THEN 'pg/ml' ELSE concat(p_brand, '_u/l') END"
UNIT_MAP = "('mmol/l', 'mmol/l'), ('sek', 's'), ('kpl', 'kpl')"
#: The rewrites with look-ahead, for an engine without it.
AHEAD = {
    r"(^(\b)?\d+(?=e\d+))": [(r"^\d+(e\d+)", r"\1")],
    r"(à?x?(10)?e0?(?=\d)|x?10(\^|\*)|^\^(?=[0-9]+.?l))": [(r"à?x?(?:10)?e0?(\d)", r"e\1"), (r"x?10(?:\^|\*)", "e"), (r"^\^([0-9]+.?l)", r"e\1")],
    r"(mo(t|l|i)?(l)?)(?=$)|nol": [(r"mo(?:t|l|i)?l?$|nol", "mol")],
}


def _nested(column: str) -> str:
    for p, r in clean.UNIT_REWRITES:
        for pattern, new in AHEAD.get(p, [(p, r)]):
            column = f"regexp_replace({column}, '{pattern}', '{new}', 'g')"
    return column


@query("clean_units", f"""WITH u AS (SELECT p_partkey, nullif(lower(translate({RAW_UNIT}, ' _,.-(){{}}\\?!', '')), '') AS unit FROM part),
 d AS (SELECT * FROM (VALUES {UNIT_MAP}) AS t(a, b))
 SELECT p_partkey, unit, nullif(CASE WHEN d.a IS NOT NULL THEN d.b ELSE {_nested('unit')} END, 'NA') AS clean_unit FROM u LEFT JOIN d ON unit = d.a""")
def clean_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part").select("p_partkey", clean.strip_unit(F.expr(RAW_UNIT)).alias("unit"))
    return clean.fix_units(df, "unit", inline(spark, UNIT_MAP, "from, to").toDF("from", "to"))


@query("clean_names", "SELECT p_partkey, replace(regexp_replace(concat('1234,', p_name, '*_', p_size), '_|\\*|#|%|^\\d{4},|,\\d{4}$', '', 'g'), '–', '-') AS name FROM part")
def clean_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", clean.clean_name(F.expr("concat('1234,', p_name, '*_', p_size)")).alias("name"))


RAW_OUTCOME = "CASE concat(l_returnflag, l_linestatus) WHEN 'AF' THEN 'POS' WHEN 'NF' THEN '<' WHEN 'RF' THEN 'OTHER' WHEN 'AO' THEN 'HH' WHEN 'NO' THEN 'NEG' ELSE '>' END"


@query("outcome_codes", f"""WITH r AS (SELECT {RAW_OUTCOME} AS raw FROM lineitem)
 SELECT raw, CASE raw WHEN '<' THEN 'L' WHEN '>' THEN 'H' WHEN 'POS' THEN 'A' WHEN 'NEG' THEN 'N' WHEN 'HH' THEN 'HH' END AS outcome, count(*) AS n_rows FROM r GROUP BY ALL""")
def outcome_codes(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(F.expr(RAW_OUTCOME).alias("raw"))
    return raw.groupBy("raw", clean.outcome_code(F.col("raw")).alias("outcome")).agg(F.count("*").alias("n_rows"))


@query("na_tokens", "SELECT event_id, CASE WHEN user_id % 5 IN (0, 1) THEN NULL ELSE event_type END AS event_type, CASE WHEN user_id % 5 = 0 THEN NULL WHEN user_id % 5 = 1 THEN '-1' ELSE event_type END AS kept FROM events")
def na_tokens(spark, sf_dir):
    raw = F.when(F.col("user_id") % 5 == 0, "TYHJÄ").when(F.col("user_id") % 5 == 1, "-1").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", clean.na_tokens(raw).alias("event_type"), clean.na_tokens(raw, clean.NA_TOKENS_VALUE).alias("kept"))


@query("status_filter", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('K', 'W', 'X', 'I', 'D', 'P')")
def status_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter(~clean.denied(F.col("o_orderstatus"))).select("o_orderkey", "o_orderstatus")


@query("datetime_build", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN try_strptime(strftime(o_orderdate, '%Y-%m-%d') || 'T08:30', '%Y-%m-%dT%H:%M') END AS event_datetime FROM orders")
def datetime_build(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "1998-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"), F.lit("08:30").alias("time"))
    return clean.build_datetime(raw, "day", "time").select("o_orderkey", "event_datetime")


@query("remove_spaces", "SELECT c_custkey, nullif(regexp_replace(concat(' ', c_name, ' x '), '\\s', '', 'g'), '') AS name, c_mktsegment FROM customer")
def remove_spaces(spark, sf_dir):
    return clean.remove_spaces(table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit(" "), "c_name", F.lit(" x ")).alias("name"), "c_mktsegment"), skip=["c_mktsegment"])


NAMES = "('economy', 'one'), ('small', 'two'), ('promo', 'three')"


@query("name_map", f"SELECT p_partkey, coalesce(t.b, lower(p_type)) AS test_name, t.a IS NOT NULL AS matched FROM part LEFT JOIN (VALUES {NAMES}) AS t(a, b) ON lower(p_type) = t.a")
def name_map(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", clean.test_name(F.col("p_type")).alias("test"))
    return clean.map_keep(df, inline(spark, NAMES, "from, to").toDF("from", "to"), "test", "test_name").select("p_partkey", "test_name", "matched")


@query("test_ids", "SELECT c_custkey, coalesce(CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END, c_name) AS test_id, CASE WHEN c_nationkey % 2 = 0 THEN '1' ELSE '0' END AS is_national FROM customer")
def test_ids(spark, sf_dir):
    i, flag = clean.test_id(F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")), F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", i.alias("test_id"), flag.alias("is_national"))


ORGS = "('https://m', 'mobile'), ('https://thther', 'other')"


@query("coding_org", f"WITH p AS (SELECT page_id, split_part(replace(url, '1.2.246.10.', ''), '.', 1) AS k FROM pages) SELECT page_id, coalesce(t.b, 'NA') AS org FROM p LEFT JOIN (VALUES {ORGS}) AS t(a, b) ON k = t.a")
def coding_org(spark, sf_dir):
    df = table(spark, sf_dir, "pages").select("page_id", clean.organisation_key(F.col("url")).alias("k"))
    return readers.lookup(df, inline(spark, ORGS, "from, to").toDF("from", "to"), "k", "org", miss="default", default="NA").select("page_id", "org")


FIXES = "('ECONOMY', 'Brand#1', 'Brand#2'), ('SMALL', 'Brand#2', 'NA'), ('LARGE', 'Brand#3', 'Brand#9')"
MAPPING = "('ECONOMY', 'Brand#2', 11, 'mass', 'APPROVED'), ('LARGE', 'Brand#9', 12, 'mass', 'APPROVED'), ('PROMO', 'Brand#5', 13, 'mole', 'APPROVED'), ('SMALL', 'Brand#7', 14, 'mass', 'IGNORED')"
CONVERSIONS = "('mass', 'Brand#2', 'g', '0.5', CAST(NULL AS INT)), ('mass', 'Brand#2', 'g', '2', 11), ('mass', 'Brand#9', 'g', '0.704*X+1', NULL), ('mole', 'Brand#5', 'mol', '10', NULL)"
TARGETS = "(11, 'mass', 'g'), (12, 'mass', 'g'), (13, 'mole', 'mol')"
_FIXED = f"""fixed AS (SELECT order_id, line_no, test, unit, value, CASE WHEN f.fix IS NOT NULL THEN nullif(f.fix, 'NA') ELSE unit END AS clean_unit, CASE WHEN f.fix IS NOT NULL THEN 'unit_fixed' WHEN unit IN ('Brand#1', 'Brand#2') THEN '1' ELSE '0' END AS unit_valid
 FROM m LEFT JOIN (VALUES {FIXES}) AS f(t, u, fix) ON test = f.t AND unit = f.u)"""
_MAPPED = f"""mapped AS (SELECT fixed.*, coalesce(g.c, -1) AS concept, g.q AS quantity FROM fixed LEFT JOIN (VALUES {MAPPING}) AS g(t, u, c, q, s) ON test = g.t AND clean_unit IS NOT DISTINCT FROM g.u AND g.s = 'APPROVED')"""
_TABLE = f"""conv AS (SELECT t.c AS concept, v.q AS quantity, v.su AS source_unit, v.tu AS target_unit, v.conversion, v.conversion LIKE '%X%' AS is_formula,
 CAST(CASE WHEN v.conversion LIKE '%X%' THEN regexp_extract(v.conversion, '^([0-9.]+)\\*X', 1) ELSE v.conversion END AS DOUBLE) AS a, CAST(CASE WHEN v.conversion LIKE '%X%' THEN regexp_extract(v.conversion, 'X([+-][0-9.]+)$', 1) END AS DOUBLE) AS b, v.oc IS NOT NULL AS restricted
 FROM (VALUES {CONVERSIONS}) AS v(q, su, tu, conversion, oc) JOIN (VALUES {TARGETS}) AS t(c, q, tu) ON v.q = t.q AND v.tu = t.tu WHERE v.oc IS NULL OR v.oc = t.c
 QUALIFY row_number() OVER (PARTITION BY t.c, v.q, v.su ORDER BY v.oc IS NULL, v.conversion) = 1)"""


def _fixed(spark, sf_dir):
    df = measurements(spark, sf_dir).withColumn("clean_unit", F.col("unit")).drop("concept")
    df = harmonise.unit_valid(df, inline(spark, "('Brand#1'), ('Brand#2')", "unit"))
    return harmonise.unit_fix(df, inline(spark, FIXES, "test, unit, fix"))


def _mapped(spark, sf_dir):
    return harmonise.concept_map(_fixed(spark, sf_dir), inline(spark, MAPPING, "test, unit, concept, quantity, status"))


def _table(spark):
    return harmonise.conversion_table(inline(spark, CONVERSIONS, "quantity, source_unit, target_unit, conversion, only_concept"), inline(spark, TARGETS, "concept, quantity, target_unit"))


@query("unit_fix", f"WITH {M_SQL}, {_FIXED} SELECT test, unit, clean_unit, unit_valid, count(*) AS n_rows FROM fixed GROUP BY ALL")
def unit_fix(spark, sf_dir):
    return _fixed(spark, sf_dir).groupBy("test", "unit", "clean_unit", "unit_valid").agg(F.count("*").alias("n_rows"))


@query("concept_map", f"WITH {M_SQL}, {_FIXED}, {_MAPPED} SELECT test, clean_unit, concept, quantity, count(*) AS n_rows FROM mapped GROUP BY ALL")
def concept_map(spark, sf_dir):
    return _mapped(spark, sf_dir).groupBy("test", "clean_unit", "concept", "quantity").agg(F.count("*").alias("n_rows"))


@query("unit_convert", f"""WITH {M_SQL}, {_FIXED}, {_MAPPED}, {_TABLE} SELECT order_id, line_no, value, mapped.concept, target_unit AS harm_unit, conversion AS factor, CASE WHEN is_formula THEN round_even(a * value + b, 2) ELSE a * value END AS harm_value
 FROM mapped LEFT JOIN conv ON mapped.concept = conv.concept AND mapped.quantity IS NOT DISTINCT FROM conv.quantity AND clean_unit = source_unit WHERE mapped.concept > 0""")
def unit_convert(spark, sf_dir):
    return harmonise.convert(_mapped(spark, sf_dir), _table(spark)).filter("concept > 0").select("order_id", "line_no", "value", "concept", "harm_unit", "factor", "harm_value")


@query("conversion_use", f"WITH {M_SQL}, {_FIXED}, {_MAPPED}, {_TABLE} SELECT conv.*, count(order_id) AS n_rows FROM conv LEFT JOIN mapped ON mapped.concept = conv.concept AND clean_unit = source_unit GROUP BY ALL")
def conversion_use(spark, sf_dir):
    used = _mapped(spark, sf_dir).groupBy("concept", F.col("clean_unit").alias("source_unit")).agg(F.count("*").alias("n_rows"))
    t = _table(spark)
    at = {x: formulas.run(F.col("program"), F.lit(x)) for x in (0.0, 1.0)}
    line = t.withColumns({"a": F.when(F.col("is_formula"), F.round(at[1.0] - at[0.0], 9)).otherwise(F.col("a")), "b": at[0.0]}).drop("program", "known")
    return line.join(used, ["concept", "source_unit"], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


@query("sanitize_text", "SELECT doc_id, md5(replace(regexp_replace(text, '\\r\\n|\\r|\\n', '␤', 'g'), chr(9), '␉')) AS digest FROM documents")
def sanitize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(clean.sanitise_text(F.col("text"))).alias("digest"))


FREE = "CASE CAST(event_id % 6 AS INT) WHEN 0 THEN concat('Tulos: ', replace(CAST(value AS STRING), '.', ','), ' mg/l') WHEN 1 THEN concat('< ', replace(CAST(value AS STRING), '.', ','), ' mg/l') WHEN 2 THEN concat('yli ', CAST(value AS STRING), ' mg/l') WHEN 3 THEN 'NEG' WHEN 4 THEN '++' ELSE '12d' END"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("text", F.expr(FREE))


@query("extract_number", f"WITH e AS (SELECT event_id, replace(replace(regexp_replace(lower({FREE.replace('STRING', 'VARCHAR')}), '\\s', '', 'g'), 'mg/l', ''), ',', '.') AS t FROM events), x AS (SELECT event_id, regexp_replace(t, '\\btulos:\\b', '', 'g') AS t FROM e) SELECT event_id, CASE WHEN regexp_full_match(t, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN TRY_CAST(t AS DOUBLE) END AS extracted FROM x")
def extract_number(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", extract.extracted_number(F.col("text"), F.lit("mg/l")).alias("extracted"))


@query("extract_comparison", """WITH e AS (SELECT event_id, event_id % 6 AS k, CAST(value AS VARCHAR) AS v FROM events)
 SELECT event_id, CASE WHEN k IN (1, 2) THEN concat(CASE k WHEN 1 THEN '<' ELSE '>' END, CASE WHEN contains(v, '.') THEN regexp_replace(regexp_replace(v, '0+$', ''), '\\.$', '') ELSE v END, 'mg/l') END AS outcome_text FROM e""")
def extract_comparison(spark, sf_dir):
    df = _events(spark, sf_dir)
    return extract.comparison_outcome(df, "text", inline(spark, "('mgl', 'mg/l')", "from, to").toDF("from", "to"), inline(spark, "('mg/l')", "unit")).select("event_id", "outcome_text")


@query("posneg_map", f"SELECT event_id, t.flag AS is_pos FROM (SELECT event_id, {FREE.replace('STRING', 'VARCHAR')} AS text FROM events) LEFT JOIN (VALUES ('NEG', '0'), ('POS', '1')) AS t(x, flag) ON text = t.x")
def posneg_map(spark, sf_dir):
    return extract.exact_lookup(_events(spark, sf_dir), inline(spark, "('NEG', '0'), ('POS', '1')", "text, flag"), "text", "is_pos").select("event_id", "is_pos")


PLUS = "('++', 3, '1'), ('++', 4, '0'), ('12d', 3, '2')"


@query("plus_overlay", f"""WITH e AS (SELECT event_id, CAST(user_id % 10 AS INT) AS concept, {FREE.replace('STRING', 'VARCHAR')} AS text FROM events)
 SELECT event_id, coalesce(p.f, CASE WHEN text = 'NEG' THEN '0' END) AS is_pos, p.x AS outcome_text FROM e LEFT JOIN (VALUES {PLUS}) AS p(x, c, f) ON text = p.x AND concept = p.c AND p.f IN ('0', '1')""")
def plus_overlay(spark, sf_dir):
    df = _events(spark, sf_dir).select("event_id", (F.col("user_id") % 10).cast("int").alias("concept"), "text", F.when(F.col("text") == "NEG", "0").alias("is_pos"), F.lit(None).cast("string").alias("outcome_text"))
    return extract.plus_overlay(df, inline(spark, PLUS, "text, concept, flag")).select("event_id", "is_pos", "outcome_text")


@query("date_in_value", "WITH e AS (SELECT event_id, floor(value * 2000) AS v FROM events) SELECT event_id, v BETWEEN 100000 AND 999999 AND floor(v / 10000) <= 31 AND floor(v / 100) % 100 BETWEEN 1 AND 12 AS is_date FROM e")
def date_in_value(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", qc.is_date(F.floor(F.col("value") * 2000).cast("double")).alias("is_date"))


VALUE_RULES = "(1, 1, 'merged', '<', 10.0D, 10.0D, 'x10'), (1, 2, 'merged', '>', 90.0D, 0.5D, 'half'), (2, 1, 'harmonised', '>=', 25.0D, 0.1D, 'tenth'), (3, 1, 'extracted', '==', 7.0D, 2.0D, 'double')"


def _qc(spark, sf_dir):
    m = measurements(spark, sf_dir).withColumns({"harm_value": F.col("value"), "extracted_value": F.when(F.col("line_no") > 3, F.col("value"))})
    return qc.start(m.withColumn("merged_value", extract.merged(F.col("harm_value"), F.col("extracted_value"))))


@query("value_fix_rules", f"""WITH {M_SQL}, a AS (SELECT *, CASE WHEN concept = 1 AND value < 10 THEN value * 10 WHEN concept = 2 AND value >= 25 THEN value * CAST(0.1 AS DOUBLE) WHEN concept = 3 AND line_no > 3 AND value = 7 THEN value * 2 ELSE value END AS v1,
  CASE WHEN concept = 1 AND value < 10 THEN 'x10' WHEN concept = 2 AND value >= 25 THEN 'tenth' WHEN concept = 3 AND line_no > 3 AND value = 7 THEN 'double' END AS n1 FROM m)
 SELECT order_id, line_no, concept, value, CASE WHEN concept = 1 AND v1 > 90 THEN v1 * 0.5 ELSE v1 END AS merged_value, nullif(concat_ws('; ', n1, CASE WHEN concept = 1 AND v1 > 90 THEN 'half' END), '') AS qc_note FROM a""")
def value_fix_rules(spark, sf_dir):
    rules = inline(spark, VALUE_RULES, "concept, seq, column, side, limit, factor, note")
    return qc.fix_values(_qc(spark, sf_dir), rules).select("order_id", "line_no", "concept", "value", "merged_value", "qc_note")


QC_RULES = "(1, 1, '<', 5.0D, 'low'), (1, 2, '>', 45.0D, 'high'), (2, 1, '!=', 20.0D, 'odd'), (3, 1, 'NA', CAST(NULL AS DOUBLE), 'checked')"


@query("threshold_qc", f"""WITH {M_SQL} SELECT order_id, line_no, concept, value, CASE WHEN (concept = 1 AND (value < 5 OR value > 45)) OR (concept = 2 AND value <> 20) THEN 0 WHEN concept IN (1, 2, 3) THEN 1 ELSE 2 END AS qc_pass,
 CASE WHEN concept = 1 AND value < 5 THEN 'low' WHEN concept = 1 AND value > 45 THEN 'high' WHEN concept = 2 AND value <> 20 THEN 'odd' END AS qc_note FROM m""")
def threshold_qc(spark, sf_dir):
    return qc.threshold_qc(_qc(spark, sf_dir), inline(spark, QC_RULES, "concept, seq, side, limit, note")).select("order_id", "line_no", "concept", "value", "qc_pass", "qc_note")


@query("outcome_conflict", f"WITH {M_SQL} SELECT outcome, CASE WHEN line_no % 2 = 0 THEN '1' ELSE '0' END AS is_pos, CASE WHEN (outcome = 'N' AND line_no % 2 = 0) OR (outcome = 'A' AND line_no % 2 = 1) THEN 0 ELSE 2 END AS qc_pass, CASE WHEN (outcome = 'N' AND line_no % 2 = 0) OR (outcome = 'A' AND line_no % 2 = 1) THEN 'OUTCOME_EXTRACT_CONFLICT' END AS qc_note, count(*) AS n_rows FROM m GROUP BY ALL")
def outcome_conflict(spark, sf_dir):
    df = _qc(spark, sf_dir).withColumn("is_pos", F.when(F.col("line_no") % 2 == 0, "1").otherwise("0"))
    return qc.outcome_conflict(df).groupBy("outcome", "is_pos", "qc_pass", "qc_note").agg(F.count("*").alias("n_rows"))


@query("blacklist", f"WITH {M_SQL} SELECT concept, CASE WHEN concept IN (1, 5) AND line_no > 3 THEN 0 ELSE 2 END AS qc_pass, CASE WHEN concept = 1 AND line_no > 3 THEN 'bad' WHEN concept = 5 AND line_no > 3 THEN 'worse' END AS qc_note, count(*) AS n_rows, count(CASE WHEN NOT (concept IN (1, 5) AND line_no > 3) THEN value END) AS n_values FROM m GROUP BY ALL")
def blacklist(spark, sf_dir):
    return qc.blacklist(_qc(spark, sf_dir), inline(spark, "(1, 'bad'), (5, 'worse')", "concept, note")).groupBy("concept", "qc_pass", "qc_note").agg(F.count("*").alias("n_rows"), F.count("merged_value").alias("n_values"))


@query("row_accounting", "SELECT count(*) AS n_in, count(*) FILTER (WHERE o_orderstatus <> 'P') AS n_out, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_quarantined, true AS balanced FROM orders")
def row_accounting(spark, sf_dir):
    from ..operators import audit

    df = table(spark, sf_dir, "orders").withColumn("bad", clean.denied(F.col("o_orderstatus")))
    return audit.row_accounting(df, df.filter("not bad"), readers.quarantine(df, "bad", "measurement_status", "o_orderstatus", "o_orderkey", "o_orderdate"))


@query("quarantine_status", "SELECT o_orderkey AS row_id, 'measurement_status' AS err, o_orderstatus AS err_value FROM orders WHERE o_orderstatus = 'P'")
def quarantine_status(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumn("bad", clean.denied(F.col("o_orderstatus")))
    return readers.quarantine(df, "bad", "measurement_status", "o_orderstatus", "o_orderkey", "o_orderdate").drop("event_datetime")
