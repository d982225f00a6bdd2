"""Operators on hand-made rows: golden cases, edge rows, brute-force twins."""

import math
import random

import pytest
from pyspark.sql import functions as F

from labflow.functions.scalar import normal_quantile, number
from labflow.operators import audit, clean, dedup, extract, harmonise, jobs, limits, qc, release, stats, units
from labflow.sources import readers


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


RAW = "row_id long, person string, day string, time string, status string, national_code string, local_code string, name string, coding_system string, value string, unit string, outcome string, text string"


def dictionaries(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    pairs = "from string, to string"
    return jobs.Dictionaries(
        frame([("9999", "b-hb")], pairs), frame([("1.2.246.10.1", "1.2.246.10.55.9"), ("prov", "named")], pairs), frame([("55", "town")], pairs), frame([("g/l", "g/l")], pairs), frame([("g/l",)], "unit string"),
        frame([("b-hb", "mg/l", "g/l")], "test string, unit string, fix string"), frame([("b-hb", "g/l", 5, "mass", "APPROVED")], "test string, unit string, concept int, quantity string, status string"),
        frame([("mass", "g/l", "mg/l", "1000", None)], "quantity string, source_unit string, target_unit string, conversion string, only_concept int"), frame([(5, "mass", "mg/l")], "concept int, quantity string, target_unit string"),
    )


def raw_row(i, status="F", day="2020-01-02", national=None, local="0000", name=" Tes t_*", value="1.2345", unit="g/l", outcome="<", text="free text"):
    return (i, "P1", day, "08:30", status, national, local, name, "1.2.246.10.1", value, unit, outcome, text)


@pytest.mark.parametrize("status,rows", [("F", 1), ("X", 0)])
def test_golden_rows(spark, status, rows):
    out = jobs.munge(spark.createDataFrame([raw_row(1, status)], RAW), dictionaries(spark))
    got = out.rows.collect()
    assert len(got) == rows and out.errors.count() == 1 - rows
    if rows:
        r = got[0]
        assert (r.test_id, r.is_national, r.test, r.value, r.clean_unit, r.unit_valid, r.concept, r.outcome) == ("0000", "0", "test", "1.2345", "g/l", "1", -1, "L")
        assert (r.source_name, r.coding_system, r.coding_system_map, r.text, str(r.event_datetime)) == ("Test_*", "1.2.246.10.55.9", "town", "free text", "2020-01-02 08:30:00")


def test_munge_keeps_account_of_every_row(spark):
    rows = [raw_row(1), raw_row(2, day="2020-13-01"), raw_row(3, status=" K "), raw_row(4, national="9999", unit="MG / L"), raw_row(5, national="1234", value="TYHJÄ", unit=None, outcome="x", text=None), raw_row(6, status=None, local=None, name=None, unit="y/l")]
    df = spark.createDataFrame(rows, RAW).withColumn("provider", F.lit("prov"))
    out = jobs.munge(df, dictionaries(spark))
    got = {r.row_id: r for r in out.rows.collect()}
    assert {(r.row_id, r.err, r.err_value) for r in out.errors.collect()} == {(2, "DATE", "2020-13-01 08:30"), (3, "measurement_status", "K")}
    assert sorted(got) == [1, 4, 5, 6] and {r.provider for r in got.values()} == {"named"}
    assert (got[4].test, got[4].clean_unit, got[4].unit_before_fix, got[4].unit_valid, got[4].concept, got[4].harm_value, got[4].harm_unit) == ("b-hb", "g/l", "mg/l", "unit_fixed", 5, 1234.5, "mg/l")
    assert (got[5].test, got[5].value, got[5].clean_unit, got[5].outcome, got[5].text) == (None, None, None, None, None)
    assert (got[6].test, got[6].test_id, got[6].clean_unit) == (None, None, "u/l")
    assert [(r.row_id, r.err, r.err_value) for r in out.warnings.collect()] == [(5, "lab_mapping", "1234")]
    assert {(r.row_id, r.old, r.new, r.source) for r in out.units.collect()} == {(6, "y/l", "u/l", "regex")}
    assert {(r.row_id, r.old, r.new) for r in out.names.collect()} == {(1, "test_*", "test")}
    empty = jobs.munge(df.limit(0), dictionaries(spark))
    assert [x.count() for x in (empty.rows, empty.errors, empty.warnings, empty.units, empty.names)] == [0] * 5


def test_core_job(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    tables = jobs.CoreTables(
        frame([(5, "mg/l")], "concept int, target_unit string"), frame([("NEG", "0")], "text string, flag string"), frame([("++", 5, "1")], "text string, concept int, flag string"), frame([], "from string, to string"), frame([("mg/l",)], "unit string"),
        frame([(5, 1, "merged", "<", 1.0, 10.0, "tenfold")], "concept int, seq int, column string, side string, limit double, factor double, note string"), frame([(5, 1, ">", 100.0, "high")], "concept int, seq int, side string, limit double, note string"),
        frame([(6, "no extraction")], "concept int, note string"), frame([(5, 2.0, 50.0, False, True)], "concept int, low double, high double, low_problem boolean, high_problem boolean"),
    )
    cols = "row_id long, event_datetime timestamp, test string, concept int, harm_value double, source_value string, outcome string, text string"
    rows = [(1, None, "t", 5, 3.0, None, "N", "++"), (2, None, "t", 5, None, "0.5", "A", "NEG"), (3, None, "t", 5, None, None, None, "150203"), (4, None, "t", 6, None, None, None, "7,5"), (5, None, None, 5, 0.5, None, None, None), (6, None, "t", 5, 200.0, None, None, "< 3 mg/l"), (7, None, "t", -1, None, None, None, None)]
    out = jobs.core(frame(rows, cols), tables, source_values=True, drop=("text",))
    got = {r.row_id: (r.merged_value, r.is_pos, r.outcome_text, r.qc_pass, r.qc_note, r.imputed_outcome) for r in out.rows.collect()}
    assert "text" not in out.rows.columns
    assert got == {
        1: (3.0, "1", "++", 0, "OUTCOME_EXTRACT_CONFLICT", "N"), 2: (5.0, "0", None, 0, "tenfold; OUTCOME_EXTRACT_CONFLICT", "N"), 4: (None, None, None, 0, "no extraction", None),
        5: (5.0, None, None, 1, "tenfold", "N"), 6: (200.0, None, "<3mg/l", 0, "high", "H*"), 7: (None, None, None, 2, None, None),
    }
    assert [(r.row_id, r.err, r.err_value) for r in out.errors.collect()] == [(3, "DATE_IN_MEASUREMENT", "t::NA::150203::150203.0")]
    assert {(r.row_id, r.err, r.err_value) for r in out.warnings.collect()} == {(2, "QC_CONVERT", "t;tenfold"), (5, "QC_CONVERT", ";tenfold"), (1, "QC_NOTE_APPENDED", "t;OUTCOME_EXTRACT_CONFLICT"), (2, "QC_NOTE_APPENDED", "t;tenfold; OUTCOME_EXTRACT_CONFLICT"), (4, "QC_NOTE_APPENDED", "t;no extraction")}


def test_loaders(spark, tmp_path):
    def file(name, *lines):
        (tmp_path / name).write_text("".join("\t".join(x) + "\n" for x in lines))
        return str(tmp_path / name)

    words = readers.vocabulary(spark, file("v", ("code", "U", "x"), (" g/l ", "TRUE", "1"), (" g/l ", "TRUE", "1"), ("kg", "FALSE", "2")), {"code": "unit", "U": "unique"})
    assert sorted((r.unit, r.unique) for r in words.collect()) == [("g/l", "TRUE"), ("kg", "FALSE")]
    assert [r.unit for r in readers.approved_units(words).collect()] == ["g/l"]
    assert [(r.test, r.unit, r.fix) for r in readers.unit_fix_table(spark, file("f", ("t", "u", "f"), ("a", "g", "first"), ("a", "g", "second"))).collect()] == [("a", "g", "first")]
    assert [(r.concept, r.note) for r in readers.blacklist_table(spark, file("b", ("c", "n", "d"), ("7", "no", "x"))).collect()] == [(7, "no")]
    rules = readers.value_fix_table(spark, file("r", ("c", "col", "v", "s", "x", "n"), ("7", "merged", "10", "<", "2", "a"), ("7", "merged", "1", ">", "3", "b")))
    assert [(r.seq, r.side, r.limit, r.factor, r.note) for r in rules.orderBy("seq").collect()] == [(1, "<", 10.0, 2.0, "a"), (2, ">", 1.0, 3.0, "b")]
    assert [(r.seq, r.limit) for r in readers.threshold_table(spark, file("q", ("c", "v", "s", "n"), ("7", "NA", "NA", "a"))).collect()] == [(1, None)]
    assert [(r.concept, r.text, r.flag) for r in readers.plus_table(spark, file("p", ("c", "t", "f", "d"), ("1", "++", "1", ""), ("1", "+-", "2", ""))).collect()] == [(1, "++", "1")]
    assert [r.text for r in readers.posneg_table(spark, file("n", ("t", "f"), ("neg", "0"), ("odd", ""))).collect()] == ["neg"]
    assert [r.target_unit for r in readers.target_units(spark, file("t", ("c", "q", "u", "o"), ("1", "mass", "g", "x"), ("2", "mass", "NA", "x"))).collect()] == ["g"]


def test_small_pieces(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "secret"), (2, None, None)], "n int, x string, text string")
    assert clean.rename(df, {"x": "y"}).columns == ["n", "y", "text"] and clean.keep_source(df, {"x": "source_x"}).first().source_x == "a"
    assert release.without(df).columns == ["n", "x"] and release.last(df.select("text", "n", "x")).columns == ["n", "x", "text"]
    readers.write_parquet(df, str(tmp_path / "p"))
    assert sorted(map(tuple, readers.read_parquet(spark, str(tmp_path / "p"), ["n", "x"]).collect())) == [(1, "a"), (2, None)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        readers.write_parquet(df, str(tmp_path / "p"))
    for name, row in (("a.tsv", "1\tx"), ("b.tsv", "2\ty")):
        (tmp_path / name).write_text(f"n\tx\n{row}\n")
    assert sorted((r.n, r.x) for r in readers.union_files(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")], ["n", "x"]).collect()) == [("1", "x"), ("2", "y")]
    assert [r.n for r in dedup.sort_by(spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, None)], "n int, x string"), "x", "-n").collect()] == [4, 3, 2, 1]
    one = spark.createDataFrame([("c", 3, "b"), ("c", 1, "a")], "k string, n long, u string")
    assert audit.as_json(one, ["k"], "u", "n").first().json == '{"a":1,"b":3}'
    hashes = [r.hash for r in audit.content_hash(spark.createDataFrame([(None, "a"), ("", "a"), (None, "a")], "x string, y string"), ["x", "y"]).collect()]
    assert hashes[0] == hashes[2] != hashes[1]
    assert audit.with_names(spark.createDataFrame([(1, 5), (2, 6)], "concept int, n int"), spark.createDataFrame([(1, "one")], "concept int, name string")).orderBy("concept").collect()[1].name is None


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "bad.tsv").write_text("a\tb\n1\tx\n2\ty\tz\n3\n")
    good, bad = readers.split_bad(readers.read_tsv(spark, str(tmp_path / "bad.tsv"), ["a", "b"], keep_bad=True))
    assert [(r.a, r.b) for r in good.collect()] == [("1", "x")] and good.columns == ["a", "b"]
    assert sorted(r.line for r in bad.collect()) == ["2\ty\tz", "3"]


def test_running_ratio_in_pieces(spark):
    """A key that holds most rows is cut into pieces; the ratios are those of one run through the key."""
    rnd = random.Random(2)
    rows = [("hot" if k % 10 else f"k{k % 7}", k, rnd.random() < 0.3) for k in range(2000)]
    df = spark.createDataFrame(rows, "key string, at int, flag boolean").repartition(5)
    got = {(r.key, r.at): r.ratio for r in stats.running_ratio(df, ["key"], ["at"], "flag").collect()}
    seen = {}
    for key, at, flag in sorted(rows):
        n, hit = seen.get(key, (0, 0))
        seen[key] = (n + 1, hit + flag)
        assert math.isclose(got[key, at], (hit + flag) / (n + 1))
    assert len(got) == 2000


def test_division_by_nothing(spark):
    """Empty tables and zero counts give nulls or zeros, not errors."""
    none = spark.createDataFrame([], "k string, n long, value double")
    assert [r.percent for r in audit.null_report(none).collect()] == [None] * 3
    assert dedup.duplicate_rate(none.withColumn("duplicate", F.lit(True))).first().percent is None
    one = spark.createDataFrame([("a", 1, 1)], "k string, n_rows long, people long")
    zero = spark.createDataFrame([("a", 0, 0, "x")], "k string, n_rows long, people long, note string")
    assert audit.version_compare(one, zero, "k", ["n_rows"]).first().growth is None
    assert audit.version_compare(one.limit(0), zero.limit(0), "k", ["n_rows"]).count() == 0
    assert audit.reconcile(one, zero, ["k"]).first().rows_ratio is None
    scored = spark.createDataFrame([("t", s, "u", 0.0, 5) for s in ("all", "low", "high")] + [("w", "all", "u", 0.5, 5)], "test string, sub string, unit string, ks double, n long")
    assert {r.test: r.improvement for r in stats.split_score(scored, ["test"]).collect()} == {"t": 0.0, "w": None}
    assert dedup.rank_sample(one, ["k"], "n_rows", "people", k=1).count() == 1
    assert units.concept_units(spark.createDataFrame([(1, "a", "q"), (1, "b", "q")], "concept int, unit string, quantity string"), spark.createDataFrame([("q", "b", "a", 0.0)], "quantity string, source_unit string, target_unit string, factor double")).first().status == "NO_CONV"
    empty = spark.createDataFrame([], "k string, side string, value double")
    assert stats.decide(empty, ["k"]).count() == 0 and stats.bimodality(empty, ["k"]).count() == 0 and stats.mixture(empty, ["k"]).count() == 0 and stats.bimodal_check(empty, ["k"]).count() == 0
    assert stats.sigma_filter(empty, ["k"]).count() == 0 and stats.average_rank(empty).count() == 0 and audit.row_accounting(empty, empty, empty).first().balanced


def test_ks_p_is_exact(spark):
    """Against the count of all interleavings, and at fixed values of the corrected limit."""
    import itertools

    for n, m, d in ((3, 5, 0.6), (4, 4, 0.75), (5, 6, 1.0), (2, 7, 5 / 14)):
        hit = 0
        paths = list(itertools.combinations(range(n + m), n))
        for c in paths:
            i = j = most = 0
            for k in range(n + m):
                i, j = (i + 1, j) if k in c else (i, j + 1)
                most = max(most, abs(i * m - j * n))
            hit += most >= round(d * n * m)
        df = spark.createDataFrame([(d, n, m)], "d double, n long, m long")
        assert df.select(stats.ks_p(F.col("d"), F.col("n"), F.col("m")).alias("p")).first().p == pytest.approx(hit / len(paths), rel=1e-9)
    df = spark.createDataFrame([(0.05, 20000, 20000), (0.01, 20000, 20000), (None, 20000, 20000), (None, 5, 5)], "d double, n long, m long")
    got = [r.p for r in df.select(stats.ks_p(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()]
    assert got[1] == pytest.approx(stats.one_sample_p(0.01, 10_000), rel=1e-12)
    assert 0 <= got[0] < 1e-18 and got[2:] == [None, None]
    lam = (1000 + 0.12 + 0.11 / 1000) * 0.001
    large = spark.createDataFrame([(0.001, 2_000_000, 2_000_000)], "d double, n long, m long").select(stats.ks_p(F.col("d"), F.col("n"), F.col("m")).alias("p")).first().p
    assert large == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 50)), rel=1e-9)


def test_ks_p_of_finite_samples():
    """Published values of the one-sample distribution function, and a matrix power."""
    for d, n, want in ((0.04, 2000, 0.99676943191713676985), (0.06, 2000, 0.99999989395692991), (0.016, 16000, 0.99945234913828052085)):
        assert 1 - stats.one_sample_p(d, n) == pytest.approx(want, abs=1e-6)
    import numpy as np

    for n, d in ((2000, 0.01), (2000, 0.02), (2000, 0.0447), (3000, 0.025)):
        k = int(n * d) + 1
        m, h = 2 * k - 1, k - n * d
        t = np.array([[0.0 if i - j + 1 < 0 else 1.0 for j in range(m)] for i in range(m)])
        for i in range(m):
            t[i, 0] -= h ** (i + 1)
            t[m - 1, i] -= h ** (m - i)
        t[m - 1, 0] += max(2 * h - 1, 0) ** m
        for i in range(m):
            for j in range(m):
                t[i, j] /= math.factorial(max(i - j + 1, 0)) if i - j < 160 else math.inf
        row, log = t[k - 1], 0.0
        for _ in range(n - 1):
            row = row @ t
            log += math.log(row.max())
            row = row / row.max()
        want = math.exp(math.log(row[k - 1]) + log + sum(math.log(i / n) for i in range(1, n + 1)))
        assert 1 - stats.one_sample_p(d, n) == pytest.approx(want, abs=1e-7)
    assert stats.one_sample_p(0.5, 250_000) == 0 and stats.one_sample_p(0, 10) == 1 and stats.one_sample_p(1, 10) == 0


def test_mixture_against_rows(spark):
    """Two normals by EM on rows instead of a histogram; the space with the lower BIC wins."""
    import numpy as np

    rng = np.random.default_rng(6)
    sets = {"two": np.round(np.r_[rng.normal(10, 1, 600), rng.normal(20, 1.5, 400)], 2), "log": np.round(10 ** np.r_[rng.normal(0, 0.1, 500), rng.normal(2, 0.2, 500)], 3), "one": np.round(rng.normal(50, 5, 800), 2), "few": np.array([1.0, 2.0, 4.0]), "small": np.round(np.r_[rng.normal(0.1, 0.01, 600), rng.normal(0.2, 0.015, 400)], 4)}
    df = spark.createDataFrame([(k, float(v)) for k, x in sets.items() for v in x], "k string, value double")
    got = {r.k: r for r in stats.mixture(df, ["k"]).collect()}
    for name in ("two", "one"):
        x, r = np.sort(sets[name]), got[name]
        cut = min(range(1, len(x)), key=lambda i: x[:i].var() * i + x[i:].var() * (len(x) - i))
        resp, before = (np.arange(len(x)) < cut).astype(float), -np.inf
        for _ in range(300):
            w = resp.mean()
            m1, m2 = np.average(x, weights=resp), np.average(x, weights=1 - resp)
            s1, s2 = (np.sqrt(np.average((x - m) ** 2, weights=q) + 1e-6) for m, q in ((m1, resp), (m2, 1 - resp)))
            a, b = w / s1 * np.exp(-0.5 * ((x - m1) / s1) ** 2), (1 - w) / s2 * np.exp(-0.5 * ((x - m2) / s2) ** 2)
            resp, now = a / (a + b), np.log((a + b) / math.sqrt(2 * math.pi)).mean()
            if abs(now - before) < 1e-3:
                break
            before = now
        assert (r.w, r.m1, r.m2, r.s1, r.s2) == pytest.approx((w, m1, m2, s1, s2), rel=1e-6)
        assert r.bic == pytest.approx(5 * math.log(len(x)) - 2 * now * len(x), rel=1e-9)
    assert 13 < got["two"].separator < 17 and got["two"].overlap_pct < 2
    best = {r.k: r for r in stats.bimodal_check(df, ["k"]).collect()}
    assert not best["small"].log_space and best["small"].shape == best["two"].shape == "bimodal" and best["log"].log_space and 3 < best["log"].separator < 60 and best["one"].shape == "unimodal"
    wide = stats.mixture(df.filter("k = 'two'"), ["k"]).first()
    small = stats.histogram(df.filter("k = 'two'"), ["k"], cells=64)
    assert small.count() <= 64 and small.agg(F.sum("__k")).first()[0] == 1000 and wide.n == 1000


def test_ambiguous_pass_splits(spark):
    """A sample of two units is cut and each half finds its unit; a sample of one unit stays whole."""
    import numpy as np

    rng = np.random.default_rng(9)
    rows = [("mix", None, float(v)) for v in np.r_[rng.normal(10, 1, 150), rng.normal(100, 8, 150)]] + [("mix", u, float(v)) for u, m, s in (("mg", 10, 1), ("ug", 100, 8)) for v in rng.normal(m, s, 200)]
    rows += [("plain", None, float(v)) for v in rng.normal(10, 1, 200)] + [("plain", u, float(v)) for u, m in (("mg", 10), ("ug", 40)) for v in rng.normal(m, 1, 200)]
    df = spark.createDataFrame(rows, "test string, unit string, value double").withColumns({"extracted": F.lit(None).cast("double"), "concept": F.lit(1)})
    top = units.prevalence(df)
    got = {(r.test, r["sub"]): r for r in units.ambiguous_pass(units.samples(df), units.classify(units.targets(df, 1), top), top).collect()}
    assert set(got) == {("mix", "low"), ("mix", "high"), ("plain", "all")}
    assert got["mix", "low"].unit == "mg" and got["mix", "high"].unit == "ug" and 12 < got["mix", "low"].cutoff < 90 and got["plain", "all"].unit == "mg"
    low, plain = got["mix", "low"], got["plain", "all"]
    assert low.status == "bimodal" and low.dip_p < 0.05 and low.separator == low.cutoff and low.score_improvement > 0.15 and low.score_split < low.score_global
    assert len(low.cand_deciles) == len(low.targ_deciles) == 9 and low.prevalence == "{mg:50.0,ug:50.0}" and low.unit_prevalence == 50.0 and low.ks_mlogp >= 0 and low.t_mlogp >= 0
    assert plain.status == "skipped" and plain.separator is None and plain.dip_p is None and plain.n_cand == 200 and plain.mad_dist <= plain.mad_threshold


@pytest.mark.parametrize("text,value", [("12", 12.0), ("12d", None), ("12f", None), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("", None), ("nan", None), ("inf", None), (None, None)])
def test_number(spark, text, value):
    assert one(spark, text, number) == value


@pytest.mark.parametrize("raw,unit", [("y/l", "u/l"), ("10e9/l", "e9/l"), ("mmol/ml", "mmol/ml"), ("pg/ml", "ng/l"), ("sek", "s"), ("/vrk", "/24h"), ("neg", "N"), ("ug/ml", "mg/l"), ("kpl/nk", "u/field"), ("***", "NA")])
def test_unit_rewrites(spark, raw, unit):
    assert one(spark, raw, clean.rewrite_unit) == unit


def test_unit_strip_and_modes(spark):
    assert one(spark, " (MMOL / L).", clean.strip_unit) == "mmol/l" and one(spark, " -?", clean.strip_unit) is None
    df = spark.createDataFrame([("sek",), (None,)], "unit string")
    known = spark.createDataFrame([("sek", "second")], "from string, to string")
    for mode, want in (("map", "second"), ("regex", "s"), ("none", "sek")):
        assert {r.clean_unit for r in clean.fix_units(df, "unit", known, mode=mode).collect()} == {want, None}


def test_text_cleaning(spark):
    assert one(spark, "a\r\nb\tc\rd\n", clean.sanitise_text) == "a␤b␉c␤d␤"
    assert one(spark, "1234,b_hb*#,9999", clean.clean_name) == "bhb"
    df = spark.createDataFrame([(" a b ", " x "), ("  ", None)], "a string, free string")
    assert [(r.a, r.free) for r in clean.remove_spaces(df, ["free"]).collect()] == [("ab", " x "), (None, None)]
    bad = spark.createDataFrame([("2020-01-02", "09:30"), ("2020-13-02", "09:30"), (None, "09:30")], "d string, t string")
    assert [r.event_datetime is None for r in clean.build_datetime(bad, "d", "t").collect()] == [False, True, True]


@pytest.mark.parametrize("raw,code", [("<", "L"), (">", "H"), ("POS", "A"), ("NEG", "N"), ("HH", "HH"), ("OTHER", None), (None, None)])
def test_outcomes(spark, raw, code):
    assert one(spark, raw, clean.outcome_code) == code


@pytest.mark.parametrize("text,unit,value", [("Tulos: 5,4 mg/l", "mg/l", 5.4), ("5,4*", None, 5.4), ("12d", None, None), ("mg/l 7", "mg/l", 7.0), (None, "mg/l", None)])
def test_extracted_number(spark, text, unit, value):
    df = spark.createDataFrame([(text, unit)], "t string, u string")
    assert df.select(extract.extracted_number(F.col("t"), F.col("u")).alias("v")).first().v == value


@pytest.mark.parametrize("text,out", [("<5 mg/l", "<5mg/l"), ("yli 3.0 mg/l", ">3mg/l"), ("Tulos: alle 5,50 mg/l", "<5.5mg/l"), ("< x mg/l", None), ("5 mg/l", None), ("<5 zz", None), ("<5", "<5"), (None, None)])
def test_comparisons(spark, text, out):
    df = spark.createDataFrame([(text,)], "t string")
    got = extract.comparison_outcome(df, "t", spark.createDataFrame([("mgl", "mg/l")], "from string, to string"), spark.createDataFrame([("mg/l",)], "unit string"))
    assert got.first().outcome_text == out


@pytest.mark.parametrize("value,date", [(150203.0, True), (10203.0, False), (320101.0, False), (151303.0, False), (150203.5, False), (None, False)])
def test_date_in_value(spark, value, date):
    assert spark.createDataFrame([(value,)], "v double").select(qc.is_date(F.col("v")).alias("d")).first().d == date


def test_rules_see_earlier_results(spark):
    df = qc.start(spark.createDataFrame([(1, 5.0, None, 5.0), (1, 50.0, 2.0, 50.0), (2, None, None, None)], "concept int, merged_value double, extracted_value double, harm_value double"))
    rules = spark.createDataFrame([(1, 1, "merged", "<", 10.0, 10.0, "a"), (1, 2, "merged", ">=", 50.0, 0.5, "b"), (1, 3, "extracted", "==", 2.0, 3.0, "c")], "concept int, seq int, column string, side string, limit double, factor double, note string")
    assert [(r.merged_value, r.qc_note) for r in qc.fix_values(df, rules).orderBy(F.desc("merged_value")).collect()] == [(75.0, "b; c"), (25.0, "a; b"), (None, None)]


def test_conversion_priority_and_formula(spark):
    conv = spark.createDataFrame([("q", "a", "t", "2", None), ("q", "a", "t", "3", 7), ("q", "b", "t", "0.5*X-1.50", None)], "quantity string, source_unit string, target_unit string, conversion string, only_concept int")
    table = harmonise.conversion_table(conv, spark.createDataFrame([(7, "q", "t"), (8, "q", "t")], "concept int, quantity string, target_unit string"))
    df = spark.createDataFrame([(7, "q", "a", "10"), (8, "q", "a", "10"), (8, "q", "b", "10"), (8, "q", "b", None), (9, "q", "a", "1")], "concept int, quantity string, clean_unit string, value string")
    assert [(r.harm_unit, r.harm_value) for r in harmonise.convert(df, table).orderBy("concept", "clean_unit", F.desc("value")).collect()] == [("t", 30.0), ("t", 20.0), ("t", 3.5), ("t", None), (None, None)]


def brute_walk(rows, low, t):
    num = ("A", "AA", "L", "LL") if low else ("A", "AA", "H", "HH")
    den = {*num, "N", *(("H", "HH") if low else ("L", "LL"))}
    rows = sorted(((v, o or "NA") for v, o in rows), key=lambda x: (x[0] if low else -x[0], x[1]))[: len(rows) // 2]
    a = b = 0
    ratios = []
    for v, o in rows:
        a, b = a + (o in num), b + (o in den)
        ratios.append((a / (b + 0.0001), v, o))
    if not ratios:
        return None, False
    known = [r for r in ratios if r[2] != "NA"]
    if known and known[-1][0] > t:
        return ratios[-1][1], True
    bad = [r for r in known if r[0] > t]
    return (bad[-1][1] if bad else None), False


def test_walk_limits_against_rows(spark):
    rnd = random.Random(1)
    groups = {g: [(float(rnd.randint(0, 12)), rnd.choice(["L", "H", "N", "N", "A", None, "LL", "HH", "NN"])) for _ in range(rnd.randint(1, 60))] for g in range(60)}
    df = spark.createDataFrame([(g, v, o) for g, rows in groups.items() for v, o in rows], "concept int, value double, outcome string")
    for r in limits.walk_limits(df, 0.3).collect():
        for low, side in ((True, "low"), (False, "high")):
            want = brute_walk(groups[r.concept], low, 0.3)
            assert (r[side], bool(r[f"{side}_problem"])) == want, (r, side)


def test_statistics_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    sets = {"a": (rng.normal(0.3, 1, 400), rng.normal(0, 1, 500)), "b": (rng.normal(5, 1, 50), rng.normal(0, 1, 60)), "c": (np.round(rng.normal(0, 0.1, 80), 1), np.round(rng.normal(0, 1, 90), 1))}
    df = spark.createDataFrame([(k, s, float(v)) for k, (c, t) in sets.items() for s, x in (("cand", c), ("targ", t)) for v in x], "k string, side string, value double")
    got = {r.k: r for r in stats.decide(df, ["k"]).collect()}
    for k, (c, t) in sets.items():
        grid = np.union1d(c, t)
        d = np.abs(np.searchsorted(np.sort(c), grid, "right") / len(c) - np.searchsorted(np.sort(t), grid, "right") / len(t)).max()
        assert math.isclose(got[k].ks, d, abs_tol=1e-12)
        w = (c.mean() - t.mean()) / math.sqrt(c.var(ddof=1) / len(c) + t.var(ddof=1) / len(t))
        assert math.isclose(got[k].t, w, rel_tol=1e-9)
    assert (got["a"].verdict, got["a"].decided_by) == ("PASS", "KS") and (got["b"].verdict, got["b"].decided_by) == ("FAIL", "MAD")
    # Student's t: two-sided p of 2.0 with 10 degrees of freedom
    p = spark.createDataFrame([(2.0, 10.0), (0.0, 5.0)], "t double, df double").select(stats.student_p("t", "df").alias("p")).collect()
    assert abs(p[0].p - 0.07338803477074037) < 1e-9 and abs(p[1].p - 1) < 1e-9


def test_normal_quantile(spark):
    got = spark.createDataFrame([(0.5,), (0.975,), (0.001,)], "p double").select(normal_quantile(F.col("p")).alias("z")).collect()
    assert [round(r.z, 6) for r in got] == [0.0, 1.959964, -3.090232]


def test_mixture_finds_two_bumps(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([("k", rnd.gauss(0, 1) if i % 2 else rnd.gauss(10, 1)) for i in range(600)], "k string, value double")
    r = stats.mixture(df, ["k"]).withColumn("cut", F.col("separator")).first()
    assert abs(min(r.m1, r.m2)) < 0.3 and abs(max(r.m1, r.m2) - 10) < 0.3 and 3.5 < r.cut < 6.5


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", 2), (1, None, 1), (1, None, 0)], "k int, x string, y int")
    assert sorted(((r.x, r.y) for r in dedup.keyed_dedup(df, ["k", "x"]).collect()), key=str) == [("a", None), (None, 0)]
    flags = dedup.adjacent_flags(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a"), (5, None), (6, None)], "row_id long, k string"), ["k"])
    assert [r.duplicate for r in flags.orderBy("row_id").collect()] == [False, True, False, False, False, True]
    numbered = dedup.number_rows(spark.range(1000).repartition(7), ["id"]).collect()
    assert all(r.row_id == r.id + 1 for r in numbered)
    breaks = dedup.order_breaks(spark.createDataFrame([("f1", 0, 1), ("f1", 1, 5), ("f1", 2, 4), ("f2", 0, 3)], "f string, i long, id long"), "f", "i", "id").collect()
    assert sorted((r.f, r.id) for r in breaks) == [("f1", 4), ("f2", 3)]


def test_audits(spark):
    df = spark.createDataFrame([("a", None), (None, 1)], "x string, y int")
    assert {(r.column, r.n_null, r.percent) for r in audit.null_report(df).collect()} == {("x", 1, 50.0), ("y", 1, 50.0)}
    votes = spark.createDataFrame([(1, "q", "u", "source")] * 3 + [(1, "q", None, "source"), (1, "q", "v", "injected"), (2, "q", None, "source")], "concept int, quantity string, unit string, origin string")
    got = {r.concept: r for r in audit.elect_unit(votes, spark.createDataFrame([(1, "q", "w")], "concept int, quantity string, unit string")).collect()}
    assert (got[1].source_unit, got[1].source_share, got[1].injected_unit, got[1].target_unit, got[1].note) == ("u", 0.75, "v", "w", "LOCKED") and got[2].target_unit is None
    assert one(spark, "=1+1", audit.spreadsheet_safe) == "'=1+1"


def test_units(spark):
    rows = [("t", None, float(i), None, 1) for i in range(20)] + [("t", "g", float(i), None, 1) for i in range(40)] + [("u", None, 1.0, 2.0, 2)] * 20
    df = spark.createDataFrame(rows, "test string, unit string, value double, extracted double, concept int")
    classes = units.classify(units.targets(df, 5), units.prevalence(df))
    assert {(r.test, r.category) for r in classes.collect()} == {("t", "UNAMBIGUOUS"), ("u", "NO_DATA")}
    assert units.unambiguous_pass(units.samples(df), classes).first().status in ("PASS", "FAIL")
    fixed = units.rescue(classes.filter("category = 'NO_DATA'"), spark.createDataFrame([(2, "SINGLE", "mg")], "concept int, status string, canonical string"))
    assert fixed.first().unit == "mg"


def test_release_projection(spark):
    df = spark.createDataFrame([("7", "p", "-1", "NA", "x"), ("8", None, "300", "1.5", "1")], "row_id string, person string, concept string, harm_value string, qc_pass string")
    got = release.project(df).orderBy("ROW_ID").collect()
    assert (got[0].OMOP_CONCEPT_ID, got[0].MEASUREMENT_VALUE_HARMONIZED, got[0].QC_PASS) == (None, None, None) and (got[1].OMOP_CONCEPT_ID, got[1].MEASUREMENT_VALUE_HARMONIZED, got[1].QC_PASS) == ("300", 1.5, 1)
    assert {r.type for r in readers.schema_export(release.project(df)).collect()} == {"INTEGER", "STRING", "FLOAT", "TIMESTAMP"}


def test_sources(spark, tmp_path):
    main = tmp_path / "main.tsv"
    main.write_text("a\tb\n1\tx\n2\t\"line\nbreak\"\n3\tz\n")
    df = readers.read_tsv(spark, str(main), ["a", "b"])
    assert [(r.a, r.b) for r in df.orderBy("a").collect()] == [("1", "x"), ("2", "line\nbreak"), ("3", "z")]
    assert [(r.row_no, r.a) for r in readers.number_in_file(df).orderBy("row_no").collect()] == [(1, "1"), (2, "2"), (3, "3")]
    assert [(r.problem, r.column) for r in readers.header_problems(spark, str(main), ["a", "c"]).collect()] == [("MISSING", "c"), ("EXTRA", "b")]
    assert {r.problem for r in readers.header_problems(spark, str(main), ["b", "a"]).collect()} == {"ORDER"}
    listing = tmp_path / "pairs"
    listing.write_text("a.tsv\tb.tsv\nc.tsv\nd.csv\te.tsv\n")
    assert sorted(r.problem for r in readers.manifest_problems(spark, str(listing)).collect()) == ["MISSING_FILE", "MISSING_FILE", "NOT_A_PAIR", "NOT_TSV"]
    listing.write_text(f"{main}\t{main}\n")
    assert readers.manifest_problems(spark, str(listing), ["a", "b"], ["a", "b"]).count() == 0
    assert {r.problem for r in readers.manifest_problems(spark, str(listing), ["a", "b"], ["a", "c"]).collect()} == {"HEADER MISSING c", "HEADER EXTRA b"}
    readers.write_tsv(spark.createDataFrame([("1", None)], "a string, b string"), str(tmp_path / "out"), gzip=False)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        readers.write_tsv(df, str(tmp_path / "out"))
    assert "1\tNA" in "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))


def test_streaming_rowwise(spark, tmp_path):
    from labflow.streaming.rowwise import clean_stream

    raw = spark.createDataFrame([("T1", "MMOL/L", "5", "<", "F"), ("T1", "y/l", "x", "POS", "X")], "test string, unit string, value string, outcome string, status string")
    raw.write.parquet(str(tmp_path / "in"))
    stream = clean_stream(spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in")), spark.createDataFrame([("t1", "one")], "from string, to string"))
    q = stream.writeStream.format("memory").queryName("cleaned").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("cleaned").collect()
    assert len(got) == 1 and (got[0].test_name, got[0].clean_unit, got[0].outcome, got[0].number) == ("one", "mmol/l", "L", 5.0)
