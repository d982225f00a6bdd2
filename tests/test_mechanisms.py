"""Mechanisms that operators share, against brute force: dips, formulas, quantiles, neighbours, bins, splits, one-pass jobs, stored releases."""

import csv
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labflow.operators import audit, clean, dedup, formulas, harmonise, jobs, pheno, quantiles, stats
from labflow.operators.dip import dip, dip_p
from labflow.plans import job_queries, registry
from labflow.sources import clustered, readers, split_scan

from .test_operators import RAW, dictionaries, raw_row


# ---------------------------------------------------------------------------------------------- dip
def _within(x, k, d):
    """Is there a distribution with one mode within d of the sample's?  The least value a convex start can reach at the mode, and the most a concave rest allows."""
    after = np.cumsum(k) / sum(k)
    before = after - np.array(k) / sum(k)

    def least(xs, low, high):
        low = [max(v, 0) for v in low]
        for a in range(len(xs)):
            if low[a] > high[a] + 1e-12:
                return None
            for b in range(a + 1, len(xs)):
                for c in range(b + 1, len(xs)):
                    t = (xs[b] - xs[a]) / (xs[c] - xs[a])
                    if low[b] > high[a] * (1 - t) + high[c] * t + 1e-12:
                        return None
        ends = [low[b] + (low[b] - high[a]) * (xs[-1] - xs[b]) / (xs[b] - xs[a]) for a in range(len(xs) - 1) for b in range(a + 1, len(xs) - 1)]
        v = max(*low, *ends, 0)
        return v if v <= high[-1] + 1e-12 else None

    for j in range(len(x)):
        left = least(x[: j + 1], [*(after[:j] - d), before[j] - d], [*(before[:j] + d), before[j] + d])
        right = least([-v for v in x[j:]][::-1], [1 - after[j] - d, *(1 - before[j + 1 :] - d)][::-1], [1 - after[j] + d, *(1 - after[j + 1 :] + d)][::-1])
        if left is not None and right is not None and left <= 1 - right + 1e-12:
            return True
    return False


def test_dip_against_its_definition():
    rnd = random.Random(1)
    for t in range(120):
        x = sorted(rnd.sample(range(60), rnd.randint(2, 8)))
        k = [rnd.choice([1, 1, 1, 2, 5]) if t % 2 else 1 for _ in x]
        low, high = 0.0, 1.0
        for _ in range(34):
            mid = (low + high) / 2
            low, high = (low, mid) if _within(x, k, mid) else (mid, high)
        assert dip(np.array(x), np.array(k)) == pytest.approx(max(high, 0.5 / sum(k)), abs=1e-8)
    assert dip(np.array([3.0]), np.array([4])) == 0.125 and np.isnan(dip(np.zeros(0), np.zeros(0)))


def test_dip_p_against_samples():
    """Half of uniform samples have a larger dip than the median's p says, a twentieth has p below 0.05."""
    rng = np.random.default_rng(8)
    for n in (30, 300):
        p = np.array([dip_p(dip(np.sort(rng.random(n)), np.ones(n)), n) for _ in range(600)])
        assert 0.42 < (p < 0.5).mean() < 0.58 and 0.02 < (p < 0.05).mean() < 0.085
    assert dip_p(0.3, 1000) == 0 and dip_p(0.001, 1000) == 1 and np.isnan(dip_p(0.1, 3))
    assert dip_p(0.003, 10**9) == dip_p(0.003, 50_000)


def test_bimodal_check_has_three_states(spark):
    rng = np.random.default_rng(3)
    sets = {"one": rng.normal(50, 5, 1500), "two": np.r_[rng.normal(10, 1, 800), rng.normal(20, 1, 700)], "careful": np.r_[rng.normal(10, 1, 1900), rng.normal(16.5, 1.3, 150), rng.normal(4, 1.3, 150)]}
    df = spark.createDataFrame([(k, float(round(v, 4))) for k, x in sets.items() for v in x], "k string, value double")
    got = {r.k: r for r in stats.bimodal_check(df, ["k"]).collect()}
    assert got["one"].shape == "unimodal" and got["two"].shape == "bimodal"
    assert {r.shape for r in spark.createDataFrame([(0.4, 0.01), (0.6, 0.01), (0.6, 0.5), (0.6, None), (0.4, None)], "bc double, p double").select(stats.bimodal_status(F.col("bc"), F.col("p")).alias("shape")).collect()} == {"bimodal_cautious", "bimodal", "unimodal"}
    for name, x in sets.items():
        v, k = np.unique(np.round(x, 4), return_counts=True)
        v = np.log10(v) if got[name].log_space else v
        assert got[name].dip == pytest.approx(dip(v, k)) and got[name].dip_p == pytest.approx(dip_p(dip(v, k), len(x)))
    # more values than cells: the dip of the cells is that of the values, to a cell's share
    wide = np.sort(np.r_[rng.normal(0, 1, 30_000), rng.normal(4, 1, 30_000)])
    cells = stats.histogram(spark.createDataFrame([("w", float(v)) for v in wide], "k string, value double"), ["k"], cells=2048).orderBy("__x").toPandas()
    assert cells["__wide"].all() and dip(cells["__x"].to_numpy(), cells["__k"].to_numpy(), True) == pytest.approx(dip(wide, np.ones(len(wide))), abs=2e-3)


# ---------------------------------------------------------------------------------------------- formulas, dictionaries
@pytest.mark.parametrize("text", ["X", "0.703*X+0", "10.93*X-23.50", "(X-32)*0.5", "X*2+1", "-2.15+0.0915*X", "1e1*X-1", "2-3-X", "12/X/2", "-X*-2", "+X-(-3)", "((X))*(1+2*(3-X))", "X/(X-4)", "2*(X+1)/(X*X+1)", ".5*X"])
def test_formulas_are_what_they_say(spark, text):
    xs = [0.0, 1.0, 4.0, -2.5, 37.25]
    df = spark.createDataFrame([(text, x) for x in xs], "t string, x double").withColumn("p", formulas.programs("t"))

    def want(x):
        try:
            return eval(text.replace("X", f"({x!r})"))
        except ZeroDivisionError:
            return None

    assert {r.x: r.v for r in df.select("x", formulas.run(F.col("p"), F.col("x")).alias("v")).collect()} == {x: want(x) for x in xs}


def test_what_is_no_formula():
    for text in (None, "", "2X", "X X", "X+", "*X", "(X", "X)", "1.2.3*X", "X**2", "eleven", "12", "X^2", "()", "import os", "X;1", "exp(X)"):
        assert formulas.compile_formula(text) is None, text
    assert formulas.compile_formula("0,703*X") == [("n", 0.703), ("x", None), ("*", None)]


def test_no_dictionary_multiplies_rows(spark):
    d = dictionaries(spark)
    doubled = jobs.Dictionaries(*[getattr(d, f).unionByName(getattr(d, f)) for f in ("names", "systems", "organisations", "units", "approved", "fixes", "mapping", "conversions", "targets")])
    doubled.fixes = doubled.fixes.unionByName(spark.createDataFrame([("b-hb", "mg/l", "zz")], "test string, unit string, fix string"))
    doubled.mapping = doubled.mapping.unionByName(spark.createDataFrame([("b-hb", "g/l", 9, "mole", "APPROVED")], "test string, unit string, concept int, quantity string, status string"))
    df = spark.createDataFrame([raw_row(1), raw_row(2, national="9999", unit="MG / L"), raw_row(3, day="x")], RAW)
    one, two = jobs.munge(df, d), jobs.munge(df, doubled)
    assert sorted(map(str, one.rows.collect())) == sorted(map(str, two.rows.collect())) and one.counts == two.counts == {"rows_in": 3, "rows_out": 2, "DATE": 1, "measurement_status": 0}
    assert {(r.dictionary, r.key, r.n_rows) for r in jobs.dictionary_clashes(doubled).collect()} == {("fixes", "b-hb | mg/l", 2), ("mapping", "b-hb | g/l", 2)}
    assert jobs.dictionary_clashes(d).count() == 0


def test_conversions_that_fail_are_told(spark):
    d = dictionaries(spark)
    d.conversions = spark.createDataFrame([("mass", "g/l", "mg/l", "1/(X-2)", None), ("mass", "kg", "mg/l", "2X", None)], "quantity string, source_unit string, target_unit string, conversion string, only_concept int")
    d.mapping = spark.createDataFrame([("b-hb", "g/l", 5, "mass", "APPROVED"), ("b-hb", "kg", 5, "mass", "APPROVED")], "test string, unit string, concept int, quantity string, status string")
    d.units = spark.createDataFrame([("g/l", "g/l"), ("kg", "kg")], "from string, to string")
    rows = [raw_row(1, national="9999", value="4"), raw_row(2, national="9999", value="2"), raw_row(3, national="9999", unit="kg", value="4"), raw_row(4, national="9999", unit="kg", value=None)]
    out = jobs.munge(spark.createDataFrame(rows, RAW), d, limit=10)
    assert {r.row_id: (r.harm_value, r.harm_unit, r.factor) for r in out.rows.collect()} == {1: (0.5, "mg/l", "1/(X-2)"), 2: (None, "mg/l", "1/(X-2)"), 3: (None, None, None), 4: (None, None, None)}
    assert {(r.row_id, r.err, r.err_value) for r in out.warnings.collect()} == {(2, "unit_conversion", "1/(X-2)"), (3, "unit_conversion", "2X")}


def test_a_job_reads_its_input_once(spark, tmp_path):
    """Rows and four logs come from one table; the raw file is scanned by one plan only."""
    rows = [raw_row(i, status="K" if i % 7 == 0 else "F", unit="y/l" if i % 3 else "g/l") for i in range(200)]
    path = str(tmp_path / "raw")
    spark.createDataFrame(rows, RAW).write.parquet(path)
    staged = []
    was = jobs.stage
    jobs.stage = lambda df, name: staged.append((name, df._jdf.queryExecution().optimizedPlan().toString())) or was(df, name)
    try:
        out = jobs.munge(spark.read.parquet(path), dictionaries(spark))
    finally:
        jobs.stage = was
    assert [n for n, _ in staged] == ["munge-cleaned", "munge-rows"]
    assert staged[0][1].count("Relation [") == 1 and "/raw" not in str(out.rows.inputFiles())
    for df in (out.rows, out.errors, out.warnings, out.units, out.names):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan and "regexp" not in plan
    account = audit.job_account(out.counts, spark).first()
    assert (account.n_in, account.n_out, account.n_quarantined, account.balanced) == (200, out.rows.count(), out.errors.count(), True)


# ---------------------------------------------------------------------------------------------- quantiles, neighbours, bins
def test_quantiles_of_hot_groups(spark):
    rng = np.random.default_rng(2)
    sets = {"hot": rng.normal(0, 1, 30_000), "ties": np.r_[np.full(20_000, 5.0), np.array([1.0]), rng.integers(0, 9, 3000)], "same": np.full(9000, 7.0), "rare": np.r_[np.full(8000, 3.0), [-1.0]], "small": rng.random(40), "single": np.array([2.5]), None: rng.random(5000)}
    data = [(k, "a", float(v)) for k, x in sets.items() for v in x] + [("empty", "a", None), ("hot", "a", None)]
    df = spark.createDataFrame(data, "k string, g string, value double").repartition(6)
    cuts = [0.0, 0.05, 0.1, 0.5, 0.777, 0.95, 1.0]
    for hot in (100, 2500, 10**6):
        got = {r.k: r for r in quantiles.group_quantiles(df, ["k", "g"], cuts, hot=hot).collect()}
        assert set(got) == set(sets)
        for k, x in sets.items():
            assert got[k].n == len(x) and got[k].quantiles == pytest.approx(np.quantile(x, cuts).tolist(), abs=1e-12), (k, hot)
    exact = {r.k: r.q for r in df.filter("value is not null").groupBy("k", "g").agg(F.percentile("value", F.array(*[F.lit(c) for c in cuts])).alias("q")).collect()}
    assert {k: r.quantiles for k, r in got.items()} == exact
    assert {r.k: r.quantiles for r in quantiles.group_quantiles(df, ["k", "g"], cuts, hot=100).collect()} == exact
    assert quantiles.group_quantiles(df.limit(0), ["k"], cuts).count() == 0


def test_hot_group_of_many_distinct_values(spark):
    """No stage of the selection brings more rows of the hot group together than a cell has."""
    df = spark.range(2_000_000).select(F.lit("k").alias("k"), ((F.col("id") * 7919) % 2_000_003 / 2).alias("value"))
    r = quantiles.group_quantiles(df, ["k"], [0.25, 0.5], hot=50_000).first()
    v = np.sort((np.arange(2_000_000) * 7919 % 2_000_003) / 2)
    assert r.quantiles == np.quantile(v, [0.25, 0.5]).tolist()


def test_running_sums_in_pieces(spark):
    """Hot keys, null keys and no keys: pieces give what one window gives."""
    rnd = random.Random(7)
    rows = [(rnd.choice(["hot"] * 9 + ["b", None]), rnd.choice(["cand", "targ"]), rnd.choice([None, *map(float, range(400))]), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, side string, value double, i int").repartition(6)
    plain = lambda x: sorted(map(tuple, x.collect()), key=str)
    assert plain(stats.ks(df, ["g"], pieces=True)) == plain(stats.ks(df, ["g"]))
    assert plain(stats.average_rank(df, "value", ["g"], pieces=True)) == plain(stats.average_rank(df, "value", ["g"]))
    assert plain(stats.average_rank(df)) == plain(stats.average_rank(df, pieces=False)) and stats.average_rank(df).agg(F.sum("k")).first()[0] == sum(r[2] is not None for r in rows)
    got = {r.i: r.ratio for r in stats.running_ratio(df.withColumn("hit", F.col("value") > 200), ["g"], ["i"], "hit").collect()}
    want, seen = {}, {}
    for k, _, v, i in rows:
        n, hit = seen.get(k, (0, 0))
        seen[k] = n + 1, hit + (v is not None and v > 200)
        want[i] = seen[k][1] / seen[k][0]
    assert got == want


def test_order_breaks_in_pieces(spark):
    rnd = random.Random(4)
    rows, want = [], []
    for f in ("a", "b", None, "c"):
        last = None
        for i in range(700):
            v = None if rnd.random() < 0.02 else i * 3 + rnd.choice([0, 0, 0, -9, 1]) + (0 if f != "c" else -900)
            rows.append((f, i, v))
            if last is not None and v is not None and v <= last:
                want.append((f, i, v, last))
            last = v
    ends = {f: [v for g, _, v in rows if g == f and v is not None] for f in (None, "a", "b", "c")}
    for f, g in ((None, "a"), ("a", "b"), ("b", "c")):
        if min(ends[g]) <= max(ends[f]):
            want.append((g, -1, min(ends[g]), max(ends[f])))
    df = spark.createDataFrame(rows, "f string, i long, id long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = dedup.order_breaks(df.repartition(5), "f", "i", "id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert dedup.order_breaks(df.limit(0), "f", "i", "id").count() == 0
    assert sorted(map(tuple, dedup.order_breaks(df.coalesce(1), "f", "i", "id", in_order=True).collect()), key=str) == sorted(want, key=str)


def test_place_rows_and_what_uses_it(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot"] * 8 + ["b", None]), rnd.randint(0, 30), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(7)
    got = {(r.id): (r["__r"], r["__n"]) for r in dedup.place_rows(df, ["g"], ["v", "id"]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: r[1:])
        want |= {r[2]: (i, len(own)) for i, r in enumerate(own)}
    assert got == want
    unique, again, _ = dedup.sorted_dedup(df, ["g", "v"], ["id"])
    first = {}
    for g, v, i in rows:
        first[g, v] = min(first.get((g, v), i), i)
    assert {(r.g, r.v): r.id for r in unique.collect()} == first and again.count() == len(rows) - len(first)


def test_region_hits_against_all_pairs(spark):
    rnd = random.Random(6)
    regions = [(rnd.randint(0, 2), s, s + rnd.choice([0, 5, 40, 900, 20_000]), f"r{i}", rnd.randint(0, 40)) for i in range(120) for s in [rnd.randint(-500, 20_000)]] + [(0, 90, 10, "never", 0)]
    hits = [(i, rnd.randint(0, 3), rnd.randint(-600, 21_000), rnd.random()) for i in range(800)]
    got = pheno.region_hits(spark.createDataFrame(hits, "hit int, chrom int, pos int, mlogp double"), spark.createDataFrame(regions, "chrom int, start int, end int, region string, seq int"))
    want = {}
    for i, c, p, _ in hits:
        own = sorted((seq, name) for rc, s, e, name, seq in regions if rc == c and s <= p <= e)
        if own:
            want[i] = own[0][1]
    assert {r.hit: r.region for r in got.collect()} == want and got.count() == len(want)


# ---------------------------------------------------------------------------------------------- files
def test_splits_of_a_file_with_quoted_line_ends(spark, tmp_path):
    rnd = random.Random(2)
    want = {}
    for name in ("a.tsv", "b c+d.tsv"):
        rows, lines = [], ["a\tb\tc"]
        for _ in range(900):
            def text():
                kind = rnd.random()
                if kind < 0.2:
                    return rnd.choice(["x\ny", '"q" \n\n z', "tab\tin", "many " + "\n".join(f'w"{j}' for j in range(900 if rnd.random() < 0.03 else 3))])
                return rnd.choice(['5" disk', "é ü", "it's", ""]) if kind < 0.4 else str(rnd.randint(0, 10**6))

            rows.append([text() for _ in range(3)])
            lines.append("\t".join('"' + x.replace('"', '""') + '"' if set("\n\t") & set(x) or x.startswith('"') else x for x in rows[-1]))
            if rnd.random() < 0.02:
                lines.append("")
        lines += ["too\tfew", "far\ttoo\tmany\tfields"]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        with open(tmp_path / name, newline="") as f:
            assert [r for r in csv.reader(f, delimiter="\t") if r][1 : len(rows) + 1] == rows
        want[name] = rows
    with pytest.MonkeyPatch.context():
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            known = split_scan.splits(spark, str(tmp_path))
            got = split_scan.scan_tsv(spark, str(tmp_path), ["a", "b", "c"]).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(known) > 20 and sum(inside for inside, _, _ in known.values()) > 5
    for name, rows in want.items():
        own = {r.row_no: r for r in got if r.source_file == name}
        assert sorted(own) == list(range(1, len(rows) + 3))
        assert [[own[i + 1][c] or "" for c in "abc"] for i in range(len(rows))] == rows
        assert [own[i].__getitem__(split_scan.BAD) is not None for i in sorted(own)] == [False] * len(rows) + [True] * 2
    whole = split_scan.scan_tsv(spark, str(tmp_path), ["a", "b", "c"], ["b"])
    assert whole.columns == ["b", split_scan.BAD, "source_file", "row_no"] and whole.count() == len(got)


def test_line_states():
    for line, inside, want in (('a\t"b', False, True), ('b"\tc', True, False), ('"a""b"', False, False), ('"a""', False, True), ('x"y', False, False), ("", True, True), ("", False, False), ('""', False, False), ('a"\t"b', True, True), ('5" \t"x"', False, False)):
        assert split_scan.ends_inside(line, inside) is want, line


def test_manifest(spark, tmp_path):
    for name, head in (("m.tsv", "a\tb"), ("f.tsv", "a\tc"), ("odd.tsv", "b\ta"), ("more+x y.tsv", "a\tc\td")):
        (tmp_path / name).write_text(head + "\n1\t2\n")
    at = str(tmp_path)
    lines = [f"{at}/m.tsv\t{at}/f.tsv", f"{at}/odd.tsv\t{at}/more+x y.tsv", f"{at}/m.tsv\t{at}/gone.tsv", "one", f"{at}/m.csv\t{at}/f.tsv"]
    (tmp_path / "list").write_text("\n".join(lines) + "\n\n")
    got = {(lines.index(r.value), r.problem) for r in readers.manifest_problems(spark, f"{at}/list", ["a", "b"], ["a", "c"]).collect()}
    assert got == {(1, "HEADER ORDER b"), (1, "HEADER ORDER a"), (1, "HEADER EXTRA d"), (2, "MISSING_FILE"), (3, "NOT_A_PAIR"), (4, "NOT_TSV")}


def test_merge_check_counts_missing_rows(spark):
    main = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (1, 3, None)], "pair_id int, row_no int, x string")
    free = spark.createDataFrame([(1, 1, "b"), (1, 2, None)], "pair_id int, row_no int, x string")
    assert readers.merge_check(readers.zip_join(main, free), ["x"]).first().asDict() == {"n_rows": 3, "n_without_id": 1, "differs_x": 1}


# ---------------------------------------------------------------------------------------------- stored releases
def test_clustered_release_needs_no_exchange(spark):
    rows = spark.range(4000).select((F.col("id") % 300).alias("person"), (F.col("id") % 7).alias("concept"), F.col("id").alias("at"))
    release = clustered.write_clustered(rows, ["person"], 4)
    people = clustered.write_clustered(spark.range(250).select(F.col("id").alias("person"), F.lit("x").alias("sex")), ["person"], 4, "people")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        window = dedup.adjacent_flags(release, ["person", "concept"], "at")
        once = dedup.keyed_dedup(release, ["person", "concept"])
        joined = release.join(people.hint("merge"), "person", "left")
        for df in (window, once, joined):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert once.count() == 2100 and joined.filter("sex is null").count() == rows.filter("person >= 250").count()


def test_sketches_stand_in_for_the_release(spark):
    new = spark.range(60_000).select((F.col("id") % 20_000).alias("person"), (F.col("id") % 3).alias("concept"))
    old = spark.range(30_000).select((F.col("id") % 10_000 + 5000).alias("person"), (F.col("id") % 2).alias("concept"))
    got = {r.concept: r for r in clustered.compare_sketches(clustered.release_sketches(new), clustered.release_sketches(old)).collect()}
    assert got["ALL"].new_exact == 20_000 and got["ALL"].old_exact == 10_000 and abs(got["ALL"].new_persons / 20_000 - 1) < 0.06 and abs(got["ALL"].all_persons / 20_000 - 1) < 0.06
    assert abs(got["ALL"].appeared - 10_000) < 1500 and got["2"].old_persons is None and got["2"].appeared == got["2"].new_persons and got["2"].persons_ratio is None


def test_elections(spark):
    rows = [(1, "q", "a", "b")] * 5 + [(1, "q", None, "b")] * 3 + [(2, "q", "A", "a")] * 4 + [(3, None, None, None)] * 2 + [(4, "q", "a", "a")] * 3 + [(5, "q", "x", "y")]
    df = spark.createDataFrame(rows, "concept int, quantity string, source string, injected string")
    ref = spark.createDataFrame([(1, "q", "z", True), (2, "q", "b", False), (4, "q", "a", False)], "concept int, quantity string, unit string, manual boolean")
    got = {r.concept: (r.target_unit, r.unit_source, r.changed, r.n_rows) for r in audit.elect_units(df, ref, 2).collect()}
    assert got == {1: ("z", "MANUAL", False, 8), 2: ("a", "SOURCE", True, 4), 3: ("NA", "SOURCE", False, 2), 4: ("a", "SOURCE", False, 3)}
    free = {r.concept: r for r in audit.elect_units(df).collect()}
    assert free[1].note == "INJECTION CHANGE: Source mode was 'a' | NEW MAPPING" and free[1].source_shares == "{'NA': 0.375, 'a': 0.625}" and free[5].unit_source == "INJECTED"


def test_dictionary_diff_with_nulls(spark):
    new = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "x")], "k int, v string")
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (5, None)], "k int, v string")
    assert {r.k: r.change for r in audit.dictionary_diff(new, old, "k", "v").collect()} == {2: "CHANGED", 4: "NEW", 5: "REMOVED"}


def test_harmonise_keeps_rows_of_clashing_keys(spark):
    df = spark.createDataFrame([("t", "u", "1")], "test string, clean_unit string, value string").withColumn("unit_valid", F.lit("1"))
    fixes = spark.createDataFrame([("t", "u", "b"), ("t", "u", "a")], "test string, unit string, fix string")
    assert [r.clean_unit for r in harmonise.unit_fix(df, fixes).collect()] == ["a"]


def test_frequent_units_are_no_tasks_of_the_job(spark):
    """The units are joined by the size of their table; an exchange by unit would send all rows of a unit to one task."""
    df = spark.range(150_000).select(F.sha2(F.col("id").cast("string"), 256).alias("row_id"), F.when(F.col("id") % 3 > 0, "mmol/l").otherwise("u/l").alias("unit"))
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("test", "value", "outcome", "__bad")}).withColumn("__log", readers.notes())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        first = jobs.stage(df, "many-rows")
        out = jobs._harmonised(first, first.select("unit"), job_queries.dictionaries(spark), "map")
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert {(r.clean_unit, r.n) for r in out.groupBy("clean_unit").agg(F.count("*").alias("n")).collect()} == {("mmol/l", 100_000), ("u/l", 50_000)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["unified_results", "ambiguous_pass", "unambiguous_table", "extracted_audit"])
def test_a_comparison_joins_its_measurements_once(spark, sf, name):
    """What is left of the plan reads staged rows and tables; it no longer joins the source tables for each test of each pass."""
    out = registry.QUERIES[name](spark, sf)
    assert out.inputFiles() and not [f for f in out.inputFiles() if "lineitem" in f]


def test_descriptions_are_cleaned_once(spark, sf, monkeypatch):
    """Both jobs write their rows twice, and no row runs the patterns that follow from its description alone."""
    staged = []
    was = jobs.stage
    monkeypatch.setattr(jobs, "stage", lambda df, name: staged.append((name, df._jdf.queryExecution().optimizedPlan().toString())) or was(df, name))
    registry.QUERIES["core_job"](spark, sf)
    assert [n for n, _ in staged] == ["munge-cleaned", "core-rows"]
    assert not [n for n, plan in staged if "|".join(clean.NAME_DELETIONS) in plan]


def test_both_jobs_at_once_give_what_they_give_in_turn(spark):
    d = dictionaries(spark)
    d.conversions = spark.createDataFrame([("mass", "g/l", "mg/l", "1/(X-2)", None)], "quantity string, source_unit string, target_unit string, conversion string, only_concept int")
    t = job_queries.core_tables(spark)
    t.targets, t.limits = spark.createDataFrame([(5, "mg/l")], "concept int, target_unit string"), spark.createDataFrame([(5, 0.1, 0.4, False, True)], "concept int, low double, high double, low_problem boolean, high_problem boolean")
    t.thresholds = spark.createDataFrame([(5, 1, ">", 0.4, "high")], "concept int, seq int, side string, limit double, note string")
    rows = [
        raw_row(1, national="9999", value="4"), raw_row(2, national="9999", value="2", text="150203"), raw_row(3, national="9999", unit="MG / L", value=None, text="Tulos: 7,5 mg/l"), raw_row(4, status="K", text="150203"), raw_row(5, day="x", national="9999"),
        raw_row(6, national="1234", unit=None, value="-1", text=" NEG"), raw_row(7, name=None, local=None, outcome="POS", text="NEG"), raw_row(8, unit="y/l", text="al*le 3 mg/l"), raw_row(9, national="9999", value="5", outcome=None, text=None),
    ]
    raw = spark.createDataFrame(rows, RAW).withColumn("provider", F.lit("prov")).withColumn("more", F.lit(" a b "))
    for source_values in (False, True):
        first = jobs.munge(raw, d)
        want = first, jobs.core(first.rows, t, source_values=source_values, drop=("status", "name"))
        got = jobs.munge_and_core(raw, d, t, source_values=source_values, drop=("status", "name"))
        for a, b, dropped in ((want[0], got[0], ["status", "name"]), (want[1], got[1], [])):
            assert a.counts == b.counts and set(a.rows.columns) - set(dropped) == set(b.rows.columns)
            columns = sorted(b.rows.columns)
            assert sorted(map(str, a.rows.select(columns).collect())) == sorted(map(str, b.rows.select(columns).collect()))
            for log in ("errors", "warnings", "units", "names"):
                if getattr(a, log) is not None:
                    assert sorted(map(str, getattr(a, log).collect())) == sorted(map(str, getattr(b, log).collect())), log
        assert {(r.row_id, r.err) for r in got[0].warnings.collect()} >= {(2, "unit_conversion"), (6, "lab_mapping")}
