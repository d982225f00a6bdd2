import collections
import inspect
import re

import corpus_pipeline
import pytest

from .test_dedup import WORD, brute_substring, lower, rows
from .test_text import encoded_texts

SCHEMA = "doc_id long, text string, lang string, source string, __row_key string, __kept int, shard string"


def awkward():
    long = rows()[5][1].split()
    more = [(50, " ".join(long[100:130]) + " fine tail of words"), (51, "nothing here"), (52, " ".join(rows()[20][1].split()[:299] + ["other"])), (53, None), (53, None)]
    return [(i, t, "en" if (i or 0) % 2 else None, None, "k", 1, "s") for i, t in [*rows(), *more]]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with a table of awkward rows, labels of few of them, and a test set."""
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(awkward(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(None, None, None), (6, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(20, 1, 0), (21, 1, 0), (None, 1, None), (6, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/trusted/labels.parquet")
    item = " ".join(rows()[5][1].split()[105:117])
    spark.createDataFrame([(1, item), (2, None), (3, "?!")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def _brute_near(data):
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set() for w in (WORD.findall(lower(r[1] or "")) for r in data)]
    parent = list(range(len(data)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    best = {}
    for k, r in enumerate(data):
        if sets[k] and (root(k) not in best or (r[0] is None, r[0] or 0) < (best[root(k)][0] is None, best[root(k)][0] or 0)):
            best[root(k)] = r
    return [r for k, r in enumerate(data) if not sets[k]] + list(best.values())


def _brute_questions(data, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for t in items:
        w = word.findall(lower(t or ""))
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    out = []
    for r in data:
        w = word.findall(lower(r[1] or ""))
        if not any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1)):
            out.append(r)
    return out


def test_every_stage_against_brute_force(spark, tables):
    """Nulls, repeated rows, empty and long texts, and columns with the pipeline's own names."""
    from labflow.llm import kneser_ney
    from labflow.llm.common import stage

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    data = awkward()
    stages = dict(corpus_pipeline.STAGES)

    def run(name, docs, folder=tables):
        out = stage(stages[name](spark, docs, folder), "test")
        assert out.columns == docs.columns
        return out, collections.Counter(tuple(r) for r in out.collect())

    # the classifier's verdict on each row; without trusted text every row stays
    verdict = collections.Counter(r.doc_id for r in kneser_ney.classify(docs, spark.read.parquet(f"{tables}/trusted/labels.parquet")).collect() if r.kept)
    _, got = run("quality classifier", docs, f"{tables}/trusted")
    assert collections.Counter(k[0] for k in got.elements()) == verdict and set(got) < set(data)
    docs, got = run("quality classifier", docs)
    assert got == collections.Counter(data)
    docs, got = run("n-gram Jaccard join", docs)
    assert got == collections.Counter(_brute_near(data))
    data = list(got.elements())
    docs, got = run("substring dedup", docs)
    sha = collections.Counter((i, n - gone) for i, n, gone, _ in brute_substring([r[:2] for r in data]))
    assert collections.Counter((r[0], len(WORD.findall(r[1] or ""))) for r in got.elements()) == sha
    whole = {(i, gone) for i, _, gone, _ in brute_substring([r[:2] for r in data]) if not gone}
    assert all(r in got for r in data if (r[0], 0) in whole and sum(x[0] == r[0] for x in data) == 1)
    data = list(got.elements())
    docs, got = run("benchmark decontamination", docs)
    items = [r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    assert got == collections.Counter(_brute_questions(data, items)) and len(list(got.elements())) < len(data)
    data = list(got.elements())
    pieces = stages["packing"](spark, docs, tables).collect()
    want = collections.Counter((r[0], len(ids)) for r, ids in zip(data, encoded_texts([r[1] for r in data], 2), strict=True))
    assert collections.Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0) == want
    assert sum(p.length for p in pieces) == sum(n * k for (_, n), k in want.items())


def test_run_is_the_stages(spark, tables, tmp_path):
    out = corpus_pipeline.run(spark, tables)
    assert out.count() > 0 and {"doc_id", "sequence_id"} <= set(out.columns)
    empty = str(tmp_path)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_stages(spark, sf):
    """Every stage keeps the documents' columns; the last returns pieces that cover what is left."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    from labflow.llm.common import stage

    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, sf), "test")
        assert docs.columns == columns, name
        n = docs.count()
        assert 0 < n <= before, name
        before = n
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert pieces.filter("start = 0").count() == before
    assert list(inspect.signature(corpus_pipeline.STAGES[0][1]).parameters) == ["spark", "docs", "sf_dir"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_queries_are_registered():
    from labflow.llm.queries import QUERIES

    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
