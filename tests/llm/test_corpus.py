"""Merkle manifest, source mix and centroids against brute force, on awkward rows."""

import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest

from .test_dedup import WORD, rows  # noqa: F401

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int, rank string, block int"


def table(spark, data):
    return spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in data], SCHEMA).repartition(7)


def documents():
    rnd = random.Random(5)
    out = [(i, rnd.choice(["web", "books", "", None]), "en", len(t or ""), t) for i, t in rows()]
    out += [(1000 + i, "hot", None if i % 3 else "fi", None, f"line {i}\nnext\n" * (i % 4)) for i in range(1600)]
    out += [(5, "one", "é", 3, "Ä\n\x00\U0001f600"), (None, None, None, None, None), (None, None, None, None, None), (7, "hot", "en", 1, "a\nb"), (7, "hot", "en", 1, "a\nb"), (8, "nul", "en", 0, None), (9, "long", "en", 5_000_000, "word \n" * 900_000)]
    return out


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climbs(digests):
    """The root of a tree, and each leaf's steps: (siblings before, siblings after)."""
    steps, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for i, p in enumerate(at):
            run = p // 3 * 3
            steps[i].append((level[run:p], level[p + 1 : run + 3]))
            at[i] = p // 3
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], steps


def brute_manifest(data):
    def leaf(row, text):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[1], row[2], row[3], text)])

    by = collections.defaultdict(list)
    for r in data:
        by[r[1]].append((r[0], leaf(r, r[4]), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        own = sorted(by[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((own, *climbs([x[1] for x in own])))
    root, over = climbs([t[1] for t in trees])
    out = []
    for (own, subroot, steps), high in zip(trees, over, strict=True):
        for (i, d, r), low in zip(own, steps, strict=True):
            text = r[4].replace("\n", "") if i is not None and r[4] is not None and zlib.crc32(str(i).encode()) % 2 == 0 else r[4]
            node = leaf(r, text)
            for before, after in [*low, *high]:
                node = h(*before, node, *after)
            out.append((i, d, subroot, root, h(*[x for b, a in [*low, *high] for x in [*b, *a]]), node, node == root))
    return out


def test_merkle_manifest(spark):
    from labflow.llm.merkle import manifest, tampered

    data = documents()
    got = manifest(table(spark, data), tampered()).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute_manifest(data))
    assert any(not r.verified for r in got) and any(r.verified for r in got)


def test_merkle_small_tables(spark):
    from labflow.llm.merkle import manifest

    for data in ([(4, "a", "en", 1, "x")], [(4, "a", "en", 1, "x"), (1, None, "en", 1, "y"), (2, "b", None, 1, None), (3, "a", "", 1, "")]):
        assert collections.Counter(map(tuple, manifest(table(spark, data)).collect())) == collections.Counter((*r[:5], r[3], True) for r in brute_manifest(data))
    assert manifest(table(spark, documents()).limit(0)).count() == 0
    bare = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert manifest(bare).first().leaf == h("1:1", "-", "-", "-", "1:x")


def test_merkle_tiers_agree_with_one_tree():
    """A tree of any size reduced by superblocks is the plain tree: here with superblocks of nine."""
    from labflow.llm import merkle

    for n in (1, 2, 8, 9, 10, 27, 28, 81, 82, 100, 730):
        nodes = [h(str(i)) for i in range(n)]
        root, steps = climbs(nodes)
        was = merkle.HEIGHT, merkle.BLOCK
        merkle.HEIGHT, merkle.BLOCK = 2, 9
        try:
            tier, size, found = nodes, n, [nodes]
            while size > 1:
                tier, size = [merkle._levels(tier[i : i + 9], size)[-1][0] for i in range(0, len(tier), 9)], -(-size // 9)
                found.append(tier)
            assert tier == [root]
            for i in (0, n // 2, n - 1):
                path, at = [], i
                for t in found[:-1]:
                    block = t[at // 9 * 9 : at // 9 * 9 + 9]
                    path += merkle._inside(merkle._levels(block, len(t)), at % 9)
                    at //= 9
                assert [x for s in path for x in s.split(",")[1:]] == [x for b, a in steps[i] for x in [*b, *a]]
                assert merkle.fold(nodes[i], path) == root
        finally:
            merkle.HEIGHT, merkle.BLOCK = was


# ---------------------------------------------------------------------------------------------- mixing
def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    due, full = {}, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        due = {s: 2.0 * sizes[s] if s in full else left * weight[s] / rest for s in names}
        above = {s for s in names if s not in full and due[s] > 2 * sizes[s]}
        if not above:
            return due
        full |= above


def awkward_mix():
    rnd = random.Random(9)
    data = [(i, rnd.choice(["web", "books", None]), "en", 0, t) for i, t in rows()]
    data += [(2000 + i, "hot", "en", 0, "w " * rnd.choice([1, 5, 80, 300])) for i in range(900)] + [(1, "tiny", "en", 0, "only four words here"), (2, "void", "en", 0, None), (3, "a", "en", 0, "x\x0by\x1cz \x85q"), (4, "big", "en", 0, "many " * 300_000)]
    return data + data[-40:]


def test_mix(spark):
    from labflow.llm.mixing import mix

    data = awkward_mix()
    got = [tuple(r) for r in mix(table(spark, data)).collect()]
    assert sorted(got, key=str) == sorted((tuple(r) for r in mix(table(spark, data[::-1]).coalesce(2)).collect()), key=str)
    assert collections.Counter((r[0], r[1]) for r in got) == collections.Counter((r[0], len(WORD.findall(r[4] or ""))) for r in data)
    sizes = collections.Counter()
    for r in data:
        sizes[r[1]] += len(WORD.findall(r[4] or ""))
    due = brute_targets(sizes)
    assert collections.Counter(round(r[3], 6) for r in got) == collections.Counter(round(due[r[1]], 6) for r in data)
    taken = collections.Counter()
    for _, size, source_size, target, n in got:
        assert 0 <= n <= 2 * size and source_size in sizes.values()
        taken[round(target, 6)] += n
    for s in sizes:  # no two sources have one target here, but those of 0
        assert abs(taken[round(due[s], 6)] - due[s]) <= 0.5


def test_mix_sql_twin(spark):
    from labflow.llm import mixing

    data = awkward_mix()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r[0], r[1], r[4]) for r in data])
    assert sorted(con.execute(mixing.SQL).fetchall(), key=str) == sorted((tuple(r) for r in mixing.mix(table(spark, data)).collect()), key=str)


def test_schedule_keeps_shares_everywhere(spark):
    """Any stretch of the schedule holds each source in its share, and each pass takes every block once."""
    from labflow.llm import mixing

    where = mixing.placed(table(spark, [(i, s, "en", 0, "w " * 4000) for i in range(600) for s in ("a", "b", "c", "d")]))
    sources = mixing.targets(where)
    slots = sorted((r.slot, r.tree) for r in mixing.schedule(sources).collect())
    share = {r.tree: r.slots for r in sources.collect()}
    total = sum(share.values())
    assert total == len(slots)
    for at in range(0, total - 200, 100):
        seen = collections.Counter(t for _, t in slots[at : at + 200])
        assert all(abs(seen[t] - 200 * n / total) < 6 for t, n in share.items())
    turns = collections.Counter((r.tree, r.lap, r.block) for r in mixing.shuffled_blocks(sources).collect())
    assert set(turns.values()) == {1} and len({b for t, lap, b in turns if t == "0a" and lap == 0}) == {r.tree: r.blocks for r in sources.collect()}["0a"]


def test_mix_without_words(spark):
    from labflow.llm.mixing import mix

    assert [tuple(r) for r in mix(table(spark, [(1, "a", "en", 0, None), (2, None, "en", 0, " \n")])).orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mix(table(spark, documents()).limit(0)).count() == 0


# ---------------------------------------------------------------------------------------------- centroids
def brute_clusters(data, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in data if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and abs(x) < 1e5 for x in v)]
    cents = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(cents)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    each = collections.Counter()
    for _, c, d in out:
        each[c] += d
    return [(i, c, d, each[c], sum(each.values()), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for i, c, d in out]


def vectors():
    rnd = np.random.default_rng(4)
    data = [(i, (rnd.normal(rnd.integers(-3, 4), 0.4, 64)).astype(np.float32).tolist()) for i in range(300)]
    data += [(7, data[7][1]), (7, data[8][1]), (None, data[9][1]), (301, None), (302, []), (303, [1.0] * 63), (304, [1.0] * 65), (305, [None, *[1.0] * 63]), (306, [math.nan, *[1.0] * 63]), (307, [math.inf, *[1.0] * 63]), (308, [3e38, *[1.0] * 63]), (309, [-0.0001] * 64), (310, [0.0] * 64)]
    return data + [(400 + i, [0.5] * 64) for i in range(120)]


SHAPE = "vec_id long, embedding array<float>, label int, cluster int, distance string"


def test_centroids(spark):
    from labflow.llm.centroids import cluster, report

    data = vectors()
    for part in (data, data[:5], data[:1], data[301:308]):
        df = spark.createDataFrame([(*r, 1, 9, "clash") for r in part], SHAPE).repartition(5)
        assert collections.Counter(map(tuple, report(*cluster(df)).collect())) == collections.Counter(brute_clusters(part))
    assert report(*cluster(df.limit(0))).count() == 0


def test_centroid_tables_are_exact():
    from labflow.llm import centroids

    rnd = np.random.default_rng(1)
    whole = rnd.integers(-centroids.MOST, centroids.MOST, (500, 64))
    pairs = []
    for d in range(64):
        values, place = np.unique(whole[:, d], return_inverse=True)
        pairs += [values, place.astype(np.uint16)]
    values, places = centroids._opened(centroids.pack(*centroids._grouped(pairs)))
    got = centroids.distances(values, places, whole[:8])
    assert got.tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c, strict=True)) for c in whole[:8]] for x in whole]


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_source_mix", "op13_centroids"])
def test_sql_twins(spark, sf, name):
    from labflow.llm.queries import QUERIES, SQL

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    got = con.execute(SQL[name])
    assert [d[0] for d in got.description] == df.columns
    assert sorted(got.fetchall()) == sorted(map(tuple, df.collect()))
