"""Deduplication and join operators against brute force, on awkward rows."""

import collections
import hashlib
import random
import re
import time

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x)


def rows():
    rnd = random.Random(3)
    vocab = ["".join(rnd.choice("abcdeé—") for _ in range(rnd.randint(1, 9))) for _ in range(400)]

    def text(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))

    passage, base = text(60), [rnd.choice(vocab) for _ in range(300)]
    out = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, text(500)), (7, text(34)), (8, "ab " * 400), (9, "x" * 3000), (10, "x" * 3000), (None, text(80))]
    for i in range(20, 30):
        near = base[:]
        near[rnd.randrange(300)] = f"edit{i}"
        out.append((i, " ".join(near)))
    for i in range(30, 40):
        out.append((i, text(40) + " " + passage + "\n" + text(rnd.randint(0, 30))))
    out += [(40, text(5000)), (41, out[5][1]), (42, out[5][1]), (6, out[5][1]), (43, out[5][1].upper()), (44, "É" * 30 + text(50))]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    data = [(i, t, "en", "s", len(t or ""), "clash", "clash", 7) for i, t in rows()]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, key string, payload string, shard int").repartition(5)


def brute_substring(data, width=35):
    words = [WORD.findall(t or "") for _, t in data]
    seen = collections.Counter(tuple(w[k : k + width]) for w in words for k in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(data, words, strict=True):
        gone = set()
        for k in range(len(w) - width + 1):
            if seen[tuple(w[k : k + width])] > 1:
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_substring_dedup(docs):
    from labflow.llm.substring_dedup import remove_repeats

    done, cleaned = remove_repeats(docs)
    got = [(r.doc_id, r.n_words, 0, r.kept_sha256) for r in done.collect()] + [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in cleaned.collect()]
    assert sorted(got, key=str) == brute_substring(rows())


def brute_suffix(data, width=50):
    big = 1 << 62
    least = {}
    raw = [((big if i is None else i), (t or "").encode()) for i, t in data]
    for i, b in raw:
        for k in range(len(b) - width + 1):
            s = b[k : k + width]
            least[s] = min(least.get(s, big), i)
    out = []
    for (i, b), (j, _) in zip(raw, data, strict=True):
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if least[b[k : k + width]] < i:
                gone[k : k + width] = b"\1" * width
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((j, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("buckets", [None, 60])
def test_suffix_dedup(docs, buckets):
    """With many buckets equal suffixes straddle boundaries."""
    from labflow.llm.suffix_dedup import remove_repeats

    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs, buckets).collect()), key=str)
    assert got == brute_suffix(rows())


def test_suffix_dedup_with_ranges_cut_again(docs, monkeypatch):
    """More shards than splitters may be: a range's buckets are cut by a hash."""
    from labflow.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "MOST_BUCKETS", 1)
    one = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs).collect()), key=str)
    monkeypatch.setattr(suffix_dedup, "MOST_BUCKETS", 3)
    three = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs).collect()), key=str)
    assert one == three == brute_suffix(rows())


def repeated_rows():
    rnd = random.Random(8)
    vocab = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 9))) for _ in range(300)]
    same, passage = " ".join(rnd.choice(vocab) for _ in range(400)), " ".join(rnd.choice(vocab) for _ in range(60))
    out = [(1, same)] * 5000 + [(None, same)] * 20 + [(k, same) for k in range(2, 40)]
    return out + [(k, " ".join(rnd.choice(vocab) for _ in range(20)) + " " + passage) for k in range(100, 400)]


def test_many_repeated_rows(spark):
    """Thousands of copies of a row cost their number, not its square; brute force on a copy or two gives the same."""
    from labflow.llm import substring_dedup, suffix_dedup

    data = repeated_rows()
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    few = sorted(set(data), key=str)
    began = time.time()
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs).collect())
    assert set(got) == set(brute_suffix(few)) and got[brute_suffix(few)[few.index((1, data[0][1]))]] == 5000
    done, cleaned = substring_dedup.remove_repeats(docs)
    got = collections.Counter([(r.doc_id, r.n_words, 0, r.kept_sha256) for r in done.collect()] + [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in cleaned.collect()])
    assert set(got) == set(brute_substring(few)) and sum(got.values()) == len(data)
    assert time.time() - began < 150


def test_text_longer_than_a_batch(spark):
    from labflow.llm import substring_dedup, suffix_dedup

    rnd = random.Random(5)
    long = " ".join(f"{rnd.randrange(10**8):x}" for _ in range(900_000))
    assert len(long) > 5 << 20
    inner = long[3_000_000:3_000_900]
    data = [(1, "short text"), (2, long), (3, inner), (4, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == {1: (10, 0, 0), 2: (len(long), 0, 0), 3: (900, 900, 1), 4: (0, 0, 0)}
    done, cleaned = substring_dedup.remove_repeats(docs)
    words = len(inner.split()) - 2  # its outer words are cut
    removed = {r.doc_id: r.n_removed for r in cleaned.collect()}
    assert words <= removed[2] == removed[3] <= words + 2 and {r.doc_id for r in done.collect()} == {1, 4}


def test_suffix_order_decides():
    """Classes from neighbours' common prefixes are the classes of equal strings."""
    import numpy as np
    from labflow.llm import suffix_dedup as sd
    from labflow.llm import textblocks as tb
    from labflow.llm.common import pack

    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab") for _ in range(90)) for _ in range(40)]
    texts += [t[:45] + "".join(rnd.choice("ab") for _ in range(45)) for t in texts] + [t[:70] + "b" * 20 for t in texts]
    raw = "".join(texts).encode()
    batch = tb.Batch(np.frombuffer(raw, np.uint8), np.arange(0, len(raw) + 1, 90))
    start, count, anchor, _, doc = sd.zones(batch)
    sizes = count + sd.WINDOW - 1
    take = np.concatenate([np.arange(a, a + k) for a, k in zip(start, sizes, strict=True)])
    one = np.ones(len(start), np.uint32)
    own = sd._Bucket([pack(batch.data[take], count.astype(np.uint8), (anchor - start).astype(np.uint8), one, doc.astype(np.uint32), start.astype(np.uint32), np.arange(len(texts)).astype(np.uint64), np.arange(len(texts)))])
    classes = collections.defaultdict(set)
    base = 0
    for zone, lcp in sd._pieces(own, 50):
        label, owner, number = own.strings(zone, lcp)
        for c, z, k in zip(label.tolist(), owner.tolist(), number.tolist(), strict=True):
            at = own.start[z] + k
            classes[own.data[at : at + sd.WINDOW].tobytes()].add((base, c))
        base += 1
    assert len(classes) > 1000 and all(len(x) == 1 for x in classes.values())
    assert len({y for x in classes.values() for y in x}) == len(classes)


def test_multikey_order():
    import numpy as np
    from labflow.llm.suffix_dedup import multikey_order

    rng = np.random.default_rng(1)
    keys = [rng.integers(0, 4, 500).astype(np.uint64) for _ in range(3)]
    order = multikey_order(keys)
    ranked = list(zip(*[k[order] for k in keys], strict=True))
    assert ranked == sorted(ranked)


def brute_components(data):
    sets = []
    for _, t in data:
        w = WORD.findall(lower(t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
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
    least = {}
    for k, (i, _) in enumerate(data):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, len(sets[k]), least.get(root(k))) for k, (i, _) in enumerate(data)), key=str)


def test_jaccard_join(docs):
    from labflow.llm.jaccard_join import near_duplicates

    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()), key=str)
    assert got == brute_components(rows())


def test_orders_filter_before_verification(spark):
    """Pairs that share a token of the first prefix: each further order removes some, and no linked pair."""
    from pyspark.sql import functions as F

    from labflow.llm import jaccard_join as jj

    rnd = random.Random(12)
    pool = [f"w{k}" for k in range(80)]
    lines = [" ".join(rnd.choice(pool) for _ in range(14)) for _ in range(60)]
    data = [(k, " ".join(rnd.sample(lines, 8))) for k in range(240)]
    for k in range(240, 280):
        words = data[k - 240][1].split()
        words[rnd.randrange(len(words))] = f"edit{k}"
        data.append((k, " ".join(words)))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    sets = jj.candidate_sets(docs, 4, 64)
    lists = sets.select(F.explode("p1").alias("token"), "set_key")
    pairs = lists.select("token", F.col("set_key").alias("u")).join(lists, "token").filter("u < set_key").select("u", F.col("set_key").alias("v")).distinct()
    flags = jj.other_orders(pairs, sets)
    first, second, both = flags.count(), flags.filter("second").count(), flags.filter("second AND third").count()
    linked = jj.verify(pairs, sets).count()
    assert first > second > both >= linked > 0
    assert jj.verify(flags.filter("second AND third").select("u", "v"), sets).count() == linked


def test_rounds_do_not_grow_with_a_list(spark):
    """Many unlike sets in one posting list are compared in a few rounds, and none is lost."""
    from labflow.llm import jaccard_join as jj

    rnd = random.Random(13)
    rare = "one passage that all share here"
    data = [(k, rare + " " + " ".join(f"v{rnd.randrange(10**6)}" for _ in range(12))) for k in range(300)]
    data += [(300 + k, data[k][1] + " more") for k in range(0, 300, 60)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    staged = []
    old = jj.stage
    jj.stage = lambda df, name: staged.append(name) or old(df, name)
    try:
        got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.near_duplicates(docs).collect()), key=str)
    finally:
        jj.stage = old
    assert got == brute_components(data)
    assert staged.count("jaccard-open") <= 6


def test_components(spark):
    from labflow.llm.components import components

    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[k] for k in range(1, 41)} == {1} and {got[k] for k in range(100, 140)} == {100} and got[201] == 200


def test_empty_tables(spark, docs):
    from labflow.llm import jaccard_join, substring_dedup, suffix_dedup

    none = docs.limit(0)
    assert jaccard_join.near_duplicates(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert sum(d.count() for d in substring_dedup.remove_repeats(none)) == 0


def test_pack_round_trip():
    import numpy as np
    from labflow.llm.common import pack, unpack

    rng = np.random.default_rng(2)
    a = np.sort(rng.integers(0, 1 << 63, 1000).astype(np.uint64))
    b, c, d = rng.standard_normal(7).astype(np.float32), np.zeros(0, np.uint16), rng.integers(-5, 5, 9)
    assert all((x == y).all() and x.dtype == y.dtype for x, y in zip(unpack(pack(a, b, c, d)), (a, b, c, d), strict=True))
