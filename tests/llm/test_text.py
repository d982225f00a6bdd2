"""Tokens, packing, output, rules, decontamination, extraction, classifiers."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from .test_dedup import docs, lower, rows  # noqa: F401

SPECIAL = ["it's o'clock .'s x's don't 'shall", "Äpfel × ÷ — ’s “q” é é a<|endoftext|>b <| c", "１２３ 12ab3 a1b2!!c ſ ǅ İI ﬁ x\xa0y", "a\x1cb\x85c\x00d", "", "ΑΣ ΣΑΣ. 日本語 テキスト", "x÷y ×3 Ãƒ " + "..." * 30]


def library():
    from labflow.llm.tokens import default_path
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


def test_tokens_equal_the_library():
    from labflow.llm import textblocks as tb
    from labflow.llm.tokens import WordTokenizer, default_path

    texts = SPECIAL + [t for _, t in rows() if t]
    ids, offsets = WordTokenizer(default_path()).encode(tb.Batch.of(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == library().encode(t, add_special_tokens=False).ids


def encoded_texts(texts, end):
    lib = library()
    return [[*lib.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


def encoded(end):
    return list(zip([i for i, _ in rows()], encoded_texts([t for _, t in rows()], end), strict=True))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_output(spark, docs):  # noqa: F811
    from labflow.llm import token_output as to
    from labflow.llm.common import scratch

    uri = scratch(spark, "ids")
    entries = to.write_shards(docs, uri)
    index, buckets = to.build_index(entries)
    got = to.read_ids(to.locate(entries.select("doc_id", "occurrence"), index, buckets, entries), to.shard_starts(entries), uri).collect()
    want = sorted(encoded(1), key=lambda x: (x[0] is not None, x[0] or 0))
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter((i, len(x), crc(x)) for i, x in want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [i for i, _ in want]
    # a key that isn't there finds nothing
    assert to.locate(spark.createDataFrame([(987654321, 0), (6, 9), (None, 3)], "doc_id long, occurrence long"), index, buckets, entries).count() == 0


def test_perfect_hash_is_minimal():
    from labflow.llm.token_output import build_mph, find_slots

    keys = np.unique(np.random.default_rng(4).integers(0, 1 << 62, 5000).astype(np.uint64))
    levels, rest, slots = build_mph(keys)
    assert sorted(slots) == list(range(len(keys))) and (find_slots(levels, rest, keys) == slots).all() and not len(rest)
    # few levels: the rest is listed; equal keys end too, each with a slot of its own
    levels, rest, slots = build_mph(keys, most=2)
    assert len(rest) and sorted(slots) == list(range(len(keys))) and (find_slots(levels, rest, keys) == slots).all()
    levels, rest, slots = build_mph(np.array([7, 7, 9], np.uint64))
    assert sorted(slots) == [0, 1, 2] and rest.tolist() == [7, 7]
    assert find_slots(levels, rest, np.array([5], np.uint64))[0] in (-1, 0, 1, 2)


def test_keys_are_a_bijection():
    from labflow.llm.token_output import keys_of

    ids = np.r_[np.arange(-5000, 5000), np.arange(5000) << 32, [2**63 - 1, -(2**63)]]
    assert len(np.unique(keys_of(ids))) == len(np.unique(ids))


def test_token_output_with_small_reads(spark, docs, monkeypatch):  # noqa: F811
    """Reads cut into pieces, sparse keys, many buckets and a text longer than a batch give what one pass gives."""
    from labflow.llm import token_output as to
    from labflow.llm.common import scratch

    monkeypatch.setattr(to, "BUCKET_KEYS", 3)
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(99, "long words " * 450_000)], "doc_id long, text string"))
    uri = scratch(spark, "ids")
    entries = to.write_shards(more, uri)
    index, buckets = to.build_index(entries)
    assert buckets > 8
    wanted = entries.filter("doc_id % 3 = 0 or doc_id is null").select("doc_id", "occurrence")
    got = to.read_ids(to.locate(wanted, index, buckets, entries), to.shard_starts(entries), uri).collect()
    long = ([*library().encode("long words " * 450_000, add_special_tokens=False).ids, 1], 99)
    want = [(i, len(x), crc(x)) for i, x in [*encoded(1), long[::-1]] if i is None or i % 3 == 0]
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter(want)


def test_packing(docs):  # noqa: F811
    from labflow.llm.packing import pack

    got = pack(docs).collect()
    want = collections.Counter((i, len(x)) for i, x in encoded(2))
    assert collections.Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == want
    assert sum(r.length for r in got) == sum(len(x) for _, x in encoded(2))
    ids = collections.defaultdict(list)
    for i, x in encoded(2):
        ids[(i, len(x))].append(x)
    for r in got:
        assert any(crc(x[r.start : r.start + r.length]) == r.ids_crc32 for x in ids[(r.doc_id, r.doc_tokens)])
    seqs = collections.defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s, parts in seqs.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or s == max(seqs)


def test_hilbert_is_a_walk():
    from labflow.llm.packing import hilbert

    points = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = hilbert(points, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = set()
    for i in range(len(words) - 7):
        if seen[tuple(words[i : i + 8])] > 1:
            again.update(range(i, i + 8))
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def test_quality_rules_verdict(spark):
    """Thresholds and verdicts against quartiles of the grid's values, taken one document at a time."""
    import math

    from labflow.llm import quality_rules as qr

    rng = np.random.default_rng(11)
    vocab = [f"word{k}" * (1 + k % 3) for k in range(400)]
    data = []
    for i in range(900):
        words = list(rng.choice(vocab, int(rng.integers(25, 120))))
        if i % 40 == 0:
            words = [w + "#$%&" for w in words]
        if i % 55 == 0:
            words = [w.upper() for w in words]
        if i % 70 == 0:
            words = ["x" * 60] * 30
        lang = ("en", "fi", None)[i % 3 if i < 700 else 0]
        data.append((i, "\n".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9)), lang, f"s{i % 2}" if i % 50 else None))
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in qr.judge(df).collect()}

    def cell(v):
        return 0 if v <= 1e-4 else math.ceil(math.log(v / 1e-4) / math.log(qr.STEP))

    def value(c):
        return 0.0 if c <= 0 else 1e-4 * qr.STEP**c

    groups = collections.defaultdict(list)
    for i, _, lang, source in data:
        for key in ((lang, source), (lang, "*"), ("*", "*")):
            groups[key].append(got[i])
    wrong = 0
    for i, _, lang, source in data:
        r, failed = got[i], []
        own = next(groups[k] for k in ((lang, source), (lang, "*"), ("*", "*")) if len(groups[k]) >= qr.MIN_GROUP or k == ("*", "*"))
        for m, (floor, both) in qr.METRICS.items():
            low, high = (value(np.quantile([cell(x[m]) for x in own], q)) for q in (0.25, 0.75))
            spread = max(high - low, floor)
            if r[m] > high + qr.FENCE * spread or both and r[m] < low - qr.FENCE * spread:
                failed.append(m)
        wrong += list(r.failed_rules) != failed or r.kept != (not r.base_failed and not failed)
    assert wrong == 0 and 0 < sum(not r.kept for r in got.values()) < 200


def test_quality_rules(spark, docs):  # noqa: F811
    from labflow.llm.quality_rules import judge

    more = spark.createDataFrame([(900, "a b\na b\n\n a b\na b #*$ <x>\n" * 3, None, None, 1, "", "", 1)], docs.schema)
    got = judge(docs.unionByName(more)).collect()
    data = [*rows(), (900, "a b\na b\n\n a b\na b #*$ <x>\n" * 3)]
    want = collections.Counter((i, *base_counts(t or "")) for i, t in data)
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert judge(docs.limit(0)).count() == 0


def test_decontamination(spark, docs):  # noqa: F811
    from labflow.llm.decontaminate import clean_only, find

    long = rows()[5][1].split()
    items = [(1, " ".join(long[50:75])), (2, "One, two!"), (3, None), (4, "..."), (5, " ".join(long[55:66])), (6, "no such words here at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = word.findall(lower(t or ""))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(str(i))
    want = collections.Counter()
    for i, t in rows():
        w, cover, names = word.findall(lower(t or "")), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if hit := windows.get(tuple(w[k : k + n])):
                    cover.update(range(k, k + n))
                    names |= hit
        want[(i, len(w), len(cover), tuple(sorted(names)))] += 1
    got = find(docs, bench).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
    texts = dict(rows())
    for r in got:
        assert sum(len(word.findall(lower(texts[r.doc_id][s.start : s.end]))) for s in r.spans) == r.n_hit
    assert clean_only(docs, bench).count() == sum(n for k, n in want.items() if not k[2])
    assert find(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_decontamination_on_few_words():
    """Windows at every place of a block, in texts of three words that repeat all the time."""
    from labflow.llm import decontaminate as dc

    rng = np.random.default_rng(8)
    made = lambda n: " ".join(rng.choice(["ab", "cd", "ef"], n))
    items = [(k, made(int(rng.integers(1, 40)))) for k in range(30)]
    texts = [made(int(rng.integers(0, 200))) for _ in range(60)]
    machine = dc.automaton(tuple(items))
    m = dc.search(machine, tb_of(texts))
    got = {(p, n, i) for p, n, which in zip(m.place, m.words, m.items, strict=True) for i in which}
    want, base = set(), 0
    for t in texts:
        w = t.split()
        for i, x in items:
            x = x.split()
            n = min(len(x), 10)
            windows = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)}
            want |= {(base + k, n, i) for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows}
        base += len(w)
    assert got == want and len(want) > 100
    assert dc.automaton(((1, ""),)) is None and not dc.search(None, tb_of(texts)).place


def test_decontamination_keeps_every_byte_of_a_word(spark, docs):  # noqa: F811
    """Bytes 0x85 and 0xA0 inside UTF-8 words do not part them, in windows of ten words and in short items."""
    from labflow.llm.decontaminate import clean_only, find

    long = "voilà la Åsa déjà vu à côté du Р хор 蠅 充電 mot fin"
    items = [(1, long), (2, "Déjà, voilà!"), (3, "蠅"), (4, "à"), (5, "Р хор")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [(1, f"x {long} y"), (2, "on dit déjà voilà ici"), (3, "un 蠅 seul"), (4, "Ã la dÃ j voil"), (5, "Р, хор"), (6, "Рхор d voil"), (7, "la Åsa déjà vu à côté du Р хор 蠅")]
    df = spark.createDataFrame([(i, t, None, None, 1, "", "", 1) for i, t in texts], docs.schema)
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in find(df, bench).collect()}
    assert got == {1: (16, 14, ["1", "3", "4", "5"]), 2: (5, 2, ["2"]), 3: (3, 1, ["3"]), 4: (5, 0, []), 5: (2, 2, ["5"]), 6: (3, 0, []), 7: (10, 10, ["1", "3", "4", "5"])}
    assert sorted(r.doc_id for r in clean_only(df, bench).collect()) == [4, 6]


HTML = """<!DOCTYPE html><html><head><title>t</title><script>var a = "<p>no</p>";</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
<div id="cookie-notice">We use cookies, all of them</div><nav><a href=/>Home</a></nav><div class="wrap"><div class="content"><h2>Title &eacute;</h2>
<p>First&nbsp;paragraph, with <a href=x>a link</a>,
 in two lines.<p>Second<br>line &amp; more<aside>side</aside><div class="share-box">share</div><p>Short.</div><div class="sidebar"><p>Nope, nope, nope</div></div>
<section class="comments"><p>I love it, really, so much, yes, indeed</section><form><p>Email</form><footer>foot</footer>"""


def test_html_is_linear():
    """Twice the page takes about twice the time, however the page is made to go wrong."""
    import time

    from labflow.llm.html_text import main_text

    made = [lambda n: "<p><button>" + "<div>" * n, lambda n: "<script " * n, lambda n: "<a " + '"' * n, lambda n: "<b '\"> '" * n, lambda n: "<a<a" * n, lambda n: "<div " + "a" * n + ">", lambda n: "<a x='" * n + ">", lambda n: "<!--" * n, lambda n: "<ul><li>" * n, lambda n: "<p>&#" + "9" * n + ";</p>", lambda n: "<style>" * n + "</styl" * n, lambda n: "<svg>" * n, lambda n: "<svg " * n + ">", lambda n: "<object>" * n + "</object>" * n, lambda n: "<math></math" * n, lambda n: "<div class='extra print'><p>a" * n]
    for page in made:
        took = []
        for n in (10_000, 40_000):
            began = time.process_time()
            main_text(page(n))
            took.append(time.process_time() - began)
        assert took[1] < 12 * took[0] + 0.3, (page(3), took)


def test_html_tokens_against_a_plain_pattern():
    """On well-formed pages the tags are those of a plain pattern."""
    from labflow.llm.html_text import tokens

    plain = re.compile(r"<!--.*?-->|<(script|style)\b[^>]*>.*?</\1>|<!doctype[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
    rng = np.random.default_rng(3)
    bits = ["<p>", "</p>", "<div class=\"a > b\" id='x'>", "</div>", "text & more ", "<!-- <p> -->", "<script>if (a < b) '<p>'</script>", "<br/>", "<A HREF=x>", "</A>", "<style>p > a</style>", "<!doctype html>", "\n", "1 < 2 "]
    for _ in range(200):
        page = "".join(rng.choice(bits, 40))
        want = [(m.start(), m.end(), bool(m[2]), m[3].lower() if m[3] else None, m[4] or "") for m in plain.finditer(page)]
        assert list(tokens(page)) == want


def test_html_keeps_the_whole_article():
    from labflow.llm.html_text import main_text

    links = "".join(f"<li><a href='/{i}'>The {i}th title of a longer work, and its author</a></li>" for i in range(4))
    menu = "".join(f"<li><a href='/{i}'>Part {i}</a></li>" for i in range(4))
    for page, want in [
        ("<article><p>A</p><svg width='1'/><p>B</p></article>", "A\nB"),
        ("<article><p>A</p><math/><p>B</p></article>", "A\nB"),
        ("<article><p>A</p><svg><p>B</p></article>", "A\nB"),
        ("<article><p>A</p><template><p>B</p></article>", "A\nB"),
        ("<article><p>A</p><object>in<object>out</object>LEAK</object><svg><svg>x</svg>LEAK</svg><noscript>n</noscript><p>B</p></article>", "A\nB"),
        ("<article><p>A</p><svg><path d='x'/><svg/><title>t</title></svg><p>B</p></article>", "A\nB"),
        ("<article><p>A</p><p class='legal-text'>B</p><section class='extra'><p>C</p></section><div class='popup-book'><p>D</p></div></article>", "A\nB\nC\nD"),
        ("<h1>T</h1><div class='legal-text'>ARTICLE</div>", "T\nARTICLE"),
        (f"<article><p>A</p><ul>{links}</ul></article>", "A\n" + "\n".join(f"The {i}th title of a longer work, and its author" for i in range(4))),
        (f"<article><p>A</p><ul>{menu}</ul></article>", "A"),
        ("<div class='page menu-open'><article><p>A</p></article></div>", "A"),
        ("<div class='sidebar-layout'><h1>T</h1><p>A long text, with commas, and all of the page.</p></div><p class='share'>Share</p>", "T\nA long text, with commas, and all of the page."),
        ("<div class='ad'>An advert that is longer than all of the article, by far.</div><article><h1>T</h1><p>A</p></article>", "T\nA"),
        ("<div class='notice'>A notice that is longer than all of the article, by far.</div><h1>T</h1><p>A</p>", "T\nA"),
        ("<div><p>A text, short.</p></div><div class='comments'><p>A comment, much longer than the text, and liked, by many, many readers.</p></div>", "A text, short."),
        ("<article><p>A</p><article class='comment'><p>no</p></article><div class='related'><p>no</p></div><div hidden>no</div></article>", "A"),
    ]:
        assert main_text(page) == want, page


def _random_tree(rnd, depth=0):
    """An element as [tag, class, children]; a child is an element, a text or a linked text."""
    if depth > 3 or depth and rnd.random() < 0.4:
        words = " ".join(rnd.choice(["alpha", "be,ta", "gamma", "delta,"]) for _ in range(rnd.randint(1, 60)))
        return [rnd.choice(["p", "h2", "pre"]), rnd.choice(["", "", "", "note", "share", "legal"]), [("a", words) if rnd.random() < 0.2 else words]]
    return [rnd.choice(["div", "section", "div", "article" if rnd.random() < 0.2 else "div"]), rnd.choice(["", "", "", "", "sidebar", "extra", "comments", "text"]), [_random_tree(rnd, depth + 1) for _ in range(rnd.randint(1, 4))]]


def _brute_article(root):
    """Scores by walking the tree again and again, as they are described."""
    from labflow.llm import html_text as h

    nodes, up = [], {}

    def walk(node, parent):
        nodes.append(node)
        up[id(node)] = parent
        for c in node[2]:
            if isinstance(c, list):
                walk(c, node)

    walk(root, None)
    kind = {id(n): 2 if n[1] == "comments" else 0 if n[0] == "article" else {"share": 1, "sidebar": 1, "legal": -1, "extra": -1}.get(n[1], 0) for n in nodes}
    below = lambda n: [n, *(x for c in n[2] if isinstance(c, list) for x in below(c))]
    above = lambda n: [] if up[id(n)] is None else [up[id(n)], *above(up[id(n)])]
    texts = lambda n: [(c[1], True) if isinstance(c, tuple) else (c, False) for c in n[2] if not isinstance(c, list)]
    marked: set[int] = set()

    def size(n, linked=False, whole=True):
        return sum(len(t) for x in (below(n) if whole else [n]) if not marked & {id(y) for y in [x, *above(x)]} for t, link in texts(x) if link or not linked)

    bad = set()
    for n in nodes:
        k = kind[id(n)]
        if not k or any(id(x) in bad for x in above(n)):
            continue
        if any(x[0] == "article" and kind[id(x)] != 2 for x in below(n)):
            continue
        all_, linked = size(n), size(n, True)
        if k == -1:
            drop = n[0] not in h.TEXTUAL and all_ < 200 and 10 * all_ < size(up[id(n)]) or linked > all_ / 2
        else:
            drop = k == 2 or any(x[0] == "article" and kind[id(x)] != 2 for x in nodes) or (all_ - linked) <= 0.6 * (size(root) - size(root, True))
        if drop:
            bad.add(id(n))
    marked |= bad
    score = {}
    for n in nodes:
        total = 0.0
        for x in below(n):
            own = size(x, whole=False)
            if own:
                dull = h.DISCOUNT ** sum(kind[id(y)] != 0 for y in [x, *above(x)])
                points = (min(own / 100, 3) + sum(t.count(",") for t, _ in texts(x)) + 0.25) * (1 - size(x, True, False) / own) * dull
                far = [id(y) for y in [x, *above(x)]].index(id(n)) - (x[0] not in ("div", "section", "article"))
                total += points / 2**far if 0 <= far <= 3 else 0.0
        score[id(n)] = total
    dense = lambda n: size(n, True) / size(n) if size(n) else 0.0
    place = {id(n): i for i, n in enumerate(nodes)}
    ok = [n for n in nodes if not marked & {id(y) for y in [n, *above(n)]}]
    if not ok:
        return ""
    best = max(ok, key=lambda n: (round(score[id(n)] * (1 - dense(n)), 9), -place[id(n)]))
    roots = [best]
    if score[id(best)] > 0:
        high = [x for x in [best, *above(best)] if x[0] == "article"]
        if high:
            roots = [high[0]]
        elif up[id(best)] is not None:
            limit = max(1.0, 0.2 * score[id(best)])
            roots += [n for n in ok if up[id(n)] is up[id(best)] and n is not best and (score[id(n)] * (1 - dense(n)) >= limit or n[0] in ("p", "pre") and size(n) and dense(n) < 0.3 or n[0] == "h2")]
    else:
        roots = [root]
    return "\n".join(t for n in ok if any(r is x for r in roots for x in [n, *above(n)]) for t, _ in texts(n))


def test_html_against_a_plain_scorer():
    import random

    from labflow.llm.html_text import main_text

    rnd, kept = random.Random(11), 0
    write = lambda n: f"<{n[0]} class='{n[1]}'>{''.join(write(c) if isinstance(c, list) else f'<a href=x>{c[1]}</a>' if isinstance(c, tuple) else c for c in n[2])}</{n[0]}>"
    for _ in range(500):
        root = ["body", "", [_random_tree(rnd) for _ in range(rnd.randint(1, 4))]]
        want = _brute_article(root)
        assert main_text(f"<html>{write(root)}</html>") == want
        kept += bool(want)
    assert kept > 300


def test_html_awkward_rows(spark):
    from labflow.llm.html_text import extract, main_text

    assert main_text("<p>&#" + "0" * 5000 + "65; &#" + "9" * 5000 + ";</p>") == "A \ufffd"
    schema = "page_id long, url string, html string, text string, n_chars string, lang int"
    df = spark.createDataFrame([(1, "u", "<p>one</p>", "clash", "clash", 1)] * 3 + [(None, None, "<p>two", "x", "x", None), (2, "u", "<p>" + "long words " * 600_000, "x", "x", 1)], schema)
    got = sorted(((r.page_id, r.text if r.n_chars < 10 else "", r.n_chars) for r in extract(df).collect()), key=str)
    assert got == [(1, "one", 3)] * 3 + [(2, "", 11 * 600_000 - 1), (None, "two", 3)]
    assert extract(df.limit(0)).count() == 0


def test_html(spark):
    from labflow.llm.html_text import extract, main_text

    assert main_text(HTML) == "Title é\nFirst paragraph, with a link, in two lines.\nSecond line & more\nShort."
    assert main_text("<article><h1>A</h1><p>b</article><footer>c") == "A\nb"
    assert main_text("plain text only") == "plain text only" and main_text("<") == "<" and main_text(None) == ""
    assert main_text("<div>" * 5000 + "deep words" + "</div>" * 5000) == "deep words"
    df = spark.createDataFrame([(1, "u", HTML), (1, "u", HTML), (2, None, None), (3, "u", "")], "page_id long, url string, html string")
    assert sorted((r.page_id, r.n_chars) for r in extract(df).collect())[2:] == [(2, 0), (3, 0)]


def random_model(seed=1):
    from labflow.llm import toxicity as tx

    rng = np.random.default_rng(seed)
    texts = ["aaaa bbbb cccc dddd", "", "bbbb", "cccc aaaa", "eeee ffff aaaa aaaa bbbb cccc gggg"]
    known = np.unique(np.concatenate([tx.featurise(tb_of([t]))[0].ravel() for t in texts[:4]]))
    known = known[known >= 0]
    table = np.r_[rng.normal(0, 1, (len(known), tx.DIM)), np.zeros((1, tx.DIM))].astype(np.float32)
    return texts, tx.Model(known, table, [rng.normal(0, 0.5, (w, tx.DIM, tx.FILTERS)).astype(np.float32) for w in tx.WIDTHS], [rng.normal(0, 0.3, tx.FILTERS).astype(np.float32) for _ in tx.WIDTHS], rng.normal(0, 0.5, tx.FILTERS * len(tx.WIDTHS)).astype(np.float32), 0.2)


def tb_of(texts):
    from labflow.llm import textblocks as tb

    return tb.Batch.of(pa.array(texts, pa.string()))


def test_toxicity_forward_pass():
    """Against a plain loop over windows; a text's score does not depend on its neighbours."""
    from labflow.llm import toxicity as tx

    texts, model = random_model()
    want = []
    for t in texts:
        buckets, _ = tx.featurise(tb_of([t]))
        vectors = [sum((model.table[np.searchsorted(model.known, b)] if b in model.known else np.zeros(tx.DIM) for b in row), np.zeros(tx.DIM)) for row in buckets.tolist()]
        padded = [*vectors, *[np.zeros(tx.DIM)] * 3]
        pooled = []
        for width, w, bias in zip(tx.WIDTHS, model.filters, model.bias, strict=True):
            maps = [sum(padded[p + i] @ w[i] for i in range(width)) + bias for p in range(max(len(vectors), 1))]
            pooled += list(np.maximum(np.max(maps, axis=0), 0))
        want.append(float(np.dot(pooled, model.out) + model.base))
    assert model.logits(tb_of(texts)) == pytest.approx(want, rel=1e-4, abs=1e-4)
    for i, t in enumerate(texts):
        assert model.logits(tb_of([t]))[0] == pytest.approx(want[i], rel=1e-4, abs=1e-4)


def test_toxicity_gradients():
    """Against differences of the loss."""
    from labflow.llm import toxicity as tx

    texts, model = random_model()
    for name in ("filters", "bias"):
        setattr(model, name, [x.astype(np.float64) for x in getattr(model, name)])
    model.table, model.out = model.table.astype(np.float64), model.out.astype(np.float64)
    labels, weights = np.array([1, 0, 1, 0, 1]), np.array([0.4, 0.1, 0.2, 0.2, 0.1])
    buckets, first = tx.featurise(tb_of(texts))
    rows = model.rows(buckets)

    def loss():
        x, start, stop = model.lay(rows, first)
        z = model.pooled(x.astype(np.float64), start, stop) @ model.out + model.base
        ridge = sum((p * p).sum() for p in [*model.filters, model.out]) * tx.RIDGE / 2
        return (weights * (np.log1p(np.exp(z)) - labels * z)).sum() + ridge

    _, grads, gx = tx.gradients(model, rows, first, labels, weights)
    rng = np.random.default_rng(2)
    for param, grad in zip([*model.filters, *model.bias, model.out], grads, strict=True):
        for at in rng.integers(0, param.size, 6):
            old = param.flat[at]
            param.flat[at] = old + 1e-3
            high = loss()
            param.flat[at] = old - 1e-3
            low = loss()
            param.flat[at] = old
            assert grad.flat[at] == pytest.approx((high - low) / 2e-3, rel=2e-2, abs=2e-3)
    # the vector of a word is the sum of its features' rows: its gradient goes to each of them
    put = np.arange(len(rows)) + tx.PAD * np.repeat(np.arange(len(texts)), np.diff(first))
    by_row = np.zeros_like(model.table)
    for k in range(4):
        np.add.at(by_row, rows[:, k], gx[put])
    for row in range(len(model.table) - 1):
        old = model.table[row, 3]
        model.table[row, 3] = old + 1e-3
        high = loss()
        model.table[row, 3] = old - 1e-3
        low = loss()
        model.table[row, 3] = old
        assert by_row[row, 3] == pytest.approx((high - low) / 2e-3, rel=2e-2, abs=2e-3)


def test_toxicity_awkward_rows(spark, docs):  # noqa: F811
    """Clashing columns, nulls, repeated rows, an empty table, and a sample bounded in bytes."""
    from labflow.llm import toxicity as tx

    labels = spark.createDataFrame([(i, (i or 0) % 2, (i or 0) % 3 == 0) for i in (1, 2, 4, 6, 6, 8, 20, 21, 23, 24, 40, None)], "doc_id long, toxic int, text boolean")
    model = tx.train(docs, labels, size=3000)
    got = tx.score(docs, model).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
    same = collections.defaultdict(set)
    for i, t in rows():
        same[t or ""].add(i)
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(round(r.score, 9))
    assert by_id[4] == by_id[5] and by_id[41] == by_id[42] and len(by_id[6]) <= 2 and by_id[1] == by_id[2] == by_id[3]
    assert tx.score(docs.limit(0), model).count() == 0


def test_toxicity_learns(spark):
    from labflow.llm import toxicity

    rng = np.random.default_rng(7)
    vocab, bad = [f"w{i}x" for i in range(500)], ["vilest", "vileness", "vile"]
    data = []
    for i in range(700):
        words, toxic = list(rng.choice(vocab, 40)), int(i % 4 == 0)
        if toxic:
            words[int(rng.integers(40))] = bad[i % 3]
        data.append((i, " ".join(words) if i != 8 else None, "en" if i % 2 else None, toxic))
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, y int")
    model = toxicity.train(df, df.select("doc_id", df.y.alias("toxic")))
    got = toxicity.score(df, model).join(df, "doc_id").withColumn("held", toxicity.held_out()).filter("held and text is not null").collect()
    right = sum((r.score >= 0.3) == bool(r.y) for r in got)
    assert right / len(got) > 0.9 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(df.limit(0), model).count() == 0
    assert toxicity.score(df, toxicity.train(df, df.select("doc_id", df.y.alias("toxic")).limit(0))).count() == 700


def _scores(df, ids, n=3):
    from labflow.llm import kneser_ney as kn

    keys = kn.keys_for(1 << 20)
    counts = kn.count_bigrams(df, ids, n, keys)
    words, d = kn.word_tables(counts)
    gains = kn.bigram_gains(counts, words, d, n, keys)
    return kn.score(df, kn.home_tables(words, gains, keys), gains, n, keys)


def test_kneser_ney_matches_formula(spark):
    """Log probabilities of the sharded model against the textbook formula on the same classes."""
    from labflow.llm import kneser_ney as kn
    from labflow.llm import textblocks as tb

    rng = np.random.default_rng(9)
    texts = [" ".join(f"t{int(x)}" for x in rng.zipf(1.5, rng.integers(1, 60)) % 50) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(None, None, None), (400, "", "de")], "doc_id long, text string, lang string")
    ids = df.select("doc_id").filter("doc_id < 200")
    got = {r.doc_id: (r.n_words, r.log_prob) for r in _scores(df, ids).collect()}
    trained = {r.doc_id for r in ids.filter(~kn.held_out()).collect()}
    big, cls = collections.Counter(), {}
    for i, t in enumerate(texts):
        w, _ = kn.keys_for(1 << 20).words(tb.Batch.of(pa.array([t])))
        cls[i] = [0, *w.tolist()]
        if i in trained:
            big.update(zip(cls[i], cls[i][1:], strict=False))
    follow, ctx, by = collections.Counter(), collections.Counter(), collections.defaultdict(collections.Counter)
    for (v, w), c in big.items():
        follow[w] += 1
        ctx[v] += c
        by[v][min(c, 3)] += 1
    d2 = kn.discounts(np.array([sum(c == k for c in big.values()) for k in (1, 2, 3, 4)]))
    d1 = kn.discounts(np.array([sum(c == k for c in follow.values()) for k in (1, 2, 3, 4)]))
    spare = sum(d1[min(c, 3) - 1] for c in follow.values()) / len(big)

    def p1(w):
        return (max(follow[w] - d1[min(follow[w], 3) - 1], 0) if follow[w] else 0) / len(big) + spare / kn.VOCABULARY

    def p2(v, w):
        if not ctx[v]:
            return p1(w)
        c = big[(v, w)]
        g = sum(d2[k - 1] * n for k, n in by[v].items()) / ctx[v]
        return (max(c - d2[min(c, 3) - 1], 0) if c else 0) / ctx[v] + g * p1(w)

    for i in range(300):
        want = sum(np.log(p2(v, w)) for v, w in zip(cls[i], cls[i][1:], strict=False))
        assert got[i][0] == len(cls[i]) - 1 and got[i][1] == pytest.approx(want, rel=1e-3, abs=1e-2)
    assert got[None] == (0, 0.0) and got[400] == (0, 0.0)


def test_kneser_ney_tells_words_apart(spark):
    """A word that was never trusted inherits nothing from a trusted word, however many words there are."""
    from labflow.llm import kneser_ney as kn
    from labflow.llm import textblocks as tb

    names = [f"q{i}" for i in range(6000)]
    starts, ends, _ = tb.words(tb.Batch.of(pa.array([" ".join(names)])))
    old = tb.word_hashes(tb.Batch.of(pa.array([" ".join(names)])).data, starts, ends) % np.uint64((1 << 18) - 1)
    by = collections.defaultdict(list)
    for name, c in zip(names, old.tolist(), strict=True):
        by[c].append(name)
    pairs = [x[:2] for x in by.values() if len(x) > 1]
    assert len(pairs) > 20
    trusted = [f"c{i} {a} d{i} {a}" for i, (a, _) in enumerate(pairs) for _ in range(3)]
    texts = [*trusted, *[x for pair in pairs for x in pair], "neverseen"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.log_prob for r in _scores(df, df.select("doc_id").filter(f"doc_id < {len(trusted)}")).collect()}
    for i in range(len(trusted), len(texts) - 1, 2):
        assert got[i] > got[i + 1] + 1 and got[i + 1] == pytest.approx(got[len(texts) - 1], rel=1e-9)


def test_kneser_ney_counts_beyond_16_bits(spark):
    """A bigram that a document holds 70,000 times weighs 70,000 times what it weighs once."""
    from labflow.llm import kneser_ney as kn

    texts = ["a b " * 20 + f"c{i}" for i in range(40)] + ["a " * 3, "a " * 4, "a " * 70_001, "a b " * 2, "a b " * 3, "a b " * 65_538]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.log_prob for r in _scores(df, df.select("doc_id").filter("doc_id < 41")).collect()}
    for few, more, many, step in ((40, 41, 42, 69_997), (43, 44, 45, 65_535)):
        assert got[many] == pytest.approx(got[more] + step * (got[more] - got[few]), rel=1e-3)


def test_kneser_ney_thresholds(spark):
    """Each language and band has the quantile of its own held-out documents, or of the next wider group with enough of them."""
    from labflow.llm import kneser_ney as kn

    rng = np.random.default_rng(4)
    data = [(i, ("en", "fi", None)[i % 3] if i < 1500 else "sv", int(i % 4 == 0), 10, float(rng.gamma(4, 0.7))) for i in range(1540)]
    scored = spark.createDataFrame(data, "doc_id long, lang string, band int, n_words long, log_ppl double")
    ids = scored.select("doc_id").filter("doc_id % 2 = 0")
    held = {r.doc_id for r in ids.filter(kn.held_out()).collect()}
    got = {(r.t_lang, r.t_band): r.limit for r in kn.thresholds(scored, ids).collect()}

    def q(lang=..., band=...):
        x = [round(p / kn.GRID) * kn.GRID for i, g, b, _, p in data if i in held and lang in (..., g) and band in (..., b)]
        return len(x), float(np.quantile(x, kn.QUANTILE)) if x else None

    assert set(got) == {(g, b) for g in ("en", "fi", None, "sv") for b in (0, 1)}
    for (lang, band), limit in got.items():
        (n0, q0), (n1, q1), (n2, q2), (_, q3) = q(lang, band), q(lang), q(band=band), q()
        if n0 >= kn.MIN_HELD:
            want = q0
        elif n1 >= kn.MIN_HELD:
            want = max(q1, q1 + q2 - q3) if n2 >= kn.MIN_HELD else q1
        else:
            want = q2 if n2 >= kn.MIN_HELD else q3
        assert limit == pytest.approx(want + np.log(kn.SLACK), abs=1e-6), (lang, band, n0, n1, n2)


def test_classifier_edge_cases(spark, docs):  # noqa: F811
    from labflow.llm.kneser_ney import classify

    labels = spark.createDataFrame([(6, 1, 0), (20, 1, 0), (None, 1, 0), (8, 0, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    got = classify(docs, labels).collect()
    assert len(got) == len(rows()) and all(r.kept for r in got if not r.n_words)
    assert all(r.kept for r in classify(docs, labels.limit(0)).collect())
    assert classify(docs.limit(0), labels).count() == 0
