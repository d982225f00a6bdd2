"""Main-text extraction by tree scoring.

A page is read once into a tree of block elements.  Subtrees that are never article text (menus, footers, forms, scripts,
hidden parts ...) are marked by tag, role and attribute.  Names of classes and ids weigh, but don't decide alone: what is called
an advert, a sidebar or a notice is marked unless it holds the article (or, where no article or title stands elsewhere, most
of the page's text), what is called reader comments unless it holds the article; a doubtful name only discounts the points, and marks what is short or mostly links against
its container.  Every remaining paragraph has points for its length and commas, times the share of it that isn't link text; they
go in full to its parent and in halves to further ancestors.  The best container, widened to the ``article`` or ``main`` that
holds it, is kept with the siblings that score well, and its blocks become lines; only lists of short links in it are menus.

Defined cases: null or empty html gives an empty text; a page without scored paragraphs gives the text of what isn't
marked; unclosed and stray tags are repaired the way browsers do for blocks; an embedded element (``svg``, ``math``, ``object``,
``noscript``, ``template``) ends at its own end tag, nested ones counted, and without one it is nothing but its tag; repeated pages
are handled each on their own.  Each page is a few linear passes, however long or deep.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements whose content is no markup; it ends at the first end tag of the same name.
RAW = frozenset("script style iframe textarea title xmp".split())
#: Elements whose content is markup but no text of the page; ``/>`` ends the two foreign ones.
EMBEDDED, FOREIGN = frozenset("noscript template svg object math".split()), frozenset("svg math".split())
_RAW_END = {name: re.compile(rf"</{name}\s*+>", re.I) for name in RAW}
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_DIGITS = re.compile(r"&#(?=[0-9])0*([0-9]{0,8})[0-9]*")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

BLOCKS = frozenset("html body head article main section div header footer nav aside form fieldset p pre blockquote h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption address details summary dialog menu hr center hgroup search option select button label legend video audio".split())
NEVER = frozenset("head nav footer aside form dialog menu search select option button label legend fieldset video audio".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACE = frozenset("br img wbr input".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open paragraph, and tags that end an open one of their own kind.
ENDS_P = BLOCKS - frozenset("head option select button label legend video audio html body".split())
ENDS_SELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: Parts of names: of reader comments, of what is hardly ever article text, and of what often isn't.
COMMENTS = frozenset("combx comment comments commentlist disqus pingback replies reply respond shoutbox trackback".split())
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs consent cookie cookies footer gdpr hidden masthead menu menus nav navbar navigation navi newsletter notice notices pager pagination paywall promo promoted promotion recommended related rss share sharing sidebar sidebars skyscraper social sponsor sponsored sponsors subscribe subscription widget widgets".split()
)
DOUBTFUL = frozenset("community disclaimer extra feedback foot legal login modal overlay popup print recommend remark signup skip teaser toolbar tooltip".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form toolbar".split())
TEXTUAL = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption".split())


def _unescape(text: str) -> str:
    """Character references decoded; a number of any length is no more work than its digits."""
    if "&#" in text:
        text = _DIGITS.sub(lambda m: f"&#{m[1] or 0}", text)
    return html.unescape(text)


def tokens(page: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """Start, end, whether it closes, lower-case tag and attributes of each tag; tag None for comments and raw elements.

    A ``>`` in a quoted attribute doesn't end a tag.  If a page has a tag that no ``>`` outside quotes ends, that tag and all
    later ones end at the first ``>``, so every character is looked at a bounded number of times.
    """
    at, n, quotes, last = 0, len(page), True, page.rfind(">")
    ended: set[str] = set()  # quote signs that no longer occur
    embedded: dict[str, dict[int, int]] = {}
    while (i := page.find("<", at)) >= 0:
        if page.startswith("<!--", i):
            j = page.find("-->", i + 4)
            at = n if j < 0 else j + 3
            yield i, at, False, None, ""
            continue
        if i > last:
            return
        if page[i + 1] in "!?":
            at = page.find(">", i) + 1
            yield i, at, False, None, ""
            continue
        m = _NAME.match(page, i)
        if not m:
            at = i + 1
            continue
        tag = m[2].lower()
        if not m[1] and tag in RAW:
            j = _RAW_END[tag].search(page, page.find(">", i) + 1)
            at = j.end() if j else n
            yield i, at, False, None, ""
            continue
        k = m.end()
        while quotes:
            stop = _STOP.search(page, k)
            if not stop:
                quotes = False
            elif stop[0] == ">":
                k = stop.start()
                break
            else:
                j = -1 if stop[0] in ended else page.find(stop[0], stop.end())
                if j < 0:
                    ended.add(stop[0])
                k = stop.end() if j < 0 else j + 1
        if not quotes:
            k = page.find(">", m.end())
        at = k + 1
        if not m[1] and tag in EMBEDDED:
            if tag not in embedded:
                embedded[tag] = _ends(page, tag)
            if not (tag in FOREIGN and page[k - 1] == "/"):
                at = embedded[tag].get(i, at)
            yield i, at, False, None, ""
            continue
        yield i, at, bool(m[1]), tag, page[m.end() : k]


def _ends(page: str, tag: str) -> dict[int, int]:
    """Where each element of an embedded kind ends, by its start; those without an end tag are left out."""
    out: dict[int, int] = {}
    open_: list[int] = []
    begun, closing = False, -1  # a start tag that no ">" has ended yet; the element whose end tag none has
    for m in re.finditer(rf"<(/?){tag}(?=[\s/>])|/?>", page, re.I):
        if m[0][-1] == ">":
            if begun and tag in FOREIGN and m[0] == "/>":
                open_.pop()
            if closing >= 0:
                out[closing] = m.end()
            begun, closing = False, -1
        elif not m[1]:
            open_.append(m.start())
            begun = True
        elif open_:
            begun, closing = False, open_.pop()
    if closing >= 0:
        out[closing] = len(page)
    return out


def _named(tag: str, attrs: str) -> int:
    """How unlikely an element is to be article text: 3 never, 2 comments, 1 by name, -1 doubtful, 0 no sign."""
    found = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
    if found.get("role", "").lower() in ROLES or found.get("aria-hidden", "").lower() == "true":
        return 3
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I) or re.search(r"(?:^|\s)hidden(?:\s|$|=)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attrs)):
        return 3
    if tag in ("body", "html", "main"):
        return 0
    kinds = {0}
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        parts = [p.lower() for p in _PARTS.findall(name)]
        for i, p in enumerate(parts):
            if not (i and parts[i - 1] in ("has", "with", "no", "without")):
                kinds.add(2 if p in COMMENTS else 1 if p in UNLIKELY else -1 if p in DOUBTFUL else 0)
    if tag == "article":
        return 2 if 2 in kinds else 0
    return max(kinds) or min(kinds)


class _Tree:
    """Nodes in page order: parent, tag, mark and kind by name of each, and the text chunks with the node they stand in."""

    def __init__(self, page: str):
        self.parent, self.tag, self.marked, self.main, self.kind = [-1], ["#root"], [False], [False], [0]
        self.chunks: list[tuple[int, str, bool]] = []  # node, text, inside a link
        self.breaks: list[int] = []
        self._read(page)

    def _read(self, page: str) -> None:
        stack, links, at = [0], 0, 0
        opened: dict[str, list[int]] = {}  # depths of the open elements of each tag
        chunks = self.chunks

        def pop_to(depth: int) -> None:
            while len(stack) > depth:
                opened[self.tag[stack.pop()]].pop()

        def nearest(tags, fences=()) -> int:
            """Depth of the innermost open element of ``tags``, 0 if one of ``fences`` lies inside it."""
            depth = max((opened[t][-1] for t in tags if opened.get(t)), default=0)
            return depth if depth > max((opened[t][-1] for t in fences if opened.get(t)), default=0) else 0

        for start, end, closes, tag, attrs in tokens(page):
            if start > at:
                chunks.append((stack[-1], page[at:start], links > 0))
            at = end
            if tag is None:
                continue
            if closes:
                if tag == "a":
                    links = 0
                elif opened.get(tag):
                    pop_to(opened[tag][-1])
                    links = 0
                continue
            if tag in SPACE:
                chunks.append((stack[-1], " ", False))
                continue
            if tag == "a":
                links = 1
                continue
            kind = _named(tag, attrs) if len(attrs) > 3 else 0
            if tag not in BLOCKS and (kind <= 0 or tag in VOID):
                continue
            if tag in ("html", "body") and opened.get(tag):
                continue
            links = 0
            if tag in ENDS_P and opened.get("p"):
                depth = nearest(("p",), ("table", "td", "th", "button"))
                if depth:
                    pop_to(depth)
            if tag in ENDS_SELF:
                depth = nearest(ENDS_SELF[tag], FENCE[tag])
                if depth:
                    pop_to(depth)
            if tag in HEADINGS and self.tag[stack[-1]] in HEADINGS:
                pop_to(len(stack) - 1)
            if tag not in ("head", "html", "body") and self.tag[stack[-1]] == "head":
                pop_to(len(stack) - 1)
            up = stack[-1]
            inside = self.main[up] or tag in ("article", "main")
            self.parent.append(up)
            self.tag.append(tag)
            self.main.append(inside)
            self.kind.append(kind)
            self.marked.append(self.marked[up] or kind == 3 or tag in NEVER or tag == "header" and not inside or tag not in HEADINGS and self.tag[up] == "header" and self.main[up])
            if tag not in VOID:
                opened.setdefault(tag, []).append(len(stack))
                stack.append(len(self.tag) - 1)
        if at < len(page):
            chunks.append((stack[-1], page[at:], links > 0))


def _blocks(tree: _Tree, keep: list[bool]) -> list[str]:
    """Text of kept nodes in page order, one entry per run that no block tag interrupts."""
    out: list[str] = []
    run: list[str] = []
    last = None
    for node, text, _ in tree.chunks:
        if node != last:
            if run and (line := " ".join("".join(run).split())):
                out.append(line)
            run, last = [], node
        if keep[node]:
            run.append(_unescape(text))
    if run and (line := " ".join("".join(run).split())):
        out.append(line)
    return out


class _Sizes:
    """Text, link text, links and commas of every node's own chunks and, as ``whole``, of its subtree; marked nodes have none."""

    def __init__(self, tree: _Tree):
        n = len(tree.tag)
        self.own, self.linked, self.links, self.commas = [0] * n, [0] * n, [0] * n, [0] * n
        for node, text, link in tree.chunks:
            if tree.marked[node]:
                continue
            k = len(text.strip())
            self.own[node] += k
            self.linked[node] += k * link
            self.links[node] += link and k > 0
            self.commas[node] += text.count(",") + text.count("，") + text.count("、")
        self.whole, self.whole_linked, self.whole_links = self.own[:], self.linked[:], self.links[:]
        for i in range(n - 1, 0, -1):
            up = tree.parent[i]
            self.whole[up] += self.whole[i]
            self.whole_linked[up] += self.whole_linked[i]
            self.whole_links[up] += self.whole_links[i]

    def density(self, i: int) -> float:
        return self.whole_linked[i] / self.whole[i] if self.whole[i] else 0.0


#: What a doubtful name leaves of the points.
DISCOUNT = 0.3


def _judge(tree: _Tree) -> list[float]:
    """Mark what names and sizes together say isn't article text; the discount of every node."""
    n, sizes = len(tree.tag), _Sizes(tree)
    core, title = [False] * n, [False] * n  # the subtree holds an article, or a title
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        core[i] |= tree.tag[i] in ("article", "main") and tree.kind[i] != 2 and not tree.marked[i]
        title[i] |= tree.tag[i] == "h1" and not tree.marked[i]
        core[up] |= core[i]
        title[up] |= title[i]
    prose = [w - k for w, k in zip(sizes.whole, sizes.whole_linked, strict=True)]
    share = [1.0] * n
    for i in range(1, n):
        up, kind = tree.parent[i], tree.kind[i]
        tree.marked[i] = tree.marked[i] or tree.marked[up]
        share[i] = share[up]
        if kind in (0, 3) or tree.marked[i]:
            continue
        part = prose[i] / prose[0] if prose[0] else 0.0
        holds = core[i] or title[i] and part > 0.3
        if kind == -1:
            short = tree.tag[i] not in TEXTUAL and sizes.whole[i] < 200 and 10 * sizes.whole[i] < sizes.whole[up]
            tree.marked[i] = not holds and (short or sizes.density(i) > 0.5)
        else:
            # most of a page's text is its article only if neither an article nor a title stands elsewhere
            tree.marked[i] = not holds and (kind == 2 or part <= 0.6 or core[0] or title[0])
        share[i] *= DISCOUNT
    return share


def main_text(page: str | None) -> str:
    if not page:
        return ""
    tree = _Tree(page)
    n, share = len(tree.tag), _judge(tree)
    sizes = _Sizes(tree)
    score = [0.0] * n
    for i in range(n):
        if not sizes.own[i]:
            continue
        points = (min(sizes.own[i] / 100, 3) + sizes.commas[i] + 0.25) * (1 - sizes.linked[i] / sizes.own[i]) * share[i]
        own = tree.tag[i] in ("div", "section", "article", "main", "body", "td", "#root")
        up, part = (i if own else tree.parent[i]), 1.0
        while up >= 0 and part >= 0.1:
            score[up] += points * part
            up, part = tree.parent[up], part / 2
    best = max((i for i in range(n) if not tree.marked[i]), key=lambda i: (score[i] * (1 - sizes.density(i)), -i), default=0)
    keep_roots = {best}
    if score[best] > 0:
        up = best
        while up > 0 and tree.tag[up] not in ("article", "main"):
            up = tree.parent[up]
        if up > 0:
            keep_roots = {up}
        elif best > 0:
            limit = max(1.0, 0.2 * score[best])
            for i in range(n):
                if tree.parent[i] == tree.parent[best] and i != best and not tree.marked[i]:
                    good = score[i] * (1 - sizes.density(i)) >= limit
                    plain = tree.tag[i] in ("p", "pre", "blockquote") and sizes.whole[i] and sizes.density(i) < 0.3
                    if good or plain or tree.tag[i] in HEADINGS:
                        keep_roots.add(i)
    else:
        keep_roots = {0}
    keep = [False] * n
    for i in range(n):
        # three links and more, of hardly four words each, with next to nothing between them
        menu = tree.tag[i] in ("ul", "ol", "div", "section", "table", "dl") and sizes.whole_links[i] > 2 and sizes.density(i) > 0.8 and sizes.whole_linked[i] < 25 * sizes.whole_links[i]
        keep[i] = not tree.marked[i] and (i in keep_roots or i > 0 and keep[tree.parent[i]] and not menu)
    return "\n".join(_blocks(tree, keep))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column("html")]
            yield pa.record_batch([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(task, "page_id long, url string, text string, n_chars long")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return extract(table(spark, sf_dir, "pages"))
