"""Merkle manifest of a table: leaves per row, one tree per source, one tree over the sources, and a proof for every row.

Trees have three children a node.  A superblock is an aligned run of 729 nodes of one tree; ``_tops`` reduces each superblock to
the node six levels up, again and again, until every tree has one node.  Then the outer nodes that a superblock needs come down
the same way: superblocks are cogrouped with the path of their top node, and one call finishes the reduction inside, joins the
two parts of the path and folds.  A group is never more than 729 nodes and one path, whatever a source's share of the rows; a
tier has a 729th of the nodes of the tier below.

Defined cases: a null field is ``-``, so that it differs from an empty one; a null source is a source of its own, before all
others; repeated ids follow each other by leaf digest, a null id comes first; a source of one row has its leaf as its root; a
proof without siblings is the hash of nothing; columns that the table lacks count as null, other columns don't matter; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, table
from .ordered import numbered

ARITY, HEIGHT = 3, 6
#: Nodes of a superblock.
BLOCK = ARITY**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "tree string, pos long, size long, digest binary, label string"
_PATH = "tree string, pos long, label string, path string, subroot string, root string"


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


# ---------------------------------------------------------------------------------------------- leaves
def _field(c: Column) -> Column:
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def leaf(values: dict[str, Column], fields: tuple[str, ...] = FIELDS) -> Column:
    """The digest of a row's fields: each with its length before it, so that no two rows have the same input."""
    return F.unhex(F.sha2(F.concat(*[_field(values[c]) for c in fields]).cast("binary"), 256))


def leaves(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """doc_id, tree, digest and, where ``changed`` (another text) isn't null, the digest with that text as ``other``."""
    values = {c: F.col(c) if c in docs.columns else F.lit(None).cast("string") for c in FIELDS}
    other = F.when(changed.isNotNull(), leaf(values | {"text": changed})) if changed is not None else F.lit(None).cast("binary")
    tree = F.coalesce(F.concat(F.lit("="), values["source"]), F.lit("-"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), leaf(values).alias("digest"), other.alias("other"))


# ---------------------------------------------------------------------------------------------- trees
def _levels(nodes: list[str], size: int) -> list[list[str]]:
    """Nodes of a superblock level by level: up to its tree's root if it is the whole tree, else six levels up."""
    levels = [nodes]
    while len(levels[-1]) > 1 if size <= BLOCK else len(levels) <= HEIGHT:
        low = levels[-1]
        levels.append([digest("".join(low[i : i + ARITY])) for i in range(0, len(low), ARITY)])
    return levels


def _inside(levels: list[list[str]], at: int) -> list[str]:
    """Steps from node ``at`` to the superblock's top: the place among the siblings, and these."""
    steps = []
    for low in levels[:-1]:
        first = at // ARITY * ARITY
        run = low[first : first + ARITY]
        own = at - first
        steps.append(",".join([str(own), *run[:own], *run[own + 1 :]]))
        at //= ARITY
    return steps


def fold(node: str, steps: list[str]) -> str:
    """The root that a node and the steps of its proof lead to."""
    for step in steps:
        own, *others = step.split(",")
        node = digest("".join([*others[: int(own)], node, *others[int(own) :]]))
    return node


def _top(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("pos")
    first, size = int(block["pos"].iloc[0]), int(block["size"].iloc[0])
    top = _levels([d.hex() for d in block["digest"]], size)[-1]
    return pd.DataFrame({"tree": [block["tree"].iloc[0]], "pos": [first // BLOCK], "size": [-(-size // BLOCK)], "digest": [bytes.fromhex(top[0])], "label": [None]})


def tiers(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (tree, pos, size, digest, label), the tops of their superblocks, the tops of these, ... to one node a tree."""
    found, largest = [nodes], nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        block = F.floor(F.col("pos") / BLOCK).alias("block")
        found.append(stage(found[-1].groupBy("tree", block).applyInPandas(_top, _NODE), "merkle-tops"))
        largest = -(-largest // BLOCK)
    return found


def _step(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("pos")
    levels = _levels([d.hex() for d in nodes["digest"]], int(nodes["size"].iloc[0]))
    above = outer["path"].iloc[0]
    paths = ["/".join([*_inside(levels, i), *([above] if above else [])]) for i in range(len(nodes))]
    return pd.DataFrame({"tree": nodes["tree"], "pos": nodes["pos"], "label": nodes["label"], "path": paths, "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0]})


def _by_block(nodes: DataFrame, outer: DataFrame):
    """Superblocks cogrouped with the paths of their tops."""
    left = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).groupBy("tree", "block")
    # new names for its columns: both sides may come from one table
    return left.cogroup(outer.select(F.col("tree").alias("tree"), F.col("pos").alias("block"), "path", "subroot", "root").groupBy("tree", "block"))


def outer_paths(found: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Paths of the tops of the lowest tier's superblocks, from the paths of the trees' roots."""
    for tier in found[-2:0:-1]:
        outer = stage(_by_block(tier, outer).applyInPandas(_step, _PATH), "merkle-paths")
    return outer


# ---------------------------------------------------------------------------------------------- manifest
def _prove(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The last exchange: reduce the superblock, join its rows' paths with the outer one, fold what each row has become."""
    nodes = nodes.sort_values("pos")
    own = [d.hex() for d in nodes["digest"]]
    levels = _levels(own, int(nodes["size"].iloc[0]))
    above = outer["path"].iloc[0].split("/") if outer["path"].iloc[0] else []
    apart = [x for step in above for x in step.split(",")[1:]]
    subroot, root = outer["subroot"].iloc[0], outer["root"].iloc[0]
    known: dict[str, str] = {}
    proofs, folded = [], []
    for i, (was, now) in enumerate(zip(own, nodes["other"], strict=True)):
        steps = _inside(levels, i)
        proofs.append(digest("".join([*(x for step in steps for x in step.split(",")[1:]), *apart])))
        top = fold(was if now is None else now.hex(), steps)
        if top not in known:
            known[top] = fold(top, above)
        folded.append(known[top])
    ids = nodes["doc_id"].astype("Int64").mask(nodes["no_id"])
    return pd.DataFrame({"doc_id": ids, "leaf": own, "subroot": subroot, "root": root, "proof_sha256": proofs, "folded_root": folded, "verified": [x == root for x in folded]})


MANIFEST = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """Every row's leaf, subroot, root and proof, and whether the row still leads to the root.

    ``changed``: another text for the rows whose proof is to be checked against it (null: the row as it is).
    """
    ranked, _ = numbered(stage(leaves(docs, changed), "merkle-leaves"), "tree", ["doc_id", "digest"], name="merkle-ranked")
    rows = stage(ranked.select("tree", F.col("rank").alias("pos"), F.col("rank_size").alias("size"), "digest", F.lit(None).cast("string").alias("label"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "other"), "merkle-nodes")
    low = tiers(rows.select("tree", "pos", "size", "digest", "label"))
    subroots = low[-1].select(F.lit("").alias("tree"), F.col("tree").alias("label"), "digest")
    ordered, _ = numbered(subroots, "tree", ["label"], name="merkle-subroots")
    high = tiers(ordered.select("tree", F.col("rank").alias("pos"), F.col("rank_size").alias("size"), "digest", "label"))
    top = high[-1].select("tree", "pos", F.lit(None).cast("string").alias("label"), F.lit("").alias("path"), F.lit("").alias("subroot"), F.hex("digest").alias("root"))
    over = _by_block(high[0], outer_paths(high, top.withColumn("root", F.lower("root")))).applyInPandas(_step, _PATH)
    roots = low[-1].select("tree", F.lower(F.hex("digest")).alias("subroot"))
    below = stage(over.select(F.col("label").alias("tree"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("label"), "path", "root").join(roots, "tree").select("tree", "pos", "label", "path", "subroot", "root"), "merkle-sources")
    return _by_block(rows, outer_paths(low, below)).applyInPandas(_prove, MANIFEST)


def tampered(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The contract's tampering: line ends leave the text of every document whose id's crc32 is even."""
    return F.when((F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0) & F.contains(text, F.lit("\n")), F.translate(text, "\n", ""))


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """The manifest of all documents, with every second document checked after its line ends are gone."""
    return manifest(table(spark, sf_dir, "documents"), tampered())


def merkle_sql(levels: int = 15) -> str:
    """The same in SQL: one step per level, for up to ``3 ** levels`` documents a source and sources."""
    def part(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"

    def tree(name: str, start: str, key: str) -> str:
        """Levels of trees (key, pos, size, d), and each lowest node's ``p`` (pos), ``sibs`` and folded ``cur``."""
        out = [f"{name}0 AS MATERIALIZED ({start})"]
        for k in range(levels):
            low = f"{name}{k}"
            out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT {key}, pos // 3 AS pos, (any_value(size) + 2) // 3 AS size, CASE WHEN any_value(size) > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE any_value(d) END AS d FROM {low} GROUP BY {key}, pos // 3)")
        return ",\n ".join(out)

    def climb(name: str, nodes: str, key: str, start: str, keep: str) -> str:
        out = [f"{name}0 AS MATERIALIZED ({start})"]
        for k in range(levels):
            sides = f"SELECT x.row, string_agg(y.d, '' ORDER BY y.pos) FILTER (y.pos < x.p) AS l, string_agg(y.d, '' ORDER BY y.pos) FILTER (y.pos > x.p) AS r, any_value(y.size) AS size FROM {name}{k} x JOIN {nodes}{k} y ON x.{key} = y.{key} AND x.p // 3 = y.pos // 3 GROUP BY x.row"
            out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT row, {key}, p // 3 AS p, {keep}, CASE WHEN size > 1 THEN sibs || coalesce(l, '') || coalesce(r, '') ELSE sibs END AS sibs, CASE WHEN size > 1 THEN sha256(coalesce(l, '') || cur || coalesce(r, '')) ELSE cur END AS cur FROM {name}{k} JOIN ({sides}) s USING (row))")
        return ",\n ".join(out)

    crc_low = "xor(list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT), lambda c, b: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295::BIGINT), 4294967295) % 2"
    fields = [part(c) for c in FIELDS]
    changed = [*fields[:4], part("replace(text, chr(10), '')")]
    return f"""WITH a AS (SELECT doc_id, coalesce('=' || source, '-') AS tree, sha256({" || ".join(fields)}) AS leaf, CASE WHEN {crc_low} = 0 THEN sha256({" || ".join(changed)}) ELSE sha256({" || ".join(fields)}) END AS other FROM documents),
 n AS MATERIALIZED (SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS size FROM a),
 {tree("t", "SELECT tree, pos, size, leaf AS d FROM n", "tree")},
 {tree("s", f"SELECT 0 AS g, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS size, d, tree FROM t{levels}", "g")},
 {climb("c", "t", "tree", "SELECT row, tree, pos AS p, doc_id, leaf, '' AS sibs, other AS cur FROM n", "doc_id, leaf")},
 {climb("e", "s", "g", f"SELECT row, 0 AS g, s0.pos AS p, doc_id, leaf, s0.d AS subroot, sibs, cur FROM c{levels} JOIN s0 USING (tree)", "doc_id, leaf, subroot")}
 SELECT doc_id, leaf, subroot, s{levels}.d AS root, sha256(sibs) AS proof_sha256, cur AS folded_root, cur = s{levels}.d AS verified FROM e{levels}, s{levels}"""
