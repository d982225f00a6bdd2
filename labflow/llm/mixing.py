"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source's documents stand in an order of hashes, as one stream of words that is cut into equal blocks.  A schedule has a
slot for every block that the mix takes: slot i looks at the golden-ratio point i * phi mod 1, and the cumulated weights of the
sources say whose slot that is.  So any stretch of the schedule holds every source in its share.  A source's slots are ranked;
slot r takes the block that is r-th in the source's shuffled blocks, of its second pass once the first is used up.

The points give a source a few slots more or less than its due: surplus slots stay empty and missing ones follow at the end.  A
source's last slot takes as much of its block as is still due, so a source's taken words are its target rounded.

Scale.  Streams, ranks and shuffles are range-partitioned (``ordered.numbered``), so a hot source is cut into pieces.  Slots and
blocks find their source by equal stretches of the cumulated weights, not by source.  Targets come from one row per source.

Defined cases: null and empty texts have no words and nothing is taken of them; a null source is a source of its own, the last;
repeated rows are places of their own; an empty table gives an empty result, one without words targets of 0; other columns don't
matter.  Orders are made from MD5 hashes of ids, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, table
from .ordered import numbered

#: The golden ratio's inverse as a fraction of 2 ** 31 (odd, so that a full period visits every point once).
STEP, GRID = 1_327_217_885, 1 << 31
#: Words of a block at most; a small source's blocks have a thousandth of its target.
BLOCK_WORDS, BLOCKS = 4096, 1024
#: Stretches that cumulated weights are cut into to find a point's source.
STRETCHES = 4096
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.coalesce(F.length(F.translate(F.regexp_replace(text, "[^ \\x09-\\x0D]+", "x"), " \t\n\x0b\x0c\r", "")).cast("long"), F.lit(0).cast("long"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = 150, times: int = 2) -> DataFrame:
    """One row per source (``tree``): its words, target, and the blocks and slots that follow.

    Sources that reach ``times`` their size are those with the least size per weight: with the sources in that order, the level
    is what is left for the first source that stays below its limit.
    """
    own = sized.groupBy("tree").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy("tree")) - 1  # a row per source, here and below
    weighed = own.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")).cast("long"))
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), "tree")
    level = weighed.withColumns({
        "__all": F.sum("source_size").over(Window.partitionBy()),
        "__full": times * (F.sum("source_size").over(by_limit.rowsBetween(Window.unboundedPreceding, 0)) - F.col("source_size")),
        "__rest": F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)),
    })
    due = percent * F.col("__all") - 100 * F.col("__full")  # hundredths of words for those that are left
    open_ = due * F.col("weight") <= 100 * times * F.col("source_size") * F.col("__rest")
    ranked = level.withColumn("__n", F.row_number().over(by_limit)).withColumn("__open", F.when(open_, F.struct(F.col("__n").alias("n"), due.alias("due"), F.col("__rest").alias("rest")))).withColumn("__first", F.min("__open").over(Window.partitionBy()))
    share = F.col("weight") * F.col("__first.due") / (100 * F.col("__first.rest"))
    target = F.when(F.col("__n") >= F.col("__first.n"), share).otherwise((times * F.col("source_size")).cast("double"))
    out = ranked.withColumn("target", F.when(F.col("__all") > 0, target).otherwise(F.lit(0.0)))
    out = out.withColumns({"due": F.floor(F.col("target") + 0.5), "words": F.least(F.lit(BLOCK_WORDS), F.greatest(F.lit(1), F.floor(F.col("target") / BLOCKS))).cast("long")})
    out = out.withColumn("blocks", F.ceil(F.col("source_size") / F.col("words")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("due") / F.greatest("source_size", F.lit(1)))).otherwise(F.lit(0)).cast("long")
    out = out.withColumn("passes", passes).withColumn("left", F.col("due") - F.col("passes") * F.col("source_size"))
    out = out.withColumns({"slots": F.col("passes") * F.col("blocks") + F.ceil(F.col("left") / F.col("words")), "laps": F.col("passes") + (F.col("left") > 0).cast("long")})
    upto = Window.orderBy("tree").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({"slots_to": F.sum("slots").over(upto), "laid": F.col("blocks") * F.col("laps"), "laid_to": F.sum(F.col("blocks") * F.col("laps")).over(upto)})
    return stage(out.select("tree", "source_size", "weight", "target", "due", "words", "blocks", "passes", "left", "laps", "slots", (F.col("slots_to") - F.col("slots")).alias("slots_from"), "slots_to", (F.col("laid_to") - F.col("laid")).alias("laid_from"), "laid_to"), "mix-sources")


def _whose(points: DataFrame, x: str, total: int, sources: DataFrame, low: str, high: str) -> DataFrame:
    """``points`` beside the source whose stretch [low, high) of the cumulated weights holds ``x``.

    Stretches are cut at ``STRETCHES`` equal marks, so a hot source's points are found in many places.
    """
    wide = max(1, -(-total // STRETCHES))
    cut = sources.filter(F.col(high) > F.col(low)).withColumn("__mark", F.explode(F.sequence(F.floor(F.col(low) / wide), F.floor((F.col(high) - 1) / wide))))
    both = points.withColumn("__at", F.floor(F.col(x) / wide)).join(cut, F.col("__at") == F.col("__mark"))
    return both.filter((F.col(x) >= F.col(low)) & (F.col(x) < F.col(high))).drop("__mark", "__at")


def schedule(sources: DataFrame) -> DataFrame:
    """tree, slot, rank, lap, turn, part: the filled slots, in a source's order, and the words that each takes of its block."""
    spark = sources.sparkSession
    total = sources.agg(F.max("slots_to")).first()[0] or 0
    point = F.floor((F.col("id") % GRID * STEP % GRID).cast("double") * total / GRID).alias("x")
    slots = _whose(spark.range(total).select(F.col("id").alias("slot"), point), "x", total, sources.select("tree", "slots_from", "slots_to"), "slots_from", "slots_to")
    ranked, _ = numbered(slots.select("tree", "slot"), "tree", ["slot"], name="mix-slots")
    ranked = ranked.select("tree", "slot", "rank")
    got = ranked.groupBy("tree").agg(F.count("*").alias("__got"))
    late = sources.join(got, "tree", "left").filter(F.col("slots") > F.coalesce("__got", F.lit(0)))
    late = late.select("tree", F.explode(F.sequence(F.coalesce("__got", F.lit(0)).cast("long"), F.col("slots") - 1)).alias("rank"), F.lit(total).cast("long").alias("slot"))
    known = sources.select("tree", "words", "blocks", "passes", "left", "slots")
    filled = ranked.unionByName(late.select("tree", "slot", "rank")).join(known, "tree").filter(F.col("rank") < F.col("slots"))
    lap = F.floor(F.col("rank") / F.col("blocks"))
    filled = filled.withColumns({"lap": lap, "turn": F.col("rank") - lap * F.col("blocks")})
    part = F.when(F.col("lap") == F.col("passes"), F.least("words", F.col("left") - F.col("turn") * F.col("words"))).otherwise(F.col("words"))
    return filled.select("tree", "slot", "rank", "lap", "turn", part.alias("part"))


def shuffled_blocks(sources: DataFrame) -> DataFrame:
    """tree, lap, turn, block: every source's blocks in an order of their own for each pass; the short last block is last."""
    total = sources.agg(F.max("laid_to")).first()[0] or 0
    laid = _whose(sources.sparkSession.range(total).withColumnRenamed("id", "x"), "x", total, sources.select("tree", "blocks", "laid_from", "laid_to"), "laid_from", "laid_to")
    at = F.col("x") - F.col("laid_from")
    each = laid.select("tree", F.floor(at / F.col("blocks")).alias("lap"), (at % F.col("blocks")).alias("block"), "blocks")
    key = F.md5(F.concat_ws(":", "tree", F.col("lap").cast("string"), F.col("block").cast("string")))
    each = each.select(F.concat_ws(":", F.col("lap").cast("string"), "tree").alias("deck"), "tree", "lap", "block", (F.col("block") == F.col("blocks") - 1).alias("last"), key.alias("key"))
    dealt, _ = numbered(each, "deck", ["last", "key"], name="mix-blocks")
    return dealt.select("tree", "lap", F.col("rank").alias("turn"), "block")


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, tree, size, rank, start: every document's place in its source's stream of words."""
    tree = F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1"))
    sized = stage(docs.select("doc_id", tree.alias("tree"), F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("")).alias("key"), word_count(F.col("text")).alias("size")), "mix-sizes")
    found, _ = numbered(sized, "tree", ["key", "doc_id", "size"], weight="size", name="mix-streams")
    return found.select("doc_id", "tree", "size", "rank", "start")


def takes(where: DataFrame, sources: DataFrame) -> DataFrame:
    """tree, rank, slot, from_word, taken: what each slot takes of each document, from its ``from_word``-th word on."""
    drawn = schedule(sources).join(shuffled_blocks(sources), ["tree", "lap", "turn"]).join(sources.select("tree", "words"), "tree")
    drawn = stage(drawn.select("tree", "slot", "block", (F.col("block") * F.col("words")).alias("low"), "part"), "mix-drawn")
    held = where.filter("size > 0").join(sources.select("tree", "words"), "tree")
    touched = held.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / F.col("words")), F.floor((F.col("start") + F.col("size") - 1) / F.col("words")))))
    both = touched.select("tree", "rank", "start", "size", "block").join(drawn, ["tree", "block"])
    first, end = F.greatest("start", "low"), F.least(F.col("start") + F.col("size"), F.col("low") + F.col("part"))
    return both.select("tree", "rank", "slot", (first - F.col("start")).alias("from_word"), (end - first).alias("taken")).filter("taken > 0")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: how many words of every document the mix takes, repeats counted."""
    where = stage(placed(docs), "mix-places")
    sources = targets(where)
    total = takes(where, sources).groupBy("tree", "rank").agg(F.sum("taken").alias("taken"))
    both = where.join(sources.select("tree", "source_size", "target"), "tree").join(total, ["tree", "rank"], "left")
    return both.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op12_source_mix(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents: 150 % of their words, no source more than twice."""
    return mix(table(spark, sf_dir, "documents"))


SQL = f"""WITH a AS (SELECT doc_id, coalesce('0' || source, '1') AS tree, coalesce(md5(doc_id::VARCHAR), '') AS key, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> ''))::BIGINT AS size FROM documents),
 w AS MATERIALIZED (SELECT *, row_number() OVER o - 1 AS rank, (sum(size) OVER o - size)::BIGINT AS start FROM a WINDOW o AS (PARTITION BY tree ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING)),
 b AS (SELECT *, list_element([5, 2, 1], ((row_number() OVER (ORDER BY tree) - 1) % 3 + 1)::INT)::BIGINT AS weight FROM (SELECT tree, sum(size)::BIGINT AS source_size FROM a GROUP BY 1)),
 c AS (SELECT *, row_number() OVER r AS n, (sum(source_size) OVER ())::BIGINT AS total, (2 * (sum(source_size) OVER r - source_size))::BIGINT AS full_, (sum(weight) OVER (ORDER BY source_size / weight, tree ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest FROM b WINDOW r AS (ORDER BY source_size / weight, tree ROWS UNBOUNDED PRECEDING)),
 f AS (SELECT n, 150 * total - 100 * full_ AS due, rest FROM c WHERE (150 * total - 100 * full_) * weight <= 200 * source_size * rest ORDER BY n LIMIT 1),
 g AS (SELECT tree, source_size, CASE WHEN total = 0 THEN 0.0 WHEN c.n >= f.n THEN weight * f.due / (100 * f.rest) ELSE (2 * source_size)::DOUBLE END AS target FROM c, f),
 h AS (SELECT *, floor(target + 0.5)::BIGINT AS due, least({BLOCK_WORDS}, greatest(1, floor(target / {BLOCKS})))::BIGINT AS words FROM g),
 i AS (SELECT *, (source_size + words - 1) // words AS blocks, due // greatest(source_size, 1) AS passes, due % greatest(source_size, 1) AS rest FROM h),
 s AS MATERIALIZED (SELECT *, passes * blocks + (rest + words - 1) // words AS slots, (sum(passes * blocks + (rest + words - 1) // words) OVER (ORDER BY tree))::BIGINT AS upto, (sum(passes * blocks + (rest + words - 1) // words) OVER ())::BIGINT AS m FROM i),
 p AS (SELECT id AS slot, floor((id % {GRID} * {STEP} % {GRID})::DOUBLE * m / {GRID})::BIGINT AS x FROM (SELECT unnest(range(max(m))) AS id, max(m) AS m FROM s)),
 q AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY slot) - 1 AS rank FROM p JOIN s ON x >= upto - slots AND x < upto),
 y AS (SELECT tree, rank FROM q UNION SELECT tree, unnest(range(slots)) FROM s), z AS (SELECT s.*, rank, rank // blocks AS lap, rank % blocks AS turn FROM y JOIN s USING (tree) WHERE rank < slots),
 k AS (SELECT tree, lap, block, row_number() OVER (PARTITION BY tree, lap ORDER BY block = blocks - 1, md5(tree || ':' || lap || ':' || block)) - 1 AS turn FROM (SELECT tree, blocks, lap, unnest(range(blocks)) AS block FROM (SELECT *, unnest(range(passes + (rest > 0)::INT)) AS lap FROM s))),
 u AS (SELECT tree, block * words AS low, CASE WHEN lap = passes THEN least(words, rest - turn * words) ELSE words END AS part FROM z JOIN k USING (tree, lap, turn)),
 v AS (SELECT w.tree, w.rank, sum(least(start + size, low + part) - greatest(start, low)) AS taken FROM w JOIN u ON w.tree = u.tree AND low < start + size AND low + part > start GROUP BY 1, 2)
 SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM w JOIN s USING (tree) LEFT JOIN v USING (tree, rank)"""
