"""Exact quantiles of groups of any size.

Groups up to ``HOT`` rows use Spark's exact percentile, whose buffer is then bounded.  A larger group is narrowed first: a mergeable
sketch gives pivots, rows are counted by the cell between two pivots, and only the cells that hold a wanted rank go on, as groups of
their own, until they are small or hold one value.  So no task ever holds the values of a hot group, and what is shuffled of
it are counts and the rows of a few cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage

#: Rows of a group from which it is narrowed, and pivots of a round.
HOT, PIVOTS = 1_000_000, 64


def group_quantiles(df: DataFrame, keys: Sequence[str], cuts: Sequence[float], value: str = "value", hot: int = HOT) -> DataFrame:
    """keys, n, quantiles: for every group with a value its number of values and the quantiles at ``cuts``, linearly interpolated."""
    rows = df.select(*keys, F.col(value).cast("double").alias("__v")).filter("__v is not null")
    at = F.array(*[F.lit(float(c)) for c in cuts])

    def plain(part: DataFrame) -> DataFrame:
        return part.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile("__v", at).alias("quantiles"))

    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > hot)
    large = stage(sizes, "hot-groups")
    if large.isEmpty():
        return plain(rows)
    names = large.select(*[F.col(k).alias(f"__{k}") for k in keys], "n")
    same = _same(keys)
    cold = plain(rows.join(names, same, "left_anti"))
    position = F.col("__cut") * (F.col("n") - 1)
    wanted = large.withColumn("__cut", F.explode(at)).select(*keys, "n", "__cut", F.floor(position).alias("__low"), F.ceil(position).alias("__high"), position.alias("__at"))
    ranks = wanted.select(*keys, F.explode(F.array("__low", "__high")).alias("rank")).distinct()
    found = stage(select_ranks(rows.join(names.drop("n"), same, "left_semi"), keys, stage(ranks, "wanted-ranks"), "__v", hot), "rank-values")
    ends = [found.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("rank").alias("__r"), F.col("value").alias(v)) for v in ("__a", "__b")]
    both = wanted.join(ends[0], _same(keys) & (F.col("__low") == F.col("__r"))).drop("__r", *[f"__{k}" for k in keys])
    both = both.join(ends[1], _same(keys) & (F.col("__high") == F.col("__r")))
    exact = F.when(F.col("__low") == F.col("__high"), F.col("__a")).otherwise((F.col("__high") - F.col("__at")) * F.col("__a") + (F.col("__at") - F.col("__low")) * F.col("__b"))
    each = both.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_set(F.struct("__cut", exact))).alias("__m"))
    return cold.unionByName(each.select(*keys, "n", F.transform(at, lambda c: F.col("__m")[c]).alias("quantiles")))


def _same(keys: Sequence[str], prefix: str = "__") -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(prefix + k))
    return on


def select_ranks(rows: DataFrame, keys: Sequence[str], ranks: DataFrame, value: str, hot: int = HOT) -> DataFrame:
    """keys, rank, value: the value at each rank (from 0) of ``ranks`` (keys, rank) among a group's sorted values.

    Rounds of counting: each leaves about a ``PIVOTS``-th of the rows of every cell that is still too large.
    """
    held = [f"__k{i}" for i in range(len(keys))]
    data = rows.select(*[F.col(k).alias(h) for k, h in zip(keys, held, strict=True)], F.col(value).alias("v"))
    want = ranks.select(*[F.col(k).alias(h) for k, h in zip(keys, held, strict=True)], "rank", F.col("rank").alias("__first"))
    own, done, at = list(held), [], 0
    while True:
        # pivots of every group, from a sketch of bounded size; the least value, so that a round always parts something
        cuts = data.groupBy(*own).agg(F.array_union(F.array(F.min("v")), F.percentile_approx("v", F.array(*[F.lit(i / PIVOTS) for i in range(1, PIVOTS)]), F.lit(16 * PIVOTS))).alias("__cuts"))
        cuts = stage(cuts.select(*[F.col(k).alias(f"__{k}") for k in own], F.array_sort("__cuts").alias("__cuts")), "pivots")
        cell = f"__c{at}"
        part = data.join(cuts, _same(own)).withColumn(cell, F.aggregate("__cuts", F.lit(0), lambda n, c: n + F.when(c < F.col("v"), 1).otherwise(0))).select(*own, "v", cell)
        sizes = part.groupBy(*own, cell).agg(F.count("*").alias("__n"), F.min("v").alias("__min"), F.max("v").alias("__max"))
        upto = Window.partitionBy(*own).orderBy(cell).rowsBetween(Window.unboundedPreceding, 0)
        sizes = sizes.withColumn("__to", F.sum("__n").over(upto))  # at most PIVOTS + 1 rows a group
        sizes = sizes.select(*[F.col(k).alias(f"__{k}") for k in own], cell, "__n", "__min", "__max", "__to")
        hit = want.join(sizes, _same(own) & (F.col("rank") >= F.col("__to") - F.col("__n")) & (F.col("rank") < F.col("__to")))
        hit = stage(hit.select(*own, cell, "__first", (F.col("rank") - F.col("__to") + F.col("__n")).alias("rank"), "__n", "__min", "__max"), "rank-cells")
        one = F.col("__min") == F.col("__max")
        done.append(hit.filter(one).select(*held, "__first", F.col("__min").alias("value")))
        own = [*own, cell]
        left = hit.filter(~one)
        want = left.select(*own, "rank", "__first")
        cells = left.select(*[F.col(k).alias(f"__{k}") for k in own]).distinct()
        data = part.join(cells, _same(own), "left_semi")
        most = left.agg(F.max("__n")).first()[0] or 0
        if most <= hot:
            break
        data, at = stage(data, "cell-rows"), at + 1
    if most:
        counts = data.groupBy(*own, "v").agg(F.count("*").alias("__n"))
        upto = Window.partitionBy(*own).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        last = counts.withColumn("__to", F.sum("__n").over(upto)).select(*[F.col(k).alias(f"__{k}") for k in own], "v", "__n", "__to")  # within one small cell
        done.append(want.join(last, _same(own) & (F.col("rank") >= F.col("__to") - F.col("__n")) & (F.col("rank") < F.col("__to"))).select(*held, "__first", F.col("v").alias("value")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*[F.col(h).alias(k) for k, h in zip(keys, held, strict=True)], F.col("__first").alias("rank"), "value")
