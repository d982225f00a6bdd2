"""Duplicates, order, row ids and samples."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage


def keyed_dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the least in all other columns, nulls first.  Nulls in keys are equal."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)).alias(c) for c in rest])).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{c}.{c}").alias(c) for c in rest]).select(df.columns)


def number_rows(df: DataFrame, order: Sequence[str], out: str = "row_id") -> DataFrame:
    """Contiguous ids from 1 in ``order`` (which must tell all rows apart): a range-partitioned sort and one offset per partition."""
    local = stage(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()), "numbered-rows")
    part = F.shiftright("__id", 33)
    sizes = local.groupBy(part.alias("__part")).agg(F.count("*").alias("__k"))
    before = sizes.select("__part", (F.sum("__k").over(Window.orderBy("__part")) - F.col("__k")).alias("__before"))  # a row per partition
    numbered = local.join(F.broadcast(before), part == F.col("__part"))
    return numbered.withColumn(out, F.col("__before") + F.col("__id").bitwiseAND((1 << 33) - 1) + 1).select(*df.columns, out)


def adjacent_flags(df: DataFrame, keys: Sequence[str], row_id: str = "row_id") -> DataFrame:
    """``duplicate``: the row before (by id) has the same keys.  Works per key, so no global order is needed."""
    w = Window.partitionBy(*keys).orderBy(row_id)
    return df.withColumn("duplicate", F.coalesce(F.col(row_id) == F.lag(row_id).over(w) + 1, F.lit(False)))


def split_duplicates(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return flagged.filter("not duplicate").drop("duplicate"), flagged.filter("duplicate").drop("duplicate")


def duplicate_rate(flagged: DataFrame) -> DataFrame:
    """Rows, duplicates and their percentage (null for an empty table)."""
    n = F.count_if("duplicate")
    return flagged.agg(F.count("*").alias("n_rows"), n.alias("n_duplicates"), F.round(F.try_divide(100 * n, F.count("*")), 4).alias("percent"))


def place_rows(df: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``__r`` (from 0) and ``__n``: a row's place in its group and the group's rows.

    Rows are range-partitioned by group and order, so a group with a large part of the rows is cut into pieces; a piece adds what
    the pieces of its group before it hold.
    """
    sort = [*groups, *order]
    local = stage(df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("__id", F.monotonically_increasing_id()), "placed-rows")
    part = F.shiftright("__id", 33)
    pieces = local.groupBy(*groups, part.alias("__part")).agg(F.count("*").alias("__k"), F.min("__id").alias("__low"))
    own = Window.partitionBy(*groups)
    told = pieces.select(*[F.col(g).alias(f"__{g}") for g in groups], "__part", "__low", (F.sum("__k").over(own.orderBy("__part")) - F.col("__k")).alias("__before"), F.sum("__k").over(own).alias("__n"))
    on = part == F.col("__part")
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"__{g}"))
    both = local.join(told, on).withColumn("__r", F.col("__before") + F.col("__id") - F.col("__low"))
    return both.select(*df.columns, "__r", "__n")


def sorted_dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str], malformed: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Unique, duplicate and malformed rows (those with a value in the corrupt-record column)."""
    bad = df.filter(F.col(malformed).isNotNull()) if malformed else df.limit(0)
    good = df.filter(F.col(malformed).isNull()) if malformed else df
    ranked = place_rows(good, keys, order)
    return ranked.filter("__r = 0").drop("__r", "__n"), ranked.filter("__r > 0").drop("__r", "__n"), bad


def limit_by_group(df: DataFrame, groups: Sequence[str], n: int, row_id: str) -> DataFrame:
    """At most n rows per group, in a fixed pseudo-random order of the row id."""
    w = Window.partitionBy(*groups).orderBy(F.md5(F.col(row_id).cast("string")), row_id)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def random_keys(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """n distinct keys in a fixed pseudo-random order."""
    return df.select(key).distinct().orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key).limit(n)


def top_by_count(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), key).limit(n)


def rank_sample(df: DataFrame, groups: Sequence[str], value: str, tie: str, k: int = 10) -> DataFrame:
    """Up to k rows per group at evenly spaced ranks of the value."""
    step = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (F.col("__n") - 1) / max(k - 1, 1)))
    ranked = place_rows(df, groups, [value, tie])
    return ranked.filter(F.array_contains(step, F.col("__r"))).withColumn("rank", F.col("__r")).drop("__r", "__n")


def sort_by(df: DataFrame, *keys: str) -> DataFrame:
    """Total order by several keys, each with an optional "-" for descending; nulls first, or last if descending."""
    return df.orderBy(*[F.col(k[1:]).desc() if k.startswith("-") else F.col(k).asc() for k in keys])


def genomic_sort(df: DataFrame, chromosome: str, position: str) -> DataFrame:
    return df.orderBy(F.col(chromosome).try_cast("int"), F.col(position).cast("long"))


def order_breaks(df: DataFrame, file: str, index: str, row_id: str, in_order: bool = False) -> DataFrame:
    """Rows whose id isn't above the id before them in the same file, and files that start below their predecessor's end.

    One pass compares neighbours inside a partition and keeps the partition's edges; the edges are compared by a second, small
    step.  So a file of any length is many tasks.  ``in_order``: the rows come as they stand in the files (a plain scan), else they
    are range-partitioned by file and index first.
    """
    own = df.select(F.col(file).alias("file"), F.col(index).cast("long").alias("index"), F.col(row_id).cast("long").alias("id"))
    own = own if in_order else own.repartitionByRange("file", "index").sortWithinPartitions("file", "index")
    kind = df.schema[file].dataType.simpleString()
    seen = stage(own.mapInArrow(_neighbours, f"file {kind}, index long, id long, previous long, edge boolean, last long, least long, most long"), "order-edges")
    inside = seen.filter("not edge").select("file", "index", "id", "previous")
    edges = seen.filter("edge")  # a row per partition and file
    joint = edges.withColumn("previous", F.lag("last").over(Window.partitionBy("file").orderBy("index"))).filter("id <= previous").select("file", "index", "id", "previous")
    ends = edges.groupBy("file").agg(F.min("least").alias("low"), F.max("most").alias("high"))  # a row per file
    across = ends.withColumn("previous", F.lag("high").over(Window.orderBy("file"))).filter("low <= previous").select("file", F.lit(-1).cast("long").alias("index"), F.col("low").alias("id"), "previous")
    return inside.unionByName(joint).unionByName(across).toDF(file, index, row_id, "previous")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose id isn't above their neighbour's, and one edge row (first and last row, least and largest id) per run of a file."""
    names = ["file", "index", "id", "previous", "edge", "last", "least", "most"]
    run: dict | None = None

    def closed(run: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([run["file"], *[pa.array([v], pa.int64()) for v in (run["index"], run["id"], None)], pa.array([True]), *[pa.array([run[c]], pa.int64()) for c in ("last", "least", "most")]], names)

    for b in batches:
        codes = np.asarray(b.column("file").dictionary_encode(null_encoding="encode").indices)
        cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts, cuts[1:], strict=False):
            if s == e:
                continue
            part = b.slice(s, e - s)
            ids = part.column("id")
            if run is None or run["file"][0].as_py() != part.column("file")[0].as_py():
                if run is not None:
                    yield closed(run)
                run = {"file": part.column("file").slice(0, 1), "index": part.column("index")[0].as_py(), "id": ids[0].as_py(), "last": None, "least": None, "most": None}
                before = pa.concat_arrays([pa.nulls(1, pa.int64()), ids.slice(0, len(ids) - 1)])
            else:
                before = pa.concat_arrays([pa.array([run["last"]], pa.int64()), ids.slice(0, len(ids) - 1)])
            ends = pc.min_max(ids).as_py()
            run["last"] = ids[len(ids) - 1].as_py()
            run["least"] = min((v for v in (run["least"], ends["min"]) if v is not None), default=None)
            run["most"] = max((v for v in (run["most"], ends["max"]) if v is not None), default=None)
            hit = pc.fill_null(pc.less_equal(ids, before), False)
            k = pc.sum(hit).as_py() or 0
            if k:
                none = pa.nulls(k, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("file").filter(hit), part.column("index").filter(hit), ids.filter(hit), before.filter(hit), pa.array([False] * k), none, none, none], names)
    if run is not None:
        yield closed(run)
