"""Ranks and running sums of rows within groups of any size.

Rows are range-partitioned by group and order, so a group with a large part of all rows is cut into pieces.  A task numbers
its own rows; what the pieces before it hold comes from one small table with a row per piece and group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import runs, stage


def numbered(df: DataFrame, group: str, order: Sequence[str], weight: str | None = None, name: str = "ordered") -> tuple[DataFrame, DataFrame]:
    """``df`` with ``rank`` (from 0 in its group) and ``rank_size`` (its group's rows), and the staged table that it reads.

    With a ``weight`` (long, no nulls) also ``start`` (the weights before the row) and ``start_sum`` (its group's weights).
    ``group`` is a string column without nulls; rows that ``order`` can't tell apart are in any order.
    """
    held = [weight] if weight else []

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, rows, total = TaskContext.get().partitionId(), None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            codes = np.asarray(b.column(group).dictionary_encode().indices)
            start, length = runs(codes)
            if b.column(group)[0].as_py() != last:
                rows, total = 0, 0
            rank = np.arange(b.num_rows) - np.repeat(start, length)
            rank[: length[0]] += rows
            rows, last = int(rank[-1]) + 1, b.column(group)[b.num_rows - 1].as_py()
            more = [pa.array(np.full(b.num_rows, part, np.int32)), pa.array(rank)]
            if weight:
                w = np.asarray(b.column(weight)).astype(np.int64)
                before = np.cumsum(w) - w
                before -= np.repeat(before[start], length)
                before[: length[0]] += total
                total = int(before[-1] + w[-1])
                more.append(pa.array(before))
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, "__part", "rank", *(["start"] if weight else [])])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", __part int, rank long" + ", start long" * bool(weight)
    placed = stage(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).mapInArrow(task, schema), name)
    pieces = placed.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__piece")).agg(F.count("*").alias("__rows"), *[F.sum(c).alias("__sum") for c in held])
    own = Window.partitionBy("__group")
    before = own.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = [("__rows", "rank")] + [("__sum", "start")] * bool(weight)
    told = pieces.select("__group", "__piece", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__{to}") for c, to in sums], *[F.sum(c).over(own).alias("rank_size" if to == "rank" else "start_sum") for c, to in sums])
    both = placed.join(stage(told, f"{name}-pieces"), (F.col(group) == F.col("__group")) & (F.col("__part") == F.col("__piece")))
    return both.withColumns({to: F.col(to) + F.col(f"__{to}") for _, to in sums}).drop("__group", "__piece", "__part", *[f"__{to}" for _, to in sums]), placed
