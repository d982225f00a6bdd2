"""A TSV scan that cuts plain files into many tasks although quoted fields hold line ends.

Where a split begins, it isn't known whether its first line starts a record or lies inside a quoted field.  A first pass over the
lines finds, for every split, how it would end and how many records it would start in either case; a prefix over a file's splits
then tells how each begins and which number its first record has.  A second pass puts lines together to records.  Records that go
on in the next split come from a third, tiny part: the splits' first and last fragments.  Nothing is shuffled but these
fragments, and rows carry file name and number without a staged copy of the file.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column of lines that don't have the expected fields.
BAD = "__corrupt"
_KEYS = ("path", "at")


def ends_inside(line: str, inside: bool, quote: str = '"', sep: str = "\t") -> bool:
    """Whether a physical line ends within a quoted field, if it begins within one or not.

    A quote opens a field only at its start, a doubled one inside is a character, one elsewhere is a character too.
    """
    at, n = 0, len(line)
    while True:
        if not inside:
            if not line.startswith(quote, at):
                at = line.find(sep, at) + 1
                if not at:
                    return False
                continue
            at += 1
        at = line.find(quote, at)
        while 0 <= at and line.startswith(quote, at + 1):
            at = line.find(quote, at + 2)
        if at < 0:
            return True
        inside = False
        at = line.find(sep, at + 1) + 1
        if not at:
            return False


def file_name(path: Column | str) -> Column:
    """A scan's path or file name as it is in the file system: scans have it percent-encoded, but for plus signs."""
    return F.url_decode(F.replace(F.col(path) if isinstance(path, str) else path, F.lit("+"), F.lit("%2B")))


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))


def _runs(b: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The lines of each split in a batch."""
    path, at = (np.asarray(b.column(c).dictionary_encode().indices) for c in _KEYS)
    cuts = [0, *(np.flatnonzero((path[1:] != path[:-1]) | (at[1:] != at[:-1])) + 1).tolist(), b.num_rows]
    for s, e in zip(cuts, cuts[1:], strict=False):
        if e > s:
            yield (b.column("path")[s].as_py(), b.column("at")[s].as_py()), b.column("value").slice(s, e - s)


def _surveyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, at, and for a start outside and inside a quoted field: whether the split ends inside, and the records it starts."""
    seen: dict[tuple[str, int], list] = {}
    for b in batches:
        for key, lines in _runs(b):
            state = seen.setdefault(key, [False, 0, True, 0])
            filled = pc.not_equal(pc.utf8_rtrim(lines, "\r"), "").to_numpy(zero_copy_only=False)
            quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
            total = np.concatenate([[0], np.cumsum(filled)])
            for case in (0, 2):  # between lines with quotes the state stays
                inside, last = state[case], 0
                for i in quoted:
                    state[case + 1] += 0 if inside else int(total[i + 1] - total[last])
                    inside, last = ends_inside(lines[int(i)].as_py(), inside), int(i) + 1
                state[case + 1] += 0 if inside else int(total[-1] - total[last])
                state[case] = inside
    rows = [(*key, *state) for key, state in seen.items()]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], ["path", "at", "out_end", "out_n", "in_end", "in_n"])


def splits(spark: SparkSession, paths: str | Sequence[str]) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """For every split: whether it begins inside a quoted field, the number of its first record, and the chain of fragments there.

    A row per split comes to the driver, which holds the list of splits anyway.
    """
    found = _lines(spark, paths).mapInArrow(_surveyed, "path string, at long, out_end boolean, out_n long, in_end boolean, in_n long")
    whole = found.groupBy("path", "at").agg(*[F.first(c).alias(c) for c in ("out_end", "out_n", "in_end", "in_n")]).collect()
    out: dict[tuple[str, int], tuple[bool, int, int]] = {}
    for path, own in groupby(sorted(whole, key=lambda r: (r["path"], r["at"])), key=lambda r: r["path"]):
        inside, n, chain = False, 0, -1
        for r in own:
            out[path, r["at"]] = (inside, n, chain)
            n += r["in_n"] if inside else r["out_n"]
            ends = r["in_end"] if inside else r["out_end"]
            if ends and (not inside or r["in_n"]):  # a record that goes on begins in this split
                chain = n - 1
            inside = ends
    return out


def _records(known: dict[tuple[str, int], tuple[bool, int, int]], fragments: bool):
    """Whole records of each split, or the pieces of those that cross splits (``row_no`` of the record, ``at`` to put them in order)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, n, held, first = None, False, 0, [], False

        def rows(found: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
            cols = list(zip(*found, strict=True)) if found else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["path", "at", "row_no", "record"])

        def rest() -> list[tuple[str, int, int, str]]:
            """What is still open at the end of a split: a fragment."""
            return [(key[0], key[1], known[key][2] if first else n - 1, "\n".join(held))] if held and fragments else []

        for b in batches:
            out: list[tuple[str, int, int, str]] = []
            for now, lines in _runs(b):
                if now != key:
                    out += rest()
                    key, held = now, []
                    inside, n, _ = known[key]
                    first = inside  # the open record began in an earlier split
                for line in lines.to_pylist():
                    was = inside
                    if '"' in line:
                        inside = ends_inside(line, inside)
                    if not was:
                        if not line.rstrip("\r"):
                            continue
                        n, held, first = n + 1, [], False
                    held.append(line)
                    if not inside:
                        if first == fragments:
                            out.append((key[0], key[1], known[key][2] if first else n - 1, "\n".join(held).rstrip("\r")))
                        held = []
            if out:
                yield rows(out)
        if key is not None and (left := rest()):
            yield rows(left)

    return task


def scan_tsv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], wanted: Sequence[str] | None = None) -> DataFrame:
    """All-string TSV with a header line, ``source_file`` and ``row_no`` (from 1), and ``__corrupt`` for records without the expected fields.

    Plain files are read by as many tasks as they have splits, compressed ones by one each.
    """
    known = splits(spark, paths)
    kind = "path string, at long, row_no long, record string"
    whole = _lines(spark, paths).mapInArrow(_records(known, False), kind).select("path", "row_no", "record")
    if any(inside for inside, _, _ in known.values()):
        pieces = _lines(spark, paths).mapInArrow(_records(known, True), kind)
        joined = pieces.groupBy("path", "row_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "record"))), lambda x: x["record"]), "\n").alias("record"))
        whole = whole.unionByName(joined.withColumn("record", F.regexp_replace("record", "\r+$", "")))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, BAD)])
    options = {"sep": "\t", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "maxCharsPerColumn": "-1"}
    parsed = whole.filter("row_no > 0").select(F.regexp_replace("path", r"^.*/", "").alias("source_file"), "row_no", F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("r"))
    return parsed.select(*[F.col(f"r.`{c}`") for c in (wanted or columns)], F.col(f"r.{BAD}").alias(BAD), file_name("source_file").alias("source_file"), "row_no")
