"""Quality rules with adaptive thresholds.

One pass over the text gives each document's counts.  Each metric is put on a fixed grid (2 % steps of a logarithmic
scale, so at most a few thousand cells at any input size) and the quartiles of each (language, source) are taken
from the cells' counts.  Those counts merge by addition in Spark's partial aggregation, so a source that holds a third
of all rows costs a few thousand cells per task.  A group with fewer than ``MIN_GROUP`` documents borrows its
language's quartiles, a language with fewer those of all documents.  A document fails a rule when its metric lies
more than ``FENCE`` spreads outside the quartiles of its group (the spread has a floor, so that a group
without variation does not reject small deviations).

Defined cases: null text has no words and fails the base rule; null languages and sources form groups of their own;
repeated rows are judged each on their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .common import stage

MIN_GROUP, FENCE, STEP = 200, 3.0, 1.02
#: metric: (smallest spread, judged below the quartiles too)
METRICS = {"word_length": (0.7, True), "symbol_share": (0.01, False), "dup_line_share": (0.1, False), "repeat_share": (0.08, False), "upper_share": (0.04, False)}
#: More thresholds than this aren't broadcast but joined on salted keys.
BROADCAST_GROUPS = 100_000
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper"]


def _per_doc(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(mask, dtype=np.int64)]
    return total[offsets[1:]] - total[offsets[:-1]]


def count(batch: tb.Batch) -> dict[str, np.ndarray]:
    data, n = batch.data, len(batch)
    starts, ends, first = tb.words(batch)
    hashes = tb.word_hashes(data, starts, ends)
    spaces = tb.SPACES[data]
    out = {"n_words": np.diff(first), "word_chars": _per_doc(~spaces & ((data & 0xC0) != 0x80), batch.offsets), "n_symbols": _per_doc(_SYMBOLS[data], batch.offsets), "n_upper": _per_doc(_UPPER[data], batch.offsets)}
    # lines: maximal runs without \n that hold a word
    newline = np.zeros(256, bool)
    newline[10] = True
    a, b, line_first = tb.words(batch, newline)
    words_before = np.r_[0, np.cumsum(~spaces)]
    full = words_before[b] > words_before[a]
    doc = np.repeat(np.arange(n), np.diff(line_first))[full]
    a, b = a[full], b[full]
    key = tb.mix(tb.word_hashes(data, a, b) + tb.mix(doc.astype(np.uint64) + np.uint64(1)))
    distinct = np.unique(key, return_index=True)[1]
    lines = np.bincount(doc, minlength=n)
    out["n_lines"], out["n_dup_lines"] = lines, lines - np.bincount(doc[distinct], minlength=n)
    # words inside 8-word windows that the same text has twice
    ok = np.flatnonzero(tb.within(first, 8))
    owner = np.searchsorted(first, ok, side="right") - 1
    windows = tb.mix(tb.rolling(hashes, 8)[ok] + tb.mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    again = ok[order[np.r_[False, same] | np.r_[same, False]]] if len(ok) else ok
    out["n_repeat_words"] = _per_doc(tb.covered(again, 8, len(starts)), first)
    return out


def features(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and ``COUNTS`` of each document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.joined(batches, "text", tb.BATCH_BYTES):
            got = count(tb.Batch.of(batch.column("text")))
            yield pa.record_batch([batch.column(c) for c in ("doc_id", "lang", "source")] + [pa.array(got[c].astype(np.int64)) for c in COUNTS], ["doc_id", "lang", "source", *COUNTS])

    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", "lang", "source", "text").mapInArrow(task, schema)


def _metrics() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    return {"word_length": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words"), "upper_share": share("n_upper", "word_chars")}


def _cell(value: Column) -> Column:
    """Grid cell of a non-negative value: 0 for values up to 1e-4, then one cell per 2 %."""
    return F.when(value <= 1e-4, F.lit(0)).otherwise(F.ceil(F.log(value / 1e-4) / np.log(STEP))).cast("int")


def _value(cell: Column) -> Column:
    return F.when(cell <= 0, F.lit(0.0)).otherwise(F.lit(1e-4) * F.pow(F.lit(STEP), cell))


def thresholds(measured: DataFrame) -> DataFrame:
    """lang, source, and low_<metric>, high_<metric> of each group."""
    cells = measured.select("lang", "source", *[_cell(F.col(m)).alias(m) for m in METRICS])
    levels = cells.rollup("lang", "source").agg(F.grouping_id().alias("level"), F.count("*").alias("n"), *[F.percentile(m, F.array(F.lit(0.25), F.lit(0.75))).alias(m) for m in METRICS])
    levels = stage(levels, "quality-levels")
    own = levels.filter("level = 0")
    by_lang = levels.filter("level = 1").select(F.col("lang").alias("l"), F.col("n").alias("n1"), *[F.col(m).alias(f"{m}1") for m in METRICS])
    total = levels.filter("level = 3").select(*[F.col(m).alias(f"{m}3") for m in METRICS])
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l"))).crossJoin(F.broadcast(total))  # one row
    out = [F.col("lang").alias("t_lang"), F.col("source").alias("t_source")]
    for m, (floor, both) in METRICS.items():
        q = F.when(F.col("n") >= MIN_GROUP, F.col(m)).when(F.col("n1") >= MIN_GROUP, F.col(f"{m}1")).otherwise(F.col(f"{m}3"))
        low, high = _value(q[0]), _value(q[1])
        spread = F.greatest(high - low, F.lit(floor))
        out += [(high + FENCE * spread).alias(f"high_{m}"), (low - FENCE * spread if both else F.lit(-1.0)).alias(f"low_{m}")]
    return joined.select(*out)


def judge(docs: DataFrame) -> DataFrame:
    """All counts and metrics, the group's thresholds, base_failed, failed_rules and kept, one row per document."""
    measured = stage(features(docs).withColumns(_metrics()), "quality-features")
    limits = thresholds(measured)
    groups = limits.count()
    on = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    if groups <= BROADCAST_GROUPS:
        both = measured.join(F.broadcast(limits), on, "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(31))).alias("t_salt")
        salted = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id", *COUNTS), F.lit(32)).cast("int"))
        both = salted.join(limits.select("*", salts), on & (F.col("salt") == F.col("t_salt")), "left")
    failed = F.filter(F.array(*[F.when((F.col(m) > F.col(f"high_{m}")) | (F.col(m) < F.col(f"low_{m}")), F.lit(m)) for m in METRICS]), lambda x: x.isNotNull())
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return both.withColumn("base_failed", base).withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")
