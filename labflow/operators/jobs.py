"""The two batch jobs as chains of operators: raw rows to harmonised rows, and harmonised rows to quality-controlled ones.

A job reads its input once.  It flags rows instead of filtering them, gathers in each row what its logs will say, and writes rows
and notes together to the shared folder; good rows and every log are then reads of that one table, and the row account is
observed while it is written.  Every dropped row is in ``errors``, every change that deserves a look in ``warnings``, ``units`` or
``names``.  Dictionaries are reduced to a row per key before they are joined, so none can multiply rows; ``clashes`` tells which keys had
several.  Missing values are nulls; "NA" is for text sinks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.readers import NOTE, clashes, left_dimension, log_of, lookup, note, notes
from ..sources.staging import sized, stage
from . import clean, extract, harmonise, qc

#: Columns that the munge job needs; any others are carried along.
RAW = ("row_id", "person", "day", "time", "status", "national_code", "local_code", "name", "coding_system", "value", "unit", "outcome", "text")
#: Columns that keep their white space.
FREE = ("text",)
#: Columns that say what was measured.  They take few combinations beside the number of rows.
DESCRIBED = ("national_code", "local_code", "name", "coding_system", "provider", "unit")


@dataclass
class Dictionaries:
    """What the munge job looks up.  Pairs are (from, to)."""

    names: DataFrame  # national code to test name
    systems: DataFrame  # organisation id to coding system
    organisations: DataFrame  # coding system's organisation to name
    units: DataFrame  # unit to unit
    approved: DataFrame  # unit
    fixes: DataFrame  # test, unit, fix
    mapping: DataFrame  # test, unit, concept, quantity, status
    conversions: DataFrame  # quantity, source_unit, target_unit, conversion, only_concept
    targets: DataFrame  # concept, quantity, target_unit


@dataclass
class CoreTables:
    """What the core job looks up."""

    targets: DataFrame  # concept, target_unit
    posneg: DataFrame  # text, flag
    plus: DataFrame  # text, concept, flag
    units: DataFrame  # from, to
    approved: DataFrame  # unit
    value_fixes: DataFrame  # concept, seq, column, side, limit, factor, note
    thresholds: DataFrame  # concept, seq, side, limit, note
    blacklist: DataFrame  # concept, note
    limits: DataFrame  # concept, low, high, low_problem, high_problem


@dataclass
class Result:
    """What a job gives: good rows, its logs, and ``counts`` (rows in, rows out, dropped rows by error)."""

    rows: DataFrame
    errors: DataFrame
    warnings: DataFrame
    units: DataFrame | None = None
    names: DataFrame | None = None
    counts: dict[str, int] = field(default_factory=dict)


ERROR = ("err", "err_value")
_LOG, _BAD = "__log", "__bad"


def _written(df: DataFrame, name: str, counts: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """``df`` with its notes, staged; and the row account that was observed on the way."""
    seen = Observation(name)
    df = df.observe(seen, *[n.alias(c) for c, n in counts.items()])
    return stage(df, name), dict(seen.get)


def _account(errors: Sequence[str], bad: str = _BAD, of: Column | None = None) -> dict[str, Column]:
    """Rows in, rows out and dropped rows by error, among the rows ``of``."""
    of = F.lit(True) if of is None else of
    return {"rows_in": F.count_if(of), "rows_out": F.count_if(of & F.col(bad).isNull())} | {e: F.count_if(of & (F.col(bad) == e)) for e in errors}


def _without_missing(df: DataFrame, skip: Sequence[str]) -> DataFrame:
    """Spaces go from strings but free text, missing tokens from all of them; columns ``skip`` stay."""
    df = clean.remove_spaces(df, [*FREE, *skip])
    return df.withColumns({c: clean.na_tokens(F.col(c), clean.NA_TOKENS_VALUE if c == "value" else clean.NA_TOKENS) for c, kind in df.dtypes if kind == "string" and c not in skip})


def _packed(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``columns`` as one struct: what a step only passes on is copied whole, not column by column."""
    return df.withColumn(name, F.struct(*[F.col(c) for c in columns])).drop(*columns)


def _opened(df: DataFrame, *columns: str) -> DataFrame:
    """Columns of the struct ``__of`` for the step that needs them."""
    return df.withColumns({c: F.col("__of")[c] for c in columns})


def _minimal(raw: DataFrame) -> DataFrame:
    """Dates, spaces, missing tokens and denied status of each row, its description as it is; no row goes."""
    df = clean.build_datetime(clean.keep_source(raw, {"value": "source_value"}), "day", "time").withColumn("__when", F.concat_ws(" ", "day", "time"))
    df = _without_missing(df, ("__when", *DESCRIBED))
    df = df.withColumn(_BAD, F.when(F.col("event_datetime").isNull(), "DATE").when(clean.denied(F.col("status")), "measurement_status"))
    return df.withColumn("__why", F.when(F.col(_BAD) == "DATE", F.col("__when")).when(F.col(_BAD).isNotNull(), F.col("status"))).drop("__when")


def _named(df: DataFrame, d: Dictionaries) -> DataFrame:
    """Test id and name, coding system, provider (if there is one) and stripped unit of descriptions."""
    test_id, national = clean.test_id(F.col("national_code"), F.col("local_code"))
    df = df.withColumns({"test_id": test_id, "is_national": national})
    df = lookup(df, d.names, "test_id", "__named", miss="default")
    df = df.withColumn("__before", clean.test_name(F.when(F.col("is_national") == "1", F.col("__named")).otherwise(F.col("name"))))
    df = lookup(df, d.systems, "coding_system", "coding_system")
    df = df.withColumn("__org", clean.organisation_key(F.col("coding_system")))
    df = lookup(df, d.organisations, "__org", "coding_system_map", miss="default").drop("__org")
    if "provider" in df.columns:
        df = lookup(df, d.systems, "provider", "provider")
    df = df.withColumns({"test": clean.clean_name(F.col("__before")), "__raw_unit": F.col("unit"), "unit": clean.strip_unit(F.col("unit"))})
    entries = notes(
        note((F.col("is_national") == "1") & F.col("__named").isNull(), "warning", err=F.lit("lab_mapping"), err_value=F.col("test_id")),
        note(~F.col("__before").eqNullSafe(F.col("test")), "name", old=F.col("__before"), unit=F.col("__raw_unit"), new=F.col("test")),
    )
    return df.withColumn(_LOG, entries).drop("__named", "__before", "__raw_unit")


def _harmonised(df: DataFrame, units: DataFrame, d: Dictionaries, mode: str) -> DataFrame:
    """Clean units, unit fixes, concepts and their conversions; ``units`` are the units that occur."""
    t = sized(clean.unit_table(units, d.units, mode=mode), "munge-units").select(F.col("from").alias("__unit"), F.col("to").alias("clean_unit"), "known")
    df = df.join(t, F.col("unit") == F.col("__unit"), "left")
    how = F.when(F.col("known"), "map").otherwise("regex")
    entry = note(~F.col("unit").eqNullSafe(F.col("clean_unit")), "unit", test=F.col("test"), old=F.col("unit"), new=F.col("clean_unit"), source=how)
    df = df.withColumn(_LOG, F.concat(_LOG, notes(entry))).drop("__unit", "known")
    df = harmonise.concept_map(harmonise.unit_fix(harmonise.unit_valid(df, d.approved), d.fixes), d.mapping)
    return harmonise.conversion_of(df, sized(harmonise.conversion_table(d.conversions, d.targets), "munge-conversions"))


def _descriptions(first: DataFrame, d: Dictionaries, mode: str, t: CoreTables | None = None) -> DataFrame:
    """A row per distinct description (and whether there is a value, as unit fixes ask for one): what follows from it, and ``__described``.

    ``t``: also what the core job looks up by concept.  Columns ``__is_`` hold the description itself.
    """
    keys = [c for c in DESCRIBED if c in first.columns]
    found = sized(first.select(*keys, F.col("value").isNotNull().alias("__is_valued")).distinct(), "munge-descriptions")
    df = found.select("*", *[F.col(c).alias(f"__is_{c}") for c in keys], F.when(F.col("__is_valued"), "").alias("value"))
    df = clean.keep_source(df, {"unit": "source_unit", "name": "source_name"})
    df = _named(_without_missing(df, ("value", *[f"__is_{c}" for c in keys])), d)
    df = _harmonised(df, df.select("unit"), d, mode).drop("value").withColumnRenamed(_LOG, "__said")
    if t is not None:
        df = _packed(_of_concept(df, t), (*CONVERSION, *CONCEPT), "__of")
    return sized(df.withColumn("__described", F.monotonically_increasing_id()), "munge-described")


def _told(first: DataFrame, described: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with ``columns`` of their description in place of it, and with their converted value and outcome code."""
    keys = [c for c in described.columns if c.startswith("__is_")]
    own = [c for c in first.columns if c not in DESCRIBED and c not in described.columns]
    rows = first.select(*own, *[F.col(c).alias(f"__has_{c}") for c in DESCRIBED if c in first.columns], F.col("value").isNotNull().alias("__has_valued"))
    same = [F.col(k.replace("__is_", "__has_")).eqNullSafe(F.col(k)) for k in keys]
    both = rows.join(described.select(*keys, *columns), reduce(and_, same), "left").drop(*keys, *[k.replace("__is_", "__has_") for k in keys])
    both = _opened(both, *CONVERSION) if "__of" in columns else both
    return harmonise.converted(both, "__failed").withColumn("outcome", clean.outcome_code(F.col("outcome")))


def _own_notes(bad: str = _BAD) -> Column:
    """A row's notes beside those of its description: why it is dropped, or that its conversion failed; else null."""
    error = note(F.lit(True), "error", err=F.col(bad), err_value=F.col("__why"))
    failed = note(F.lit(True), "warning", err=F.lit("unit_conversion"), err_value=F.col("__failed"))
    return F.when(F.col(bad).isNotNull(), F.array(error).cast(NOTE)).when(F.col("__failed").isNotNull(), F.array(failed).cast(NOTE))


def _all_notes(own: str, lost: str) -> Column:
    """With those of the description, which a dropped row doesn't get."""
    return F.when(F.col(lost).isNotNull(), F.col(own)).when(F.col(own).isNotNull(), F.concat("__said", own)).otherwise(F.col("__said"))


MUNGE_ERRORS, CORE_ERRORS = ("DATE", "measurement_status"), ("DATE_IN_MEASUREMENT",)


def _cleaned(raw: DataFrame, limit: int | None, rebalance: bool) -> DataFrame:
    raw = raw if limit is None else raw.limit(limit)
    return _minimal(raw.hint("rebalance", "row_id") if rebalance else raw)


def munge(raw: DataFrame, d: Dictionaries, mode: str = "map", limit: int | None = None, rebalance: bool = False) -> Result:
    """Raw rows to harmonised rows; ``raw`` has at least the columns ``RAW``.

    ``limit``: a trial run on the first rows.  ``rebalance``: deal the rows anew where the input is a few large splits.
    """
    first = stage(_cleaned(raw, limit, rebalance), "munge-cleaned")
    described = _descriptions(first, d, mode)
    df = _told(first, described, [c for c in described.columns if not c.startswith("__is_") and c != "__described"])
    kept, counts = _written(df.withColumn("__own", _own_notes()).withColumn(_LOG, _all_notes("__own", _BAD)).drop("__own", "__said", "__why", "__failed"), "munge-rows", _account(MUNGE_ERRORS))
    rows = kept.filter(F.col(_BAD).isNull()).drop(_BAD, _LOG)
    return Result(rows, log_of(kept, "error", ERROR), log_of(kept, "warning", ERROR), log_of(kept, "unit", ("test", "old", "new", "source")), log_of(kept, "name", ("old", "unit", "new")), counts)


def munge_and_core(raw: DataFrame, d: Dictionaries, t: CoreTables, mode: str = "map", source_values: bool = False, drop: tuple[str, ...] = (), limit: int | None = None, rebalance: bool = False) -> tuple[Result, Result]:
    """Both jobs on the same rows, which are written once, with the number of their description; results join that table when read.

    The first result's rows are the munge job's, without the columns ``drop``.
    """
    first = _cleaned(raw, limit, rebalance)
    passed = [c for c in first.columns if c not in (*DESCRIBED, *drop, *USED)]
    first = stage(_packed(first, passed, "__row"), "munge-cleaned")
    described = _descriptions(first, d, mode, t)
    df = _told(first, described, ["__described", "concept", "test", "__of"]).withColumn("__lost", F.col(_BAD))
    lost = F.col("__lost").isNotNull()
    found = _checked(df, t, source_values).withColumn(_LOG, F.when(~lost, F.col(_LOG))).drop("__of", "test", *drop)
    account = {f"m_{c}": n for c, n in _account(MUNGE_ERRORS, "__lost").items()} | {f"c_{c}": n for c, n in _account(CORE_ERRORS, of=~lost).items()}
    kept, counts = _written(found, "core-rows", account)
    told = kept.select("*", *[F.col("__row")[c].alias(c) for c in passed])
    more = described.drop("__of", "concept", *drop, *[c for c in described.columns if c.startswith("__is_")]).withColumnRenamed("__described", "__d")
    told = told.join(more, F.col("__described") == F.col("__d"), "left")
    said = told.withColumn("__own", _own_notes("__lost")).withColumn("__munge_log", _all_notes("__own", "__lost"))
    inner = ("__row", "__d", "__described", "__said", "__lost", "__why", "__failed", _BAD, _LOG)

    def log(kind: str, columns: Sequence[str]) -> DataFrame:
        return log_of(said, kind, columns, log="__munge_log")

    rows = told.filter(~lost)
    munged = Result(rows.drop(*inner, *ADDED), log("error", ERROR), log("warning", ERROR), log("unit", ("test", "old", "new", "source")), log("name", ("old", "unit", "new")), {c[2:]: n for c, n in counts.items() if c[:2] == "m_"})
    when = kept.withColumn("event_datetime", F.col("__row.event_datetime"))
    cored = Result(rows.filter(F.col(_BAD).isNull()).drop(*inner), log_of(when, "error", ERROR), log_of(when, "warning", ERROR), counts={c[2:]: n for c, n in counts.items() if c[:2] == "c_"})
    return munged, cored


def dictionary_clashes(d: Dictionaries) -> DataFrame:
    """dictionary, key, n_rows: keys that a dictionary has several different rows of (the least row counts)."""
    approved = d.mapping.filter(F.col("status") == "APPROVED").select("test", "unit", "concept", "quantity")
    parts = [clashes(t.select("from", "to"), ["from"], name) for t, name in ((d.names, "names"), (d.systems, "systems"), (d.organisations, "organisations"), (d.units, "units"))]
    parts += [clashes(d.fixes.select("test", "unit", "fix"), ["test", "unit"], "fixes"), clashes(approved, ["test", "unit"], "mapping")]
    return reduce(DataFrame.unionByName, parts)


#: What the core job looks up by concept, and the columns that it adds.
CONCEPT = ("target_unit", "__fixes", "__thresholds", "__listed", "low", "high", "low_problem", "high_problem")
CONVERSION = ("a", "program", "__text")
#: Columns of a row that the core job works with; the others are only passed on.
USED = ("row_id", "value", "source_value", "text", "outcome", _BAD, "__why")
ADDED = ("extracted_value", "merged_value", "is_pos", "outcome_text", "qc_pass", "qc_note", "imputed_outcome")


def _of_concept(df: DataFrame, t: CoreTables) -> DataFrame:
    """The columns ``CONCEPT`` of each row's concept."""
    df = left_dimension(df, t.targets.select("concept", "target_unit"), "concept")
    return qc.limits_of(qc.listed_of(qc.thresholds_of(qc.fixes_of(df, t.value_fixes), t.thresholds), t.blacklist), t.limits)


def _extracted(df: DataFrame, t: CoreTables, source_values: bool) -> DataFrame:
    """Number, flag and comparison from the free text, and the merged value."""
    df = df.withColumn("extracted_value", extract.extracted_number(F.col("text"), F.col("__of.target_unit")))
    df = df.withColumn("merged_value", extract.merged(F.col("harm_value"), F.col("extracted_value"), F.col("source_value") if source_values else None))
    df = extract.exact_lookup(df, t.posneg, "text", "is_pos")
    return extract.plus_overlay(extract.comparison_outcome(df, "text", t.units, t.approved), t.plus)


def _judged(df: DataFrame) -> DataFrame:
    """Dates among values are flagged; rules, conflicts and the blacklist leave their state and notes."""
    why = F.concat_ws("::", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in ("test", "harm_value", "text", "extracted_value")])
    df = df.withColumn(_BAD, F.when(qc.is_date(F.col("extracted_value")), "DATE_IN_MEASUREMENT"))
    noted = F.concat_ws(";", F.coalesce("test", F.lit("")), "qc_note")
    entries: list[Column] = []

    def step(df: DataFrame, err: str) -> DataFrame:
        """Keep the note of a row whose quality note has changed since ``__note``."""
        name = f"__entry{len(entries)}"
        entries.append(note(F.col(name).isNotNull(), "warning", err=F.lit(err), err_value=F.col(name)))
        return df.withColumn(name, F.when(F.col(_BAD).isNull() & ~F.col("qc_note").eqNullSafe(F.col("__note")), noted)).withColumn("__note", F.col("qc_note"))

    df = step(qc.fixed(_opened(qc.start(df), "__fixes").withColumn("__note", F.lit(None).cast("string"))), "QC_CONVERT")
    df = qc.judged(_opened(df, "__thresholds")).withColumn("__note", F.col("qc_note"))
    df = step(qc.outcome_conflict(df), "QC_NOTE_APPENDED")
    df = step(qc.distrusted(_opened(df, "__listed")), "QC_NOTE_APPENDED")
    names = [f"__entry{i}" for i in range(len(entries))]
    dropped = note(F.lit(True), "error", err=F.col(_BAD), err_value=why)
    log = F.when(F.col(_BAD).isNotNull(), F.array(dropped).cast(NOTE)).when(F.coalesce(*names).isNotNull(), notes(*entries))
    return df.withColumn(_LOG, log).drop("__note", *names)


def _checked(df: DataFrame, t: CoreTables, source_values: bool) -> DataFrame:
    """The core job's columns, flags and notes of rows that have those of their concept."""
    return qc.imputed(_opened(_judged(_extracted(df, t, source_values)), "low", "high", "low_problem", "high_problem"))


def core(df: DataFrame, t: CoreTables, source_values: bool = False, drop: tuple[str, ...] = (), limit: int | None = None) -> Result:
    """Harmonised rows to quality-controlled rows with imputed outcomes; ``drop``: sensitive columns that end here."""
    df = df if limit is None else df.limit(limit)
    kept, counts = _written(_checked(_packed(_of_concept(df, t), CONCEPT, "__of"), t, source_values).drop("__of", *drop), "core-rows", _account(CORE_ERRORS))
    return Result(kept.filter(F.col(_BAD).isNull()).drop(_BAD, _LOG), log_of(kept, "error", ERROR), log_of(kept, "warning", ERROR), counts=counts)
