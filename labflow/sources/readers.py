"""Scans, checks of inputs, joins of file pairs, sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import sanitise_text
from .staging import stage

# The raw files' columns, in order.  The first one's name differs by data owner: see ``raw_columns``.
MAIN_COLUMNS = [
    "PERSON_ID",
    "EVENT_AGE",
    "APPROX_EVENT_DAY",
    "TIME",
    "asiakirjaoid_pseudo",
    "merkintaoid_pseudo",
    "entryoid_pseudo",
    "load_id_pseudo",
    "file_name_pseudo",
    "laboratoriotutkimusoid",
    "laboratoriotutkimusnimike",
    "paikallinentutkimusnimike_koodi",
    "paikallinentutkimusnimike_selite",
    "tutkimuskoodistonjarjestelma",
    "tiedonlahde",
    "tutkimusvastauksentila",
    "tutkimustulosarvo",
    "tutkimustulosyksikko",
    "tutkimuksennaytelaatu",
    "tutkimuksentekotapa",
    "tuloksenpoikkeavuus",
    "viitearvoryhma",
    "viitevalialkuarvo",
    "viitevalialkuyksikko",
    "viitevaliloppuarvo",
    "viitevaliloppuyksikko",
]
FREETEXT_COLUMNS = [*MAIN_COLUMNS[:9], "tutkimustulosteksti"]
BAD = "__corrupt"


def raw_columns(person: str, free_text: bool = False) -> list[str]:
    """The expected header of a main or free-text file whose person column is called ``person``."""
    return [person, *(FREETEXT_COLUMNS if free_text else MAIN_COLUMNS)[1:]]


def read_tsv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], wanted: Sequence[str] | None = None, keep_bad: bool = True) -> DataFrame:
    """All-string TSV (plain or gzip).  Malformed lines are kept in ``__corrupt`` (see ``split_bad``), or dropped if asked for.

    A file is one task; ``split_scan.scan_tsv`` cuts plain files.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns] + ([T.StructField(BAD, T.StringType())] if keep_bad else []))
    reader = spark.read.schema(schema).option("sep", "\t").option("header", True).option("multiLine", True).option("enforceSchema", True)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD) if keep_bad else reader.option("mode", "DROPMALFORMED")
    df = reader.csv(paths)
    return df.select(*wanted, *([BAD] if keep_bad else [])) if wanted else df


def split_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the malformed lines (column ``line``) of a scan with ``keep_bad``: log these instead of losing them."""
    return df.filter(F.col(BAD).isNull()).drop(BAD), df.filter(F.col(BAD).isNotNull()).withColumnRenamed(BAD, "line")


def read_parquet(spark: SparkSession, path: str, wanted: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*wanted) if wanted else df


def headers_problems(spark: SparkSession, expected: dict[str, Sequence[str]]) -> DataFrame:
    """path, problem, column: missing, extra or misplaced columns of files' headers; no row for a file where all is well."""
    heads = [(f, list(c), _first_line(spark, f)) for f, c in expected.items()]
    got = spark.createDataFrame(heads, "path string, want array<string>, line string").withColumn("got", F.split(F.rtrim("line"), "\t"))
    want, have = F.col("want"), F.col("got")
    less, more = F.array_except(want, have), F.array_except(have, want)
    shifted = F.filter(F.transform(have, lambda c, i: F.struct(F.lit("ORDER").alias("problem"), c.alias("column"))), lambda s: F.array_position(have, s["column"]) != F.array_position(want, s["column"]))
    none = F.array().cast("array<struct<problem:string,column:string>>")
    problems = F.concat(
        F.transform(less, lambda c: F.struct(F.lit("MISSING").alias("problem"), c.alias("column"))),
        F.transform(more, lambda c: F.struct(F.lit("EXTRA").alias("problem"), c.alias("column"))),
        F.when((F.size(less) == 0) & (F.size(more) == 0) & (have != want), shifted).otherwise(none),
    )
    return got.select("path", problems.alias("p")).select("path", F.inline("p"))


def _first_line(spark: SparkSession, path: str) -> str:
    """A file's first line, by the file system on the driver: a job would have to read a compressed file to its end."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    codec, stream = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at), at.getFileSystem(conf).open(at)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def header_problems(spark: SparkSession, path: str, expected: Sequence[str]) -> DataFrame:
    """``headers_problems`` of one file."""
    return headers_problems(spark, {path: expected})


def manifest_pairs(spark: SparkSession, path: str) -> DataFrame:
    """line, main, free of each non-empty line of a manifest: two paths with a tab between them."""
    lines = spark.read.text(path).filter(F.trim("value") != "").select("value", F.split(F.trim("value"), "\t").alias("parts"))
    return lines.select("value", F.size("parts").alias("n"), F.get("parts", F.lit(0)).alias("main"), F.get("parts", F.lit(1)).alias("free"))


def manifest_problems(spark: SparkSession, path: str, main: Sequence[str] = (), free: Sequence[str] = ()) -> DataFrame:
    """value, problem: lines of a manifest that don't name a pair of existing TSV files with the expected headers.

    A manifest names tens of files.  On the driver each folder of them is listed once and each file's first line is read.
    """
    pairs = manifest_pairs(spark, path)
    tsv = F.col("main").rlike(r"\.tsv(\.gz)?$") & F.col("free").rlike(r"\.tsv(\.gz)?$")
    kind = F.when(F.col("n") != 2, "NOT_A_PAIR").when(~tsv, "NOT_TSV")
    found = [pairs.select("value", kind.alias("problem")).filter("problem is not null")]
    named = [(r["value"], r["main"], r["free"]) for r in pairs.filter(kind.isNull()).collect()]
    there = _existing(spark, {f for _, *files in named for f in files})
    gone = [(v, "MISSING_FILE") for v, *files in named for f in files if f not in there]
    if gone:
        found.append(spark.createDataFrame(gone, "value string, problem string"))
    wanted = {f: list(columns) for _, a, b in named for f, columns in ((a, main), (b, free)) if f in there and columns}
    if wanted:
        bad = headers_problems(spark, wanted)
        lines = spark.createDataFrame([(v, f) for v, *files in named for f in files if f in wanted], "value string, path string")
        found.append(lines.join(bad, "path").select("value", F.concat_ws(" ", F.lit("HEADER"), "problem", "column").alias("problem")))
    return reduce(DataFrame.unionByName, found)


def _existing(spark: SparkSession, files: set[str]) -> set[str]:
    """Those of ``files`` that exist; a folder is listed once however many of its files are asked for."""
    hadoop, out = spark.sparkContext._jvm.org.apache.hadoop.fs, set()
    by_folder: dict[str, set[str]] = {}
    for f in files:
        by_folder.setdefault(f.rpartition("/")[0], set()).add(f)
    for folder, own in by_folder.items():
        at = hadoop.Path(folder or ".")
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = {s.getPath().getName() for s in fs.listStatus(at)} if fs.exists(at) else set()
        out |= {f for f in own if f.rpartition("/")[2] in names}
    return out


def number_in_file(df: DataFrame, out: str = "row_no") -> DataFrame:
    """1-based number of each row within its file, and the file's name.

    Text sources have no row index, but one file's partitions keep its order: number each partition and add what precedes it.
    """
    named = stage(df.withColumns({"source_file": F.col("_metadata.file_name"), "__id": F.monotonically_increasing_id()}), "file-rows")
    part = F.shiftright("__id", 33)
    size = named.groupBy("source_file", part.alias("__part")).agg(F.count("*").alias("__k"), F.min("__id").alias("__low"))
    w = Window.partitionBy("source_file").orderBy("__part")
    before = size.select(F.col("source_file").alias("__f"), "__part", "__low", (F.sum("__k").over(w) - F.col("__k")).alias("__before"))  # a row per file split
    both = named.join(F.broadcast(before), (F.col("source_file") == F.col("__f")) & (part == F.col("__part")))
    return both.withColumn(out, F.col("__before") + F.col("__id") - F.col("__low") + 1).drop("__id", "__f", "__part", "__low", "__before")


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def zip_join(main: DataFrame, free: DataFrame, on: Sequence[str] = ("pair_id", "row_no")) -> DataFrame:
    """Rows of a file pair side by side; the shorter file is padded with nulls.  ``main._rowid`` and ``freetext._rowid`` tell which row a side has."""
    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*on, F.col(on[-1]).alias(f"{prefix}._rowid"), *[F.col(c).alias(f"{prefix}.{c}") for c in df.columns if c not in on])

    return side(main, "main").join(side(free, "freetext"), list(on), "full_outer")


def merge_check(zipped: DataFrame, shared: Sequence[str]) -> DataFrame:
    """One row: rows, rows that lack a side's row id, and rows that differ per shared column (a null against a value differs)."""
    missing = F.col("`main._rowid`").isNull() | F.col("`freetext._rowid`").isNull()
    return zipped.agg(F.count("*").alias("n_rows"), F.count_if(missing).alias("n_without_id"), *[F.count_if(~F.col(f"`main.{c}`").eqNullSafe(F.col(f"`freetext.{c}`"))).alias(f"differs_{c}") for c in shared])


def consolidate(zipped: DataFrame, main: Sequence[str], free: Sequence[str]) -> DataFrame:
    return zipped.select(*[F.col(f"`main.{c}`").alias(c) for c in main], *[F.col(f"`freetext.{c}`").alias(c) for c in free])


def tidy(df: DataFrame, sex: DataFrame, text: Sequence[str], order: Sequence[str], person: str = "PERSON_ID") -> DataFrame:
    """Attach sex (a row per person), sanitise untrusted text, fix the column order."""
    both = df.join(sex, person, "left")
    return both.withColumns({c: sanitise_text(F.col(c)) for c in text}).select(*order)


def left_dimension(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join of a dimension, a row per key; Spark broadcasts it while its size in bytes allows."""
    return df.join(unique(dim, [key]), key, "left")


def left_reports(responses: DataFrame, reports: DataFrame, keys: Sequence[str], missing: str | None = "NA") -> DataFrame:
    """Reports beside the responses they belong to; string columns of a response without a report hold ``missing``."""
    texts = [c for c, kind in reports.dtypes if kind == "string" and c not in keys]
    joined = responses.join(reports, list(keys), "left")
    return joined if missing is None else joined.withColumns({c: F.coalesce(c, F.lit(missing)) for c in texts})


def roll_up_reports(df: DataFrame, keys: Sequence[str], seq: str, text: str) -> DataFrame:
    """A group's texts in order, joined by "::"; several are announced by "HUOM::n::"."""
    n = F.count("*")
    joined = F.concat_ws("::", F.transform(F.array_sort(F.collect_list(F.struct(seq, text))), lambda x: x[text]))
    return df.groupBy(*keys).agg(F.when(n > 1, F.concat(F.lit("HUOM::"), n.cast("string"), F.lit("::"), joined)).otherwise(joined).alias("report"), n.alias("n_parts"))


def union_files(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return read_tsv(spark, list(paths), columns)


def write_tsv(df: DataFrame, path: str, gzip: bool = True) -> None:
    """Header, tab-separated, "NA" for null; fails where the path exists."""
    df.write.mode("errorifexists").option("sep", "\t").option("header", True).option("nullValue", "NA").option("compression", "gzip" if gzip else "none").csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)


# ------------------------------------------------------------------------------------------------ logs
#: What a row leaves in the logs of a job: kind (error, warning, unit, name), and what the kind's log holds.
NOTE = "array<struct<kind:string,err:string,err_value:string,test:string,unit:string,old:string,new:string,source:string>>"
_FIELDS = ("err", "err_value", "test", "unit", "old", "new", "source")


def note(flag: Column, kind: str, **values: Column) -> Column:
    """An entry of a row's log where the flag holds, else null."""
    return F.when(flag, F.struct(F.lit(kind).alias("kind"), *[values.get(f, F.lit(None)).cast("string").alias(f) for f in _FIELDS]))


def notes(*entries: Column) -> Column:
    return F.array_compact(F.array(*entries)).cast(NOTE)


def log_of(df: DataFrame, kind: str, columns: Sequence[str], log: str = "__log", row_id: str = "row_id", when: str = "event_datetime") -> DataFrame:
    """row_id, event_datetime and ``columns`` of one kind of entry."""
    each = df.select(F.col(row_id).alias("row_id"), F.col(when).cast("string").alias("event_datetime"), F.explode(log).alias("e")).filter(F.col("e.kind") == kind)
    return each.select("row_id", "event_datetime", *[F.col(f"e.{c}").alias(c) for c in columns])


def quarantine(df: DataFrame, flag: str, kind: str, value: str, row_id: str = "row_id", when: str = "event_datetime") -> DataFrame:
    """Rows with a flag, as (row_id, event_datetime, err, err_value)."""
    return df.filter(F.col(flag)).select(F.col(row_id).alias("row_id"), F.col(when).cast("string").alias("event_datetime"), F.lit(kind).alias("err"), F.col(value).cast("string").alias("err_value"))


def unit_log(df: DataFrame, old: str, new: str, source: str, row_id: str = "row_id", when: str = "event_datetime") -> DataFrame:
    return df.filter(~F.col(old).eqNullSafe(F.col(new))).select(F.col(row_id).alias("row_id"), F.col(when).cast("string").alias("event_datetime"), "test", F.col(old).alias("old"), F.col(new).alias("new"), F.lit(source).alias("source"))


def read_dictionary(spark: SparkSession, path: str, columns: Sequence[str], header: bool = True) -> DataFrame:
    """A small all-string table; the header line is no entry."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("sep", "\t").option("header", header).csv(path)


def vocabulary(spark: SparkSession, path: str, names: dict[str, str]) -> DataFrame:
    """Wanted columns of a vocabulary file under new names, blanks trimmed, each row once."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    return df.select(*[F.trim(F.col(f"`{old}`")).alias(new) for old, new in names.items()]).distinct()


def approved_units(vocabulary: DataFrame, code: str = "unit", flag: str = "unique") -> DataFrame:
    """unit: the vocabulary's units that are marked unique for laboratory use."""
    return vocabulary.filter(F.lower(F.col(flag)).isin("true", "1")).select(F.col(code).alias("unit")).distinct()


def unit_fix_table(spark: SparkSession, path: str) -> DataFrame:
    """test, unit, fix: the first row of each (test, unit) in file order."""
    lines = read_dictionary(spark, path, ["test", "unit", "fix"]).withColumn("__at", F.monotonically_increasing_id())
    return first_per_key(lines, ["test", "unit"], "__at").drop("__at")


def blacklist_table(spark: SparkSession, path: str) -> DataFrame:
    return read_dictionary(spark, path, ["concept", "note", "description"]).select(F.col("concept").cast("int"), "note")


def value_fix_table(spark: SparkSession, path: str) -> DataFrame:
    """concept, seq (file order), column, side, limit, factor, note."""
    raw = read_dictionary(spark, path, ["concept", "column", "limit", "side", "factor", "note"]).withColumn("__at", F.monotonically_increasing_id())
    seq = F.row_number().over(Window.partitionBy("concept").orderBy("__at"))
    return raw.select(F.col("concept").cast("int"), seq.alias("seq"), "column", "side", F.col("limit").cast("double"), F.col("factor").cast("double"), "note")


def threshold_table(spark: SparkSession, path: str) -> DataFrame:
    """concept, seq (file order), side, limit (null for "NA"), note."""
    raw = read_dictionary(spark, path, ["concept", "limit", "side", "note"]).withColumn("__at", F.monotonically_increasing_id())
    seq = F.row_number().over(Window.partitionBy("concept").orderBy("__at"))
    return raw.select(F.col("concept").cast("int"), seq.alias("seq"), "side", F.col("limit").try_cast("double").alias("limit"), "note")


def plus_table(spark: SparkSession, path: str) -> DataFrame:
    """concept, text, flag of plus-sign texts that are judged positive or negative."""
    raw = read_dictionary(spark, path, ["concept", "text", "flag", "description"])
    return raw.filter(F.col("flag").isin("0", "1")).select(F.col("concept").cast("int"), "text", "flag")


def posneg_table(spark: SparkSession, path: str) -> DataFrame:
    return read_dictionary(spark, path, ["text", "flag"]).filter("text is not null and flag is not null")


def target_units(spark: SparkSession, path: str) -> DataFrame:
    """concept, quantity, target_unit; rows without a unit are no targets."""
    raw = read_dictionary(spark, path, ["concept", "quantity", "target_unit", "origin"])
    return raw.filter("target_unit is not null and target_unit != 'NA'").select(F.col("concept").cast("int"), "quantity", "target_unit")


def rules_with_vocabulary(rules: DataFrame, words: DataFrame, order: str, keys: Sequence[str] = ("test", "unit")) -> DataFrame:
    """Rules beside the first vocabulary row of their (test, unit), compared in lower case without outer blanks."""
    def norm(df: DataFrame) -> DataFrame:
        return df.withColumns({f"__{k}": F.lower(F.trim(F.col(k))) for k in keys})

    own = [f"__{k}" for k in keys]
    best = first_per_key(norm(words).drop(*keys), own, order)
    return norm(rules).join(best, own, "left").drop(*own)


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the least in its other columns (nulls last): what makes a table a dictionary, so that no join multiplies rows."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(*[x for c in rest for x in (F.col(c).isNull().alias(f"__{c}"), F.col(c))])).alias("b"))
    return best.select(*[F.col(f"b.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def clashes(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """dictionary, key, n_rows: keys of a dictionary that have several different rows."""
    return df.distinct().groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1").select(F.lit(name).alias("dictionary"), F.concat_ws(" | ", *[F.coalesce(F.col(k).cast("string"), F.lit("NA")) for k in keys]).alias("key"), "n_rows")


def lookup(df: DataFrame, names: DataFrame, key: str, out: str, miss: str = "key", default: str | None = None) -> DataFrame:
    """Dictionary join with three policies for a miss: keep the key, a default, or null."""
    small = unique(names.select("from", "to"), ["from"]).toDF("__from", "__to")
    other = F.col(key) if miss == "key" else F.lit(default)
    return df.join(small, F.col(key) == F.col("__from"), "left").withColumn(out, F.coalesce("__to", other)).drop("__from", "__to")


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row of each key in file order."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("b"))
    return best.select(*keys, *[F.col(f"b.{c}").alias(c) for c in rest]).select(df.columns)


def schema_export(df: DataFrame) -> DataFrame:
    """name, type, mode of each column, in a warehouse's terms; an unknown type is STRING."""
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "tinyint": "INTEGER", "double": "FLOAT", "float": "FLOAT", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "DATETIME", "date": "DATE"}
    rows = [(f.name, kinds.get(f.dataType.simpleString(), "STRING"), "NULLABLE" if f.nullable else "REQUIRED") for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "name string, type string, mode string")
