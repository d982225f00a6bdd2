"""Cleaning of raw measurement rows: text, names, codes, units, outcomes.  Every operator maps a DataFrame to a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import blank_to_null, delete_chars, without_space

# Tokens that mean "missing", denied status codes, characters that units lose, outcome codes.
NA_TOKENS = ("Puuttuu", '""', "TYHJÄ", "_", "NULL", "-1")
NA_TOKENS_VALUE = ("Puuttuu", '""', "TYHJÄ", "_", "NULL")
DENIED_STATUS = ("K", "W", "X", "I", "D", "P")
UNIT_CHARS = " _,.-(){}\\?!"
OUTCOME_MAP = {"<": "L", ">": "H", "POS": "A", "NEG": "N"}
OUTCOMES = ("L", "H", "A", "N", "LL", "HH", "AA", "NN")
NAME_DELETIONS = ("_|\\*|#|%", "^\\d{4},", ",\\d{4}$")
NAME_REPLACEMENTS = (("–", "-"),)
# Unit rewrites, applied in this order.
UNIT_REWRITES = (
    (r"(^\*+$|^$)", "NA"),
    (r"\bc\b", "°c"),
    (r"(^(\b)?\d+(?=e\d+))", ""),
    (r"(à?x?(10)?e0?(?=\d)|x?10(\^|\*)|^\^(?=[0-9]+.?l))", "e"),
    (r"(y|µ)ks(ikkö)?", "u"),
    (r"y", "u"),
    (r"lµ", "ly"),
    (r"tehtµ", "tehty"),
    (r"µg", "ug"),
    (r"m([a-z]?)µ", "mu"),
    (r"^mµ.?l$", "mu/l"),
    (r"^µ.?l$", "u/l"),
    (r"^u.?l$", "u/l"),
    (r"µmol", "umol"),
    (r"^µmol.?l$", "umol/l"),
    (r"^(µ|u)g.?l$", "ug/l"),
    (r"^(m)?mmo(l)?/", "mmol/"),
    (r"(mo(t|l|i)?(l)?)(?=$)|nol", "mol"),
    (r"^mmol.?(l|i).?$", "mmol/l"),
    (r"krea", ""),
    (r"^mmol.?mol.?$", "mmol/mol"),
    (r"(^(m)?m(h)?/h$|^mh.?h$)", "mm/h"),
    (r"^.?mg.?l$", "mg/l"),
    (r"^ml/min.*", "ml/min/173m2"),
    (r"^inrarvo$", "inr"),
    (r"^mg/lfeu$", "mg/l"),
    (r"^mo(l)?sm/kg.*$", "mosm/kgh2o"),
    (r"(^tilo(s)?$|^(til)osuu(s)$)", "osuus"),
    (r"(kopio(t)?(a)?|klp|sol(y|µ|u)|sol(y|µ|u)a|pisteet)", "kpl"),
    (r"(n(ä)?kö(ke)?k(enttä|entt)?|s(y|µ)n(fält|f)?$)", "nk"),
    (r"(^(kpla)/nk|^kpl.?nk$|/nk$)", "kpl/nk"),
    (r"^.*ti(i)?t(t)?er(i)?.*$", "titre"),
    (r"^elia(u|µ)", "eliau"),
    (r"^eliau/m$", "eliau/ml"),
    (r"^a(u|µ)/ml$", "au/ml"),
    (r"(gulos(t.*)$|gulo)", "gstool"),
    (r"((u|µ)g/g(\s+)?stool|(u|µ)g/g(f)?)", "ug/g"),
    (r"(^promil(l)?$|^o/oo$)", "promille"),
    (r"(^\-$|^negat$|^neg$)", "N"),
    (r"(^pos$|^\+$)", "A"),
    (r"^p.?g$", "pg"),
    (r"^f.?l$", "fl"),
    (r"\/\/", "/"),
    (r"(c)?aste(c)?", "aste"),
    (r"sek", "s"),
    (r"ve/", "responseequivalent/"),
    (r"^ve$", "responseequivalent"),
    (r"aru", "au"),
    (r"liter", "l"),
    (r"(/d$|/vrk$)", "/24h"),
    (r"nk$", "field"),
    (r"kpl", "u"),
    (r"(lausunto|lomake)", "form"),
    (r"indeksi", "index"),
    (r"arvio", "estimate"),
    (r"suhde", "ratio"),
    (r"krt", "times"),
    (r"/100le(uk)$", "/100leuk"),
    (r"/l(/|)?(4|37c|ph7|ph74)+", "/l"),
    (r"nmol(bce)?/mmol", "nmol/mmol"),
    (r"^ku/l$", "u/ml"),
    (r"^pg/ml$", "ng/l"),
    (r"^(µ|u)g/ml$", "mg/l"),
    (r"(^\s+$|^$)", "NA"),
)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def keep_source(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Copy columns before they are cleaned: ``{"value": "source_value"}``."""
    return df.withColumns({new: F.col(old) for old, new in columns.items()})


def sanitise_text(c: Column) -> Column:
    """Line ends to ␤ and tabs to ␉, so that a text stays in one field of one line."""
    return F.translate(F.regexp_replace(c, "\r\n|\r|\n", "␤"), "\t", "␉")


def build_datetime(df: DataFrame, day: str, time: str, out: str = "event_datetime") -> DataFrame:
    """Day and time to a timestamp; null where they don't form one (such rows go to quarantine)."""
    return df.withColumn(out, F.try_to_timestamp(F.concat(F.col(day), F.lit("T"), F.col(time)), F.lit("yyyy-MM-dd'T'HH:mm")))


def remove_spaces(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Delete all Unicode white space from string columns, except those skipped; what is empty then is null."""
    return df.withColumns({c: blank_to_null(without_space(c)) for c, kind in df.dtypes if kind == "string" and c not in skip})


def na_tokens(c: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    return F.when(~c.isin(list(tokens)), c)


def denied(status: Column) -> Column:
    return F.coalesce(status.isin(list(DENIED_STATUS)), F.lit(False))


def test_id(national: Column, local: Column) -> tuple[Column, Column]:
    """The test's id and whether it is a national one."""
    return F.coalesce(national, local), F.when(national.isNotNull(), "1").otherwise("0")


def map_keep(df: DataFrame, names: DataFrame, key: str, out: str) -> DataFrame:
    """Look ``key`` up in ``names`` (from, to); what isn't there keeps its own value.  ``matched`` tells which."""
    small = names.groupBy(F.col("from").alias("__from")).agg(F.min("to").alias("__to"))
    both = df.join(small, F.col(key) == F.col("__from"), "left")
    return both.withColumns({"matched": F.col("__from").isNotNull(), out: F.coalesce("__to", key)}).drop("__from", "__to")


def test_name(c: Column) -> Column:
    return F.translate(F.lower(c), '"', "")


def organisation_key(c: Column, prefixes: Sequence[str] = ("1.2.246.537.10.", "1.2.246.10.")) -> Column:
    """The part of an organisation code that the dictionaries know: prefixes off, text before the first dot."""
    for p in prefixes:
        c = F.replace(c, F.lit(p), F.lit(""))
    return F.substring_index(c, ".", 1)


def clean_name(c: Column) -> Column:
    c = F.regexp_replace(c, "|".join(NAME_DELETIONS), "")
    for old, new in NAME_REPLACEMENTS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def strip_unit(c: Column) -> Column:
    return F.lower(blank_to_null(delete_chars(c, UNIT_CHARS)))


def rewrite_unit(c: Column, pairs: Sequence[tuple[str, str]] = UNIT_REWRITES) -> Column:
    for pattern, new in pairs:
        c = F.regexp_replace(c, "(?U)" + pattern, new.replace("$", "\\$"))
    return c


def unit_table(units: DataFrame, known: DataFrame, pairs: Sequence[tuple[str, str]] = UNIT_REWRITES, mode: str = "map") -> DataFrame:
    """from, to, known of distinct stripped units (column ``unit``): by dictionary, else by the rewrites, run once per unit.

    ``mode``: "map" dictionary first, "regex" rewrites for all, "none" neither.
    """
    names = known.groupBy(F.col("from").alias("__from")).agg(F.min("to").alias("__to"))
    both = units.filter("unit is not null").distinct().join(names, F.col("unit") == F.col("__from"), "left")
    own = F.col("unit") if mode == "none" else rewrite_unit(F.col("unit"), pairs)
    found = F.when(F.col("__from").isNotNull(), F.col("__to")).otherwise(own) if mode == "map" else own
    return both.select(F.col("unit").alias("from"), F.nullif(found, F.lit("NA")).alias("to"), F.col("__from").isNotNull().alias("known"))


def fix_units(df: DataFrame, unit: str, known: DataFrame, out: str = "clean_unit", pairs: Sequence[tuple[str, str]] = UNIT_REWRITES, mode: str = "map") -> DataFrame:
    """Known units by dictionary, others by the rewrites.  Distinct units are rewritten once and joined back."""
    if mode == "none":
        return df.withColumn(out, F.col(unit))
    t = unit_table(df.select(F.col(unit).alias("unit")), known, pairs, mode).select(F.col("from").alias("__unit"), F.col("to").alias("__fixed"))
    return df.join(t, F.col(unit) == F.col("__unit"), "left").withColumn(out, F.col("__fixed")).drop("__unit", "__fixed")


def outcome_code(c: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in OUTCOME_MAP.items() for x in kv])
    c = F.coalesce(known[c], c)
    return F.when(c.isin(list(OUTCOMES)), c)
