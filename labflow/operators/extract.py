"""Values and outcomes from free text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import delete_chars, number, without_space
from ..sources.readers import unique
from .clean import UNIT_CHARS

# Words that announce a result, and comparison signs.
RESULT_WORDS = ("tutkimuksentulos:", "resultat:", "provresultat:", "tutkimuksen tulos:", "tulos:", "vastaus:")
COMPARISONS = ("<", ">", "yli", "alle")


def _without_words(t: Column, pattern: str) -> Column:
    """Result words deleted one after the other; all of them end in a colon, so a text without one is left alone."""
    out = t
    for word in RESULT_WORDS:
        out = F.regexp_replace(out, pattern.format(word), "")
    return F.when(t.contains(":"), out).otherwise(t)


def extracted_number(text: Column, unit: Column) -> Column:
    """The number in a text once spaces, the concept's unit, result words and asterisks are gone."""
    t = F.replace(without_space(F.lower(text)), F.coalesce(unit, F.lit("")), F.lit(""))
    return number(F.translate(_without_words(t, r"(?U)\b{}\b"), ",*", "."))


def merged(harmonised: Column, extracted: Column, source: Column | None = None) -> Column:
    """Harmonised value, else the extracted one, else (if asked) the source's."""
    return F.coalesce(harmonised, extracted) if source is None else F.coalesce(harmonised, extracted, number(source))


def exact_lookup(df: DataFrame, table: DataFrame, text: str, out: str) -> DataFrame:
    """``out`` by exact text from a table (text, flag)."""
    t = unique(table.select("text", "flag"), ["text"]).select(F.col("text").alias("__t"), F.col("flag").alias(out))
    return df.join(t, F.col(text) == F.col("__t"), "left").drop("__t")


def comparison_outcome(df: DataFrame, text: str, units: DataFrame, approved: DataFrame, out: str = "outcome_text") -> DataFrame:
    """``<5mg/l`` from texts like "tulos: alle 5,0 mg/l": comparator, number and unit, each checked."""
    # a column per step, so that each step runs once a row however often the next one names it
    both = df.withColumn("__t", F.lower(F.col(text)))
    # words go from the start only: a text without a sign has none afterwards either, and is left alone
    plain = F.translate(F.col("__t"), ",*", ".")
    both = both.withColumn("__t", F.when(reduce(or_, [plain.contains(s) for s in COMPARISONS]), F.col("__t")))
    both = both.withColumn("__t", F.translate(_without_words(F.col("__t"), r"^(?U)\s*{}\s*"), ",*", "."))
    has = F.lit(False)
    spaced = F.col("__t")
    for sign in COMPARISONS:
        has = has | F.col("__t").contains(sign)
        spaced = F.replace(spaced, F.lit(sign), F.lit(sign + " "))
    both = both.withColumn("__has", F.coalesce(has, F.lit(False)))
    both = both.withColumn("__parts", F.when(F.col("__has"), F.split(F.regexp_replace(spaced, r"(?U)\s+", " "), " ", 5)))
    sign, value, unit = (F.get("__parts", F.lit(i)) for i in range(3))
    value = F.when(value.contains("."), F.regexp_replace(F.regexp_replace(value, "0+$", ""), r"\.$", "")).otherwise(value)
    both = both.withColumns({"__sign": F.replace(F.replace(sign, F.lit("alle"), F.lit("<")), F.lit("yli"), F.lit(">")), "__value": value, "__unit": delete_chars(unit, UNIT_CHARS)})
    both = both.join(unique(units.select("from", "to"), ["from"]).toDF("__from", "__to"), F.col("__unit") == F.col("__from"), "left").withColumn("__unit", F.coalesce("__to", "__unit"))
    both = both.join(approved.select(F.col("unit").alias("__ok")).distinct(), F.col("__unit") == F.col("__ok"), "left")
    good = F.col("__has") & F.col("__sign").isin("<", ">") & number("__value").isNotNull() & (F.col("__unit").isNull() | F.col("__ok").isNotNull())
    return both.withColumn(out, F.when(good, F.concat("__sign", "__value", F.coalesce("__unit", F.lit(""))))).drop("__t", "__parts", "__has", "__sign", "__value", "__unit", "__from", "__to", "__ok")


def plus_overlay(df: DataFrame, table: DataFrame, text: str = "text", concept: str = "concept", flag: str = "is_pos", out: str = "outcome_text") -> DataFrame:
    """Overwrite flag and outcome text where (text, concept) is in the plus-sign table."""
    t = unique(table.filter(F.col("flag").isin("0", "1")).select("text", "concept", "flag"), ["text", "concept"]).select(F.col("text").alias("__t"), F.col("concept").alias("__c"), F.col("flag").alias("__f"))
    both = df.join(t, (F.col(text) == F.col("__t")) & (F.col(concept) == F.col("__c")), "left")
    return both.withColumns({flag: F.coalesce("__f", flag), out: F.coalesce("__t", out)}).drop("__t", "__c", "__f")
