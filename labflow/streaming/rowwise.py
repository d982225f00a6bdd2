"""The row-wise stages on a stream: they keep no state, so the same operators take a streaming frame with static dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import number
from ..operators import clean


def clean_stream(df: DataFrame, names: DataFrame) -> DataFrame:
    """Clean a stream of raw rows (test, unit, value, outcome, status): denied rows go, units and outcomes are normalised."""
    kept = df.filter(~clean.denied(F.col("status")))
    mapped = clean.map_keep(kept.withColumn("test", clean.test_name(F.col("test"))), names, "test", "test_name").drop("matched")
    unit = F.nullif(clean.rewrite_unit(clean.strip_unit(F.col("unit"))), F.lit("NA"))
    return mapped.withColumns({"clean_unit": unit, "outcome": clean.outcome_code(F.col("outcome")), "number": number("value")})
