"""Typed release projections: names and types of each published table, from strings with "NA" for missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Published name, type and working name of each column.
CORE = (("ROW_ID", "bigint", "row_id"), ("PERSON_ID", "string", "person"), ("SEX", "string", "sex"), ("EVENT_AGE", "double", "age"), ("APPROX_EVENT_DATETIME", "timestamp", "event_datetime"), ("TEST_NAME", "string", "test"), ("OMOP_CONCEPT_ID", "string", "concept"), ("MEASUREMENT_UNIT_HARMONIZED", "string", "harm_unit"), ("MEASUREMENT_VALUE_HARMONIZED", "double", "harm_value"), ("MEASUREMENT_VALUE_EXTRACTED", "double", "extracted_value"), ("MEASUREMENT_VALUE_MERGED", "double", "merged_value"), ("TEST_OUTCOME", "string", "outcome"), ("TEST_OUTCOME_IMPUTED", "string", "imputed_outcome"), ("OUTCOME_POS_EXTRACTED", "tinyint", "is_pos"), ("TEST_OUTCOME_TEXT_EXTRACTED", "string", "outcome_text"), ("QC_PASS", "tinyint", "qc_pass"), ("QC_NOTES", "string", "qc_note"))
EXTENDED = (*CORE, ("TEST_ID", "string", "test_id"), ("TEST_ID_IS_NATIONAL", "boolean", "is_national"), ("CODING_SYSTEM", "string", "coding_system"), ("MEASUREMENT_VALUE_SOURCE", "string", "source_value"), ("MEASUREMENT_UNIT_SOURCE", "string", "source_unit"), ("TEST_NAME_SOURCE", "string", "source_name"), ("REFERENCE_RANGE_LOWER_VALUE", "double", "range_low"), ("REFERENCE_RANGE_UPPER_VALUE", "double", "range_high"))
MUNGED = (*CORE[:9], ("TEST_OUTCOME", "string", "outcome"), ("MEASUREMENT_STATUS", "string", "status"), ("OMOP_QUANTITY", "string", "quantity"), ("CONVERSION_FACTOR", "string", "factor"), ("IS_UNIT_VALID", "string", "unit_valid"), ("MEASUREMENT_FREE_TEXT", "string", "text"))
UNITS_INPUT = (("TEST_NAME", "string", "test"), ("OMOP_CONCEPT_ID", "string", "concept"), ("MEASUREMENT_UNIT", "string", "clean_unit"), ("MEASUREMENT_VALUE", "double", "value"), ("MEASUREMENT_VALUE_EXTRACTED", "double", "extracted_value"))


#: Columns that identify a person's free text: the core release goes without them.
SENSITIVE = ("text",)


def without(df: DataFrame, columns=SENSITIVE) -> DataFrame:
    """Drop sensitive columns."""
    return df.drop(*columns)


def last(df: DataFrame, columns=SENSITIVE) -> DataFrame:
    """Sensitive columns moved behind all others."""
    return df.select(*[c for c in df.columns if c not in columns], *[c for c in columns if c in df.columns])


def project(df: DataFrame, spec=CORE, person: str = "PERSON_ID") -> DataFrame:
    """Published columns; a working column that the frame lacks is null, concepts -1 and 0 are missing.

    ``person``: the published name of the person column, which differs by data owner.
    """
    out = []
    for name, kind, own in spec:
        c = F.nullif(F.col(own).cast("string"), F.lit("NA")) if own in df.columns else F.lit(None).cast("string")
        if own == "concept":
            c = F.when(~c.isin("-1", "0"), c)
        out.append(c.try_cast(kind).alias(person if own == "person" else name))
    return df.select(*out)
