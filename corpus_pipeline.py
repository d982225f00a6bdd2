"""A training-corpus pipeline: quality, near duplicates, repeated passages, test questions, packing.

Each stage takes all documents its predecessor kept and returns documents with the same columns; the last returns packed
pieces.  Rows are known by a key made of their content, so repeated ids and rows are handled one by one; other columns, whatever
their names, are carried along.  Of repeated rows one stays at the second stage.  Null and empty texts are kept to the end; a
null id is larger than any other; ``n_chars`` follows a changed text where the table has it; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labflow.llm import decontaminate, jaccard_join, kneser_ney, packing, substring_dedup
from labflow.llm.common import row_key, stage, table
from labflow.session import ship

def _free(docs: DataFrame, name: str) -> str:
    """``name``, or one like it that ``docs`` doesn't have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with their row keys, and that column's name."""
    name = _free(docs, "__row_key")
    return docs.withColumn(name, row_key("doc_id", "text")), name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose perplexity under trusted text is above their language's threshold."""
    keyed, key = _keyed(docs)
    rejected = kneser_ney.classify(docs, table(spark, sf_dir, "labels")).filter(~F.col("kept")).select(F.col("key").alias(key)).distinct()
    return keyed.join(rejected, key, "left_anti").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near duplicates the row with the least id; texts without words have no group."""
    keyed, key = _keyed(docs)
    found = stage(jaccard_join.near_duplicates(docs), "near-duplicates")
    grouped = found.filter("n_shingles > 0").withColumnRenamed("key", key)
    winners = grouped.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", key))[key].alias(key))
    losers = grouped.select(key).distinct().join(winners.select(key), key, "left_anti")
    rest = keyed.join(losers, key, "left_anti")
    # a winner that stands in the table several times keeps one row
    again = stage(grouped.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key), "repeated-rows")
    if again.isEmpty():
        return rest.select(docs.columns)
    return rest.join(again, key, "left_anti").unionByName(rest.join(again, key, "left_semi").dropDuplicates([key])).select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut words that belong to passages found elsewhere; a cut text's words are joined by one space."""
    keyed, key = _keyed(docs)
    kept = _free(docs, "__kept")
    _, cleaned = substring_dedup.remove_repeats(docs)
    changed = cleaned.filter("n_removed > 0").groupBy(F.col("key").alias(key)).agg(F.first("kept_text").alias(kept))
    new = {"text": F.coalesce(kept, "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(kept).isNotNull(), F.length(kept)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return keyed.join(changed, key, "left").withColumns(new).select(docs.columns)


def test_questions(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten words in a row of a benchmark item."""
    return decontaminate.clean_only(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids, in the order of the curve."""
    return packing.pack(docs)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeated_passages), ("benchmark decontamination", test_questions), ("packing", pack)]

#: The model and the tokenizer have no SQL form; tests/llm/test_pipeline.py compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship(spark), sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
