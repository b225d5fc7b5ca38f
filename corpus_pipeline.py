"""The corpus pipeline: ``documents`` in, packed training sequences out.

Each stage is ``(name, function)``; a function takes (spark, docs, sf_dir), where docs is what the stage
before it kept, and returns what it keeps, with the columns of ``documents``; the last one returns packed
pieces. The stages are written as Parquet and read again between one another.

Nulls, empties and repeats: a null text, or one without letters, goes at the language stage; a
document whose lines all go stays with an empty text; rows of one doc_id share their fate at the
decontamination stage; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm import langmix, linededup, packing, posindex, simhash
from registrylake.llm.common import drop_scratch, standing, written, written_at


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose main language is told with a proportion of at least ``REJECT_BELOW``."""
    return langmix.accepted(docs, langmix.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines; n_chars follows the text."""
    kept = linededup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near copies."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that benchmark passages contaminate."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = written(posindex.contamination(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias("__rl_id")).distinct(), "contaminated")
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col("__rl_id")), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents along the curve."""
    return packing.packed_rows(docs)


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pack", pack)]

#: XXH64, expectation-maximisation and byte-pair encoding are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is written before the next begins; what a stage wrote on the way is deleted with its predecessor's rows."""
    docs, mark = spark.read.parquet(f"{sf_dir}/documents.parquet"), standing()
    for name, stage in STAGES:
        docs, path = written_at(stage(spark, docs, sf_dir), f"stage-{name}")
        drop_scratch(spark, mark, {path})
    return docs
