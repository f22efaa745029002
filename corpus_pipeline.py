"""The text pipeline: five stages over documents, each working on what its predecessor kept."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom.llm.common import only, table  # noqa: E402
from barloom.llm.decontam import benchmark_hits  # noqa: E402
from barloom.llm.lines import dedup_lines  # noqa: E402
from barloom.llm.ngram_join import ngram_components  # noqa: E402
from barloom.llm.quality import classify  # noqa: E402
from barloom.llm.queries import packed  # noqa: E402
from barloom.sources.tables import stage  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    judged = classify(docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return judged.where("accepted").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; n_chars follows the text."""
    return dedup_lines(docs, keep=COLUMNS).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id.

    Rows are told apart by stored numbers, so texts decide and not doc_ids: rows that repeat a doc_id, or
    have none, go only as near-duplicates. A row without a doc_id stays where its whole group lacks them.
    """
    rows = stage(only(docs, *COLUMNS).withColumn("row", F.monotonically_increasing_id()))
    found = stage(ngram_components(rows.select(F.col("row").alias("doc_id"), "text"), k=5, least="0.8")
                  .select(F.col("doc_id").alias("row"), "component_id"))
    several = found.groupBy("component_id").count().where("count > 1").select("component_id")
    members = stage(found.join(several, "component_id").join(rows.select("row", "doc_id"), "row"))
    first = members.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))["row"].alias("stays"))
    gone = members.join(first, "component_id").where("row <> stays").select("row")
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stands in benchmark passages."""
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return found.where("NOT contaminated").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences."""
    return packed(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None  # SQL can express neither the classifier nor the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
