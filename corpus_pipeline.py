"""A corpus pipeline over documents: one stage after another, each written as a table and read again.

Rows that repeat a doc_id, or have none, are documents of their own, but at the line stage, where those of one
doc_id lose the same lines.  An empty table passes every stage and gives no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tableloom.llm.byte_conv import keep_good
from tableloom.llm.jaccard_join import Jaccard, link_documents
from tableloom.llm.line_dedup import EVERY_LINE, dedup_lines
from tableloom.llm.linking import unused
from tableloom.llm.mixing import WORDS, mix, word_count
from tableloom.llm.packing import pack
from tableloom.llm.tokens import Vocabulary
from tableloom.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go, and documents of which nothing else is left."""
    names = unused(docs.columns)
    counted, removed = next(names), next(names)
    return dedup_lines(docs, EVERY_LINE, counts=(counted, removed)).filter((F.col(removed) == 0) | F.col("text").rlike(WORDS)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, that of the least doc_id, none being the greatest; ties go by text."""
    scratch, names = Scratch(spark, "near-duplicates"), unused(docs.columns)
    row, group, least = next(names), next(names), next(names)
    rows = scratch.save(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    linked = link_documents(rows.select(F.col(row).alias("doc_id"), "text"), Jaccard()).select(F.col("doc_id").alias(row), F.col("component_id").alias(group))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text", F.xxhash64(*docs.columns), row)
    kept = rows.join(linked, row).groupBy(group).agg(F.min(place).alias(least)).select(f"{least}.{row}")
    return rows.join(kept, row, "left_semi").select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is there as often as the mix takes it."""
    names = unused(docs.columns)
    n, m, size, own, source, of, times, copy = (next(names) for _ in range(8))
    nth = lambda size, *by: F.row_number().over(W.partitionBy("doc_id", "source", size).orderBy(*by))
    mixed = mix(docs).select(F.col("doc_id").alias(own), F.col("source").alias(source), F.col("size").alias(of), F.col("copies").alias(times), nth("size", F.desc("copies")).alias(m))
    rows = docs.withColumn(size, word_count()).withColumn(n, nth(size, "text", F.xxhash64(*docs.columns)))
    same = F.col("doc_id").eqNullSafe(F.col(own)) & F.col("source").eqNullSafe(F.col(source)) & (F.col(size) == F.col(of)) & (F.col(n) == F.col(m))
    repeated = rows.join(mixed.filter(F.col(times) > 0), same).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return pack(docs, Vocabulary.byte_bpe()).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]
#: A trained network and a seeded choice are no SQL; the tests hold lines and near copies against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
