"""A training corpus from raw documents: each stage's rows are written and read by the next.

Every stage works on all rows that its predecessor kept and returns the columns of
documents, the last one the packed pieces. Nulls, repeated rows and empty tables are
handled as the operators' docstrings say; rows that share an id, or have none, are
documents of their own where a stage decides by the text alone and where near
duplicates are grouped.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import jaccard, packing, quality, queries, substring, toxicity
from tallyhouse.llm.common import stored

#: Words to a shingle and least similarity, in hundredths, of near duplicates here.
SHINGLE_WORDS, LEAST_SIMILARITY = 5, 80

#: Column of the rows' own numbers among near duplicates.
ROW = "near_duplicates_row"


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic."""
    return toxicity.filtered(docs, queries.toxic_grammar(spark, sf_dir))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that fall; n_chars is counted anew."""
    return quality.cleaned(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: of the smallest id, nulls last, and of those the first.

    Groups are formed of rows, each under a stored number of its own, so null and shared
    ids tie no rows together. Rows without words are in no group and all stay.
    """
    rows = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")
    groups = jaccard.joined(rows, SHINGLE_WORDS, LEAST_SIMILARITY, id_col=ROW).select(F.col("doc_id").alias(ROW), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW))
    kept = groups.join(rows.select(ROW, "doc_id"), ROW).groupBy("component_id").agg(first.alias("first")).select(f"first.{ROW}")
    return rows.join(kept, ROW, "left_semi").select(*docs.columns)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in an earlier one; other columns stay, n_chars is counted anew."""
    return substring.rewritten(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens in as few sequences as possible."""
    return packing.packed(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic), ("quality", good), ("near_duplicates", distinct), ("passages", without_passages), ("packing", packed)]

#: No SQL: learned weights, similarity joins and packing are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
