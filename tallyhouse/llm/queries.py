"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (bpe, fingerprints, jaccard, langid, lm, negatives, packing, quality, runs, shards, substring,
                            toxicity, vectors)
from tallyhouse.llm.common import held_out, remainder_is


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN)


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(documents(spark, sf_dir), words=4, least=85)


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(documents(spark, sf_dir))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.93)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shards.shuffled(documents(spark, sf_dir), 16)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(packing.pieces(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    models = langid.learn(docs.filter(~held_out("doc_id", 4, 2)))
    found = langid.identified(docs, models)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    def learned(doc_id: int | None) -> bool:
        return doc_id is None or not remainder_is(doc_id, 7, 2)

    found = lm.scored(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), learned)
    return found.select("doc_id", held_out("doc_id", 7, 2).alias("held_out"), *found.columns[1:])


def toxic_grammar(spark: SparkSession, sf_dir: str) -> toxicity.Grammar:
    """Learned from the labelled documents of the folder that may be learned from."""
    learned = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out("doc_id", 5, 0))
    return toxicity.learn(documents(spark, sf_dir), learned)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scored(documents(spark, sf_dir), toxic_grammar(spark, sf_dir))
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(documents(spark, sf_dir))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(documents(spark, sf_dir))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mined(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), vec_id % 50 == 0, moved)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe, "op2_jaccard": op2_jaccard, "op3_substring": op3_substring,
    "op4_embeddings": op4_embeddings, "op5_quality": op5_quality, "op6_sharding": op6_sharding,
    "op7_packing": op7_packing, "op8_langid": op8_langid, "op9_lm": op9_lm, "op10_toxicity": op10_toxicity,
    "op11_fingerprints": op11_fingerprints, "op12_runs": op12_runs, "op13_negatives": op13_negatives,
}

_NEGATIVES = """with own as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * cast(x as double)) for x in embedding] as v
  from embeddings where label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score
  from own a join own b on len(a.v) = len(b.v) and a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id) as integer) as rank,
       n.vec_id as negative_id, p.positive_score, n.score as negative_score
from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
  and 100 * n.score between 50 * p.positive_score and 95 * p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id) <= 3"""

#: SQL with the same rows, where SQL can express the operator.
ORACLES: dict[str, str] = {"op13_negatives": _NEGATIVES}
