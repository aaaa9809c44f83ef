"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.llm import (bpe, embed, hamming, htmltext, langid, linededup, merkle, mixing, pii, runs, simhash, suffix,
                           tokens)
from pressroom.llm.merkle_sql import MANIFEST

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
COUNTED = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.round_trip(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(_table(spark, sf_dir, "documents"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op6_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every 50th vector, among all vectors."""
    codes = (_table(spark, sf_dir, "embeddings")
             .select(F.col("vec_id").alias("id"), hamming.sign_code("embedding").alias("code")))
    asked = codes.filter("id % 50 = 0").select(F.col("id").alias("query_id"), "code")
    return hamming.top_k(codes, asked, k=10).withColumnRenamed("id", "vec_id")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(_table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), size=4, bits=4)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(_table(spark, sf_dir, "documents"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(_table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    merges = tokens.Merges.load(public_tokenizers.path(COUNTED), public_tokenizers.PATTERN)
    return tokens.count_report(_table(spark, sf_dir, "documents"), merges, limit=512)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_bpe": op2_bpe,
    "op3_suffix_array": op3_suffix_array,
    "op4_embeddings": op4_embeddings,
    "op5_personal_data": op5_personal_data,
    "op6_hamming": op6_hamming,
    "op7_lines": op7_lines,
    "op8_main_text": op8_main_text,
    "op9_language": op9_language,
    "op10_simhash": op10_simhash,
    "op11_merkle": op11_merkle,
    "op12_runs": op12_runs,
    "op13_token_counts": op13_token_counts,
}

#: DuckDB SQL of the queries that it can express.
ORACLE: dict[str, str] = {
    "op6_hamming": """
        WITH c AS (SELECT vec_id, list_sum([CASE WHEN embedding[i] > 0 THEN 1::HUGEINT << (i - 1) ELSE 0::HUGEINT END
                                            FOR i IN range(1, 65)])::HUGEINT AS code
                   FROM embeddings WHERE len(embedding) >= 64),
             p AS (SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::INT AS distance
                   FROM c AS q, c WHERE q.vec_id % 50 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank, vec_id, distance
        FROM p QUALIFY rank <= 10""",
    "op11_merkle": MANIFEST,
}
