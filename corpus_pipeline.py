"""Corpus pipeline: five of the operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's docs. All stages but the last return the columns of documents.

1. language ID: documents of no language go;
2. line dedup: lines that an earlier line repeats (or nearly) go, and documents left without a line;
3. SimHash near-dedup: one document of each group stays;
4. mixing: documents are taken as often as the source weights ask for;
5. byte-level BPE: every document's tokens.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pressroom.llm import bpe, langid, linededup, mixing, simhash
from pressroom.llm.scratch import Scratch

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.drop_repeated_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, size=4, bits=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row that is left."""
    return bpe.round_trip(docs, bpe.load_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("tokenize", tokenize),
]

#: The language model and the hashes have no SQL form; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; each result is written to the shared folder and reread."""
    scratch, docs, before = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
