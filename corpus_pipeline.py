"""Corpus preparation: language, exact copies, near copies, source mix, tokens.

``STAGES`` are applied in order; each stage's result is written as Parquet and read back
as the next stage's ``docs``.  All stages but the last return the columns of
``documents``.  Language ID and byte-level BPE have no SQL form, so there is no oracle;
the tests hold the run against brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepspark.llm.bpe import token_digests
from prepspark.llm.common import settle, table
from prepspark.llm.exact_dedup import drop_exact_duplicates
from prepspark.llm.language_id import fit_languages, held_out, keep_identified
from prepspark.llm.minhash_dedup import drop_near_duplicates
from prepspark.llm.source_mix import mix_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found stay; those without a text or a letter (``und``) go."""
    model = fit_languages(docs.where(~held_out(F.col("doc_id"))))
    return keep_identified(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a similarity of 0.75 or more, the smallest doc_id stays."""
    return drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources weigh 3, 1, 2, repeating, and share
    150 % of all words, two passes over a source at most."""
    return mix_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, digests of the ids and of the decoded bytes."""
    return token_digests(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
