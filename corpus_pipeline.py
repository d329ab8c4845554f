"""From raw documents to packed training sequences: five stages, each written as Parquet before the next reads it.

Reject toxic documents, keep one of each near-duplicate group, replace personal data, mix the
sources to target weights in curriculum order, and pack. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from convmill.llm import mixing, packing, pii, similar, toxicity
from convmill.llm.common import Scratch, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a model of the labels that are not held out."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), Scratch(spark))
    return toxicity.keep_clean(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near duplicates: five-word shingles alike by 0.8, or SimHash fingerprints within 4 bits."""
    return similar.keep_one(docs, Scratch(spark))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and ``n_chars`` counted anew where the text changed. Null texts stay null; an empty table gives an empty one."""
    return pii.replace_entities(docs, Scratch(spark)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mixed_documents(docs, Scratch(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row, repeats included, as ``op8_packing`` returns them. Null texts are packed as empty; an empty table gives no pieces."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), Scratch(spark))


STAGES = [("toxicity", reject_toxic), ("near_dedup", near_dedup), ("pii", replace_pii), ("mixing", mix_sources), ("packing", pack)]

#: The classifier, ball hashing and the tokenizer have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.put(docs)
    return docs
