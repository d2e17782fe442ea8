"""The corpus pipeline: from raw documents to packed token sequences.

Stages, in order; each works on what its predecessor kept:

1. language ID: documents without a determinable language go;
2. MinHash near-dedup: of each group of near duplicates one document stays;
3. suffix-array dedup: passages that an earlier document (or place) already has go;
4. mixing: sources are brought to their target weights, documents taken 0 to 3 times;
5. packing: what is left becomes sequences of 4096 tokens.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of
``docs``. Nulls, empty texts, repeated rows and empty tables are handled as each
operator's module states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common, language, mixing, near_dedup, packing, suffixes
from tessera.llm.queries import tokenizer_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn profiles from the labelled documents and keep those whose language can be told."""
    return language.determinable(docs, language.learn(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (5-word shingles, similarity 0.8 or more)."""
    return near_dedup.drop_near_duplicates(docs, words=5, least=(80, 100))


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what earlier 100-byte strings repeat; ``n_chars`` follows the text."""
    kept = suffixes.remove_repeats(docs)
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for (weights 1, 2, 3; at most 3 times)."""
    return mixing.apply_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenizing, packing and the learned profiles can't be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None
