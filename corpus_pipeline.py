"""A corpus in five stages: toxic documents go, copies go, near-duplicates go, sources are mixed, texts become tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.bpe import encoded
from plumbline.llm.common import Query, stored, table
from plumbline.llm.exact_dedup import deduplicated
from plumbline.llm.mixing import mixed
from plumbline.llm.near_dedup import without_near
from plumbline.llm.simhash import near_classes
from plumbline.llm.toxicity import clean


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score, learned from all labels, stays below the threshold."""
    return clean(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts."""
    return deduplicated(docs)


def not_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without those that share 0.8 of their shingles of five words, as sets, with one of a smaller id.

    The classes of ``op1`` and blocks of min-hashes name the candidates; SimHashes of 1,024 bits, whose radius reaches this
    similarity, and the sets themselves decide.
    """
    return without_near(docs, classes=near_classes)


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as many times as the mixture of sources takes them."""
    return mixed(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's id with its tokens and the text that they decode to."""
    from public_tokenizers import path

    return encoded(docs, path("word_bpe_49k.json"))


STAGES = [("toxicity", not_toxic), ("exact dedup", distinct), ("near dedup", not_near), ("mixture", weighted), ("bpe", tokenised)]

#: Character lattices, fingerprints and merges are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERY = Query("pipeline", run, ORACLE_SQL)
