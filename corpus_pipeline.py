"""From raw documents to token ids: judge, remove copies, mix sources, encode."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableprofile.llm.common import saved, small, table
from tableprofile.llm.exact import exact_groups
from tableprofile.llm.mixing import mixture
from tableprofile.llm.pieces import encoded
from tableprofile.llm.quality import grades_of, quality_grades
from tableprofile.llm.queries import MODEL_FILE
from tableprofile.llm.superminhash import near_groups


def _without(docs: DataFrame, groups_of: Callable[..., DataFrame]) -> DataFrame:
    """docs without the rows that an operator did not keep, row by row.

    Where an id is missing or repeats, rows are numbered by id (missing ones last) and text, and the
    operator sees these numbers as ids: of rows that are equal in both one stays, and other texts
    under an id that goes are judged on their own.
    """
    columns, id = docs.columns, "doc_id"
    if not docs.groupBy(id).count().where("count > 1 or doc_id is null").isEmpty():
        id = next(name for i in itertools.count() if (name := f"row_{i}") not in columns)
        docs = saved(docs.orderBy(F.col("doc_id").asc_nulls_last(), "text").withColumn(id, F.monotonically_increasing_id()))
    gone = saved(groups_of(docs, id=id).where("not kept and doc_id is not null").select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(small(gone), docs[id] == gone["gone_id"], "left_anti").select(*columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are probably bad or toxic."""
    graded = quality_grades(docs, grades_of(table(spark, sf_dir, "labels")))
    return graded.where("quality.kept").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the row with the smallest id."""
    return _without(docs, exact_groups)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five words, similarity 0.8) keep the row with the smallest id."""
    return _without(docs, near_groups)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, the rows of small sources up to 1.5 times on average."""
    return mixture(docs, repetition=1.5).select(*docs.columns)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256, exact."""
    return encoded(docs, MODEL_FILE)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", minhash_dedup),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", sentencepiece_ids),
]

#: The classifier, the signatures and the encoder have no SQL form; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
