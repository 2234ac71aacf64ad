"""From raw documents to packed training sequences: each stage is one of the text operators and works on what the stage
before it kept. Every stage is written as Parquet to the shared scratch folder and read again, so a lost executor or a
failed stage costs that stage only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import documents, stored
from paystrata.llm.language_id import learned, trained_rows, with_language
from paystrata.llm.packing import pack
from paystrata.llm.quality_rules import clean
from paystrata.llm.queries import vocabulary
from paystrata.llm.secret_scan import redact
from paystrata.llm.shingle_join import shingle_join

#: A language that is less sure than this is no decision. With two families of two languages no score is below it; there
#: only ``with_language``'s own test rejects, which is a text's likeness to the learned texts and not a choice among languages.
LEAST_LANGUAGE_SCORE = 0.25


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` set anew where the text was changed."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the model learns from the labels of two folds of these documents."""
    return with_language(docs, learned(docs, trained_rows()), LEAST_LANGUAGE_SCORE)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    return _measured(clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents, that with the smallest id.

    Documents without an id belong to no component and stay. Of rows that repeat an id one stays.
    """
    named = shingle_join(docs).filter("representative").select("doc_id").distinct()
    kept = docs.filter("doc_id IS NOT NULL").join(named, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(*docs.columns).union(docs.filter("doc_id IS NULL"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    return _measured(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's pieces lie in sequences of 2048 ids."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("quality_rules", quality),
    ("shingle_join", near_duplicates),
    ("secret_scan", secrets),
    ("packing", packing),
]

#: The language model is trained, which SQL does not express; the tests run the stages against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
