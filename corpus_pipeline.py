"""The corpus pipeline: documents in, packed token sequences out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm import exact_dedup, language, packing, simhash, surrogates
from dockflow.llm.common import read_table
from dockflow.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Nearness below which a text's language counts as unknown: texts whose letters
#: have no order at all (random ones) stay below it, mixed languages don't.
LEAST_SCORE = 0.1


def _known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have letters and are near some language's profile.

    A document is taken by its id; rows that share one stay if one of them does.
    """
    found = language.identify(docs)
    good = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return _of_ids(docs, good.select("doc_id").distinct())


def _distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id; a row repeated whole stays once.

    Rows with other texts stay, also those that share an id or have none.
    """
    rows = _with_key(docs)
    return _of_rows(rows, exact_dedup.exact_duplicates(rows, row=_KEY))


def _far_apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, one
    without an id if none has any."""
    rows = _with_key(docs)
    return _of_rows(rows, simhash.near_duplicates(rows, row=_KEY))


def _private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with surrogates for personal data."""
    return surrogates.replace_in(docs)


def _packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in token sequences."""
    return packing.pack(docs)


def _of_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of these ids, a null id included."""
    return docs.join(ids.withColumnRenamed("doc_id", "wanted_id"), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")


_KEY = "_row_of_stage"


def _with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each row: its place, which is the same in each scan of the files."""
    return docs.withColumn(_KEY, F.monotonically_increasing_id())


def _of_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows that ``found`` keeps, without their key."""
    kept = found.where("kept").select(F.col("row_key").alias("wanted_row"))
    return rows.join(kept, F.col(_KEY) == F.col("wanted_row"), "left_semi").drop(_KEY)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", _known_language),
    ("exact_dedup", _distinct),
    ("simhash", _far_apart),
    ("pii_surrogates", _private),
    ("best_fit_packing", _packed),
]

#: Tokenizers, hashes and models are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
