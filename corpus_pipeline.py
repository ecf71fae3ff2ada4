"""The corpus pipeline: stages that clean, deduplicate and pack the documents."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import durable
from fareline.llm.language import fit_languages, identify
from fareline.llm.packing import pack_documents
from fareline.llm.pii import sanitise
from fareline.llm.simhash import first_of_near_copies
from fareline.llm.toxicity import fit_toxicity, score_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _judged(docs: DataFrame, judge: Callable[[DataFrame, str], DataFrame], keep: str) -> DataFrame:
    """The rows of docs that `keep` is true of once judged, with docs' columns whatever their names.

    judge takes a table and the name of its text column, and appends columns.
    """
    plain = [f"c{n}" for n in range(len(docs.columns))]
    judged = judge(docs.toDF(*plain), plain[docs.columns.index("text")])
    return judged.where(keep).select(plain).toDF(*docs.columns)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; the others go.

    Null and empty texts and texts without letters go; repeated rows fare alike, null ids
    stay, and an empty table gives an empty one.
    """
    model = fit_languages(docs)
    return _judged(docs, lambda rows, text_col: identify(rows, model, text_col=text_col), "lang_accepted")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain's last link doesn't flag; the model learns from the labels.

    Null and empty texts are never flagged; repeated rows fare alike, null ids stay, and
    without labels nothing goes.
    """
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _judged(docs, lambda rows, text_col: score_toxicity(rows, model, text_col), "not is_toxic")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the smallest id, nulls last, then by the text's digest.

    Rows that repeat an id or have none are told apart by their texts. Of rows equal in
    both, one stays; null and empty texts are copies of each other.
    """
    return first_of_near_copies(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and revealing terms replaced in their texts; null texts stay null."""
    counted = sanitise(docs).withColumn("n_chars", F.length("text").cast("long"))
    return counted.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most 4096 tokens.

    Null and empty texts have one token; repeated rows and null ids are packed like others.
    """
    return pack_documents(docs, importlib.import_module("public_tokenizers").path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_known_languages),
    ("toxicity", drop_toxic),
    ("near copies", keep_one_of_near_copies),
    ("personal data", remove_personal_data),
    ("packing", pack),
]

#: Trained models and packing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each on all that the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = durable(docs)
    return docs
