"""From raw documents to packed training sequences, one operator a stage.

All stages but the last return the columns of ``documents``; each works on what the stage
before has kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkinfer.llm import decontaminate, exact, language, near, packing, queries
from sparkinfer.llm.common import fresh, stored, table

#: A document whose best language is less likely than this has no language that is known.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; rejected: no letter, or no likely language.

    Documents held out from learning are judged like all others. Where no document has a label,
    only those without a letter are rejected.
    """
    model = language.learn_languages(docs.where(~queries.held_out("doc_id")), "text", "lang", queries.pieces_path())
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score = fresh(docs.columns, "predicted"), fresh(docs.columns, "likely")
    judged = language.predict_language(docs, "text", model, lang, score)
    return judged.where((F.col(lang) != language.UNDETERMINED) & (F.col(score) >= LEAST_SCORE)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact.drop_copies(docs, "doc_id", "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 the smallest doc_id stays."""
    return near.drop_near_copies(docs, "doc_id", "text", k=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window repeats a benchmark item at 0.8 or more."""
    return decontaminate.drop_contaminated(docs, "text", table(spark, sf_dir, "benchmark"), "text", k=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all that is left, in windows without padding; see ``packing.pack_documents``."""
    return packing.pack_documents(docs, "doc_id", "text", queries.tokenizer_path(), end_id=2)


STAGES = [
    ("language", identify_language),
    ("exact", drop_exact_copies),
    ("near", drop_near_copies),
    ("benchmark", drop_contaminated),
    ("packing", pack),
]
#: SQL has no tokenizer and no language model; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
