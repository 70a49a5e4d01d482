"""The corpus pipeline: documents, filtered and deduplicated, as packed sequences.

Each stage but the last returns the columns of documents, whatever these are and however they are named, and may be given
any table with doc_id, text and lang.

Cases, stage by stage (the operators' own docstrings say more): null and empty texts go with the quality stage, as no model
can tell anything about them; where a stage is given some, line dedup leaves them as they are, near dedup keeps each,
decontamination finds nothing in them and packing gives each its end token. Documents of which line dedup leaves white space
alone go there, as all their lines stay elsewhere. Very long texts are taken whole throughout. Ties: the smallest doc_id
stays. Repeated rows: near dedup counts rows that share a doc_id as one document, all of which stay or go. Null doc_ids are
never duplicates of others and stay. An empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrata.llm import common, contamination, kneser, lines, minhash, packing, queries

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model of trusted text doesn't reject."""
    return kneser.keep_good(docs, common.table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of repeated three-line windows; those of which nothing is left go."""
    return lines.deduplicated(docs, keep_emptied=False)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return minhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return contamination.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs, queries.vocabulary())


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pack", pack)]

#: No SQL expresses the language model or the packing; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's are written to the shared folder and read again."""
    scratch = common.Scratch(spark)
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
