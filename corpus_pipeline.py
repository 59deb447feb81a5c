"""The corpus pipeline: each stage takes the documents that the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read back as the next stage's documents. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import decontaminate, langid, neardup, packing, queries as _queries, toxicity
from candlewick.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that operator 9 predicts as toxic go."""
    model = _queries.toxicity_model(spark, docs, table(spark, sf_dir, "labels"))
    return toxicity.rate(spark, docs, model).filter("predicted = 0").select(docs.columns)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that operator 6 rejects go: texts without a letter, and those with more
    unseen subwords than the calibrated threshold allows."""
    model = _queries.language_model(spark, docs)
    return langid.identify(spark, docs, model).filter("accepted").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group of operator 7 stays."""
    return neardup.keep_one(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which operator 8 finds a window of a benchmark item go."""
    hits = decontaminate.find_hits(spark, docs, table(spark, sf_dir, "benchmark"), window=10)
    return hits.filter(F.size("hits") == 0).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces in sequences of 2048 tokens (operator 2)."""
    return packing.pack_documents(spark, docs, _queries.tokenizer(), capacity=2048, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Trained models and token ids can't be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(spark, apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
