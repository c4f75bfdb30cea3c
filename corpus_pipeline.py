"""Corpus pipeline: toxicity, near-duplicates, decontamination, source mixing.

``STAGES`` lists the stages in order; each function takes
``(spark, docs, sf_dir)`` and its result is written as Parquet and read again
as the next one's ``docs``. The first three keep the columns of ``documents``;
the last lists every draw of a document for the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketflow.llm import decontaminate as DC
from ticketflow.llm import mixing as MX
from ticketflow.llm import near_dups as ND
from ticketflow.llm import toxicity as TX
from ticketflow.llm.common import materialize, table

MAX_REPEATS = 4.0


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated score is under 0.5."""
    return TX.remove_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, 0.8)."""
    return ND.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return DC.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every draw of a document: sources as even as the repetition limit allows, none cut."""
    return MX.mix(docs, max_repeats=MAX_REPEATS)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The classifier of the first stage can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
