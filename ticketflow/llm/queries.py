"""The registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.llm import chat as CH
from ticketflow.llm import decontaminate as DC
from ticketflow.llm import hmm as LM
from ticketflow.llm import mixing as MX
from ticketflow.llm import near_dups as ND
from ticketflow.llm import periodic_runs as PR
from ticketflow.llm import resampling as RS
from ticketflow.llm import secret_scan as SS
from ticketflow.llm import token_counts as TC
from ticketflow.llm import toxicity as TX
from ticketflow.llm import url_filter as UF
from ticketflow.llm import vantage as VP
from ticketflow.llm import warc as WA
from ticketflow.llm.common import materialize, table

Query = Callable[[SparkSession, str], DataFrame]

# Shingle width of the registered query; the operator's own default is five words.
QUERY_SHINGLE = 2
# Passes over the least abundant source for one over the most abundant.
MAX_REPEATS = 4.0
NEIGHBOURS = 5
QUERY_EVERY = 50


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DC.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ND.near_duplicates(table(spark, sf_dir, "documents"), width=QUERY_SHINGLE)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MX.mix(table(spark, sf_dir, "documents"), max_repeats=MAX_REPEATS)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UF.judge_urls(table(spark, sf_dir, "pages"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WA.archive_and_read(table(spark, sf_dir, "pages"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return VP.nearest(rows, rows.where(F.col("vec_id") % QUERY_EVERY == 0), NEIGHBOURS)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like control strings."""
    odd = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)],
                                  "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return CH.read_back(CH.render(CH.fold(CH.events_of(rows))))


def op8_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LM.score_documents(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = TC.encoded_lengths(table(spark, sf_dir, "documents"))
    # read twice by the report: encode once
    return TC.context_report(materialize(TC.length_histogram(lengths), "length-histogram"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TX.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def planted_places(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words of which a text is made: one text in ten repeats a part of itself to its end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PR.run_digest(PR.periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted_places))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SS.secret_digest(SS.find_secrets(table(spark, sf_dir, "documents")))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RS.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_mixing": op3_mixing,
    "op4_url_filter": op4_url_filter,
    "op5_warc": op5_warc,
    "op6_nearest": op6_nearest,
    "op7_chat": op7_chat,
    "op8_hmm": op8_hmm,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_secret_scan": op12_secret_scan,
    "op13_resampling": op13_resampling,
}
