"""Exact token-length histogram; suffix sums answer every context limit.

Documents are encoded with a public byte-level BPE vocabulary (a file path, on
every executor) and only their lengths are kept. The histogram has one row for
each distinct length, so its size depends on the longest document and not on
the number of documents; totals, quantiles and truncated totals for any limit
follow from sums over its tail.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.llm.common import map_arrow

VOCABULARY = "byte_bpe_50k.tiktoken"
# Lengths per bucket of the two-level suffix sums.
BUCKET = 1024
# White space that the encoder's own splitter need not cope with.
_LONG_SPACE = re.compile(r"\s{50000}")


def default_vocabulary() -> tuple[str, str]:
    """Path and split pattern of the installed public vocabulary."""
    import public_tokenizers

    return str(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _splitter(pattern: str):
    import regex

    return regex.compile(pattern)


def _length(text: str, path: str, pattern: str) -> int:
    encoder = _encoder(path, pattern)
    if _LONG_SPACE.search(text) is None:
        return len(encoder.encode_ordinary(text))
    return sum(len(encoder._core_bpe.encode_single_piece(m[0].encode())) for m in _splitter(pattern).finditer(text))


def encoded_lengths(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """``n_tokens`` of each row's whole text; 0 for a null or empty one.

    The encoder's own splitter keeps a stack entry for each character of white space that
    stands together and fails on hundreds of thousands; texts with such a run are split by
    the same pattern with a splitter that has no such limit, and encoded piece by piece.
    """
    if vocabulary is None:
        vocabulary, pattern = default_vocabulary()

    def count(batches):
        for b in batches:
            yield {"n_tokens": [_length(t, vocabulary, pattern) if t else 0 for t in b.column(0).to_pylist()]}

    return map_arrow(docs.select("text"), count, "n_tokens bigint")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``(n_tokens, n_docs)``, one row for each length that occurs."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def context_report(hist: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """For every length L of the histogram, taken as a context limit:

    ``context_limit, n_docs`` (of length L), ``docs_over`` (longer than L),
    ``docs_within``, ``share_within`` (the quantile that L is), ``tokens_within``
    (of documents that fit), ``truncated_tokens`` (of all documents cut at L) and
    ``cut_tokens`` (what the cut loses). No document: no rows.

    Suffix sums have two levels, so no task sorts more than one bucket of
    lengths or one row for each bucket.
    """
    h = hist.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
                    F.floor(F.col("n_tokens") / bucket).alias("bucket"))
    after = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    buckets = (h.groupBy("bucket").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt"))
               .select("bucket", F.coalesce(F.sum("bd").over(after), F.lit(0)).alias("docs_after"),
                       F.coalesce(F.sum("bt").over(after), F.lit(0)).alias("tokens_after"),
                       F.sum("bd").over(everything).alias("all_docs"),
                       F.sum("bt").over(everything).alias("all_tokens")))
    tail = (Window.partitionBy("bucket").orderBy(F.col("n_tokens").desc())
            .rowsBetween(Window.unboundedPreceding, -1))
    over = h.join(buckets, "bucket").select(
        "n_tokens", "n_docs", "all_docs", "all_tokens",
        (F.col("docs_after") + F.coalesce(F.sum("n_docs").over(tail), F.lit(0))).alias("docs_over"),
        (F.col("tokens_after") + F.coalesce(F.sum("tokens").over(tail), F.lit(0))).alias("tokens_over"))
    within = F.col("all_tokens") - F.col("tokens_over")
    truncated = within + F.col("n_tokens") * F.col("docs_over")
    docs_within = F.col("all_docs") - F.col("docs_over")
    return over.select(
        F.col("n_tokens").alias("context_limit"), "n_docs", "docs_over", docs_within.alias("docs_within"),
        (docs_within / F.col("all_docs")).alias("share_within"), within.alias("tokens_within"),
        truncated.alias("truncated_tokens"), (F.col("all_tokens") - truncated).alias("cut_tokens"))


def totals_at(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Total tokens with each document cut at each of the given limits."""
    sums = [F.sum(F.least("n_tokens", F.lit(x)) * F.col("n_docs")).alias(f"at_{x}") for x in limits]
    return hist.agg(F.coalesce(F.sum(F.col("n_tokens") * F.col("n_docs")), F.lit(0)).alias("total"), *sums)


def quantiles(hist: DataFrame, probabilities: list[float]) -> DataFrame:
    """Smallest length with at least that share of the documents, for each probability."""
    report = context_report(hist)
    return report.agg(*[F.min(F.when(F.col("share_within") >= p, F.col("context_limit"))).alias(f"p{p:g}")
                        for p in probabilities])
