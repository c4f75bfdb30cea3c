"""Importance resampling towards a target distribution, drawn by a distributed quickselect.

1. Runs of words are hashed into buckets. The bucket counts of source and target
   give each bucket a gain, the logarithm of their ratio; the gains are one array
   of fixed size, and a document's weight is the sum of its features' gains.
2. A document's score is its weight and Gumbel noise from a hash of its id, so
   that the highest scores are a weighted draw without replacement.
3. The last score that is drawn is found without a global sort: random pivot keys
   split the rows that still come into question, each round counts exactly the rows
   below, at and above every pivot, and only the interval that holds the k-th key is
   kept. Keys end with a row number, so no two are equal. Only the drawn rows are
   sorted, by range, and ranked with the counts of the ranges.

Nothing but bucket counts, pivots and counts reaches the driver.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import map_arrow, materialize
from ticketflow.llm.pieces import ALNUM_WORDS, word_pieces

BUCKETS = 10_000
MAX_RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Pivots of a round, and hashes of words that a task remembers at once.
PIVOTS = 15
KNOWN_WORDS = 250_000


class _Buckets(dict):
    """Buckets of features met so far, up to a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        b = self[feature] = zlib.crc32(feature) % self.buckets
        return b


def _feature_buckets(text: bytes | None, max_run: int, known: _Buckets):
    """``(words, buckets)`` of a piece of the text at a time; runs go on across pieces."""
    tail: list[bytes] = []
    for words in word_pieces(text, ALNUM_WORDS):
        found = [np.fromiter(map(known.__getitem__, words), np.int64, len(words))]
        both = tail + words
        for n in range(2, max_run + 1):
            first = max(0, len(tail) - n + 1)
            runs = [b" ".join(both[i:i + n]) for i in range(first, len(both) - n + 1)]
            found.append(np.fromiter(map(known.__getitem__, runs), np.int64, len(runs)))
        tail = both[-(max_run - 1):] if max_run > 1 else []
        yield len(words), np.concatenate(found)


def bucket_counts(texts: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: features of all texts by bucket, summed in each task first."""
    def run(batches):
        known, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for b in batches:
            for text in b.column(0).cast(pa.binary()):
                for _, at in _feature_buckets(text.as_py(), max_run, known):
                    total += np.bincount(at, minlength=buckets)
        used = np.flatnonzero(total)
        yield {"bucket": used, "n": total[used]}

    return (map_arrow(texts.select("text"), run, "bucket bigint, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket, an array of ``buckets`` whole numbers (thousandths, rounded down)."""
    spark = source.sparkSession
    s, t = source.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    counts = materialize(spark.range(buckets).select(F.col("id").alias("bucket")).join(s, "bucket", "left")
                         .join(t, "bucket", "left").na.fill(0, ["s", "t"]), "resample-buckets")
    total = counts.agg(F.sum("s"), F.sum("t")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1) * F.lit(float(total[0] + buckets)) / ((s + 1) * F.lit(float(total[1] + buckets)))
    rows = counts.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect()  # one row a bucket
    gains = np.zeros(buckets, np.int64)
    for r in rows:
        gains[r.bucket] = r.gain
    return gains


def document_weights(docs: DataFrame, gains: np.ndarray, max_run: int = MAX_RUN) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of each row."""
    def run(batches):
        known = _Buckets(len(gains))
        for b in batches:
            out = {"doc_id": b.column(0), "n_words": [], "n_features": [], "weight": []}
            for text in b.column(1).cast(pa.binary()):
                n_words = n_features = weight = 0
                for n, at in _feature_buckets(text.as_py(), max_run, known):
                    n_words += n
                    n_features += len(at)
                    weight += int(gains[at].sum())
                out["n_words"].append(n_words)
                out["n_features"].append(n_features)
                out["weight"].append(weight)
            yield out

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run,
                     "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel_noise(doc_id: Column, seed: int = SEED) -> Column:
    """Noise in thousandths, rounded down, from the hash of seed and id (a null id counts as empty)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


# Fields of the order, smallest first: high scores, small ids, rows without an id last.
_ORDER = ("low", "no_id", "id", "features", "weight", "row")


def _order_key() -> Column:
    return F.struct((-F.col("score")).alias("low"), F.col("doc_id").isNull().alias("no_id"),
                    F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("id"), F.col("n_features").alias("features"),
                    F.col("weight").alias("weight"), F.monotonically_increasing_id().alias("row"))


def _literal(key: tuple) -> Column:
    return F.struct(*[F.lit(v).cast("boolean" if name == "no_id" else "bigint").alias(name)
                      for name, v in zip(_ORDER, key)])


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS, seed: int = SEED) -> tuple:
    """The ``k``-th smallest ``key`` (from 1) of a written table with unique keys and at least k rows."""
    active, before, turn = rows.select("key"), 0, 0
    key = F.col("key")
    while True:
        turn += 1
        chosen = active.orderBy(F.xxhash64(F.lit(seed + turn), "key"), "key").limit(pivots).collect()
        marks = sorted(tuple(r.key) for r in chosen)
        counted = active.agg(*[F.count_if(key < _literal(m)).alias(f"below{i}") for i, m in enumerate(marks)],
                             *[F.count_if(key == _literal(m)).alias(f"at{i}") for i, m in enumerate(marks)]).first()
        low, high = None, None
        for i, mark in enumerate(marks):
            below, at = before + counted[f"below{i}"], counted[f"at{i}"]
            if below < k <= below + at:
                return mark
            if below + at < k:
                low, passed = mark, below + at
            elif high is None:
                high = mark
        if low is not None:
            active, before = active.where(key > _literal(low)), passed
        if high is not None:
            active = active.where(key < _literal(high))
        active = materialize(active, "resample-active")


def draw(scored: DataFrame, k: int, pivots: int = PIVOTS) -> DataFrame:
    """All rows of a written table with ``key`` and ``eligible``, and the ``rank`` of the k smallest eligible keys."""
    spark = scored.sparkSession
    unranked = F.lit(None).cast("bigint").alias("rank")
    if k < 1:
        return scored.select(*scored.columns, unranked)
    last = _literal(kth_key(scored.where("eligible"), k, pivots))
    drawn = F.col("eligible") & (F.col("key") <= last)
    placed = materialize(scored.where(drawn).repartitionByRange("key").sortWithinPartitions("key")
                         .withColumn("__place", F.monotonically_increasing_id()), "resample-drawn")
    part = F.shiftright("__place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # one row a range
    offsets, passed = [], 0
    for r in counts:
        offsets.append((r.part, passed))
        passed += r.n
    starts = F.broadcast(spark.createDataFrame(offsets, "__part bigint, __start bigint"))
    within = F.col("__place") - F.shiftleft(part, 33)
    ranked = placed.join(starts, part == F.col("__part")).select(
        *scored.columns, (F.col("__start") + within + 1).alias("rank"))
    return ranked.unionByName(scored.where(~drawn).select(*scored.columns, unranked))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             max_run: int = MAX_RUN, buckets: int = BUCKETS, seed: int = SEED, pivots: int = PIVOTS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_features, weight, score, rank``.

    Of the rows with at least ``least_words`` words, ``percent`` % (rounded down)
    are drawn; others have no rank. A null or empty text has no features, weight 0
    and is drawn only if ``least_words`` is 0. Ties go to the smaller doc_id, rows
    without an id come last; rows that repeat an id have the same noise, each its
    own weight, and equal rows are ranked in any order. Without a target every
    gain only reflects the smoothing. Empty table: no rows.
    """
    gains = bucket_gains(bucket_counts(docs, max_run, buckets), bucket_counts(target, max_run, buckets), buckets)
    weighed = document_weights(docs, gains, max_run)
    scored = (weighed.withColumn("score", F.col("weight") + gumbel_noise(F.col("doc_id"), seed))
              .withColumn("eligible", F.col("n_words") >= least_words))
    scored = materialize(scored.select("doc_id", "n_features", "weight", "score", "eligible", _order_key().alias("key")),
                         "resample-scores")
    k = scored.where("eligible").count() * percent // 100
    return draw(scored, k, pivots).select("doc_id", "n_features", "weight", "score", "rank")
