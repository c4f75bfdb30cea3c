"""Toxicity scores: boosted trees over dense text features, isotonically calibrated.

The lexicon is learned: words whose document frequency is far higher among
labelled toxic documents. Features of a whole text are lexicon densities (plain,
weighted and after undoing obfuscation), closeness of lexicon words to the
second person, capitals, punctuation, obfuscation and length. The lexicon is
counted over all labelled rows of two folds; trees and calibration are fitted on
at most ``fit_rows`` labelled rows. Every document is then scored in one scan
without a shuffle while the lexicon fits ``lexicon_bytes``; the rarer words of a
larger one stay in a table and are joined to the documents that hold them.
"""

from __future__ import annotations

import math
import re
from collections import ChainMap, Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ticketflow.llm.boosted import BoostedModel, bounded_sample, fit_boosted, quoted, score_boosted
from ticketflow.llm.common import (ASCII_LOWER, ASCII_UPPER, BROADCAST_MAX_BYTES, bounded_broadcast,
                                    map_arrow, materialize, ship_package)

FIT_ROWS = 100_000
# Bytes of a lexicon entry in a worker's memory, besides its letters.
ENTRY_BYTES = 200
# Bytes of a labelled row in a broadcast: an id, a label and a fold.
LABEL_BYTES = 64
# Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 300_000
MIN_DOCS = 4
MIN_LOG_ODDS = 2.5
NEAR = 3
FEATURES = "__tox_features"
# Words of a text that a task passes on at once to meet the lexicon table.
PASSED_WORDS = 50_000

SECOND_PERSON = frozenset(
    "you your yours yourself u ur youre tu te toi ton ta tes vous votre vos du dich dir dein deine "
    "euch ihr tú ti tus usted ustedes vosotros".encode().split())

_SPACED = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
_WORDS = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode()).translate(_SPACED)
_LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())
_UNLEET = bytes.maketrans(b"013457@$!|", b"oieastasii")
_OBFUSCATED = re.compile(rb"(?<![a-z0-9@$])(?:[0-9@$]++[a-z]++|[a-z]++[0-9@$!*|]++[a-z]++)(?:[0-9@$!*|]++[a-z]++)*+"
                         rb"|(?<![a-z])[a-z](?:[.*_-][a-z]){2,}+(?![a-z])")
_CAPITALS = re.compile(rb"(?<![A-Za-z])[A-Z]{3,}+(?![a-z])")
_LONG_RUN = re.compile(rb"([a-z])\1{3,}+|[!?]{2,}+")


def words(text: bytes) -> list[bytes]:
    """Words for the lexicon: A-Z lower-cased, ASCII punctuation as space."""
    return text.translate(_WORDS).split()


def unobfuscated(token: bytes) -> bytes:
    return token.translate(_UNLEET, b".*_-")


def looked_up(text: bytes) -> set[bytes]:
    """Every word that ``text_features`` looks up in the lexicon."""
    return {*words(text), *map(unobfuscated, _OBFUSCATED.findall(text.translate(_LOWER)))}


def text_features(text: bytes, lexicon: Mapping[bytes, float]) -> list[float]:
    ws = words(text)
    n = max(1, len(ws))
    hits = [(i, lexicon[w]) for i, w in enumerate(ws) if w in lexicon]
    second = [i for i, w in enumerate(ws) if w in SECOND_PERSON]
    near = 0
    if hits and second:
        at = set(second)
        near = sum(any(j in at for j in range(i - NEAR, i + NEAR + 1)) for i, _ in hits)
    weights = [x for _, x in hits]
    lower = text.translate(_LOWER)
    obfuscated = _OBFUSCATED.findall(lower)
    hidden = sum(unobfuscated(t) in lexicon for t in obfuscated)
    size = max(1, len(text))
    upper = size - len(text.translate(None, ASCII_UPPER.encode())) if text else 0
    letters = max(1, size - len(lower.translate(None, ASCII_LOWER.encode())))
    marks = text.count(b"!") + text.count(b"?")
    punctuation = size - len(text.translate(None, b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")) if text else 0
    return [len(hits) / n, sum(weights) / n, float(len(hits)), sum(weights), max(weights, default=0.0),
            float(len({ws[i] for i, _ in hits})), float(hidden), hidden / n, float(near), near / n,
            len(second) / n, upper / letters, len(_CAPITALS.findall(text)) / n, marks / n, punctuation / size,
            len(obfuscated) / n, len(_LONG_RUN.findall(lower)) / n, math.log1p(len(ws))]


def training_labels(labels: DataFrame, fold: str = "doc_id", folds: int = 5) -> DataFrame:
    """``(doc_id, toxic, fold)`` of labelled rows outside the held-out fold 0.

    Rows without an id or a label teach nothing; a document labelled twice
    counts as toxic if any of its labels says so.
    """
    k = F.crc32(F.col(fold).cast("string").cast("binary")) % folds
    return (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
            .withColumn("fold", k).where("fold <> 0"))


@dataclass(frozen=True)
class Lexicon:
    """Weights by word: ``head`` travels with the tasks, ``tail`` (``word, w``) is joined."""

    head: dict[bytes, float]
    tail: DataFrame | None = None


def weigh_words(rows: DataFrame, min_docs: int = MIN_DOCS, min_log_odds: float = MIN_LOG_ODDS) -> DataFrame:
    """``(word, docs, w)``: log odds of the words of toxic documents, from ``(text, toxic)`` rows.

    Counts are summed in each task first. Empty without rows of both classes.
    """
    def count(batches):
        pos, neg = Counter(), Counter()

        def counted():
            keys = list(pos.keys() | neg.keys())
            return {"word": keys, "pos": [pos[k] for k in keys], "neg": [neg[k] for k in keys]}

        for b in batches:
            for text, toxic in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist()):
                (pos if toxic else neg).update(set(words(text or b"")))
                if len(pos) + len(neg) >= COUNTED_WORDS:
                    yield counted()
                    pos.clear()
                    neg.clear()
        yield counted()

    n_pos, n_neg = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    odds = lambda c, n: F.log((F.col(c) + 0.5) / (F.lit(n) - F.col(c) + 0.5))
    counts = (map_arrow(rows.select("text", "toxic"), count, "word binary, pos bigint, neg bigint")
              .groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    return (counts.where((F.col("pos") >= min_docs) & F.lit(bool(n_pos and n_neg)))
            .select("word", (F.col("pos") + F.col("neg")).alias("docs"), (odds("pos", n_pos) - odds("neg", n_neg)).alias("w"))
            .where(F.col("w") >= min_log_odds))


def learn_lexicon(rows: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> Lexicon:
    """The lexicon of ``(text, toxic)`` rows, all of its words.

    Words by falling power of two of their documents travel with the tasks
    while their counted bytes fit ``max_bytes``. The first power that does not
    fit holds so many words that none of the joined ones is a hot key.
    """
    table = materialize(weigh_words(rows), "tox-lexicon").withColumn("power", F.floor(F.log2("docs")).cast("int"))
    sizes = table.groupBy("power").agg(F.sum(F.octet_length("word") + F.lit(ENTRY_BYTES))).collect()
    least, total = 64, 0
    for power, size in sorted(sizes, reverse=True):
        total += size
        if total > max_bytes:
            break
        least = power
    head = {bytes(r.word): r.w for r in table.where(F.col("power") >= least).select("word", "w").collect()}
    return Lexicon(head, table.where(F.col("power") < least).select("word", "w") if total > max_bytes else None)


def with_features(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All columns of ``df`` and the feature array of ``text``; null counts as empty."""
    if lexicon.tail is not None:
        return _with_joined_features(df, lexicon)
    at, head = df.columns.index("text"), lexicon.head
    schema = StructType([*df.schema.fields, StructField(FEATURES, ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).cast(pa.binary()).to_pylist()
            values = pa.array([text_features(t or b"", head) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns, values], names=[*b.schema.names, FEATURES])

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def _with_joined_features(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The same for a lexicon with a tail: the words of a text outside the head
    meet the table, and its hits come back to it by a row number."""
    head = lexicon.head
    others = [c for c in df.columns if c != "text"]
    row = F.struct(*[F.col(quoted(c)) for c in others] or [F.lit(0).alias("none")]).alias("row")
    numbered = materialize(df.select(row, "text").withColumn("at", F.monotonically_increasing_id()), "tox-numbered")

    def pass_on(batches):
        for b in batches:
            for at, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                own = [w for w in looked_up(text or b"") if w not in head]
                for i in range(0, len(own), PASSED_WORDS):
                    part = own[i:i + PASSED_WORDS]
                    yield {"at": [at] * len(part), "word": part}

    hits = (map_arrow(numbered.select("at", "text"), pass_on, "at bigint, word binary").join(lexicon.tail, "word")
            .groupBy("at").agg(F.collect_list(F.struct("word", "w")).alias("hits")))
    joined = numbered.join(hits, "at", "left").select("row", "text", "hits")
    schema = StructType([*joined.schema.fields[:2], StructField(FEATURES, ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            found = [{h["word"]: h["w"] for h in hs or ()} for hs in b.column(2).to_pylist()]
            values = pa.array([text_features(t or b"", ChainMap(own, head)) for t, own in zip(texts, found)],
                              pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], values], names=["row", "text", FEATURES])

    ship_package(df.sparkSession)
    return joined.mapInArrow(run, schema).select(
        *[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in df.columns], FEATURES)


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    boosted: BoostedModel

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """All columns of ``df`` and the calibrated score of its ``text``."""
        return score_boosted(with_features(df, self.lexicon), FEATURES, self.boosted, out)


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS,
                 lexicon_bytes: int = BROADCAST_MAX_BYTES) -> ToxicityModel:
    """Fit on labelled documents outside fold 0.

    All of folds 2 and 3 give the lexicon. Of at most ``fit_rows`` documents,
    chosen by hash, fold 1 calibrates and the others train the trees. Without
    labels of both classes the score is a constant.
    """
    known = materialize(training_labels(labels), "tox-labels")
    texts = docs.select("doc_id", "text")
    counted, _ = bounded_broadcast(known.where("fold in (2, 3)"), LABEL_BYTES)
    lexicon = learn_lexicon(texts.join(counted, "doc_id").select("text", "toxic"), lexicon_bytes)
    sample = bounded_sample(known, "doc_id", fit_rows)
    # at most fit_rows rows of an id, a label and a fold
    rows = texts.join(F.broadcast(sample), "doc_id").select("text", "toxic", "fold")
    rows = materialize(with_features(rows, lexicon).select("toxic", "fold", FEATURES), "tox-features")
    return ToxicityModel(lexicon, fit_boosted(rows.where("fold <> 1"), FEATURES, "toxic", rows.where("fold = 1")))


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``.

    A null or empty text gets the score of its (empty) features; a null doc_id
    is not held out; rows that repeat an id are scored each by its own text.
    """
    model = fit_toxicity(docs, labels, fit_rows)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return model.score(docs.select("doc_id", "text")).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents scored under 0.5, with all their columns, whatever their names."""
    model = fit_toxicity(docs, labels, fit_rows)
    row = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row")
    scored = model.score(docs.select(row, "text"), "score").where(F.col("score") < 0.5)
    return scored.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
