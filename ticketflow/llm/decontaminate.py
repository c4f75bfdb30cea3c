"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window is ``WINDOW`` consecutive words of a benchmark item (the whole item if
it has fewer). Of a window's k-gram hashes the smallest is its fingerprint, and
a run of neighbouring document windows with one smallest hash keeps that hash
once. Equal windows have equal fingerprints, so joining the document
fingerprints with those of the benchmark finds every shared window; each hit is
then extended to the whole window and compared as text.

The fingerprints and windows of the benchmark are broadcast if their summed
bytes are within a bound; beyond it both joins shuffle, and only thin fingerprint
rows of the documents are moved before the hits are known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import (BROADCAST_MAX_BYTES, bounded_broadcast, let, lower_ascii,
                                   materialize)

WINDOW = 10
KGRAM = 5
# Least bytes reckoned for one benchmark window, and those beside its text or an item id.
WINDOW_ROW_BYTES = 400
VALUE_BYTES = 32
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of the text, A-Z lower-cased; none for a null text."""
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), NOT_WORD), ""),
                      F.array().cast("array<string>"))


def _gram(ws: Column, start: Column, length: int, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), *[F.get(ws, start + j) for j in range(length)])


def _runs(ws: Column, window: int, k: int) -> Column:
    """Runs ``(fp, s0, s1, len)``: windows starting at s0..s1 share the fingerprint fp."""
    last = F.size(ws) - window
    per_window = window - k + 1

    def winnowed(hashes: Column) -> Column:
        mins = F.transform(F.sequence(F.lit(0), last),
                           lambda s: F.least(*[F.get(hashes, s + j) for j in range(per_window)])
                           if per_window > 1 else F.get(hashes, s))
        return let(mins, lambda m: let(
            F.filter(F.sequence(F.lit(0), last),
                     lambda s: (s == 0) | (F.get(m, s) != F.get(m, F.greatest(s - 1, F.lit(0))))),
            lambda starts: F.transform(starts, lambda s, j: F.struct(
                F.get(m, s).alias("fp"), s.alias("s0"),
                (F.coalesce(F.get(starts, j + 1), last + 1) - 1).alias("s1"),
                F.lit(window).alias("len")))))

    hashes = F.transform(F.sequence(F.lit(0), F.size(ws) - k), lambda i: _gram(ws, i, k, k))
    empty = F.array().cast("array<struct<fp:bigint,s0:int,s1:int,len:int>>")
    return F.when(last >= 0, let(hashes, winnowed)).otherwise(empty)


def _grams_of(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each window of the runs in ``run``, with its words as text."""
    starts = df.select(*keys, "words", F.col("run.fp").alias("fp"), F.col("run.len").alias("len"),
                       F.explode(F.sequence(F.col("run.s0"), F.col("run.s1"))).alias("s"))
    return starts.select(*keys, "fp", "len", "s",
                         F.array_join(F.slice("words", F.col("s") + 1, F.col("len")), " ").alias("gram"))


def benchmark_windows(bench: DataFrame, window: int = WINDOW, k: int = KGRAM) -> DataFrame:
    """Distinct benchmark windows ``(gram, len, fp, items)``.

    ``items``: sorted ids, as strings, of the items that hold the window. Items
    without an id mark words but can't be listed; items without words have none.
    """
    ws = bench.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    n = F.size("words")
    short = F.array(F.struct(F.xxhash64(F.lit("short"), F.array_join("words", " ")).alias("fp"),
                             F.lit(0).alias("s0"), F.lit(0).alias("s1"), n.alias("len")))
    runs = F.when(n >= window, _runs(F.col("words"), window, k)).otherwise(short)
    rows = ws.where(n > 0).select("item_id", "words", F.explode(runs).alias("run"))
    return (_grams_of(rows, ["item_id"]).groupBy("gram", "len", "fp")
            .agg(F.array_sort(F.collect_set("item_id")).alias("items")))


def _window_bytes() -> Column:
    """Bytes of a row ``(gram, items)``, which may hold long words or many items."""
    items = F.aggregate("items", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x) + VALUE_BYTES)
    return F.greatest(F.octet_length("gram") + VALUE_BYTES + items, F.lit(WINDOW_ROW_BYTES))


def _short_runs(ws: Column, n: int) -> Column:
    """Every n-gram as a run of its own, as short items match whole n-grams."""
    runs = F.transform(F.sequence(F.lit(0), F.size(ws) - n), lambda i: F.struct(
        F.xxhash64(F.lit("short"), F.array_join(F.slice(ws, i + 1, n), " ")).alias("fp"),
        i.alias("s0"), i.alias("s1"), F.lit(n).alias("len")))
    return F.when(F.size(ws) >= n, runs).otherwise(F.array().cast("array<struct<fp:bigint,s0:int,s1:int,len:int>>"))


def _document_runs(docs: DataFrame, short_lengths: list[int], window: int, k: int) -> DataFrame:
    """``(doc_id, h, words, runs)``; ``h`` tells rows that repeat a doc_id apart."""
    def runs(ws: Column) -> Column:
        return F.concat(_runs(ws, window, k), *[_short_runs(ws, n) for n in short_lengths])

    one = let(words(F.col("text")), lambda ws: F.struct(ws.alias("words"), runs(ws).alias("runs")))
    return (docs.select("doc_id", F.xxhash64("text").alias("h"), one.alias("one"))
            .select("doc_id", "h", "one.words", "one.runs"))


def window_hits(docs: DataFrame, bench: DataFrame, window: int = WINDOW, k: int = KGRAM,
                max_broadcast: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``(doc_id, h, s, len, items)``: benchmark windows at word ``s`` of a document."""
    grams = materialize(benchmark_windows(bench, window, k), "bench-windows")
    # at most window - 1 values
    short = [r[0] for r in grams.where(F.col("len") < window).select("len").distinct().collect()]
    known, small = bounded_broadcast(grams.select("gram", "items"), _window_bytes(), max_broadcast)
    fps = grams.select("fp", "len").distinct()
    if small:
        fps = F.broadcast(fps)
    ws = _document_runs(docs, sorted(short), window, k)
    on = (F.col("run.fp") == fps["fp"]) & (F.col("run.len") == fps["len"])
    if small:
        kept = ws.select("doc_id", "h", "words", F.explode("runs").alias("run")).join(fps, on, "left_semi")
    else:
        thin = (ws.select("doc_id", "h", F.explode("runs").alias("run")).join(fps, on, "left_semi")
                .groupBy("doc_id", "h").agg(F.collect_set("run").alias("hit_runs")))
        left, right = ws.drop("runs").alias("l"), thin.alias("r")
        kept = (left.join(right, F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.h") == F.col("r.h")))
                .select("l.doc_id", "l.h", "words", F.explode("hit_runs").alias("run")))
    return (_grams_of(kept, ["doc_id", "h"]).join(known, "gram")
            .select("doc_id", "h", "s", "len", "items"))


def _covered(spans: Column) -> Column:
    """Words under the union of ``(s, e)`` spans sorted by start."""
    return F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], x["e"]).alias("end")),
        lambda a: a["n"])


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, k: int = KGRAM,
                  max_broadcast: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    One row for each input row, whatever other columns it has. A null or empty
    text has no words and no hits; rows that repeat a doc_id are judged each by
    its own text, a null doc_id is kept. Empty benchmark: nothing is hit.
    """
    docs = docs.select("doc_id", "text")
    hits = window_hits(docs, bench, window, k, max_broadcast)
    per_doc = hits.groupBy("doc_id", "h").agg(
        _covered(F.array_sort(F.collect_set(F.struct("s", (F.col("s") + F.col("len")).alias("e"))))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("ids"))
    all_docs = docs.select("doc_id", F.xxhash64("text").alias("h"),
                           F.size(words(F.col("text"))).cast("long").alias("n_words"))
    left, right = all_docs.alias("l"), per_doc.alias("r")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return (left.join(right, F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.h") == F.col("r.h")), "left")
            .select("l.doc_id", "n_words", n_hit.alias("n_hit"),
                    F.size(ids).cast("long").alias("n_items"),
                    F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated")))


def remove_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, k: int = KGRAM) -> DataFrame:
    """The documents without a hit word, with all their columns."""
    hit = window_hits(docs.select("doc_id", "text"), bench, window, k).select("doc_id", "h").distinct()
    left, right = docs.alias("l"), hit.alias("r")
    on = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.xxhash64("l.text") == F.col("r.h"))
    return left.join(right, on, "left_anti")
