"""Maximal periodic runs of words, by longest common extensions of suffix trees.

A run is a stretch with smallest period q, at least ``max(MIN_LENGTH, 2 * q)`` long,
that no neighbouring word extends keeping q. Every run has a Lyndon root: for one of
the two orders of words, the longest Lyndon word at some place of the run is one
period. So the longest Lyndon words of both orders, one for each place (the distance to
the next smaller suffix), are the candidates; each is extended to both sides by
longest common extensions, which the suffix trees of the words and of their reversal
answer in constant time. All candidates together cost time in proportion to the words.

Before trees are built, stretches that cannot hold a run are left out exactly: words of
a run lie in two equal stretches of ``MIN_LENGTH / 2`` words at a distance of q, both
inside the run. Words outside every such repeat, counted within what is left until
nothing changes, belong to no run. Runs never cross what is left out, and what would
extend a run is never left out, so the runs are those of the whole text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import map_arrow
from ticketflow.llm.pieces import SPACED_WORDS, word_pieces
from ticketflow.llm.suffix_tree import SuffixTree

MIN_LENGTH = 12

# (doc_id, number of words) -> place of the word that stands at each place, or none
Rewrite = Callable[[int | None, int], np.ndarray | None]


def lyndon_lengths(order: list[int], n: int) -> np.ndarray:
    """Length of the longest Lyndon word at each of ``n`` places, from the sorted suffixes."""
    rank = [0] * (n + 1)
    for r, at in enumerate(order):
        rank[at] = r
    smaller, stack = [n] * n, []
    for i in range(n):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            smaller[stack.pop()] = i
        stack.append(i)
    return np.array(smaller, np.int64) - np.arange(n)


def maximal_runs(words: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows ``(start, length, period)`` of the runs of a sequence of numbers, by start, then period."""
    n = len(words)
    if n < 2:
        return np.empty((0, 3), np.int64)
    values = words.tolist()
    ahead, back = SuffixTree(values), SuffixTree(values[::-1])
    found = []
    for order in (ahead.order, ahead.descending()):
        period = lyndon_lengths(order, n)
        at = np.arange(n)
        right = ahead.extension(at, at + period)
        left = back.extension(n - at, n - at - period)
        run = (left + right >= period) & (left + right + period >= min_length)
        found.append(np.stack([at - left, period + left + right, period], axis=1)[run])
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def repeating_stretches(words: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int]]:
    """Stretches ``(start, end)`` outside which no word belongs to a run."""
    k = (min_length + 1) // 2
    if len(words) < min_length:
        return []
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    gram = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        gram = gram * np.uint64(0xD6E8FEB86659FD93) + mixed[j:j + len(gram)]
    starts, ends = np.array([0]), np.array([len(words)])
    while True:
        # grams that lie in one stretch, and the stretch of each
        sizes = ends - starts - k + 1
        of = np.repeat(np.arange(len(starts)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[of]
        order = np.lexsort((gram[at], of))
        g, s = gram[at][order], of[order]
        same = (g[1:] == g[:-1]) & (s[1:] == s[:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        places, of = at[twice], of[twice]
        if not len(places):
            return []
        # neighbouring or overlapping grams of one stretch cover one stretch; ends of neighbours may touch
        new = np.flatnonzero((places[1:] - places[:-1] > k) | (of[1:] != of[:-1]))
        first = places[np.concatenate([[0], new + 1])]
        last = places[np.concatenate([new, [len(places) - 1]])] + k
        kept = last - first >= min_length
        before = (len(starts), int((ends - starts).sum()))
        starts, ends = first[kept], last[kept]
        if not len(starts):
            return []
        if before == (len(starts), int((ends - starts).sum())):
            return list(zip(starts.tolist(), ends.tolist()))


def text_runs(words: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """``maximal_runs`` of a whole text, from the stretches that can hold runs."""
    found = []
    for start, end in repeating_stretches(words, min_length):
        runs = maximal_runs(np.unique(words[start:end], return_inverse=True)[1], min_length)
        runs[:, 0] += start
        found.append(runs)
    if not found:
        return np.empty((0, 3), np.int64)
    return np.concatenate(found)


def repeated_words(runs: np.ndarray, n: int) -> np.ndarray:
    """Whether each of ``n`` words lies in a run after the run's first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:n]) > 0


def _words_of(text: bytes | None) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the words of a text, and the words by number."""
    known: dict[bytes, int] = {}
    parts = [np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
             for words in word_pieces(text, SPACED_WORDS)]
    return (np.concatenate(parts) if parts else np.empty(0, np.int64)), list(known)


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, rewrite: Rewrite | None = None) -> DataFrame:
    """Per row: ``doc_id, n_words, runs, collapsed``.

    ``runs``: structs ``(start, length, period)`` by start, then period; ``collapsed``:
    the words joined by one space, without those that a run repeats after its first
    period. Words are what white space of ASCII separates. A null, empty or blank text has no
    words, no runs and an empty ``collapsed``; rows that repeat an id are judged each
    by its own text, a null id stays. ``rewrite`` may replace words by others of the same
    text before. A stretch of n repeating words takes about 1 kB of a task's memory
    for each word while its trees are built. Empty table: no rows.
    """
    if min_length < 2:
        raise ValueError("min_length must be at least 2")

    def run(batches):
        for b in batches:
            out = {"doc_id": b.column(0), "n_words": [], "runs": [], "collapsed": []}
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
                words, known = _words_of(text.as_py())
                places = rewrite(doc_id, len(words)) if rewrite is not None else None
                if places is not None:
                    words = words[places]
                runs = text_runs(words, min_length)
                kept = words[~repeated_words(runs, len(words))] if len(runs) else words
                out["n_words"].append(len(words))
                out["runs"].append([{"start": s, "length": n, "period": q} for s, n, q in runs.tolist()])
                out["collapsed"].append(b" ".join(map(known.__getitem__, kept.tolist())))
            yield out

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run,
                     "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                     "collapsed string")


def run_digest(found: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_runs``, the longest run, ``exponent_milli`` and digests of runs and text.

    The longest run is the first of equally long ones, then that of the smallest
    period; without runs its columns are null.
    """
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"),
                                                                (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                   F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("longest.s")).alias("start"), F.col("longest.n").alias("length"), (-F.col("longest.q")).alias("period"),
        F.floor(F.lit(1000) * F.col("longest.n") / -F.col("longest.q")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
