"""Hidden Markov language model: Baum-Welch over partitions, exact scores.

Tokens are white-space words (A-Z lower-cased) and an end of text. The model
emits symbols: the end, the most frequent words, and classes of the other words
by their shape; within a class a word has its add-one share of the class, one
share being left for unseen words. Every pass of Baum-Welch runs the scaled
forward-backward recursion over all training documents, sums expected counts in
its task and then across tasks with a grouped sum; the model itself has a fixed
size. A document's score is the scaled forward likelihood of its whole text.

Counts of the ``HEAD_WORDS`` most frequent words travel with the tasks. The
other words of a document, none of them frequent, are joined with their counts.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import map_arrow, materialize

STATES = 8
SYMBOL_WORDS = 4000
HEAD_WORDS = 262_144
ITERATIONS = 3
END = 0
FOLDS, HELD_OUT_FOLD = 7, 2
# Distinct words that a task counts before it passes them on.
COUNTER_WORDS = 1_000_000
# Tokens that a forward-backward step holds at once (twice as many, if that is all).
CHUNK_TOKENS = 400_000
# Bytes of text that are split into words at once.
PART_BYTES = 1 << 20
# Groups into which words of one count are cut by their hash, on each of three levels.
HASH_BITS, HASH_LEVELS = 12, 3
# Pseudo-counts: of a symbol in proportion to its share, of a transition.
SYMBOL_PRIOR, MOVE_PRIOR = 50.0, 1.0
LN10 = np.log(10.0)


SPACE = re.compile(rb"[\x20\x09-\x0d]")


def tokens(text: bytes | None) -> Iterator[bytes]:
    """The words of a text, split part by part at white space."""
    start, end = 0, len(text or b"")
    while start < end:
        cut = SPACE.search(text, start + PART_BYTES)
        stop = cut.start() if cut else end
        yield from text[start:stop].lower().split()
        start = stop


def shape(word: bytes) -> int:
    """One of 24 classes: non-ASCII or not, last character, length."""
    last = word[-1]
    kind = 1 if last == 46 else 2 if last == 44 else 0 if last >= 97 else 3
    return (not word.isascii()) * 12 + kind * 3 + (0 if len(word) <= 5 else 1 if len(word) <= 10 else 2)


SHAPES = 24


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text has the held-out remainder; a null id has not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, c)`` over whole texts; tasks pass on partial counts."""
    def count(batches):
        counter: Counter[bytes] = Counter()
        for b in batches:
            for text in b.column(0).cast(pa.binary()).to_pylist():
                counter.update(tokens(text))
                if len(counter) >= COUNTER_WORDS:
                    yield {"word": list(counter), "c": list(counter.values())}
                    counter.clear()
        yield {"word": list(counter), "c": list(counter.values())}

    return (map_arrow(docs.select("text"), count, "word binary, c bigint")
            .groupBy("word").agg(F.sum("c").alias("c")))


def shape_expr(word: Column) -> Column:
    """``shape`` of a binary word as a column."""
    code = F.hex(word)
    last = F.conv(F.substring(code, -2, 2), 16, 10).cast("int")
    kind = F.when(last == 46, 1).when(last == 44, 2).when(last >= 97, 0).otherwise(3)
    n = F.octet_length(word)
    ascii_only = ~code.rlike("^(?:..)*[89A-F]")
    return F.when(ascii_only, 0).otherwise(12) + kind * 3 + F.when(n <= 5, 0).when(n <= 10, 1).otherwise(2)


@dataclass(frozen=True)
class Lexicon:
    """Counts that travel with the tasks; sizes are bounded by parameters."""

    head: dict[bytes, int]
    symbols: int
    class_total: tuple[int, ...]
    n: int
    v: int

    def symbol_ids(self) -> dict[bytes, int]:
        return {w: i + 1 for i, w in enumerate(self.head) if i < self.symbols}

    @property
    def n_symbols(self) -> int:
        return 1 + self.symbols + SHAPES


def frequent_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The ``most`` most frequent words and their counts, most frequent first.

    Words are taken in whole steps of the count (a sixteenth of a doubling);
    the step that no longer fits is taken by single counts, and a count that
    does not fit by ranges of the words' hash, so only group sizes and the
    chosen words reach the driver.
    """
    key = F.xxhash64("word")
    levels = [-F.floor(F.log2("c") * 16), -F.col("c")]
    levels += [F.shiftright(key, i * HASH_BITS).bitwiseAND((1 << HASH_BITS) - 1) for i in range(HASH_LEVELS)]
    chosen, open_, room = F.lit(False), F.lit(True), most
    for level in levels:
        split = last = None
        for r in sorted(counts.where(open_).groupBy(level.cast("long").alias("g")).count().collect()):
            if r["count"] > room:
                split = r.g
                break
            room -= r["count"]
            last = r.g
        if last is not None:
            chosen = chosen | (open_ & (level <= last))
        if split is None or not room:
            break
        open_ = open_ & (level == split)
    t = counts.where(chosen).select("word", "c").toArrow()
    return sorted(zip(t.column("word").to_pylist(), t.column("c").to_pylist()), key=lambda x: (-x[1], x[0]))


def fit_lexicon(counts: DataFrame, n_docs: int, symbol_words: int = SYMBOL_WORDS,
                head_words: int = HEAD_WORDS) -> Lexicon:
    head = dict(frequent_words(counts, head_words))
    symbols = min(symbol_words, len(head))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    by_shape = counts.groupBy(shape_expr(F.col("word")).alias("s")).agg((F.sum("c") + F.count(F.lit(1))).alias("t")).collect()
    total = [1] * SHAPES
    for r in by_shape:
        total[r.s] += r.t
    for w, c in list(head.items())[:symbols]:
        total[shape(w)] -= c + 1
    return Lexicon(head, symbols, tuple(total), n + n_docs, v + (n_docs > 0))


def encode(docs: DataFrame, lexicon: Lexicon, n_docs: int) -> DataFrame:
    """Per row: symbols and the sums that the head of the vocabulary settles.

    ``base_head``: sum of log10(c + 1) over the end and head words. ``rare_head``:
    the same over head words in classes, less log10 of the class total of every
    word in a class. ``tail``, ``tail_n``: the other words and how often.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        lex = shared.value
        ids, head = lex.symbol_ids(), lex.head
        log_count = {w: float(np.log10(c + 1)) for w, c in head.items()}
        log_class = [float(np.log10(t)) for t in lex.class_total]
        first_class = 1 + lex.symbols
        row = 0
        for b in batches:
            out = {k: [] for k in ("row", "symbols", "n_tokens", "known_head", "base_head", "rare_head", "tail", "tail_n")}
            for text in b.column("text").cast(pa.binary()).to_pylist():
                seq, base, rare, known, left = array("H"), float(np.log10(n_docs + 1)), 0.0, int(n_docs > 0), Counter()
                for w in tokens(text):
                    s = ids.get(w)
                    if s is None:
                        k = shape(w)
                        s = first_class + k
                        rare -= log_class[k]
                        x = log_count.get(w)
                        if x is None:
                            left[w] += 1
                        else:
                            base += x
                            rare += x
                    else:
                        base += log_count[w]
                    seq.append(s)
                seq.append(END)
                known += len(seq) - 1 - left.total()
                for k, x in zip(out, (row, seq.tobytes(), len(seq), known, base, rare,
                                      list(left), list(left.values()))):
                    out[k].append(x)
                row += 1
            yield {"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), **out}

    keyed = docs.select("doc_id", held_out().alias("held_out"), "text")
    rows = map_arrow(keyed, run, f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}, held_out boolean, row bigint, "
                     "symbols binary, n_tokens bigint, known_head bigint, base_head double, rare_head double, "
                     "tail array<binary>, tail_n array<int>")
    # with the task's number, the row's number within the task is unique
    return materialize(rows.withColumn("row", F.col("row") + F.spark_partition_id().cast("long") * (1 << 40)), "hmm-encoded")


@dataclass(frozen=True)
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def first_model(share: np.ndarray, states: int = STATES, seed: int = 5) -> Hmm:
    """Symbol shares, perturbed for each state; states tend to stay."""
    rng = np.random.default_rng(seed)
    emit = share[None, :] * rng.gamma(2.0, 1.0, (states, len(share)))
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Hmm(np.full(states, 1.0 / states), move, emit / emit.sum(axis=1, keepdims=True))


def _chunks(sequences: list[np.ndarray]):
    """Positions of sequences, longest first, about ``CHUNK_TOKENS`` at a time."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    part, size = [], 0
    for i in order:
        part.append(i)
        size += len(sequences[i])
        if size >= CHUNK_TOKENS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _spans(sequences: list[np.ndarray]) -> list[tuple[int, int]]:
    """Times ``[t0, t1)`` that together cover sequences of falling length, each of about ``CHUNK_TOKENS`` tokens."""
    lengths = np.array([len(s) for s in sequences])
    if lengths.sum() <= 2 * CHUNK_TOKENS:
        return [(0, int(lengths[0]))]
    out, t = [], 0
    while t < lengths[0]:
        step = max(1, CHUNK_TOKENS // int((lengths > t).sum()))
        out.append((t, min(t + step, int(lengths[0]))))
        t += step
    return out


class _Forward:
    """Scaled forward recursion over the times ``[t0, t1)`` of sequences of
    falling length; ``before`` is what the recursion left at ``t0 - 1``."""

    def __init__(self, model: Hmm, sequences: list[np.ndarray], span: tuple[int, int], before: np.ndarray | None, keep: bool):
        t0, t1 = span
        parts = [s[t0:t1] for s in takewhile(lambda s: len(s) > t0, sequences)]
        lengths = np.array([len(s) for s in parts])
        flat = np.concatenate(parts)
        t = np.concatenate([np.arange(n) for n in lengths])
        doc = np.repeat(np.arange(len(lengths)), lengths)
        order = np.lexsort((doc, t))
        self.obs = flat[order].astype(np.int64)
        self.width = np.bincount(t)
        self.at = np.concatenate([[0], np.cumsum(self.width)])
        self.emitted = model.emit[:, self.obs]
        self.alpha = np.empty_like(self.emitted) if keep else None
        self.scale = np.empty(len(flat))
        turn = model.move.T.copy()
        a = before
        for i, n in enumerate(self.width):
            lo, hi = self.at[i], self.at[i + 1]
            a = (model.start[:, None] if a is None else turn @ a[:, :n]) * self.emitted[:, lo:hi]
            c = a.sum(axis=0)
            a /= c
            self.scale[lo:hi] = c
            if keep:
                self.alpha[:, lo:hi] = a
        self.last = a
        self.log10 = np.bincount(doc[order], weights=np.log(self.scale), minlength=len(lengths)) / LN10


def sequence_log10(model: Hmm, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each sequence; memory does not follow the longest one."""
    out = np.zeros(len(sequences))
    for part in _chunks(sequences):
        seqs, last = [sequences[i] for i in part], None
        for span in _spans(seqs):
            f = _Forward(model, seqs, span, last, keep=False)
            out[part[:len(f.log10)]] += f.log10
            last = f.last
    return out


def expected_counts(model: Hmm, sequences: list[np.ndarray]):
    """Expected starts, moves and emissions, and the log10 likelihood.

    Long sequences are walked span by span: what the forward recursion leaves
    at each border is kept, and a span is run again when the backward recursion reaches it.
    """
    start, move = np.zeros_like(model.start), np.zeros_like(model.move)
    emit, log10 = np.zeros_like(model.emit), 0.0
    for part in _chunks(sequences):
        seqs = [sequences[i] for i in part]
        spans, borders = _spans(seqs), [None]
        for span in spans[:-1]:
            borders.append(_Forward(model, seqs, span, borders[-1], keep=False).last)
        after = None
        for span, before in zip(reversed(spans), reversed(borders)):
            f = _Forward(model, seqs, span, before, keep=True)
            log10 += f.log10.sum()
            for i in range(len(f.width) - 1, -1, -1):
                lo, hi = f.at[i], f.at[i + 1]
                beta = np.ones((len(start), f.width[i]))
                if after is not None:
                    n = after.shape[1]
                    move += f.alpha[:, lo:lo + n] @ after.T
                    beta[:, :n] = model.move @ after
                after = f.emitted[:, lo:hi] * beta / f.scale[lo:hi]
                f.alpha[:, lo:hi] *= beta
            if before is None:
                start += f.alpha[:, :f.width[0]].sum(axis=1)
            for s in range(len(start)):
                emit[s] += np.bincount(f.obs, weights=f.alpha[s], minlength=emit.shape[1])
    return start, move * model.move, emit, log10


def baum_welch_step(encoded: DataFrame, model: Hmm, share: np.ndarray) -> tuple[Hmm, float]:
    """One iteration over all given rows; the second value is their log10 likelihood.

    Each task gives a row for each symbol, state and the start; they are summed
    by key, so what reaches the driver has the size of the model.
    """
    states, symbols = model.emit.shape
    names = [f"s{i}" for i in range(states)]
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        sums = None
        for b in batches:
            got = expected_counts(shared.value, [np.frombuffer(x, np.uint16) for x in b.column(0).to_pylist()])
            sums = got if sums is None else tuple(x + y for x, y in zip(sums, got))
        if sums is not None:
            start, move, emit, log10 = sums
            rows = np.vstack([emit.T, move, start[None, :], np.eye(1, states) * log10])
            yield {"key": np.arange(len(rows)), **{n: rows[:, i] for i, n in enumerate(names)}}

    sums = (map_arrow(encoded.select("symbols"), run, "key int, " + ", ".join(f"{n} double" for n in names))
            .groupBy("key").agg(*[F.sum(n).alias(n) for n in names]).collect())
    got = np.zeros((symbols + states + 2, states))
    for r in sums:
        got[r.key] = r[1:]
    emit = got[:symbols].T + SYMBOL_PRIOR * share[None, :]
    move, start = got[symbols:symbols + states] + MOVE_PRIOR, got[symbols + states] + MOVE_PRIOR
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True),
               emit / emit.sum(axis=1, keepdims=True)), float(got[-1, 0])


def symbol_shares(lexicon: Lexicon, n_docs: int) -> np.ndarray:
    """Add-one share of each symbol in the training tokens."""
    top = list(lexicon.head.values())[:lexicon.symbols]
    counts = np.array([n_docs, *top, *lexicon.class_total], float) + 1.0
    return counts / counts.sum()


def score_documents(docs: DataFrame, states: int = STATES, iterations: int = ITERATIONS,
                    symbol_words: int = SYMBOL_WORDS, head_words: int = HEAD_WORDS) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from the rows not held out. A null or empty text is an end alone; a
    null doc_id is not held out; repeated rows count and are scored each. With
    nothing to learn from, words and symbols are uniform.
    """
    docs = docs.select("doc_id", "text")
    training = docs.where(~held_out())
    n_docs = training.count()
    counts = materialize(word_counts(training), "hmm-counts")
    lexicon = fit_lexicon(counts, n_docs, symbol_words, head_words)
    encoded = encode(docs, lexicon, n_docs)
    share = symbol_shares(lexicon, n_docs)
    model = first_model(share, states)
    for _ in range(iterations if n_docs else 0):
        model, _ = baum_welch_step(encoded.where("not held_out"), model, share)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def forward(batches):
        for b in batches:
            seqs = [np.frombuffer(x, np.uint16) for x in b.column("symbols").to_pylist()]
            kept = ("row", "doc_id", "held_out", "n_tokens", "known_head", "base_head", "rare_head")
            yield {**{k: b.column(k) for k in kept}, "forward": sequence_log10(shared.value, seqs)}

    kept = encoded.drop("tail", "tail_n")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    scored = map_arrow(kept, forward, f"row bigint, doc_id {doc_type}, held_out boolean, n_tokens bigint, "
                       "known_head bigint, base_head double, rare_head double, forward double")
    tail = (encoded.where(F.size("tail") > 0).select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("t"))
            .select("row", F.col("t.tail").alias("word"), F.col("t.tail_n").alias("k")))
    sums = (tail.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("tail_log"),
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("tail_known")))
    all_log = float(np.log10(lexicon.n + lexicon.v + 1))
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    return scored.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known_head") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(lexicon.n).cast("long").alias("train_tokens"),
        (F.col("base_head") + tail_log - F.col("n_tokens") * all_log).alias("base_score"),
        (F.col("forward") + F.col("rare_head") + tail_log).alias("score"))
