"""Secrets in texts: patterns, and a character network for what the patterns do not name.

The patterns are the labelled findings. Every run of ``CANDIDATE`` characters is a
candidate; those that a pattern touches are positive. A character network
(``char_cnn``) learns from a bounded sample of different candidates in their context
and scores every candidate of every text. Over all candidates of the held-out fold
(by a hash of the candidate's window), binned counts give the calibrated probability of each score, and
the highest threshold that still finds ``RECALL`` of the held-out findings of every kind.
Candidates over it that no pattern touches become findings of kind ``model``.

Nothing but the sample and the binned counts reaches the driver.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.char_cnn import BATCH, CharNetwork, train, windows_of
from ticketflow.llm.common import map_arrow, materialize

KINDS = ("assign", "access", "hex", "model")
MODEL = KINDS.index("model")
FIT_ROWS = 20_000
RECALL = 0.95
BINS = 1000
FOLDS = 5

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the patterns' matches in code points, sorted.

    Matches of a kind don't overlap, leftmost first; an assignment counts if its
    value has 12 characters, but a shorter one still uses up its text.
    """
    out = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, end, kind)``: kind of the first pattern that touches the candidate, -1 if none does."""
    out = []
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        out.append((s, e, next((k for a, k, b in base if a < e and s < b), -1)))
    return out


def _window_hash(windows: list[tuple[str, int]]) -> int:
    return xxhash.xxh3_64_intdigest("".join(w for w, _ in windows).encode("utf-8", "surrogatepass"))


def _held(h: int) -> bool:
    return h % FOLDS == 0


def labelled_sample(docs: DataFrame, fit_rows: int = FIT_ROWS) -> list:
    """At most ``fit_rows`` windows ``(window, size, label)`` outside the held-out fold, half of each label.

    Those with the smallest hash of their content: equal windows count once, and a
    task passes on no more than the sample holds.
    """
    half = fit_rows // 2

    def run(batches):
        best: tuple[list, list] = ([], [])  # heaps of (-hash, window, size)
        seen: tuple[set, set] = (set(), set())
        for b in batches:
            for value in b.column(0):
                text = value.as_py() or ""
                for s, e, kind in candidates(text, base_spans(text)):
                    windows = windows_of(text, s, e)
                    h = _window_hash(windows)
                    label = int(kind >= 0)
                    heap, known = best[label], seen[label]
                    if _held(h) or h in known or (len(heap) >= half and h >= -heap[0][0]):
                        continue
                    known.add(h)
                    heapq.heappush(heap, (-h, *windows[0]))
                    if len(heap) > half:
                        known.discard(-heapq.heappop(heap)[0])
        for label in (0, 1):
            rows = best[label]
            yield {"label": [label] * len(rows), "h": [-r[0] - (1 << 63) for r in rows],
                   "part": [r[1] for r in rows], "size": [r[2] for r in rows]}

    found = materialize(map_arrow(docs.select("text"), run, "label int, h bigint, part string, size int")
                        .dropDuplicates(["label", "h"]), "secret-sample")
    slot = F.shiftright("h", 52)  # 4,096 ranges of hashes
    counts = found.groupBy("label", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).orderBy("slot").collect()
    out = []
    for label in (0, 1):
        enough, last = 0, None
        for r in counts:
            if r.label == label and enough < half:
                enough, last = enough + r.n, r.slot
        if last is not None:  # half of the sample and one range at most
            rows = found.where((F.col("label") == label) & (slot <= last)).orderBy("h").limit(half).collect()
            out += [(r.part, r["size"], label) for r in rows]
    return out


def fit_network(docs: DataFrame, fit_rows: int = FIT_ROWS) -> CharNetwork | None:
    """The network, or none if the sample lacks findings or other candidates."""
    sample = labelled_sample(docs, fit_rows)
    labels = np.array([x[2] for x in sample])
    if len(set(labels.tolist())) < 2:
        return None
    return train([x[:2] for x in sample], labels)


def scan(docs: DataFrame, net: CharNetwork | None) -> DataFrame:
    """``(doc_id, base, cands)`` of every text: pattern spans, and candidates with the bin of their score.

    A candidate of several windows has the highest of their scores.
    """
    def run(batches):
        for b in batches:
            out = {"doc_id": b.column(0), "base": [], "cands": []}
            rows, windows, owner = [], [], []

            def flush():
                if windows and net is not None:
                    best = np.zeros(len(rows), np.float32)
                    np.maximum.at(best, owner, net.score(windows))
                    for row, p in zip(rows, best):
                        row["bin"] = min(BINS - 1, int(p * BINS))
                rows.clear(), windows.clear(), owner.clear()

            for value in b.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                cands = []
                for s, e, kind in candidates(text, base):
                    own = windows_of(text, s, e)
                    cands.append({"start": s, "end": e, "kind": kind, "held": _held(_window_hash(own)), "bin": 0})
                    owner.extend([len(rows)] * len(own))
                    rows.append(cands[-1])
                    windows.extend(own)
                    if len(windows) >= 8 * BATCH:
                        flush()
                out["base"].append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                out["cands"].append(cands)
            flush()
            yield out

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run,
                     "doc_id bigint, base array<struct<start:bigint,kind:int,end:bigint>>, "
                     "cands array<struct<start:bigint,end:bigint,kind:int,held:boolean,bin:int>>")


@dataclass(frozen=True)
class Threshold:
    """Least bin of a finding (none: nothing is added), and the calibrated probability of every bin."""

    least: int | None
    probability: list[float]


def isotonic(positive: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Non-decreasing probability of each bin by pooling adjacent violators; empty bins take the one below."""
    blocks: list[list[float]] = []  # positives, rows, bins
    for p, n in zip(positive.tolist(), total.tolist()):
        blocks.append([p, n, 1])
        while len(blocks) > 1 and (not blocks[-1][1] or blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]):
            p2, n2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p2, blocks[-1][1] + n2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), p / n if n else 0.0) for p, n, k in blocks])


def choose_threshold(scanned: DataFrame, recall: float = RECALL) -> Threshold:
    """From the held-out candidates of all texts: the highest bin over which every kind keeps ``recall``."""
    counts = (scanned.select(F.explode("cands").alias("c")).where("c.held")
              .groupBy(F.col("c.bin").alias("bin"), F.col("c.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n")))
    table = np.zeros((MODEL + 1, BINS), np.int64)  # the last row: candidates without a pattern
    for r in counts.collect():  # at most BINS rows a kind
        table[r.kind, r.bin] += r.n
    found = table[:MODEL]
    calibrated = isotonic(found.sum(axis=0), table.sum(axis=0)).tolist()
    least = None
    for kind in found[found.sum(axis=1) > 0]:
        above = np.cumsum(kind[::-1])[::-1]
        reached = int(np.flatnonzero(above >= recall * above[0]).max())
        least = reached if least is None else min(least, reached)
    return Threshold(least, calibrated)


def find_secrets(docs: DataFrame, fit_rows: int = FIT_ROWS, recall: float = RECALL) -> DataFrame:
    """Per row: ``doc_id, spans``, an array of ``(start, kind, end, probability)`` by start, then kind.

    Starts and ends count code points, ends are exclusive; a span is the whole match of its
    pattern (an assignment with its name) or the candidate. ``kind`` is a position in
    ``KINDS``. Spans of patterns are always there and have no probability; kind
    ``model`` is added by the network with its calibrated probability. A null or empty text has no spans; rows that
    repeat an id are scanned each by its own text, a null id stays. Without findings in the
    held-out fold, or with nothing but findings, no span is added. Empty table: no rows.
    """
    net = fit_network(docs, fit_rows)
    scanned = materialize(scan(docs, net), "secret-scan")
    chosen = choose_threshold(scanned, recall) if net is not None else Threshold(None, [])
    base = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"),
                                                  F.lit(None).cast("double").alias("probability")))
    if chosen.least is None:
        return scanned.select("doc_id", F.array_sort(base).alias("spans"))
    least = F.lit(chosen.least)
    probability = F.lit(chosen.probability)
    added = F.transform(F.filter("cands", lambda c: (c["kind"] < 0) & (c["bin"] >= least)), lambda c: F.struct(
        c["start"].alias("start"), F.lit(MODEL).alias("kind"), c["end"].alias("end"),
        F.element_at(probability, c["bin"] + 1).alias("probability")))
    return scanned.select("doc_id", F.array_sort(F.concat(base, added)).alias("spans"))


def secret_digest(found: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, the spans of each pattern counted, ``base_sha256`` and all ``spans`` as text."""
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def text(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat(
            F.element_at(kinds, x["kind"] + 1), F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")

    def of(kind: int):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda x: x["kind"] < MODEL)
    return found.select("doc_id", *[of(k).alias(f"n_{KINDS[k]}") for k in range(MODEL)],
                        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text("spans").alias("spans"))
