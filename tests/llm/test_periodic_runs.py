import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketflow.llm import periodic_runs as PR
from ticketflow.llm.queries import planted_places
from ticketflow.llm.suffix_tree import RangeMinimum, SuffixTree


def brute(x, least):
    """Runs by definition: every period, every maximal stretch, smallest periods first."""
    n, out, seen = len(x), [], []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if x[i] == x[i + q]:
                j = i
                while j + q < n and x[j] == x[j + q]:
                    j += 1
                s, size = i, j + q - i
                if size >= 2 * q:
                    if size >= least and not any(a <= s and a + b >= s + size for a, b in seen):
                        out.append((s, size, q))
                    seen.append((s, size))
                i = j
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(ws, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def test_runs_of_random_sequences():
    rng = random.Random(1)
    for _ in range(1500):
        n, k, least = rng.randint(0, 60), rng.randint(1, 4), rng.choice([2, 3, 5, 12])
        x = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.5 and n > 8:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(2, 9)
            x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
        words = np.array(x, np.int64)
        assert [tuple(r) for r in PR.maximal_runs(words, least).tolist()] == brute(x, least)
        assert [tuple(r) for r in PR.text_runs(words, least).tolist()] == brute(x, least)


def test_suffix_order_and_extensions():
    rng = random.Random(2)
    for k in (1, 2, 3, 50):
        x = [rng.randrange(k) for _ in range(120)]
        tree = SuffixTree(x)
        assert tree.order == sorted(range(121), key=lambda i: x[i:])
        assert tree.descending() == sorted(range(121), key=lambda i: [-v for v in x[i:]])
        i, j = np.triu_indices(121, 1)
        want = [next((m for m in range(120) if max(a, b) + m >= 120 or x[a + m] != x[b + m]), 0) for a, b in zip(i, j)]
        assert tree.extension(i, j).tolist() == want and tree.extension(j, i).tolist() == want


def test_range_minimum():
    values = np.random.default_rng(3).integers(0, 100, 700)
    lo, hi = np.triu_indices(700)
    got = RangeMinimum(values).query(lo, hi)
    at = np.random.default_rng(4).integers(0, len(lo), 5000)
    assert got[at].tolist() == [values[lo[i]:hi[i] + 1].min() for i in at]


@pytest.fixture(scope="module")
def docs(prose):
    rows = [(i, prose(i, i % 150)) for i in range(160)]
    line = prose(900, 7)
    rows += [(500, "\n".join([line] * 9)), (501, line + " " + prose(901, 30) + " " + line), (502, "a b " * 40 + "c " * 13 + "a"),
             (503, "x " * 11), (504, "x " * 12), (505, "É ü ß " * 8), (506, None), (507, ""), (508, " \n\t "),
             (None, "y z " * 20), (None, None), (500, "a a b " * 6), (509, "Same " * 60_000),
             *[(510, prose(3, 40) + " " + prose(3, 40))] * 5]
    return rows


@pytest.mark.parametrize("rewrite", [None, planted_places])
def test_matches_brute_force(make_docs, docs, rewrite):
    want = []
    for d, text in docs:
        ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        places = rewrite(d, len(ws)) if rewrite else None
        ws = [ws[i] for i in places] if places is not None else ws
        runs = [(0, 60_000, 1)] if d == 509 else brute(ws, 12)
        longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((d, len(runs), *longest, None if not runs else 1000 * longest[1] // longest[2],
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapse(ws, runs).encode()).hexdigest()))
    got = PR.run_digest(PR.periodic_runs(make_docs(docs), rewrite=rewrite))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table_and_extra_columns(make_docs, docs):
    assert PR.run_digest(PR.periodic_runs(make_docs([]))).count() == 0
    wide = make_docs(docs[:9]).withColumn("runs", F.lit("x")).withColumn("collapsed", F.lit(1)).withColumn("a.b", F.lit(1))
    assert PR.periodic_runs(wide).count() == 9
    with pytest.raises(ValueError):
        PR.periodic_runs(wide, min_length=1)
