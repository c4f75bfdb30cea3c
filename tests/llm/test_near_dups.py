import random

import numpy as np
import pytest

from ticketflow.llm import near_dups as ND
from ticketflow.llm.components import components


def shingles(text, k):
    import re
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else ({tuple(ws)} if ws else set())


def brute(docs, k):
    sets = [(d, shingles(t, k)) for d, t in docs]
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted(((d, len(s), None if d is None else find(d), d is None or find(d) == d) for d, s in sets), key=repr)


@pytest.fixture(scope="module")
def docs(prose):
    rng = random.Random(5)
    rows = [(i, prose(i, rng.randint(1, 120))) for i in range(60)]
    n = 100
    for base in range(10):
        words = prose(1000 + base, rng.randint(40, 300)).split()
        for _ in range(rng.randint(2, 30)):
            copy = list(words)
            for _ in range(rng.randint(0, len(copy) // 20)):
                copy[rng.randrange(len(copy))] = "edit%d" % rng.randrange(10**6)
            n += 1
            rows.append((n, " ".join(copy)))
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "Eins"), (904, "eins"), (905, "eins zwei"), (906, "ÉINS"),
             (None, prose(3, 30)), (None, None), (907, rows[0][1]), (908, "a " * 30_000), (909, "a " * 29_999)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_matches_brute_force(make_docs, docs, width):
    got = ND.near_duplicates(make_docs(docs), width=width)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, width)


def test_dense_regions_and_clusters_of_many_blocks_lose_nothing(make_docs, docs):
    got = ND.near_duplicates(make_docs(docs), width=2, region_rows=4, block_docs=5)
    want = {r[0]: r[2] for r in brute(docs, 2)}
    assert all(want[r.doc_id] == r.component_id for r in got.collect())


def test_blocks_alone_are_exact(spark, make_docs, docs):
    """One cluster of everything, in blocks of seven."""
    named = [(d, t) for d, t in docs if d is not None and shingles(t, 2)]
    frame = make_docs(named)
    clusters = spark.createDataFrame([(d, min(x for x, _ in named)) for d, _ in named], "node bigint, component bigint")
    sizes = spark.createDataFrame([(d, len(shingles(t, 2))) for d, t in named], "node bigint, n_shingles bigint")
    found = components(ND.confirmed_edges(frame, clusters, sizes, 2, block_docs=7)).collect()
    got = {r.node: r.component for r in found}
    for d, _, comp, _ in brute(named, 2):
        assert got.get(d, d) == comp


def test_empty_table_and_extra_columns(make_docs, docs):
    from pyspark.sql import functions as F
    assert ND.near_duplicates(make_docs([])).count() == 0
    wide = make_docs(docs).withColumn("component", F.lit("x")).withColumn("node", F.lit(1)).withColumn("sig", F.lit(0))
    left = ND.keep_one(wide, width=2)
    assert left.columns == wide.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == sorted(r[0] or -1 for r in brute(docs, 2) if r[3])


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (102, 101), (7, 7), (None, 3), (200, 199), (200, 199)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 102: 100, 199: 199, 200: 199}


def test_signature_estimates_similarity(prose):
    hashes = ND._WordHashes()
    a, b = prose(1, 2000).split(), prose(1, 2000).split()
    b[::20] = ["x%d" % i for i in range(100)]
    s, t = (ND.shingle_set(" ".join(x).encode(), 2, hashes) for x in (a, b))
    true = len(np.intersect1d(s, t)) / len(np.union1d(s, t))
    assert abs((ND.signature(s) == ND.signature(t)).mean() - true) < 0.2


def test_dense_regions_lose_no_candidate(spark, make_docs, docs):
    """Candidates connect the same documents however few rows a task takes of a region."""
    reps = (ND.signatures(make_docs(docs), 2).where("digest is not null and doc_id is not null")
            .selectExpr("doc_id as node", "n_shingles", "sig")).cache()

    def clusters(region_rows):
        return sorted(tuple(r) for r in components(ND.forest_edges(reps, region_rows)).collect())

    whole = clusters(10**6)
    assert len(whole) > 100
    assert clusters(4) == whole and clusters(2) == whole


def test_one_dense_region_of_many_groups(spark):
    """Boilerplate gives all rows one first prefix; pairs that only meet there are still candidates."""
    rng = np.random.default_rng(4)
    rows = []
    for g in range(60):
        base = rng.integers(0, 2**32, ND.HASHES, dtype=np.uint32)
        base[:3] = 7
        for c in range(2):
            sig = base.copy()
            sig[3 + c::6] = rng.integers(0, 2**32, len(sig[3 + c::6]), dtype=np.uint32)  # no other shared triple
            rows.append((10 * g + c, 100, sig.tobytes()))
    reps = spark.createDataFrame(rows, "node bigint, n_shingles bigint, sig binary")
    got = {r.node: r.component for r in components(ND.forest_edges(reps, 8)).collect()}
    assert got == {10 * g + c: 10 * g for g in range(60) for c in range(2)}


def test_keep_one_judges_each_text_of_a_repeated_id(make_docs, prose):
    a, b = prose(1, 60), prose(2, 60)
    c = a + " more"
    rows = [(3, a), (7, a), (7, b), (7, c), (8, b), (9, c), (9, prose(4, 60)), (None, a), (5, b), (5, b)]
    got = sorted(((r.doc_id, r.text) for r in ND.keep_one(make_docs(rows)).collect()), key=repr)
    assert got == sorted([(3, a), (5, b), (5, b), (9, prose(4, 60)), (None, a)], key=repr)
    few = [(3, a), (7, a), (7, b)]
    assert sorted((r.doc_id, r.text) for r in ND.keep_one(make_docs(few)).collect()) == [(3, a), (7, b)]


def test_sparse_links_in_a_dense_region(make_docs, prose):
    """Texts that share most of their words with hundreds of others, but link only with their own copy."""
    rng = random.Random(6)
    common = prose(77, 150).split()
    rows = []
    for i in range(150):
        own = prose(500 + i, 90).split()
        copy = list(own)
        copy[rng.randrange(90)] = "edit%d" % i
        rows += [(10 * i, " ".join(common + own)), (10 * i + 1, " ".join(common + copy))]
    got = ND.near_duplicates(make_docs(rows), width=2, region_rows=16, block_docs=50)
    want = {r[0]: r[2] for r in brute(rows, 2)}
    assert len(set(want.values())) == 150
    assert all(want[r.doc_id] == r.component_id for r in got.collect())
