import numpy as np
import pytest

from ticketflow.llm import vantage as VP

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def rows_of(n=400, dim=8, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) + rng.integers(0, 4, (n, 1)) * 2
    rows = [(i, [float(np.float32(v)) for v in r], 0) for i, r in enumerate(x)]
    rows += [(1000 + i, rows[50][1], 0) for i in range(40)]           # one vector many times
    rows += [(2000, [0.0] * dim, 0), (2050, None, 0), (2100, [1.0, None] + [0.0] * (dim - 2), 0), (2150, [float("nan")] * dim, 0),
             (2200, [float("inf")] + [1.0] * (dim - 1), 0), (2250, [], 0), (None, rows[1][1], 0), (2300, [1.0, 2.0], 0), (2301, [2.0, 1.0], 0)]
    return rows


def brute(rows, k=5, every=50):
    good = [(i, np.array(v, float)) for i, v, _ in rows
            if i is not None and v and all(e is not None and np.isfinite(e) for e in v) and any(v)]
    out = []
    for qi, q in good:
        if qi % every:
            continue
        c = [(-float(VP.cosines(q[None], v[None])[0]), i) for i, v in good if i != qi and len(v) == len(q)]
        out += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(sorted(c)[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [60, 100_000])
def test_factor_one_is_exact_with_ties(spark, shard_rows):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA)
    got = VP.nearest(df, df.where("vec_id % 50 = 0"), 5, shard_rows=shard_rows, block_rows=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_larger_factor_trades_recall_for_work(spark):
    rows = rows_of(2000, 6, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.query_id, r.vec_id) for r in VP.nearest(df, df.where("vec_id % 50 = 0"), 5, factor=1.3).collect()}
    want = {(q, v) for q, _, v, _ in brute(rows)}
    assert len(got & want) >= 0.9 * len(want)


def test_few_or_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert VP.nearest(empty, empty).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1)], SCHEMA)
    assert [tuple(r)[:3] for r in VP.nearest(two, two.where("vec_id = 0")).collect()] == [(0, 1, 1)]


def test_repeated_rows_leave_room_for_other_ids(spark):
    same, other = [1.0, 2.0], [2.0, -1.0]
    rows = [(1, same, 0)] * 8 + [(i, same, 0) for i in (2, 3, 4, 0)] + [(9, other, 0)] * 7
    df = spark.createDataFrame(rows, SCHEMA)
    got = VP.nearest(df, df.where("vec_id = 0"), 5)
    assert [(r.rank, r.vec_id) for r in got.orderBy("rank").collect()] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 9)]


def test_tree_keeps_distinct_ids_of_equal_vectors():
    ids, x = np.array([1] * 8 + [2, 3]), np.ones((10, 2))
    found = VP.search_tree(VP.build_tree(ids, x, 5), np.array([0]), np.ones((1, 2)), 5)[1]
    assert sorted(found) == [1, 2, 3]


def test_very_large_and_small_components(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 1e200]), (2, [1.0, 0.0]), (3, [3e-200, 0.0]), (4, [0.0, 1e-320]), (50, [1e300, 1e-300])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in VP.nearest(df, df.where("vec_id % 50 = 0"), 5).collect()}
    assert len(got) == 10
    assert got[0, 2] == got[0, 3] == got[0, 50] == got[50, 2] == 1.0 and got[0, 4] == 0.0
    assert got[0, 1] == pytest.approx(0.5 ** 0.5, rel=1e-15)
    x = np.random.default_rng(3).normal(size=(50, 7))
    assert (VP.cosines(x[:25], x[25:]) == VP.dots(x[:25], x[25:]) / (VP.norms(x[:25]) * VP.norms(x[25:]))).all()
