import math

import pytest

from ticketflow.llm import mixing as MX


@pytest.fixture(scope="module")
def docs(make_docs, prose):
    rows = [(i, prose(i, 5 + i % 40), "big") for i in range(300)]
    rows += [(1000 + i, prose(i, 10), "mid") for i in range(60)]
    rows += [(2000 + i, prose(i, 12), "small") for i in range(10)]
    rows += [(3000, prose(5, 20), None), (3001, None, None), (3002, "", "blank"), (None, "a b c", "small"),
             (2000, prose(0, 12), "small")]
    return make_docs(rows)


def tokens(docs):
    out = {}
    for r in docs.collect():
        out.setdefault(r.source, []).append(len((r.text or "").split()))
    return out


def test_repetition_limit_draws_every_document_and_respects_the_limit(docs):
    by = tokens(docs)
    total = {s: sum(x) for s, x in by.items()}
    drawn = MX.mix(docs, max_repeats=4.0).collect()
    assert {(r.doc_id, r.source) for r in drawn} == {(r.doc_id, r.source) for r in docs.collect()}
    got = {s: sum(r.n_tokens for r in drawn if r.source == s) for s in by}
    assert got["big"] == total["big"]
    most = max(total.values())
    least = min(v for v in total.values() if v)
    a = max(0.0, 1 - math.log(4) / math.log(most / least))
    for s, t in total.items():
        want = (t / most) ** a * most if t else 0
        assert want - 1 <= got[s] <= want + max(by[s]) + 1
        assert got[s] <= 4 * t + max(by[s])


def test_each_pass_is_a_permutation_of_its_own(docs):
    drawn = MX.mix(docs, max_repeats=4.0).collect()
    first = {r.place: r.doc_id for r in drawn if r.source == "small" and r.epoch == 0}
    second = {r.place: r.doc_id for r in drawn if r.source == "small" and r.epoch == 1}
    assert [first[k] for k in sorted(first)] != [second[k] for k in sorted(second)]
    again = MX.mix(docs, max_repeats=4.0).collect()
    assert sorted(map(tuple, drawn), key=repr) == sorted(map(tuple, again), key=repr)


def test_budget_and_entropy(spark, docs):
    drawn = MX.mix(docs, target_entropy=0.9, budget_tokens=1000).collect()
    assert 1000 - 10 <= sum(r.n_tokens for r in drawn) <= 1000 + 5 * 45
    sources = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "source string, tokens bigint")
    exponent = MX.bisect_exponent(sources, target_entropy=0.9)
    w = [(t / 1110) ** exponent for t in (1000, 100, 10)]
    p = [x / sum(w) for x in w]
    assert abs(-sum(x * math.log(x) for x in p) / math.log(3) - 0.9) < 1e-9
    exponent = MX.bisect_exponent(sources, max_repeats=4.0)
    assert abs(100 ** (1 - exponent) - 4) < 1e-6
    assert MX.bisect_exponent(sources, max_repeats=1000.0) < 1e-9
    assert MX.bisect_exponent(sources.limit(1), target_entropy=0.5) == 1.0


def test_degenerate_tables(make_docs):
    assert MX.mix(make_docs([]), max_repeats=4.0).count() == 0
    rows = MX.mix(make_docs([(1, None, "a"), (2, "", None)]), max_repeats=4.0).collect()
    assert sorted((r.doc_id, r.epoch) for r in rows) == [(1, 0), (2, 0)]
    with pytest.raises(ValueError):
        MX.mix(make_docs([(1, "x", "a")]))


def test_no_python_in_the_plan(docs):
    assert "Python" not in MX.mix(docs, max_repeats=4.0)._jdf.queryExecution().executedPlan().toString()


def test_many_passes_are_dealt_in_parts(spark):
    planned = spark.createDataFrame([(1, "a", "x", 3, 25), (1, "a", "x", 3, 25), (2, "b", "y", 2, 10), (3, None, "z", 1, 1), (4, "c", "w", 0, 0)],
                                    "doc_id long, source string, h string, n_tokens long, whole long")
    for passes in (1, 7, 10, 25, 1000):
        got = MX.whole_passes(planned, 25, seed=17, passes=passes).collect()
        want = MX.whole_passes(planned, 0, seed=17, passes=1000).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
        assert sorted((r.doc_id, r.epoch) for r in got) == sorted(
            [(1, e) for e in range(25)] * 2 + [(2, e) for e in range(10)] + [(3, 0)])


def test_a_tiny_source_is_drawn_very_often(make_docs, prose):
    docs = make_docs([(i, prose(i, 400), "big") for i in range(200)] + [(900, "one", "tiny"), (901, "two", "tiny")])
    drawn = MX.mix(docs, target_entropy=1.0)
    tiny = drawn.where("source = 'tiny'").groupBy("doc_id").count().collect()
    assert {r.doc_id for r in tiny} == {900, 901}
    assert all(abs(r["count"] - 40_000) <= 1 for r in tiny)
