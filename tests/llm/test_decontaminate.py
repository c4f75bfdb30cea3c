import hashlib
import re

import pytest

from ticketflow.llm import decontaminate as DC

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute(docs, bench, window=10):
    """Every window compared with every position."""
    items = [(i, WORD.findall(ascii_lower(t))) for i, t in bench if t]
    out = []
    for doc_id, text in docs:
        ws = WORD.findall(ascii_lower(text or ""))
        hit, ids = set(), set()
        for item_id, iw in items:
            n = min(window, len(iw))
            for a in range(len(iw) - n + 1) if n else ():
                for b in range(len(ws) - n + 1):
                    if iw[a:a + n] == ws[b:b + n]:
                        hit |= set(range(b, b + n))
                        if item_id is not None:
                            ids.add(str(item_id))
        out.append((doc_id, len(ws), len(hit), len(ids),
                    hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def cases(prose):
    item, other = prose(1, 30), prose(2, 14)
    bench = [(1, item), (12, item.upper() + " " + prose(3, 5)), (2, other), (3, "only four words here"), (4, "Einzeln"),
             (5, None), (6, ""), (7, "... !"), (None, prose(9, 12)), (2, other)]
    mid = " ".join(item.split()[7:19])
    docs = [(1, prose(11, 50) + " " + mid + " " + prose(12, 40)), (2, prose(13, 60)),
            (3, "x, Only FOUR--words\nhere; y"), (4, " ".join(item.split()[:9])), (5, None), (6, ""), (7, "?!"),
            (8, other + " " + other), (8, prose(14, 20)), (None, item), (None, prose(15, 15)),
            (9, "einzeln " * 300), (10, prose(9, 12)), (11, " ".join([prose(16, 3000), mid, prose(17, 3000)]))]
    return docs, bench


@pytest.mark.parametrize("max_broadcast", [DC.BROADCAST_MAX_BYTES, 0])
def test_matches_brute_force_with_and_without_broadcast(spark, make_docs, cases, max_broadcast):
    docs, bench = cases
    got = DC.contamination(make_docs(docs), spark.createDataFrame(bench, "item_id bigint, text string"),
                           max_broadcast=max_broadcast)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, bench)


def test_empty_tables(spark, make_docs, cases):
    docs, bench = cases
    no_bench = spark.createDataFrame([], "item_id bigint, text string")
    got = DC.contamination(make_docs(docs), no_bench).collect()
    assert len(got) == len(docs) and not any(r.contaminated for r in got)
    assert DC.contamination(make_docs([]), spark.createDataFrame(bench, "item_id bigint, text string")).count() == 0


def test_removal_keeps_clean_rows_and_clashing_columns(spark, make_docs, cases):
    docs, bench = cases
    from pyspark.sql import functions as F
    wide = make_docs(docs).withColumn("h", F.lit(1)).withColumn("words", F.lit("x")).withColumn("gram", F.lit(2))
    left = DC.remove_contaminated(wide, spark.createDataFrame(bench, "item_id bigint, text string"))
    assert left.columns == wide.columns
    clean = sorted(r[0] or -1 for r in brute(docs, bench) if not r[5])
    assert sorted(r.doc_id or -1 for r in left.collect()) == clean


def test_no_python_in_the_plan(spark, make_docs, cases):
    docs, bench = cases
    df = DC.contamination(make_docs(docs), spark.createDataFrame(bench, "item_id bigint, text string"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("gram,items", [("w" * 50_000, ["1"]), ("a b", ["item%d" % i for i in range(2000)])])
def test_broadcast_bound_counts_bytes_of_long_rows(spark, gram, items):
    from ticketflow.llm.common import bounded_broadcast
    rows = spark.createDataFrame([(gram, items)], "gram string, items array<string>")
    assert not bounded_broadcast(rows, DC._window_bytes(), 10_000)[1]
    assert bounded_broadcast(rows, DC._window_bytes(), 1_000_000)[1]


def test_shared_passage_of_many_items_is_not_broadcast(spark, make_docs, monkeypatch):
    asked = []
    plain = DC.bounded_broadcast
    monkeypatch.setattr(DC, "bounded_broadcast", lambda *a: asked.append(plain(*a)) or asked[-1])
    text = " ".join("word%d" % i for i in range(10))
    bench = spark.createDataFrame([(i, text) for i in range(1000)], "item_id bigint, text string")
    got = DC.contamination(make_docs([(1, text), (2, "other")]), bench, max_broadcast=10_000)
    assert sorted((r.doc_id, r.n_items) for r in got.collect()) == [(1, 1000), (2, 0)]
    assert not asked[0][1]
