import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ticketflow.llm import resampling as RS
from ticketflow.llm.pieces import ALNUM_WORDS, SPACED_WORDS, word_pieces

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, max_run):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return ws, [" ".join(ws[i:i + n]) for n in range(1, max_run + 1) for i in range(len(ws) - n + 1)]


def brute(docs, target, percent, least, max_run, buckets):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in docs for f in features(t, max_run)[1])
    t = Counter(bucket(f) for x in target for f in features(x, max_run)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for d, text in docs:
        ws, fs = features(text, max_run)
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(fs), weight, weight + noise, len(ws) >= least])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    k = len(able) * percent // 100
    return sorted([(*r[:4], i + 1 if i < k else None) for i, r in enumerate(able)]
                  + [(*r[:4], None) for r in rows if not r[4]], key=repr)


@pytest.fixture(scope="module")
def docs(prose):
    rows = [(i, prose(i, 5 + i % 90)) for i in range(300)]
    rows += [(1000 + i, rows[40][1]) for i in range(60)]
    rows += [(7, rows[8][1]), (7, rows[50][1]), (None, rows[60][1]), (None, None), (2000, None), (2001, ""), (2002, " \t-!"),
             (2003, "É é Ünder ñ " * 30), (2004, "word " * 400_000), *[(2005, rows[70][1])] * 40]
    return rows


@pytest.mark.parametrize("max_run,percent,least,pivots", [(1, 10, 20, 15), (3, 35, 0, 4)])
def test_matches_brute_force(spark, make_docs, prose, docs, max_run, percent, least, pivots):
    target = [prose(40, 30), prose(5000, 60), None, ""]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    got = RS.resample(make_docs(docs), bench, percent, least, max_run, 97, pivots=pivots)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, target, percent, least, max_run, 97)


def test_target_like_documents_are_drawn(spark, make_docs, prose):
    rows = [(i, prose(i, 60)) for i in range(200)] + [(900 + i, " ".join(f"alpha{1 + j % 3} beta{1 + j % 3}" for j in range(30)) + f" {i}") for i in range(20)]
    bench = spark.createDataFrame([(1, "alpha1 beta1 alpha2 beta2 alpha3 beta3 " * 400)], "item_id bigint, text string")
    got = RS.resample(make_docs(rows), bench, percent=9).where("rank is not null").collect()
    assert len(got) == 19 and all(r.doc_id >= 900 for r in got)
    assert sorted(r["rank"] for r in got) == list(range(1, 20))


def test_empty_tables_and_extra_columns(spark, make_docs, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert RS.resample(make_docs([]), none).count() == 0
    wide = make_docs(docs[:30]).withColumn("rank", F.lit("x")).withColumn("key", F.lit(1)).withColumn("bucket", F.lit(0)).withColumn("a.b", F.lit(2))
    assert RS.resample(wide, none, percent=50).count() == 30


def test_kth_key_of_every_rank(spark):
    rows = spark.range(60).select(F.expr("id % 7").alias("score"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("doc_id"),
                                  F.lit(0).cast("bigint").alias("n_features"), F.lit(0).cast("bigint").alias("weight"))
    keyed = RS.materialize(rows.select(RS._order_key().alias("key")), "test-keys")
    want = sorted(tuple(r.key) for r in keyed.collect())
    for k in (1, 17, 60):
        assert RS.kth_key(keyed, k, pivots=2) == want[k - 1]


@pytest.mark.parametrize("size", [1, 2, 7, 100])
def test_pieces_hold_all_words(size):
    text = "Ab c-dé  \n x y \tLONG" + "z" * 50 + " end"
    data = text.encode()
    assert [w for p in word_pieces(data, SPACED_WORDS, size) for w in p] == data.split()
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    assert [w.decode() for p in word_pieces(data, ALNUM_WORDS, size) for w in p] == WORD.findall(lower)
    assert list(word_pieces(None, ALNUM_WORDS)) == [] and list(word_pieces(b" \n ", ALNUM_WORDS)) == []
