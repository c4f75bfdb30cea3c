"""Registered queries against DuckDB (sf0.001), and the pipeline against brute force."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from check_oracle import TABLES, digest
from ticketflow.llm import toxicity as TX
from ticketflow.llm.oracle import ORACLES
from ticketflow.llm.queries import QUERIES
from ticketflow.session import scratch_path

from .test_decontaminate import brute as hits_of
from .test_near_dups import brute as components_of

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


@pytest.fixture(scope="module")
def tables(spark, make_docs, prose):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        words = prose(i, rng.randint(30, 90)).split()
        if i % 6 == 0:
            words.insert(5, "rotter!")
            words.insert(9, "knave")
        labels += [(i, 1, int(i % 6 == 0))] if i % 4 else []
        rows.append((i, " ".join(words), "big" if i % 10 else "small"))
    item = prose(7000, 40)
    rows += [(1000 + i, rows[7 + i % 3][1] + (" tail" if i % 2 else ""), "big") for i in range(30)]
    rows += [(2000 + i, prose(8000 + i, 30) + " " + " ".join(item.split()[i:i + 10 + i]), "small") for i in range(12)]
    rows += [(3000, None, None), (3001, "", "big")]
    folder = scratch_path(spark, "test-pipeline")
    docs = make_docs(rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    bench = [(1, item), (2, prose(7001, 6))]
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, bench


def test_pipeline_against_brute_force(spark, tables):
    folder, rows, bench = tables
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    toxic = {r.doc_id for r in TX.toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet")).where("predicted = 1").collect()}
    planted = {i for i in range(400) if i % 6 == 0}
    assert len(toxic ^ planted) <= 8
    left = [(d, t) for d, t, _ in rows if d not in toxic]
    kept = {r[0] for r in components_of(left, 5) if r[3]}
    clean = {r[0] for r in hits_of([x for x in left if x[0] in kept], bench) if not r[5]}
    assert clean.isdisjoint(range(2000, 2012)) and 3000 in clean
    drawn = P.run(spark, folder).collect()
    assert {r.doc_id for r in drawn} == clean
    small = [r for r in drawn if r.source == "small"]
    assert max(r.epoch for r in small) >= 1 and max(r.epoch for r in drawn if r.source == "big") == 0


def test_every_filtering_stage_keeps_the_columns(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, folder).schema == docs.schema


def test_stages_with_columns_of_any_name(spark, tables):
    """Dotted, back-quoted and helper names pass through every filtering stage."""
    folder, _, _ = tables
    names = ["meta.src", "odd`name", "__pred", "__tox_features", "__tox_score", "__prob", "__row", "row", "score", "component",
             "h", "l", "r", "n", "gram", "text.x", "words"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({n: F.lit(i) for i, n in enumerate(names)})
    for _, stage in P.STAGES[:-1]:
        left = stage(spark, docs, folder)
        assert left.schema == docs.schema
        first = left.first()
        assert [first[n] for n in names] == list(range(len(names)))
    assert P.STAGES[-1][1](spark, docs, folder).count() > 0


def test_pipeline_of_empty_tables(spark, make_docs):
    folder = scratch_path(spark, "test-pipeline")
    make_docs([]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert P.run(spark, folder).count() == 0
