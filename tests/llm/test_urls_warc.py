import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ticketflow.llm import url_filter as UF
from ticketflow.llm import warc as WA
from ticketflow.session import scratch_path

PAGES = "page_id bigint, url string, html string"


def test_host_path_and_rules():
    known = UF.rule_table(UF.RULES)
    cases = {
        None: ("", "", None), "": ("", "", None), "no scheme.net/x": ("", "", None),
        "http://A.Example.NET/en/x?y=/z#q": ("a.example.net", "/en/x", ("example.net/en/", "allow")),
        "http://example.net/de/": ("example.net", "/de/", ("net/", "block")),
        "https://badexample.net/en/": ("badexample.net", "/en/", ("net/", "block")),
        "http://x.org/fr/a": ("x.org", "/fr/a", ("org/fr/", "allow")),
        "http://x.org/fra": ("x.org", "/fra", None),
        "http://x.example.com/de/1": ("x.example.com", "/de/1", ("example.com/de/", "block")),
        "http://x.net": ("x.net", "", None), "http://x.net?a": ("x.net", "", None),
        "ftp://É.Org/a://b": ("É.org", "/a://b", None),
    }
    for url, (host, path, rule) in cases.items():
        assert UF.host_and_path(url) == (host, path)
        assert UF.fitting_rule(host, path, known) == rule


def test_urls_without_a_rule_get_a_learned_verdict(spark):
    rows = [(i, f"http://cheap-pills{i % 9}.shop.test/{i}?a=1&b=2&c={i}") for i in range(60)]
    rows += [(100 + i, f"https://news.site.test/articles/story-{i}") for i in range(60)]
    labelled = spark.createDataFrame([(u, int(i < 60)) for i, u in rows if i % 2], "url string, blocked int")
    pages = spark.createDataFrame([(*r, 1) for r in rows] + [(None, None, 1), (7, "http://y.net/", 2)],
                                  "page_id bigint, url string, host int")
    got = UF.judge_urls(pages, labelled=labelled).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r.rule is None and r.host:
            assert r.verdict == ("block" if "cheap" in r.host else "allow")
    assert [r.verdict for r in got if r.rule == "net/"] == ["block"]


def _labelled(spark, rows):
    hosts = [(u, UF.host_and_path(u)[0], b) for u, b in rows]
    return UF.label_urls(spark.createDataFrame(hosts, "url string, host string, blocked int"))


def test_suffix_statistics_by_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(f"http://h{rng.randint(0, 9)}.d{rng.randint(0, 3)}.{rng.choice(['aa', 'bb'])}/{i}", rng.randint(0, 1)) for i in range(200)]
    rows += [("http://hot.d0.aa/" + str(i), i % 2) for i in range(100)] + [("http://aa/", 1), ("x", 0), ("http://é.d9.bb", 1)]
    labelled = _labelled(spark, rows)
    known = {r.url: r for r in labelled.withColumn("shown", UF.levels_seen(F.col("url"))).collect()}
    assert len(known) == len(rows)
    assert {r.shown for r in known.values()} == {0, 1, 2, 3}

    def level(host, i):
        return ".".join(host.split(".")[-i:]) if i < 3 else host

    def expected(url, host, fitting):
        seen = []
        for i in (1, 2, 3):
            others = [r for r in known.values() if level(r.host, i) == level(host, i)]
            if fitting:
                others = [r for r in others if r.fold != known[url].fold and known[url].shown >= i]
            seen.append((len(others), sum(r.blocked for r in others)))
        return UF.url_features(url, seen, 0.4)

    counts = UF.suffix_counts(labelled)
    new = spark.createDataFrame([("http://new.d0.aa/q", "new.d0.aa"), ("http://n.zz/", "n.zz"), (None, "")], "url string, host string")
    for bound in (None, 0):
        if bound is not None:
            monkeypatch.setattr(UF, "bounded_broadcast", lambda df, n: (df, False))
            monkeypatch.setattr(UF, "HOT_ROWS", 30)
        for fitting, urls in ((True, labelled), (False, labelled.select("url", "host").unionByName(new))):
            got = UF.with_url_features(UF.with_counts(urls, counts), 0.4, fitting).collect()
            assert len(got) == urls.count()
            for r in got:
                assert r.features == pytest.approx(expected(r.url, r.host, fitting))


def test_unseen_hosts_are_judged_by_their_form(spark):
    """Half of the urls of an unknown top-level name look like the blocked ones."""
    bad = lambda i, top: f"http://w{i}.shop{i % 40}.{top}/{i * 7919}?id={i}&ref={i * 31}&s=1"
    good = lambda i, top: f"https://w{i}.site{i % 40}.{top}/articles/story-of-the-day"
    rows = [(bad(i, "one"), 1) for i in range(300)] + [(good(i, "two"), 0) for i in range(300)]
    labelled = _labelled(spark, rows)
    assert UF.held_out_quality(labelled, "domain")["accuracy"] >= 0.95
    assert UF.held_out_quality(labelled)["auc"] >= 0.95
    pages = spark.createDataFrame([(i, bad(i, "new")) for i in range(50)] + [(100 + i, good(i, "new")) for i in range(50)],
                                  "page_id bigint, url string")
    got = UF.judge_urls(pages, labelled=labelled.select("url", "blocked")).collect()
    assert len(got) == 100
    assert sum(r.verdict == ("block" if r.page_id < 100 else "allow") for r in got) >= 95


def test_filter_without_labels_or_rows(spark):
    empty = spark.createDataFrame([], PAGES)
    assert UF.judge_urls(empty).count() == 0
    one = UF.judge_urls(spark.createDataFrame([(1, "http://x.test/", "")], PAGES)).collect()
    assert (one[0].rule, one[0].verdict) == (None, "allow")


@pytest.fixture(scope="module")
def pages(spark):
    long, other = "é" * 700, "x" * 2000
    rows = [(1, "http://a.b.c/x", long), (2, "http://a.b.c/y", long), (3, "http://q/", "short"), (4, "http://q/", "short"),
            (5, None, None), (6, "nothing", ""), (7, "http://B.c/\tz", other), (9, "http://B.c/\tz", other),
            (9, "http://B.c/\tz", other), (None, "http://n/", other), (10, "http://h/", "y" * 999), (11, "http://h/", "y" * 999),
            (12, "http://h/", "<p>\r\n\r\nWARC/1.0\r\n" * 200)]
    rows += [(100 + i, "http://hot.test/", f"page {i} " * 5) for i in range(300)]
    return spark.createDataFrame(rows, PAGES)


def test_archive_round_trip(pages):
    want = []
    rows = pages.collect()
    for r in rows:
        body = (r.html or "").encode()
        same = [x.page_id for x in rows if (x.html or "").encode() == body and x.page_id is not None]
        last = max(same, default=None)
        revisit = len(body) >= 1000 and last is not None and r.page_id != last
        want.append((r.page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response",
                     last if revisit else None))
    got = [tuple(r) for r in WA.archive_and_read(pages).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # and with the repeated payloads too many to broadcast
    again = WA.classify(pages, max_broadcast=0).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in again.collect()), key=repr) == sorted(want, key=repr)


def test_index_of_small_blocks_finds_all_captures_of_a_key(spark, pages):
    folder = scratch_path(spark, "test-warc")
    manifest = WA.write_archives(WA.classify(pages), folder, max_bytes=2000)
    index = WA.build_index(manifest, f"{folder}/index", block_lines=3)
    keys = spark.createDataFrame([("test,hot)/",), ("c,b)/%09z",), ("no,such)/",), (")nothing",), (")",), (None,)], "surt string")
    got = WA.lookup(index, keys)
    counts = {r.surt: r["count"] for r in got.groupBy("surt").count().collect()}
    assert counts == {"test,hot)/": 300, "c,b)/%09z": 3, ")nothing": 1, ")": 1}
    assert WA.read_records(got, folder).count() == 305


def test_records_are_valid_members():
    data = WA.record_bytes(3, "http://a/ b", b"body", "d1", "revisit", 9)
    headers, payload = WA.parse_record(gzip.decompress(gzip.compress(data)))
    assert payload == b"" and headers["WARC-Refers-To"] == "<urn:page:9>" and headers["WARC-Target-URI"] == "http://a/%20b"
    assert WA.archive_and_read.__doc__


def test_empty_archive(spark):
    assert WA.archive_and_read(spark.createDataFrame([], PAGES)).count() == 0
