"""URL filter: rules first, then boosted trees on lexical features of the url.

A rule is a host and a path prefix with an action; it fits the host and all its
subdomains, and the longest fitting rule decides. Urls without a rule get the
verdict of trees trained from labelled urls (here: those that rules label) on
length, depth, digits, entropy, parameters and statistics of host suffixes.

Suffix statistics (labelled and blocked urls of a top-level name, a domain and a
host) are counted over all labelled urls, by fold of the url, and joined. A url
that trees are fitted on sees the counts of the other folds only, and some of
them see fewer levels or none, as urls of hosts, domains or top-level names that
nobody labelled will.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.boosted import BoostedModel, bounded_sample, fit_boosted, score_boosted
from ticketflow.llm.common import bounded_broadcast, map_arrow, materialize

FIT_ROWS = 100_000
# Folds of labelled urls; a fitted url sees the statistics of the others.
FOLDS = 5
# Of ten fitted urls, how many see no level, the top-level name only, and that and the domain.
HIDDEN = (2, 2, 2)
LEVELS = ("top", "domain", "host")
# Pseudo-counts that pull a suffix's block rate to the overall one.
SMOOTHING = 20.0
# A key is hot from this share of the rows of a join (so at most 1000 keys are); its rows are dealt over SALTS.
HOT_SHARE, HOT_ROWS, SALTS = 0.001, 10_000, 64
# Bytes of the counts of a host in memory, besides its name: 6 arrays of FOLDS longs and their headers.
COUNT_BYTES = 6 * (8 * FOLDS + 32) + 64

RULES: tuple[tuple[str, str], ...] = (
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

_LOWER = {i: i + 32 for i in range(65, 91)}
SPLIT = re.compile(r"[^/?#]*")
PATH = re.compile(r"[^?#]*")


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = SPLIT.match(rest)[0]
    return host.translate(_LOWER), PATH.match(rest, len(host))[0]


def suffixes(host: str) -> list[str]:
    """The host and its parents, longest first."""
    out = [host]
    while "." in host:
        host = host.partition(".")[2]
        out.append(host)
    return out


def fitting_rule(host: str, path: str, rules: dict[str, list[tuple[str, str, str]]]) -> tuple[str, str] | None:
    """``(rule, action)`` of the longest rule that fits; of equal ones the first."""
    best = None
    for s in suffixes(host):
        for prefix, rule, action in rules.get(s, ()):
            if path.startswith(prefix) and (best is None or len(rule) > len(best[0])):
                best = rule, action
    return best


def rule_table(rules: tuple[tuple[str, str], ...]) -> dict[str, list[tuple[str, str, str]]]:
    out: dict[str, list[tuple[str, str, str]]] = {}
    for action, rule in rules:
        host, _, path = rule.partition("/")
        out.setdefault(host, []).append((f"/{path}", rule, action))
    return out


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def url_features(url: str | None, seen: Sequence[tuple[int, int]], rate: float) -> list[float]:
    """Lexical features; ``seen`` has labelled and blocked urls of the url's
    top-level name, domain and host, ``rate`` the share of blocked ones overall."""
    u = url or ""
    host, path = host_and_path(u)
    labels = host.split(".")
    query = u.partition("?")[2].partition("#")[0]
    params = [p for p in query.split("&") if p]
    digits = sum(c.isdigit() for c in u)
    out = [float(len(u)), float(len(host)), float(len(path)), float(len(labels)),
           float(sum(1 for p in path.split("/") if p)), digits / max(1, len(u)),
           sum(c.isdigit() for c in host) / max(1, len(host)), _entropy(host), _entropy(path),
           float(len(params)), float(len(query)), float(u.count("-")), float("#" in u), float("%" in u),
           float(max(map(len, labels))), float(u.startswith("https")), float(path.endswith("/"))]
    for n, blocked in seen:
        out += [math.log1p(n), (blocked + SMOOTHING * rate) / (n + SMOOTHING)]
    return out


def apply_rules(pages: DataFrame, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    """``(page_id, url, host, path, rule, action)``; the rules travel with the tasks."""
    known = rule_table(rules)

    def run(batches):
        for b in batches:
            ids, urls = b.column(0), b.column(1).to_pylist()
            parts = [host_and_path(u) for u in urls]
            hits = [fitting_rule(h, p, known) or (None, None) for h, p in parts]
            yield {"page_id": ids, "url": urls, "host": [x[0] for x in parts], "path": [x[1] for x in parts],
                   "rule": [x[0] for x in hits], "action": [x[1] for x in hits]}

    return map_arrow(pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url"), run,
                     "page_id bigint, url string, host string, path string, rule string, action string")


def top_level(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def fold_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(5), url), F.lit(FOLDS)).cast("int")


def levels_seen(url: Column) -> Column:
    """How many levels of statistics a url shows while trees are fitted."""
    place = F.pmod(F.xxhash64(F.lit(6), url), F.lit(10))
    none, top, dom = HIDDEN
    return (F.when(place < none, 0).when(place < none + top, 1)
            .when(place < none + top + dom, 2).otherwise(3))


def join_spread(left: DataFrame, right: DataFrame, key: str, row_bytes: Column) -> DataFrame:
    """Left join with ``right``, a written table with one row a key.

    A broadcast if the counted bytes of ``right`` fit the bound. Otherwise a
    shuffle join in which the rows of hot keys are dealt over ``SALTS`` parts.
    """
    small, hinted = bounded_broadcast(right, row_bytes)
    if hinted:
        return left.join(small, key, "left")
    keys = materialize(left.groupBy(key).agg(F.count(F.lit(1)).alias("rows")), f"url-keys-{key}")
    least = max(HOT_ROWS, HOT_SHARE * (keys.agg(F.sum("rows")).first()[0] or 0))
    # at most 1 / HOT_SHARE keys
    hot = [r[0] for r in keys.where(F.col("rows") >= least).select(key).collect()]
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    salt = F.when(is_hot, F.pmod(F.xxhash64(*left.columns), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    salts = F.sequence(F.lit(0).cast("long"), F.when(is_hot, F.lit(SALTS - 1)).otherwise(F.lit(0)).cast("long"))
    return (left.withColumn("salt", salt)
            .join(right.withColumn("salt", F.explode(salts)), [key, "salt"], "left").drop("salt"))


def suffix_counts(labelled: DataFrame) -> dict[str, DataFrame]:
    """By level, a table ``(level, n, b)``: labelled and blocked urls of each
    fold, of all of ``labelled`` (``url, host, blocked, fold``)."""
    def sums(n, b):
        return [F.array(*[F.sum(x(i)).cast("long") for i in range(FOLDS)]).alias(c) for c, x in (("n", n), ("b", b))]

    in_fold = lambda i: F.col("fold") == i
    hosts = materialize(labelled.groupBy("host").agg(*sums(
        lambda i: in_fold(i).cast("long"), lambda i: F.when(in_fold(i), F.col("blocked")).otherwise(0))), "url-host-counts")
    more = sums(lambda i: F.col("n")[i], lambda i: F.col("b")[i])
    domains = materialize(hosts.groupBy(domain(F.col("host")).alias("domain")).agg(*more), "url-domain-counts")
    tops = materialize(domains.groupBy(top_level(F.col("domain")).alias("top")).agg(*more), "url-top-counts")
    return {"top": tops, "domain": domains, "host": hosts}


def with_counts(urls: DataFrame, counts: dict[str, DataFrame]) -> DataFrame:
    """``urls`` with ``top_n, top_b, domain_n, …``: arrays of each fold's counts,
    null where nothing is labelled. Names, not urls, meet the shorter suffixes."""
    named = {level: counts[level].select(level, F.col("n").alias(f"{level}_n"), F.col("b").alias(f"{level}_b"))
             for level in LEVELS}
    hosts = urls.groupBy("host").agg(domain(F.first("host")).alias("domain")).withColumn("top", top_level(F.col("domain")))
    for level in LEVELS:
        hosts = join_spread(hosts, named[level], level, F.octet_length(level) + COUNT_BYTES)
    hosts = materialize(hosts.drop("domain", "top"), "url-host-statistics")
    return join_spread(urls, hosts, "host", F.octet_length("host") + COUNT_BYTES)


def with_url_features(df: DataFrame, rate: float, fitting: bool = False) -> DataFrame:
    """Features for the counts of ``with_counts``, whose columns go: all counts,
    or for fitting (``url, fold`` given) those of other folds, some levels hidden."""
    def total(c: str) -> Column:
        sums = F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y)
        return F.coalesce(sums - F.col(c)[F.col("fold")] if fitting else sums, F.lit(0).cast("long"))

    shown = levels_seen(F.col("url")) if fitting else F.lit(len(LEVELS))
    helpers = [f"{level}_{x}" for level in LEVELS for x in "nb"]
    seen = F.array(*[F.when(shown > i // 2, total(c)).otherwise(0) for i, c in enumerate(helpers)])
    df = df.withColumn("seen", seen).drop(*helpers)

    def run(batches):
        for b in batches:
            cols = dict(zip(b.schema.names, b.columns))
            seen = cols.pop("seen").to_pylist()
            yield {**cols, "features": [url_features(u, list(zip(s[::2], s[1::2])), rate)
                                        for u, s in zip(cols["url"].to_pylist(), seen)]}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.drop("seen").schema.fields)
    return map_arrow(df, run, f"{fields}, features array<double>")


@dataclass(frozen=True)
class UrlModel:
    """Trees, the counts they look up and the overall share of blocked urls."""

    boosted: BoostedModel
    counts: dict[str, DataFrame]
    rate: float

    def score(self, urls: DataFrame) -> DataFrame:
        """``urls`` (with ``url, host``) and ``p_block``, the probability of block."""
        return score_boosted(with_url_features(with_counts(urls, self.counts), self.rate),
                             "features", self.boosted, "p_block")


def label_urls(labelled: DataFrame) -> DataFrame:
    """Distinct urls ``(url, host, blocked, fold)`` of rows with a url and a label;
    a url labelled twice is blocked if any of its labels says so."""
    return materialize(labelled.where("url is not null and blocked is not null")
                       .groupBy("url", "host").agg(F.max("blocked").cast("int").alias("blocked"))
                       .withColumn("fold", fold_of(F.col("url"))), "url-labelled")


def fit_urls(rows: DataFrame, fit_rows: int = FIT_ROWS) -> UrlModel:
    """Count suffixes over all of ``rows`` (of ``label_urls``), fit trees on at
    most ``fit_rows`` of them, chosen by hash."""
    rate = float(rows.agg(F.avg("blocked")).first()[0] or 0.0)
    counts = suffix_counts(rows)
    sample = with_counts(bounded_sample(rows, "url", fit_rows), counts)
    fitted = materialize(with_url_features(sample, rate, fitting=True).select("features", "blocked"), "url-features")
    return UrlModel(fit_boosted(fitted, "features", "blocked"), counts, rate)


def held_out_quality(rows: DataFrame, part: str = "url", fit_rows: int = FIT_ROWS) -> dict[str, float]:
    """Accuracy and area under the curve on a tenth of ``rows`` (of ``label_urls``).

    The tenth is taken by hash of ``part``: the url, or the host or domain, so
    that the judged urls have hosts or domains of which no url was labelled.
    """
    by = domain(F.col("host")) if part == "domain" else F.col(part)
    out = F.pmod(F.xxhash64(F.lit(7), by), F.lit(10)) == 0
    scored = materialize(fit_urls(rows.where(~out), fit_rows).score(rows.where(out)).select("blocked", "p_block"), "url-held-out")
    right = ((F.col("p_block") >= 0.5).cast("int") == F.col("blocked")).cast("double")
    n, pos, accuracy = scored.agg(F.count(F.lit(1)), F.coalesce(F.sum("blocked"), F.lit(0)), F.avg(right)).first()
    area = BinaryClassificationEvaluator(rawPredictionCol="p_block", labelCol="blocked").evaluate(scored) if 0 < pos < n else None
    return {"rows": n, "blocked": pos, "accuracy": accuracy, "auc": area}


def rule_labels(judged: DataFrame) -> DataFrame:
    """``(url, host, blocked)`` of the urls that a rule decides."""
    return judged.where("rule is not null").select("url", "host", (F.col("action") == "block").cast("int").alias("blocked"))


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, labelled: DataFrame | None = None,
               fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``pages``: ``page_id, host, path, rule, verdict``.

    ``labelled``: rows ``(url, blocked)`` to train from; by default the urls
    that a rule labels. At most ``fit_rows`` distinct urls are fitted, chosen by
    hash; statistics of suffixes are counted over all of them.
    A null url has an empty host and path, fits no rule and is judged by its
    (empty) features; rows that repeat are judged alike; labels of one class
    give that class as the verdict, no labels give allow.
    """
    judged = apply_rules(pages, rules)
    if labelled is None:
        labelled = rule_labels(judged)
    else:
        known = apply_rules(labelled.select(F.col("blocked").cast("bigint").alias("page_id"), "url"), ())
        labelled = known.select("url", "host", F.col("page_id").cast("int").alias("blocked"))
    scored = fit_urls(label_urls(labelled), fit_rows).score(judged)
    by_model = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("action", by_model).alias("verdict"), "p_block")
