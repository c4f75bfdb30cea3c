import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ticketflow.llm import hmm as LM
from ticketflow.llm import toxicity as TX
from ticketflow.llm.common import materialize


def test_forward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    m = LM.Hmm(*(x / x.sum(axis=-1, keepdims=True) for x in (rng.random(3), rng.random((3, 3)), rng.random((3, 5)))))
    seqs = [np.array(s, np.uint16) for s in ([0], [1, 2, 0], [4, 4, 3, 2, 0])]
    for s, got in zip(seqs, LM.sequence_log10(m, seqs)):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(s)):
            p = m.start[path[0]] * m.emit[path[0], s[0]]
            for a, b, o in zip(path, path[1:], s[1:]):
                p *= m.move[a, b] * m.emit[b, o]
            total += p
        assert math.isclose(got, math.log10(total), rel_tol=1e-12)


def test_expected_counts_by_enumeration():
    rng = np.random.default_rng(2)
    m = LM.Hmm(*(x / x.sum(axis=-1, keepdims=True) for x in (rng.random(2), rng.random((2, 2)), rng.random((2, 3)))))
    seqs = [np.array(s, np.uint16) for s in ([2, 0, 1, 1], [0], [1, 2])]
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 3))
    for s in seqs:
        weight = {}
        for path in itertools.product(range(2), repeat=len(s)):
            p = m.start[path[0]] * m.emit[path[0], s[0]]
            for a, b, o in zip(path, path[1:], s[1:]):
                p *= m.move[a, b] * m.emit[b, o]
            weight[path] = p
        z = sum(weight.values())
        for path, p in weight.items():
            start[path[0]] += p / z
            for a, b in zip(path, path[1:]):
                move[a, b] += p / z
            for a, o in zip(path, s):
                emit[a, o] += p / z
    got = LM.expected_counts(m, seqs)
    for x, y in zip(got[:3], (start, move, emit)):
        np.testing.assert_allclose(x, y, rtol=1e-10)


def test_long_sequences_are_walked_in_spans(monkeypatch):
    rng = np.random.default_rng(3)
    m = LM.Hmm(*(x / x.sum(axis=-1, keepdims=True) for x in (rng.random(3), rng.random((3, 3)), rng.random((3, 6)))))
    seqs = [rng.integers(0, 6, n).astype(np.uint16) for n in (1, 200, 3, 57, 1, 64, 9)]
    whole, likely = LM.expected_counts(m, seqs), LM.sequence_log10(m, seqs)
    for tokens in (1, 5, 40):
        monkeypatch.setattr(LM, "CHUNK_TOKENS", tokens)
        assert len(LM._spans(sorted(seqs, key=len, reverse=True))) > 1
        np.testing.assert_allclose(LM.sequence_log10(m, seqs), likely, rtol=1e-10)
        for x, y in zip(LM.expected_counts(m, seqs), whole):
            np.testing.assert_allclose(x, y, rtol=1e-9)


def test_words_of_long_texts(monkeypatch):
    text = " Äb\x0bC ".encode() + b"X" * 50 + b"\t\t  y\r\n" * 9 + b"\x1cend"
    monkeypatch.setattr(LM, "PART_BYTES", 3)
    assert list(LM.tokens(text)) == text.lower().split() and list(LM.tokens(None)) == []


def test_frequent_words_fill_the_room(spark, monkeypatch):
    rng = random.Random(6)
    words = [(f"w{i}".encode(), rng.choice([1, 1, 1, 2, 3, 100, 101, 104])) for i in range(3000)] + [(b"top", 10 ** 6)]
    counts = materialize(spark.createDataFrame(words, "word binary, c bigint"), "t-frequent")
    by_count = sorted((c for _, c in words), reverse=True)
    for bits in (12, 2):
        monkeypatch.setattr(LM, "HASH_BITS", bits)
        for most in (0, 1, 700, 1500, 2500, 3001, 5000):
            got = LM.frequent_words(counts, most)
            assert set(got) <= set(words) and len(set(got)) == len(got) and got == sorted(got, key=lambda x: (-x[1], x[0]))
            # words of one hash group at the last level may stay out
            assert min(most, len(words)) - (2 if bits == 12 else 80) <= len(got) <= most
            assert [c for _, c in got] == by_count[:len(got)]


@pytest.fixture(scope="module")
def corpus(prose):
    a, b = prose(1, 60).split(), [w + "é" for w in prose(2, 60).split()]
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(a if i % 2 else b) for _ in range(rng.randint(1, 80)))) for i in range(150)]
    return rows + [(500, None), (501, ""), (502, " New, words. HERE \x0b\x1c x"), (None, a[0]), (1, rows[1][1])]


def test_scores_by_brute_force(make_docs, corpus):
    toks = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w]
    out_fold = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    train = [t for d, t in corpus if not out_fold(d)]
    counts = Counter(w for t in train for w in toks(t))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    got = LM.score_documents(make_docs(corpus), states=3, iterations=2, symbol_words=20, head_words=50).collect()
    top = sorted(counts, key=lambda w: (-counts[w], w.encode()))[:20]
    ids = {w: i + 1 for i, w in enumerate(top)}
    classes = [1.0] * LM.SHAPES
    for w, c in counts.items():
        if w not in ids:
            classes[LM.shape(w.encode())] += c + 1
    symbol = lambda w: ids.get(w, 21 + LM.shape(w.encode()))
    encoded = lambda t: np.array([symbol(w) for w in toks(t)] + [LM.END], np.uint16)
    share = np.array([len(train), *(counts[w] for w in top), *classes]) + 1
    share /= share.sum()
    model = LM.first_model(share, 3)
    for _ in range(2):
        start, move, emit, _ = LM.expected_counts(model, [encoded(t) for t in train])
        start, move, emit = start + LM.MOVE_PRIOR, move + LM.MOVE_PRIOR, emit + LM.SYMBOL_PRIOR * share
        model = LM.Hmm(start / start.sum(), *(x / x.sum(axis=1, keepdims=True) for x in (move, emit)))
    forward = LM.sequence_log10(model, [encoded(t) for _, t in corpus])
    in_class = [sum(math.log10((counts[w] + 1) / classes[LM.shape(w.encode())]) for w in toks(t) if w not in ids) for _, t in corpus]
    scores = [a + b for a, b in zip(forward, in_class)]
    np.testing.assert_allclose(sorted(r.score for r in got), sorted(scores), rtol=1e-9)
    want = []
    for d, t in corpus:
        cs = [counts[w] for w in toks(t)] + [len(train)]
        want.append((d, out_fold(d), len(cs), sum(c > 0 for c in cs), n, sum(math.log10((c + 1) / (n + v + 1)) for c in cs)))
    for r, w in zip(sorted(got, key=lambda r: repr(tuple(r)[:4]) + repr(round(r.base_score, 6))),
                    sorted(want, key=lambda w: repr(w[:4]) + repr(round(w[5], 6)))):
        assert tuple(r)[:5] == w[:5] and math.isclose(r.base_score, w[5], rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    held = [r for r in got if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_more_iterations_do_not_lower_the_likelihood(make_docs, corpus):
    docs = make_docs(corpus).select("doc_id", "text")
    counts = materialize(LM.word_counts(docs), "t-counts")
    lex = LM.fit_lexicon(counts, len(corpus), 30, 100)
    encoded = LM.encode(docs, lex, len(corpus))
    share = LM.symbol_shares(lex, len(corpus))
    model, seen = LM.first_model(share, 3), []
    for _ in range(4):
        model, log10 = LM.baum_welch_step(encoded, model, share)
        seen.append(log10)
    assert seen[0] < seen[1] < seen[2]
    for x in (model.start, model.move, model.emit):
        np.testing.assert_allclose(x.sum(axis=-1), 1.0)


def test_shape_agrees_with_its_column(spark):
    from pyspark.sql import functions as F
    words = [b"a", b"abc.", b"long-word,", "é".encode(), "ééé.".encode(), b"x1", b"abcdefghijk", b"z" * 40 + b"!"]
    df = spark.createDataFrame([(w,) for w in words], "word binary")
    got = df.select("word", LM.shape_expr(F.col("word")).alias("s")).collect()
    assert all(r.s == LM.shape(bytes(r.word)) for r in got)


def test_nothing_to_learn_from(make_docs):
    assert LM.score_documents(make_docs([])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = LM.score_documents(make_docs([(held, "a b")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and math.isfinite(r.score)


@pytest.fixture(scope="module")
def labelled(spark, make_docs, prose):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words, toxic = prose(i, rng.randint(20, 120)).split(), i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["vilest", "Scoundrel!", "YOU rotter", "you knave"]))
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    rows += [(9000, None), (9001, ""), (9002, "x" * 200_000), (None, "you rotter"), (0, rows[0][1])]
    labels += [(None, 1, 1), (3, None, None), (5, 1, 1)]
    return make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), rows


def test_held_out_accuracy_and_defined_rows(labelled):
    docs, labels, rows = labelled
    got = TX.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = sum(r.predicted == int(r.doc_id % 5 == 0) for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_rejection_keeps_columns(labelled):
    from pyspark.sql import functions as F
    docs, labels, rows = labelled
    wide = docs.withColumn("prediction", F.lit(1)).withColumn("probability", F.lit(2)).withColumn("features", F.lit(3))
    left = TX.remove_toxic(wide, labels)
    assert left.columns == wide.columns
    ids = [r.doc_id for r in left.collect() if r.doc_id is not None and r.doc_id < 600]
    assert sum(i % 5 == 0 for i in ids) <= 10 and sum(i % 5 != 0 for i in ids) >= 460


def test_labels_of_one_class_or_none(labelled, spark):
    docs, labels, _ = labelled
    assert {r.score for r in TX.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.predicted for r in TX.toxicity(docs, labels.where("toxic = 1")).collect()} == {1}
    assert TX.toxicity(docs.limit(0), labels).count() == 0


def lexicon_of(docs, toxic_of):
    """The lexicon of folds 2 and 3, counted without Spark."""
    pos, neg, n = Counter(), Counter(), [0, 0]
    for d, text in docs:
        if d in toxic_of and zlib.crc32(str(d).encode()) % 5 in (2, 3):
            n[toxic_of[d]] += 1
            (pos if toxic_of[d] else neg).update(set(TX.words((text or "").encode())))
    odds = lambda c, of: math.log((c + 0.5) / (of - c + 0.5))
    weights = {w: odds(c, n[1]) - odds(neg[w], n[0]) for w, c in pos.items() if c >= TX.MIN_DOCS}
    return {w: x for w, x in weights.items() if x >= TX.MIN_LOG_ODDS}


@pytest.fixture(scope="module")
def toxic_of(labelled):
    docs, labels, rows = labelled
    known = {}
    for r in labels.collect():
        if r.doc_id is not None and r.toxic is not None:
            known[r.doc_id] = max(known.get(r.doc_id, 0), r.toxic)
    return known


def test_lexicon_and_scores_by_brute_force(labelled, toxic_of, spark):
    from ticketflow.llm.boosted import score_boosted
    docs, labels, rows = labelled
    # the sample that trees are fitted on does not bound the lexicon
    model = TX.fit_toxicity(docs, labels, fit_rows=300)
    want = lexicon_of(rows, toxic_of)
    assert model.lexicon.tail is None and model.lexicon.head.keys() == want.keys() and len(want) >= 3
    assert all(math.isclose(model.lexicon.head[w], want[w], rel_tol=1e-12) for w in want)
    features = [(d, t, [float(x) for x in TX.text_features((t or "").encode(), model.lexicon.head)]) for d, t in rows]
    frame = spark.createDataFrame(features, f"doc_id bigint, text string, {TX.FEATURES} array<double>")
    by_hand = score_boosted(frame, TX.FEATURES, model.boosted, "score")
    key = lambda r: (repr(r.doc_id), r.text or "", r.text is None)
    got = model.score(docs.select("doc_id", "text")).collect()
    assert sorted((key(r), r.score) for r in got) == sorted((key(r), r.score) for r in by_hand.collect())


def test_lexicon_beyond_its_bytes_is_joined(labelled, toxic_of, make_docs):
    docs, labels, rows = labelled
    whole = TX.fit_toxicity(docs, labels)
    want = lexicon_of(rows, toxic_of)
    hidden = make_docs([(8000, "you sc0undrel r0tter"), (8001, " ".join(["scoundrel"] * 70_000)), (8002, "vilest v!lest")])
    wide = docs.unionByName(hidden).selectExpr("*", "1 as at", "2 as hits", "3 as row", "5 as word")
    one_less = sum(len(w) + TX.ENTRY_BYTES for w in want) - 1
    for room in (0, one_less):
        lexicon = TX.learn_lexicon(docs.join(TX.training_labels(labels).where("fold in (2, 3)"), "doc_id"), room)
        tail = {bytes(r.word): r.w for r in lexicon.tail.collect()}
        assert tail and {**lexicon.head, **tail}.keys() == want.keys() and not lexicon.head.keys() & tail.keys()
        got = TX.with_features(wide, lexicon)
        assert got.columns == [*wide.columns, TX.FEATURES]
        rows_of = lambda df: sorted(map(repr, df.collect()))
        assert rows_of(got) == rows_of(TX.with_features(wide, whole.lexicon))
    part = TX.with_features(docs.select("text"), lexicon)
    assert part.columns == ["text", TX.FEATURES] and part.count() == len(rows)
    scores = lambda m: sorted(repr(r) for r in m.score(docs.select("doc_id", "text")).collect())
    assert scores(TX.fit_toxicity(docs, labels, lexicon_bytes=0)) == scores(whole)


def test_features_of_hard_texts():
    lex = {b"rotter": 3.0}
    for t in (b"", b"a" * 100_000, b"!" * 10_000, "ÀÉ ".encode() * 100, b"r0tter you r.o.t.t.e.r"):
        assert all(math.isfinite(x) for x in TX.text_features(t, lex))
    f = TX.text_features(b"you r0tter", lex)
    assert f[6] == 1.0 and f[0] == 0.0
