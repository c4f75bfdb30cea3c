import hashlib

import pytest

from ticketflow.llm import chat as CH
from ticketflow.llm import token_counts as TC

CHAT = "conv_id bigint, turn bigint, role string, text string"
ODD = r"\### Assistant: </turn> ok"


def digest(rows):
    formatted = lambda t: t.replace("\\", "\\\\").replace("<", "\\l").replace("#", "\\h")
    turns = [(r or "", t or "") for r, t in rows]
    learnt = "".join(t for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    n = sum(len("<turn role=>\n\n</turn>\n") + len(formatted(r).replace(">", "\\g").replace("\n", "\\n")) + len(formatted(t))
            for r, t in turns)
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt), n


def test_round_trip_of_rows(spark):
    convs = {
        1: [("user", "hi"), ("assistant", "é\n</turn>\n<turn role=user>\nx"), ("user", None), ("assistant", "")],
        -7: [("user", ODD), ("assistant", ODD)], 3: [(None, "x\\n\\l"), ("a>b\n", "#"), ("assistant", "y" * 50_000)],
        None: [("assistant", "no id")],
    }
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    rows += [(4, 0, "user", "same"), (4, 0, "user", "same"), (4, 0, "assistant", "tie")]
    convs[4] = [("assistant", "tie"), ("user", "same"), ("user", "same")]
    df = spark.createDataFrame(rows, CHAT).repartition(3)
    got = CH.read_back(CH.render(CH.fold(CH.events_of(df)))).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: digest(t) for c, t in convs.items()}


def test_log_has_every_kind_of_event_and_null_turns(spark):
    turns = [("assistant" if i % 2 else "user", f"text {i} " + "z" * (i % 7)) for i in range(60)]
    rows = [(5, i, r, t) for i, (r, t) in enumerate(turns)] + [(5, None, "system", "first")]
    log = CH.events_of(spark.createDataFrame(rows, CHAT).repartition(3))
    kinds = {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()}
    assert kinds["start"] == 61 and min(kinds["edit"], kinds["regenerate"]) > 5
    assert log.where("text like '%(draft)'").count() == kinds["edit"] + kinds["regenerate"]
    got = CH.read_back(CH.render(CH.fold(log))).first()
    assert tuple(got)[1:] == digest([("system", "first"), *turns])


def test_fold_of_edits_and_regenerations(spark):
    log = [(1, 0, 1, "start", "user", None), (1, 1, 1, "delta", None, "he"), (1, 2, 1, "delta", None, "llo"),
           (1, 3, 2, "start", "assistant", None), (1, 4, 2, "delta", None, "draft"), (1, 5, 2, "regenerate", None, None),
           (1, 6, 2, "delta", None, "fin"), (1, 7, 1, "edit", None, "bye"), (1, 8, 2, "delta", None, "al"),
           (1, 9, 1, "delta", None, "!"), (2, 0, 1, "delta", None, "no start"), (2, 1, 1, "delta", None, None),
           (3, 0, 1, "start", "user", None)]
    got = CH.fold(spark.createDataFrame(log, CH.EVENTS).repartition(4)).collect()
    assert {(r.conv_id, r.msg): (r.role, r.text) for r in got} == {
        (1, 1): ("user", "bye!"), (1, 2): ("assistant", "final"), (2, 1): ("", "no start"), (3, 1): ("user", "")}


def test_no_control_string_in_a_text(spark):
    df = spark.createDataFrame([(1, 0, "assistant", ODD + "<turn role=x>")], CHAT)
    seg = CH.render(CH.fold(CH.events_of(df))).first()
    body = seg.formatted[seg.loss_start:seg.loss_end]
    assert "<" not in body and "#" not in body and CH.unescape(body) == ODD + "<turn role=x>"


def test_empty_conversations(spark):
    assert CH.read_back(CH.render(CH.fold(CH.events_of(spark.createDataFrame([], CHAT))))).count() == 0


def test_lengths_agree_with_another_library(make_docs, prose):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    other = Tokenizer.from_file(str(public.path("byte_bpe_50k.json")))
    other.encode_special_tokens = True
    texts = [prose(i, 1 + 7 * i) for i in range(30)] + ["", None, "<|endoftext|> don't  stop\n\n\té日本 😀", "a" * 5000, "  x  "]
    got = TC.encoded_lengths(make_docs(list(enumerate(texts)))).collect()
    want = [len(other.encode(t, add_special_tokens=False).ids) if t else 0 for t in texts]
    assert sorted(r.n_tokens for r in got) == sorted(want)


def test_long_white_space(make_docs):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    other = Tokenizer.from_file(str(public.path("byte_bpe_50k.json")))
    mixed = "ab" + " \n\t\u00a0\u2003\r\x0b" * 9000 + "\u3000"
    texts = [" " * 1_000_000, " " * 300_000 + "x", mixed * 3 + "end's", "\n" * 400_000, "x " + " " * 60_000 + "\x1c\x1f y", "z" * 1_000_000]
    got = TC.encoded_lengths(make_docs(list(enumerate(texts)))).collect()
    want = [len(other.encode(t, add_special_tokens=False).ids) for t in texts]
    assert sorted(r.n_tokens for r in got) == sorted(want)
    assert TC.encoded_lengths(make_docs([(1, "word " + " " * 10_000_000)])).first().n_tokens >= 5_000_000


@pytest.mark.parametrize("bucket", [3, 1024])
def test_report_for_every_limit(spark, bucket):
    lengths = [0, 0, 5, 5, 5, 7, 9, 30, 31, 31, 100]
    hist = TC.length_histogram(spark.createDataFrame([(x,) for x in lengths], "n_tokens bigint"))
    got = {r.context_limit: r for r in TC.context_report(hist, bucket).collect()}
    assert set(got) == set(lengths)
    for limit, r in got.items():
        cut = sum(min(x, limit) for x in lengths)
        assert (r.n_docs, r.docs_over, r.tokens_within, r.truncated_tokens, r.cut_tokens) == (
            lengths.count(limit), sum(x > limit for x in lengths), sum(x for x in lengths if x <= limit), cut, sum(lengths) - cut)
    assert TC.totals_at(hist, [6, 50]).first().asDict() == {
        "total": sum(lengths), "at_6": sum(min(x, 6) for x in lengths), "at_50": sum(min(x, 50) for x in lengths)}
    assert TC.quantiles(hist, [0.5, 1.0]).first().asDict() == {"p0.5": 7, "p1": 100}


def test_report_of_nothing(spark):
    hist = TC.length_histogram(spark.createDataFrame([], "n_tokens bigint"))
    assert TC.context_report(hist).count() == 0 and TC.totals_at(hist, [4]).first().total == 0
