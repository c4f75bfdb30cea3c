"""Chat formatting from an event log.

A log row is ``(conv_id, seq, msg, kind, role, text)``; messages are in the order
of ``msg``, of any sortable type. By ``seq``, which orders the events of a message, a *start*
opens message ``msg`` with a role, a *delta* appends text to it, an *edit*
replaces its text and a *regenerate* throws away what was streamed so far. The
fold is by message, so a conversation that holds most of the log is still dealt
over many tasks; the rendered conversation is a sequence of segments, one for
each message, that is written and read in order without ever being held whole.

Template: ``<turn role=ROLE>`` newline TEXT newline ``</turn>`` newline. In a
text ``\\`` is written ``\\\\``, ``<`` is ``\\l`` and ``#`` is ``\\h``, so no
control string can stand in it and the text can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.llm.common import map_arrow

EVENTS = "conv_id bigint, seq bigint, msg bigint, kind string, role string, text string"
OPENS = ("start", "edit", "regenerate")
# Characters of a text that its draft holds, backwards.
DRAFT_CHARS = 16
SEGMENT = re.compile(r"<turn role=([^>]*)>\n(.*)\n</turn>\n", re.DOTALL)
UNESCAPE = {"\\": "\\", "l": "<", "h": "#", "g": ">", "n": "\n"}


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")),
                               F.lit("<"), F.lit("\\l")), F.lit("#"), F.lit("\\h"))


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: UNESCAPE[m[1]], text, flags=re.DOTALL)


def events_of(rows: DataFrame) -> DataFrame:
    """The log that streams finished rows ``(conv_id, turn, role, text)``.

    ``msg`` is the turn and the row's number within the turn (by role and text,
    so repeated rows each stay a message): texts of a conversation are never
    sorted together. Every third message is a start and two deltas, every third
    is regenerated after a draft, and every third is drafted and then edited; the
    final texts are the rows'.
    """
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    r = (rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
         .withColumn("copy", F.row_number().over(order).cast("long"))
         .select("conv_id", F.struct("turn", "copy").alias("msg"), "role", "text",
                 F.pmod(F.xxhash64("conv_id", "turn", "copy"), F.lit(3)).alias("way")))
    half = F.floor(F.length("text") / 2).cast("int")
    none = F.lit(None).cast("string")
    first, rest = F.substr("text", F.lit(1), half), F.substr("text", half + 1)
    draft = F.concat(F.reverse(F.substr("text", F.lit(1), F.lit(DRAFT_CHARS))), F.lit(" (draft)"))

    def events(*kinds: tuple[int, str, Column, Column]) -> Column:
        return F.array(*[F.struct(F.lit(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"),
                                  role.alias("role"), text.alias("text")) for seq, kind, role, text in kinds])

    start = (0, "start", F.col("role"), none)
    streamed = events(start, (1, "delta", none, first), (2, "delta", none, rest))
    again = events(start, (1, "delta", none, draft), (2, "regenerate", none, none),
                   (3, "delta", none, first), (4, "delta", none, rest))
    edited = events(start, (1, "delta", none, draft), (5, "edit", none, F.col("text")))
    log = F.when(F.col("way") == 0, streamed).when(F.col("way") == 1, again).otherwise(edited)
    return r.select("conv_id", "msg", F.explode(log).alias("e")).select(
        "conv_id", "e.seq", "msg", "e.kind", "e.role", "e.text")


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, msg, role, text)``.

    Of a message, what came before its last start, edit or regenerate is
    dropped, the rest joined by ``seq``; its role is that of its last start.
    Events that tie in seq are taken in order of kind (opening kinds first) and
    text. A null text is empty, a missing role empty; null ids are ids of their own.
    """
    opens = F.col("kind").isin(*OPENS)
    message = Window.partitionBy("conv_id", "msg")
    live = (events.withColumn("opened", F.max(F.when(opens, F.col("seq"))).over(message))
            .where(F.col("opened").isNull() | (F.col("seq") >= F.col("opened"))
                   | (F.col("kind") == "start")))
    current = F.col("opened").isNull() | (F.col("seq") >= F.col("opened"))
    part = F.when(current & F.col("text").isNotNull(),
                  F.struct("seq", (~opens).alias("later"), "text"))
    return live.groupBy("conv_id", "msg").agg(
        F.coalesce(F.max_by("role", F.when(F.col("kind") == "start", F.col("seq"))), F.lit("")).alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """Segments ``(conv_id, msg, formatted, loss_start, loss_end)``.

    The loss mask of a segment is the code points ``[loss_start, loss_end)`` of
    ``formatted``: the text of the learnt role, empty for any other.
    """
    head = F.concat(F.lit("<turn role="), escape_role(F.col("role")), F.lit(">\n"))
    body = escape(F.col("text"))
    return messages.select(
        "conv_id", "msg", F.concat(head, body, F.lit("\n</turn>\n")).alias("formatted"),
        F.length(head).alias("loss_start"),
        (F.length(head) + F.when(F.col("role") == learn, F.length(body)).otherwise(0)).alias("loss_end"))


def read_back(segments: DataFrame) -> DataFrame:
    """Digests per conversation, parsed from the rendered segments.

    Tasks stream the segments in order and keep running hashes: a conversation's
    digest is sequential, so one task reads it, one segment at a time.
    """
    in_order = segments.repartition("conv_id").sortWithinPartitions("conv_id", "msg")

    def digest(batches):
        state = None
        for b in batches:
            done = []
            for conv, formatted, start, end in zip(*(b.column(c).to_pylist() for c in
                                                     ("conv_id", "formatted", "loss_start", "loss_end"))):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = (unescape(x) for x in SEGMENT.fullmatch(formatted).groups())
                learnt = unescape(formatted[start:end])
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(learnt)
                state[4].update(learnt.encode())
                state[5] += len(formatted)
            if done:
                yield _digest_rows(done)
        if state is not None:
            yield _digest_rows([state])

    return map_arrow(in_order, digest, "conv_id bigint, n_turns bigint, turns_sha256 string, "
                     "loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def _digest_rows(states: list) -> dict:
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return dict(zip(names, zip(*[[s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]] for s in states])))
