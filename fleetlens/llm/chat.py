"""Chat formatting from event logs.

A conversation is a log of events: a message is opened, its text streams in as
deltas, an edit replaces it, a regeneration empties it and drops the messages
behind it, a deletion removes it. Logs are folded per message (a message's
events meet, not a conversation's), superseded messages are dropped by one
running minimum, and every final message is rendered on its own, so that the
formatted text of a conversation is its pieces in order.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template, and what stands for its control strings inside a text.
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
DELTA_CHARS = 400
#: Beginning of a text by which rows of one turn are ordered first.
HEAD_CHARS = 64


def escape(text: Column) -> Column:
    r"""``\`` -> ``\\``, ``### `` -> ``\h## ``, ``</turn>`` -> ``\l/turn>``."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit(OPEN), F.lit("\\h## "))
    return F.replace(text, F.lit("</turn>"), F.lit("\\l/turn>"))


def escape_role(role: Column) -> Column:
    r"""As in a text; also ``:`` -> ``\c``."""
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


PLAIN = {"\\": "\\", "h": "#", "l": "<", "c": ":"}


def unescape(text: str) -> str:
    return re.sub(r"\\([\\hlc])", lambda m: PLAIN[m[1]], text)


def parse_piece(piece: str) -> tuple[str, str]:
    """(role, text) of a rendered message."""
    if not (piece.startswith(OPEN) and piece.endswith(CLOSE)):
        raise ValueError("not a rendered message")
    role, _, text = piece[len(OPEN) : -len(CLOSE)].partition(COLON)
    return unescape(role), unescape(text)


def fold(events: DataFrame) -> DataFrame:
    """events (conv_id, seq, msg, kind, role, text) -> final messages
    (conv_id, msg, role, text).

    ``seq`` orders a conversation's log, ``msg`` its messages; both may be of
    any type that sorts. Kinds: ``open`` (with the role), ``delta`` (appends),
    ``edit`` (replaces the text), ``regenerate`` (empties the text; messages
    that sort behind and were opened before it are gone), ``delete``. An event
    of another kind or of a message that was never opened has no effect. Null
    texts are empty; the role is that of the last ``open``, null is empty.
    """
    known = events.where(F.col("kind").isin("open", "delta", "edit", "regenerate", "delete"))
    log = known.groupBy("conv_id", "msg").agg(
        F.sort_array(F.collect_list(F.struct("seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text")))).alias("log")
    )
    is_kind = lambda *kinds: lambda e: e["kind"].isin(*kinds)
    opened = F.filter("log", is_kind("open"))
    resets = F.filter("log", is_kind("open", "edit", "regenerate", "delete"))
    last = F.col("last")
    messages = (
        log.withColumn("opened", opened)
        .where("size(opened) > 0")
        .withColumn("last", F.element_at(resets, -1))
        .select(
            "conv_id",
            "msg",
            F.element_at("opened", 1)["seq"].alias("seq"),
            F.coalesce(F.element_at("opened", -1)["role"], F.lit("")).alias("role"),
            F.array_join(F.transform(F.filter("log", lambda e: (e["seq"] >= last["seq"]) & e["kind"].isin("open", "edit", "delta")), lambda e: e["text"]), "").alias("text"),
            (last["kind"] == "delete").alias("gone"),
        )
    )
    # A later regeneration of an earlier message drops this one: read the log
    # backwards and keep the smallest message regenerated so far.
    marks = known.where("kind = 'regenerate'").select("conv_id", "seq", F.col("msg").alias("barrier"))
    back = Window.partitionBy("conv_id").orderBy(F.col("seq").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    some = marks.select(F.col("conv_id").alias("marked")).distinct()
    touched = messages.join(some, F.col("conv_id").eqNullSafe(F.col("marked")), "left_semi")
    line = touched.select("conv_id", "msg", "seq").withColumn("barrier", F.lit(None).cast(marks.schema["barrier"].dataType)).unionByName(marks, allowMissingColumns=True)
    dropped = line.withColumn("low", F.min("barrier").over(back)).where("low < msg").select("conv_id", "msg").distinct()
    return messages.where("not gone").join(dropped, (messages.conv_id.eqNullSafe(dropped.conv_id)) & (messages.msg == dropped.msg), "left_anti").select("conv_id", "msg", "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """Messages -> their pieces of the formatted text: (conv_id, msg, role,
    piece, loss_start, loss_length). The loss mask covers the text of each
    ``assistant`` message, counted in code points of the piece."""
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(COLON))
    body = escape(F.col("text"))
    assistant = F.col("role") == "assistant"
    return messages.select(
        "conv_id",
        "msg",
        "role",
        F.concat(head, body, F.lit(CLOSE)).alias("piece"),
        F.char_length(head).alias("loss_start"),
        F.when(assistant, F.char_length(body)).otherwise(F.lit(0)).alias("loss_length"),
    )


def _digests(batches):
    """Reads pieces in order of conversation and message; keeps two running
    digests and three counts, never a conversation."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    now, state = None, None
    for pdf in batches:
        out = []
        for conv, conv_null, piece, start, length in zip(pdf["conv_id"], pdf["conv_null"], pdf["piece"], pdf["loss_start"], pdf["loss_length"]):
            key = None if conv_null else conv
            if state is None or key != now:
                if state is not None:
                    out.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                now, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse_piece(piece)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            if length:
                loss = unescape(piece[start : start + length])
                state[2] += len(loss)
                state[3].update(loss.encode())
            state[4] += len(piece)
        yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
    if state is not None:
        yield pd.DataFrame([(now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])], columns=names).astype({"conv_id": "Int64"})


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """Pieces -> one row per conversation, parsed from the formatted text. A
    digest runs over a conversation from end to end, so one task reads a
    conversation's pieces; it streams them and keeps none."""
    rows = pieces.select(F.coalesce("conv_id", F.lit(0)).alias("conv_id"), F.col("conv_id").isNull().alias("conv_null"), "msg", "piece", "loss_start", "loss_length")
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(tasks, "conv_id", "conv_null").sortWithinPartitions("conv_id", "conv_null", "msg").select("conv_id", "conv_null", "piece", "loss_start", "loss_length")
    return ordered.mapInPandas(_digests, DIGEST_SCHEMA)


def log_of(conversations: DataFrame) -> DataFrame:
    """A table (conv_id, turn, role, text) as an event log: each row opens a
    message and streams its text in deltas of ``DELTA_CHARS`` code points.
    Repeated rows are messages of their own; rows of one turn are ordered by
    role and text, a null turn comes first."""
    rows = conversations.select(
        conversations.conv_id.cast("long").alias("conv_id"), conversations.turn.cast("long").alias("turn"), F.coalesce(conversations.role.cast("string"), F.lit("")).alias("role"), F.coalesce(conversations.text.cast("string"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("same", F.sha2(F.concat_ws("\n", "role", "text"), 256))
    rows = rows.withColumn("head", F.substring("text", 1, HEAD_CHARS))
    copies = rows.groupBy("conv_id", "turn", "role", "head", "same", "text").agg(F.count("*").alias("n")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    # Texts of one turn and role are in order of their beginnings; only where
    # two begin alike the whole text goes into the order.
    alike = rows.groupBy("conv_id", "turn", "role", "head").agg(F.min("same").alias("lo"), F.max("same").alias("hi")).where("lo < hi")
    alike = alike.select(*(F.col(c).alias(f"_{c}") for c in ("conv_id", "turn", "role", "head")))
    meets = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "turn", "role", "head")))
    copies = copies.join(alike, meets, "left").withColumn("order", F.when(F.col("_role").isNotNull(), F.col("text")).otherwise(F.lit("")))
    msg = F.struct(F.coalesce("turn", F.lit(-(1 << 63))).alias("turn"), F.col("role"), F.col("head"), F.col("order"), F.col("copy"))
    cuts = F.sequence(F.lit(0), F.floor(F.char_length("text") / DELTA_CHARS).cast("int"))
    empty = F.lit(None).cast("string")
    opening = F.struct(F.lit(-1).alias("step"), F.lit("open").alias("kind"), F.col("role").alias("role"), empty.alias("text"))
    deltas = F.transform(cuts, lambda i: F.struct(i.alias("step"), F.lit("delta").alias("kind"), empty.alias("role"), F.substring(F.col("text"), i * DELTA_CHARS + 1, F.lit(DELTA_CHARS)).alias("text")))
    rows = copies.select("conv_id", msg.alias("msg"), F.explode(F.concat(F.array(opening), deltas)).alias("e"))
    return rows.select("conv_id", F.struct("msg", "e.step").alias("seq"), "msg", "e.kind", "e.role", "e.text")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> rendered pieces.

    A null role or text is empty; rows with a null conv_id form one
    conversation of their own. Rows of one turn are in order of role and text,
    a null turn comes first. A very long text is streamed in deltas. An empty
    table gives no rows. Other columns are ignored."""
    return render(fold(log_of(conversations)))
