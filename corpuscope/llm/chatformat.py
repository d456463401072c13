"""Conversations as training texts with a loss mask, in DataFrame operations only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one
role are merged by array functions, and all is concatenated::

    <turn>user<says>Hello</turn>
    <turn>assistant<says>Hi.<next>How are you?</turn>

``<next>`` stands between merged turns, so they can be told apart again. The loss mask is
a list of byte ranges, one per assistant text, without the markers around it. A marker that
occurs in a text or role gets a backslash after its ``<``; one that has backslashes
there already gets one more. So no text holds a marker, and taking one backslash away
restores it. A marker begins with ``<``, ends with ``>`` and has neither inside, so none can
arise where text and marker meet.

Cases: null text and null role are empty; turns without a number come first; equal numbers are
ordered by role and text; repeated rows are turns each; rows without a conversation id are
one conversation; turns may be of any length and number as far as a conversation fits
one string (2 GB), see ``dialogue.py`` for very many; an empty table gives no rows;
columns besides conv_id, turn, role and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.functions.arrays import let, runs
from corpuscope.llm.common import id_back, id_key, text_of
from corpuscope.llm.dialogue import MANY, gather

TURN, SAYS, NEXT, CLOSE = "<turn>", "<says>", "<next>", "</turn>"
MARKER = "(?:turn|says|next|/turn)>"
#: Prefix sums are taken inside chunks of this length, then over the chunks.
CHUNK = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"<(\\*{MARKER})", r"<\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"<\\(\\*{MARKER})", r"<$1")


def merged(turns: Column) -> Column:
    """Blocks (role, texts) of a sorted array of turns or of blocks already built."""
    return F.transform(
        runs(turns, lambda t: t["role"]),
        lambda run: F.struct(
            F.get(run, F.lit(0))["role"].alias("role"),
            F.flatten(F.transform(run, lambda t: t["texts"])).alias("texts"),
        ),
    )


def _blocks(turns: Column) -> Column:
    return merged(
        F.transform(
            turns,
            lambda t: F.struct(
                escape(t["role"]).alias("role"), F.array(escape(t["text"])).alias("texts")
            ),
        )
    )


def _parts(block: Column) -> Column:
    """Consecutive strings of a block, each with whether it is under the loss mask."""
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    texts = F.flatten(
        F.transform(
            block["texts"],
            lambda t: F.array(
                part(F.lit(NEXT), no), part(t, block["role"] == F.lit("assistant"))
            ),
        )
    )
    opening = F.concat(F.lit(TURN), block["role"], F.lit(SAYS))
    return F.concat(
        F.array(part(opening, no)),
        F.slice(texts, F.lit(2), F.size(texts) - 1),
        F.array(part(F.lit(CLOSE + "\n"), no)),
    )


def before(sizes: Column) -> Column:
    """For each number of an array the sum of those in front of it."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)

    def front(items: Column, start: Column) -> Column:
        return F.transform(items, lambda _, i: start + total(F.slice(items, F.lit(1), i)))

    def chunks(items: Column) -> Column:
        last = F.floor((F.size(items) - 1) / CHUNK).cast("int")
        return F.when(F.size(items) == 0, F.array().cast("array<array<bigint>>")).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                lambda k: F.slice(items, k * CHUNK + 1, CHUNK),
            )
        )

    def joined(parts: Column) -> Column:
        starts = front(F.transform(parts, total), F.lit(0).cast("long"))
        return F.flatten(F.zip_with(parts, starts, front))

    return let(let(sizes, chunks), joined)


def formatted(conversations: DataFrame, many: int = MANY) -> DataFrame:
    """(conv, text, loss): loss is the byte ranges (start, bytes) of the assistant's texts."""
    rows = conversations.select(
        id_key("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        text_of("role").alias("role"),
        text_of("text").alias("text"),
    )
    blocks = gather(rows, _blocks, many).select("conv", merged(F.col("parts")).alias("blocks"))
    parts = blocks.select("conv", F.flatten(F.transform("blocks", _parts)).alias("parts"))
    bytes_ = F.transform("parts", lambda p: F.octet_length(p["text"]).cast("long"))
    marked = F.zip_with(
        "parts",
        before(bytes_),
        lambda p, start: F.struct(
            start.alias("start"),
            F.octet_length(p["text"]).cast("long").alias("bytes"),
            p["loss"].alias("loss"),
        ),
    )
    kept = F.transform(
        F.filter(marked, lambda m: m["loss"]),
        lambda m: F.struct(m["start"].alias("start"), m["bytes"].alias("bytes")),
    )
    return parts.select(
        "conv", F.array_join(F.col("parts.text"), "").alias("text"), kept.alias("loss")
    )


def turns_of(text: Column) -> Column:
    """Turns (role, text) read back from a formatted text."""

    def read(block: Column) -> Column:
        role = unescape(F.substring_index(F.substr(block, F.lit(len(TURN) + 1)), SAYS, 1))
        said = F.get(F.split(block, SAYS, 2), F.lit(1))
        return F.transform(
            F.split(said, NEXT),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        )

    blocks = F.split(text, CLOSE + "\n")
    whole = let(blocks, lambda b: F.slice(b, F.lit(1), F.size(b) - 1))
    return F.flatten(F.transform(whole, read))


def under_loss(text: Column, loss: Column) -> Column:
    """Texts under the loss mask, as they were before formatting."""
    return let(
        text.cast("binary"),
        lambda data: F.transform(
            loss,
            lambda m: unescape(
                F.substring(data, (m["start"] + 1).cast("int"), m["bytes"].cast("int")).cast("string")
            ),
        ),
    )


def report(conversations: DataFrame, many: int = MANY) -> DataFrame:
    """Digests of what is read back from the formatted texts."""
    read = formatted(conversations, many).select(
        "conv",
        turns_of(F.col("text")).alias("turns"),
        F.array_join(under_loss(F.col("text"), F.col("loss")), "").alias("learnt"),
        F.char_length("text").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        id_back("conv", "conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )


SQL = r"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
            (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
    m AS (
        SELECT *, row_number() OVER w AS place,
            lag(role) OVER w IS DISTINCT FROM role OR row_number() OVER w = 1 AS opens,
            len(regexp_extract_all(text, '<\\*(turn|says|next|/turn)>')) AS text_escapes,
            len(regexp_extract_all(role, '<\\*(turn|says|next|/turn)>')) AS role_escapes
        FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), ''))
            AS loss_sha256,
        sum(length(text) + text_escapes
            + CASE WHEN opens THEN length(role) + role_escapes + 20 ELSE 6 END)::BIGINT
            AS formatted_chars
    FROM m GROUP BY conv_id"""
