"""Chat formatting with typed content parts.

A message is an ordered list of parts: text, image, audio or document.  A visitor turns the parts into one string, each
attachment into a placeholder that stands where the part stood, and records the attachment (its reference, its order in
the conversation and how many tokens its placeholder expands to).  Control strings inside texts and roles are escaped
reversibly: ``&``, ``<`` and ``[`` become ``&amp;``, ``&lt;`` and ``&#91;``, so no text can spell a turn mark, a
placeholder or ``[INST]``.

The output has one row per message, in order: its formatted segment and the loss span inside it (code points, end
exclusive; assistant messages only).  A conversation is the concatenation of its segments, so a conversation of any
length is never held in one place; consumers stream the sorted segments.

Defined results: null text is empty; a null role is the empty role; rows of a conversation are ordered by turn (nulls
first), then role, then text, so ties and repeated rows have a fixed order; rows with a null conversation id form one
conversation; a part of an unknown type becomes a placeholder that names the type and expands to no tokens; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.common import map_batches

PART = T.StructType([T.StructField("type", T.StringType()), T.StructField("text", T.StringType()), T.StructField("ref", T.StringType()),
                     T.StructField("width", T.LongType()), T.StructField("height", T.LongType()), T.StructField("seconds", T.DoubleType()), T.StructField("pages", T.LongType())])
ATTACHMENT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("ref", T.StringType()), T.StructField("position", T.LongType()), T.StructField("tokens", T.LongType())])

TURN, MIDDLE, END = "<turn|", "|>", "<end>"
#: Tokens that a placeholder expands to: a patch of an image, a second of audio, a page of a document.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 512


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("["), F.lit("&#91;"))


def escape_role(c: Column) -> Column:
    """Roles stand before the mark ``|>``, so their bars are escaped too."""
    return F.replace(escape(c), F.lit("|"), F.lit("&#124;"))


def unescape(s: str) -> str:
    return s.replace("&#124;", "|").replace("&#91;", "[").replace("&lt;", "<").replace("&amp;", "&")


def text_part(text: Column) -> Column:
    """A message that is one text part."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), null.cast("string").alias("ref"), null.cast("long").alias("width"),
                            null.cast("long").alias("height"), null.cast("double").alias("seconds"), null.cast("long").alias("pages")))


def expanded_tokens(p: Column) -> Column:
    """Tokens that an attachment part stands for."""
    patches = F.ceil(F.coalesce(p["width"], F.lit(PATCH)) / PATCH) * F.ceil(F.coalesce(p["height"], F.lit(PATCH)) / PATCH)
    return (F.when(p["type"] == "image", patches).when(p["type"] == "audio", F.ceil(F.coalesce(p["seconds"], F.lit(1.0)) * AUDIO_RATE))
            .when(p["type"] == "document", F.coalesce(p["pages"], F.lit(1)) * PAGE_TOKENS).cast("long"))


def _visit(p: Column) -> Column:
    placeholder = F.concat(F.lit("<"), p["type"], F.lit("|"), escape(F.coalesce(p["ref"], F.lit(""))), F.lit("|"), expanded_tokens(p).cast("string"), F.lit(">"))
    return (F.when(p["type"] == "text", escape(F.coalesce(p["text"], F.lit("")))).when(p["type"].isin("image", "audio", "document"), placeholder)
            .otherwise(F.concat(F.lit("<unknown|"), escape(F.coalesce(p["type"], F.lit(""))), F.lit("|"), escape(F.coalesce(p["ref"], F.lit(""))), F.lit(">"))))


def format_messages(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """(conv, turn, role, segment, loss_start, loss_end, attachments), one row a message; attachments count within it.

    The loss span covers the parts of an assistant message without the marks around them.
    """
    p = F.coalesce(F.col(parts), F.array().cast(T.ArrayType(PART)))
    name = F.coalesce(F.col(role).cast("string"), F.lit(""))
    body = F.array_join(F.transform(p, _visit), "")
    rows = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), name.alias("role"), p.alias("parts"), body.alias("body"),
                           F.concat(F.lit(TURN), escape_role(name), F.lit(MIDDLE)).alias("head"))
    loss = F.col("role") == "assistant"
    placed = F.filter(F.transform("parts", lambda x, i: F.struct(x["type"].alias("kind"), x["ref"].alias("ref"), i.cast("long").alias("position"), expanded_tokens(x).alias("tokens"))), lambda x: x["kind"] != "text")
    return rows.select("conv", "turn", "role", F.concat("head", "body", F.lit(END)).alias("segment"),
                       F.when(loss, F.length("head")).cast("long").alias("loss_start"),
                       F.when(loss, F.length("head") + F.length("body")).cast("long").alias("loss_end"), placed.alias("attachments"))


def in_order(segments: DataFrame) -> DataFrame:
    """The segments of a conversation in one partition and in order."""
    return segments.repartition("conv").sortWithinPartitions("conv", "turn", "role", "segment")


_SEGMENT = re.compile(re.escape(TURN) + r"([^<\[]*?)" + re.escape(MIDDLE) + r"(.*)" + re.escape(END), re.S)


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and unescaped body of a formatted segment."""
    m = _SEGMENT.fullmatch(segment)
    if not m:
        raise ValueError(f"not a formatted segment: {segment[:80]!r}")
    return unescape(m[1]), unescape(m[2])


def _digest_batches(batches):
    state, started = None, False

    def done():
        conv, n, turns, chars, loss, size = state
        return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)

    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    for b in batches:
        out = []
        for conv, segment, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if not started or state[0] != conv:
                if started:
                    out.append(done())
                state, started = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0], True
            role, text = parse_segment(segment)
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            state[5] += len(segment)
            if start is not None:
                masked = unescape(segment[start:end])
                state[3] += len(masked)
                state[4].update(masked.encode())
        yield pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in out], pa.string() if i in (2, 4) else pa.int64()) for i, k in enumerate(names)})
    if started:
        yield pa.RecordBatch.from_pydict({k: pa.array([v]) if v is not None else pa.array([None], pa.int64()) for k, v in zip(names, done(), strict=True)})


def digests(segments: DataFrame) -> DataFrame:
    """Per conversation what can be read back from its formatted segments; streams, so a long conversation isn't held."""
    rows = in_order(segments).select(F.col("conv").cast("long"), "segment", "loss_start", "loss_end")
    return map_batches(rows, _digest_batches, "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
