"""Conversations of typed content parts as one training text each, with a loss mask.

A turn becomes ``<|im_start|>role``, a line feed, its flattened content,
``<|im_end|>`` and a line feed.  Content is a list of typed parts; the visitor
of a part's type renders it: text is escaped, an image, a sound or a document
becomes its placeholder.  The placeholders of a conversation and its
attachments are in the same order; each attachment records what it refers to
and how many tokens its placeholder stands for.

Inside texts ``&``, ``<`` and ``[`` are written as character references, so no
control string of this or of a bracketed template survives in a text, and
``unescape`` gives back the text exactly.

The loss mask is a list of spans of UTF-8 bytes of the formatted text: the
content of each assistant turn, without its markers.

Defined results: turns go by number, null first, ties by role and parts as they
are given, before escapes; a null role or text is empty; a null or empty list of
parts is an empty text; a part of unknown type is text if it has text, else a
file placeholder of one token; sizes that are null count as the smallest; a null
conversation id is a conversation of its own; rows that repeat are turns of
their own; an empty table gives no rows; other columns are ignored, whatever
their names.  A conversation is one row of the result, so the bound of a row, 2
GB, holds for its formatted text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
FILE = "<|file|>"
PATCH = 14  # pixels of the side of an image patch, one token each
AUDIO_TOKENS = 25  # a second
PAGE_TOKENS = 512
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
LINE = ("\n", "&#10;")
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in (LINE, *reversed(ESCAPES)):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A list with the one part that a plain text is."""
    names = ("type", "text", "ref", "width", "height", "seconds", "pages")
    values = {"type": F.lit("text"), "text": text}
    return F.array(F.struct(*(values.get(n, F.lit(None)).alias(n) for n in names)).cast(PART))


def _is_text(part: Column) -> Column:
    known = F.coalesce(part["type"].isin(*PLACEHOLDERS), F.lit(False))
    return F.coalesce(part["type"] == "text", F.lit(False)) | (~known & part["text"].isNotNull())


def visit_text(part: Column) -> Column:
    """What stands in the formatted text for a part."""
    shown = F.when(_is_text(part), escape(F.coalesce(part["text"], F.lit(""))))
    for kind, placeholder in PLACEHOLDERS.items():
        shown = shown.when(part["type"] == kind, F.lit(placeholder))
    return shown.otherwise(F.lit(FILE))


def visit_tokens(part: Column) -> Column:
    """Tokens that an attachment's placeholder is expanded to."""

    def at_least_one(value: Column) -> Column:
        return F.greatest(F.coalesce(F.ceil(value), F.lit(1)), F.lit(1)).cast("bigint")

    image = at_least_one(part["width"] / PATCH) * at_least_one(part["height"] / PATCH)
    return (
        F.when(part["type"] == "image", image)
        .when(part["type"] == "audio", at_least_one(part["seconds"] * AUDIO_TOKENS))
        .when(part["type"] == "document", at_least_one(part["pages"]) * PAGE_TOKENS)
        .otherwise(F.lit(1).cast("bigint"))
    )


def attachments(parts: Column) -> Column:
    files = F.filter(parts, lambda p: ~_is_text(p))
    return F.transform(
        files,
        lambda p: F.struct(
            F.coalesce(p["type"], F.lit("file")).alias("type"), p["ref"].alias("ref"), visit_tokens(p).alias("n_tokens")
        ),
    )


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts"
) -> DataFrame:
    """One row per conversation: ``formatted``, ``loss_spans`` and ``attachments`` beside its id."""
    parts = F.coalesce(F.col(parts_col).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv_col).alias("_conv"),
        F.struct(
            F.col(turn_col).alias("turn"),
            role.alias("role"),
            parts.alias("parts"),
        ).alias("_turn"),
    )
    ordered = rows.groupBy("_conv").agg(F.array_sort(F.collect_list("_turn")).alias("_turns"))
    head = lambda t: F.concat(F.lit(START), F.replace(escape(t["role"]), F.lit(LINE[0]), F.lit(LINE[1])), F.lit("\n"))
    tail = F.lit(END + "\n")
    pieces = ordered.select(
        "_conv",
        F.transform(
            "_turns",
            lambda t: F.struct(
                head(t).alias("head"),
                F.array_join(F.transform(t["parts"], visit_text), "").alias("body"),
                (t["role"] == "assistant").alias("loss"),
                attachments(t["parts"]).alias("files"),
            ),
        ).alias("_pieces"),
    )
    long = lambda c: F.octet_length(c).cast("bigint")
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,n_bytes:bigint>>").alias("spans"))
    spans = F.aggregate(
        "_pieces",
        begin,
        lambda acc, p: F.struct(
            (acc["at"] + long(p["head"]) + long(p["body"]) + len(END) + 1).alias("at"),
            F.when(
                p["loss"],
                F.concat(
                    acc["spans"],
                    F.array(F.struct((acc["at"] + long(p["head"])).alias("start"), long(p["body"]).alias("n_bytes"))),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return pieces.select(
        F.col("_conv").alias(conv_col),
        F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], tail)), "").alias("formatted"),
        spans.alias("loss_spans"),
        F.flatten(F.transform("_pieces", lambda p: p["files"])).alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs of a formatted conversation of texts."""
    marked = F.split(formatted, r"<\|im_end\|>\n")
    segments = F.transform(
        F.slice(marked, F.lit(1), F.size(marked) - 1), lambda s: F.substr(s, F.lit(len(START) + 1))
    )
    return F.transform(
        segments,
        lambda s: F.struct(
            unescape(F.substring_index(s, "\n", 1)).alias("role"),
            unescape(F.substr(s, F.length(F.substring_index(s, "\n", 1)) + 2)).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, in order, unescaped."""
    whole = formatted.cast("binary")
    return unescape(
        F.array_join(
            F.transform(
                spans,
                lambda s: F.substr(whole, (s["start"] + 1).cast("int"), s["n_bytes"].cast("int")).cast("string"),
            ),
            "",
        )
    )
