"""Conversations with typed content parts as one formatted text, with loss spans and attachments.

A turn's content is a list of parts (``PART``). A visitor has one rule for each part type: text is
escaped, an image, audio or document part becomes a placeholder ``<|type:turn.part|>`` in its place, and
is recorded with its reference and the number of tokens the placeholder stands for once
expanded. New types are new entries of ``VISITOR``.

Every turn reads ``<|role|>\\n`` content ``<|end|>\\n``. Inside texts and roles '&', '<' and '[' are escaped, so
no control string of this or another template (``</s>``, ``[INST]``, ``<|end|>``) can appear there;
``unescape`` undoes it. Offsets come from a running sum over a conversation's turns, in code points; loss spans
cover exactly the contents of the ``learn`` roles.

Turns are ordered by turn, role, content. Defined results: a null text or part list is empty, a null
role is an empty role, unknown part types become placeholders of 0 tokens; null turns come first; rows
of a null conv_id form one conversation; repeated rows are turns of their own.
Only the conversation's columns are returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))
ROLE_ESCAPES = (*ESCAPES, ("|", "&bar;"), ("\n", "&nl;"))
END = "<|end|>\n"
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 1024

VISITOR: dict[str, Callable[[Column], Column]] = {
    "image": lambda p: F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH),
    "audio": lambda p: F.ceil(p["seconds"] * AUDIO_RATE),
    "document": lambda p: p["pages"] * PAGE_TOKENS,
}


def escape(text: Column, escapes=ESCAPES) -> Column:
    for a, b in escapes:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def unescape(text: str, escapes=ESCAPES) -> str:
    for a, b in reversed(escapes):
        text = text.replace(b, a)
    return text


def text_part(text: Column) -> Column:
    """A list of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
                            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def _tokens(part: Column) -> Column:
    out = None
    for kind, count in VISITOR.items():
        out = F.when(part["type"] == kind, count(part)) if out is None else out.when(part["type"] == kind, count(part))
    return F.coalesce(out.otherwise(0), F.lit(0)).cast("long")


def _placeholder(part: Column, turn: Column, i: Column) -> Column:
    kind = escape(F.coalesce(part["type"], F.lit("unknown")), ROLE_ESCAPES)
    return F.concat(F.lit("<|"), kind, F.lit(":"), F.coalesce(turn.cast("string"), F.lit("")), F.lit("."), i.cast("string"), F.lit("|>"))


def format_chats(df: DataFrame, learn: tuple[str, ...] = ("assistant",), conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", parts: str = "parts") -> DataFrame:
    """conv_id, n_turns, formatted, loss (spans of code points), attachments, expanded_tokens."""
    turns = df.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                      F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")).alias("parts"))
    def visit(p: Column, i: Column) -> Column:
        return F.when(p["type"] == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(_placeholder(p, F.col("turn"), i))
    attached = F.filter(F.transform("parts", lambda p, i: F.struct(
        _placeholder(p, F.col("turn"), i).alias("placeholder"), p["type"].alias("type"), p["ref"].alias("ref"),
        _tokens(p).alias("tokens"))), lambda a: ~a["type"].eqNullSafe("text"))
    turns = (turns.withColumn("content", F.array_join(F.transform("parts", visit), ""))
             .withColumn("attached", attached)
             .withColumn("head", F.concat(F.lit("<|"), escape(F.col("role"), ROLE_ESCAPES), F.lit("|>\n")))
             .select("conv_id", "turn", "role", "head", "content", "attached"))
    whole = F.length("head") + F.length("content") + len(END)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "content")
    placed = (turns.withColumn("n", F.row_number().over(order))
              .withColumn("start", F.sum(whole.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("content") - len(END)))
    span = F.struct(F.col("start"), (F.col("start") + F.length("content")).alias("stop"))
    rows = (placed.groupBy("conv_id")
            .agg(F.count("*").alias("n_turns"),
                 F.array_sort(F.collect_list(F.struct("n", F.concat("head", "content", F.lit(END)).alias("text"),
                                                      F.when(F.col("role").isin(*learn), span).alias("loss"), F.col("attached")))).alias("all")))
    return rows.select(
        "conv_id", "n_turns", F.array_join(F.col("all.text"), "").alias("formatted"),
        F.filter(F.col("all.loss"), lambda x: x.isNotNull()).alias("loss"),
        F.flatten(F.col("all.attached")).alias("attachments"),
        F.aggregate(F.flatten(F.col("all.attached")), F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("expanded_tokens"))


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    out = []
    for one in formatted.split(END)[:-1]:
        role, _, content = one.removeprefix("<|").partition("|>\n")
        out.append((unescape(role, ROLE_ESCAPES), unescape(content)))
    return out


def loss_text(formatted: str, spans: list[tuple[int, int]]) -> str:
    """All text under the loss mask."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)
