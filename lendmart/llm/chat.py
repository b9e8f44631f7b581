"""Chat formatting with typed content parts.

A turn's content is a list of parts, each a text, image, audio or document. The visitor
writes them in order into one string per conversation:

    <turn ROLE>text<image/>text</turn>

Texts and roles are escaped so that no ``<`` of theirs survives: backslash, ``<`` and
``>`` become ``\\b``, ``\\l`` and ``\\g``. Markers can therefore be found by plain search
and texts are restored exactly. Attachments are listed in order with their reference and
the number of tokens their placeholder stands for.

Turns are ordered by turn number, then role, then content; nulls first, repeated rows
stay. Null roles and texts count as empty, an unknown part type as a document. Rows
without an id form one conversation. An empty table gives no rows. Other input columns
are not carried, as a result row stands for many input rows. A conversation is one
record, built in one piece like the text of a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendmart.llm.common import table, whole
from lendmart.sources.snapshots import small_table

PART = "struct<type:string,text:string,ref:string,tokens:bigint>"
#: Tokens a placeholder stands for where the part does not say.
EXPANDED = {"image": 576, "audio": 750, "document": 1024}
TEACHER = "assistant"

PROBE_ID = -7
PROBE = r"\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    out = F.replace(whole(text), F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    """Every backslash of an escaped text opens a code of two characters, so the codes
    can be undone one kind after the other, the backslash itself last."""
    out = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A turn's plain text as a list of one part."""
    return F.array(F.struct(F.lit("text").alias("type"), whole(text).alias("text"),
                            F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("long").alias("tokens")))


def _kind(part: Column) -> Column:
    kind = F.coalesce(part["type"], F.lit("document"))
    return F.when(kind.isin("text", *EXPANDED), kind).otherwise("document")


def _visit(part: Column) -> Column:
    return (F.when(_kind(part) == "text", escape(part["text"]))
            .otherwise(F.concat(F.lit("<"), _kind(part), F.lit("/>"))))


def _tokens(part: Column) -> Column:
    default = F.lit(EXPANDED["document"])
    for kind, n in EXPANDED.items():
        default = F.when(_kind(part) == kind, F.lit(n)).otherwise(default)
    return F.coalesce(part["tokens"], default).cast("long")


def format_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                parts: str = "parts") -> DataFrame:
    """Per conversation: ``formatted``; ``segments`` [{text, loss}], whose texts joined
    are ``formatted`` and whose flags are the loss mask; ``attachments`` [{turn, kind,
    ref, tokens}]; ``expanded_tokens``.

    ``parts`` is an array of type, text, ref and tokens; see ``text_part``.
    """
    role_of = whole(role)
    content = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    turns = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), role_of.alias("role"),
        F.array_join(F.transform(content, _visit), "").alias("body"),
        F.transform(F.filter(content, lambda p: _kind(p) != "text"), lambda p: F.struct(
            _kind(p).alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens")))
        .alias("attached"))
    whole_chat = turns.groupBy("conv").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "body", "attached"))).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(F.concat(F.lit("<turn "), escape(t["role"]), F.lit(">")).alias("text"),
                 F.lit(False).alias("loss")),
        F.struct(t["body"].alias("text"), (t["role"] == TEACHER).alias("loss")),
        F.struct(F.lit("</turn>\n").alias("text"), F.lit(False).alias("loss")))))
    attachments = F.flatten(F.transform("turns", lambda t: F.transform(
        t["attached"], lambda a: F.struct(t["turn"].alias("turn"), a["kind"].alias("kind"),
                                          a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    out = whole_chat.select(F.col("conv").alias(conv), segments.alias("segments"),
                            attachments.alias("attachments"))
    return out.select(
        conv, F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments", "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
        .alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """[{role, body}] of a formatted conversation; bodies keep their placeholders."""
    pieces = F.filter(F.split(formatted, "</turn>\n", -1), lambda s: s != "")
    return F.transform(pieces, lambda s: F.struct(
        unescape(F.regexp_extract(s, "^<turn ([^>]*)>", 1)).alias("role"),
        F.regexp_replace(s, "^<turn [^>]*>", "").alias("body")))


def body_text(body: Column) -> Column:
    """The text of a body, without its placeholders."""
    return unescape(F.regexp_replace(body, "<[a-z]+/>", ""))


def op7_content_parts(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = small_table(spark, [(PROBE_ID, 0, "user", PROBE), (PROBE_ID, 1, TEACHER, PROBE)],
                        "conv_id long, turn long, role string, text string")
    chats = format_chat(rows.unionByName(extra).withColumn("parts", text_part(F.col("text"))))
    read = chats.select("conv_id", "formatted", "expanded_tokens",
                        read_turns(F.col("formatted")).alias("turns"),
                        F.array_join(F.transform(
                            F.filter("segments", lambda s: s["loss"]),
                            lambda s: body_text(s["text"])), "").alias("learned"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), body_text(t["body"]), F.lit("\n"))), ""), 256)
        .alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
