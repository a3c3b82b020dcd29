"""Chat formatting: typed content parts become one training string with ordered placeholders and a loss mask.

DataFrame functions only. Every turn is formatted in its own row; the turns of a conversation then meet once, in the
row that is the conversation. Defined results: a null text is an empty one, a null role is an empty role, a null
turn sorts last, rows alike in turn are ordered by role and unescaped text (by code point), then by their parts,
repeated rows are turns of their own, a null conv_id is a conversation of its own. An empty table gives an empty
result; extra columns are ignored. Texts of any length are formatted whole: a conversation's output is one string,
which a row can hold up to 2 GB of.

Output grammar: ``<|turn|>`` role ``<|says|>`` content ``<|done|>`` and a newline, for each turn. In roles and texts
``&`` becomes ``&amp;``, ``<`` ``&lt;`` and ``[`` ``&lb;``, so no text can hold a control string of this template or
of those that use ``[INST]``, and unescaping in the other order gives the text back. A part that is not text becomes
``<|kind:number|>`` ("image", "audio", "document"), numbered from 0 within the conversation; in kinds ``|``, ``:``,
``>`` and line breaks are escaped too (``&bar;``, ``&col;``, ``&gt;``, ``&nl;``), so no kind can end a placeholder or a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, SAYS, DONE = "<|turn|>", "<|says|>", "<|done|>\n"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))
#: A part's kind stands inside a placeholder, whose signs it can't hold either.
KIND_ESCAPES = (*ESCAPES, ("|", "&bar;"), (":", "&col;"), (">", "&gt;"), ("\n", "&nl;"))
#: Model tokens that an attachment stands for, where the part itself doesn't say; fixed values of this template.
EXPANDED = {"image": 576, "audio": 50, "document": 256}
PARTS = "array<struct<kind:string,text:string,ref:string,n_tokens:int>>"


def escape(c: Column, escapes=ESCAPES) -> Column:
    for plain, coded in escapes:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column, escapes=ESCAPES) -> Column:
    for plain, coded in reversed(escapes):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def visit(part: Column, number: Column) -> Column:
    """The visitor: what a part contributes to the text; number: an attachment's place among the conversation's."""
    placeholder = F.concat(F.lit("<|"), escape(part["kind"], KIND_ESCAPES), F.lit(":"), number.cast("string"), F.lit("|>"))
    return F.when(is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(placeholder)


def text_parts(text: Column) -> Column:
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("n_tokens"))).cast(PARTS)


def format_turns(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, parts) -> a row for each with its segment of the output, the place of the segment
    and of the assistant's content in it, and its attachments with their numbers."""
    known = F.create_map(*[F.lit(x) for kv in EXPANDED.items() for x in kv])
    none = F.array().cast(PARTS)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("parts", none).alias("parts"))
    rows = rows.withColumn("files", F.filter("parts", lambda p: ~is_text(p)))
    # a placeholder's length depends on its number, so numbers come first, then places
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", F.array_join(F.transform("parts", lambda p: F.coalesce(p["text"], F.lit(""))), ""), "parts")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"turn_no": F.row_number().over(order), "first": F.coalesce(F.sum(F.size("files")).over(before), F.lit(0))})
    content = F.array_join(F.zip_with("parts", ordinals(F.col("parts")), lambda p, i: visit(p, i + F.col("first"))), "")
    rows = rows.withColumn("content", content).withColumn("segment", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS), "content", F.lit(DONE)))
    place = Window.partitionBy("conv_id").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("segment")).over(place), F.lit(0)).cast("long")
    end = F.col("at") + F.length("segment") - len(DONE)
    rows = rows.withColumn("at", at).withColumn("end", end)
    return rows.select(
        "conv_id", "turn_no", "segment",
        F.struct("at", F.when(F.col("role") == "assistant", F.col("end") - F.length("content")).otherwise(F.col("end")).alias("start"), "end").alias("mask"),
        F.transform("files", lambda p, i: F.struct((i + F.col("first")).alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), F.coalesce(p["n_tokens"], F.try_element_at(known, p["kind"]), F.lit(1)).alias("n_tokens"))).alias("files"),
    )


def ordinals(parts: Column) -> Column:
    """For each part, how many attachments stand before it in its turn."""
    return F.transform(parts, lambda _, i: F.size(F.filter(F.slice(parts, F.lit(1), i), lambda p: ~is_text(p))))


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask, attachments, n_attachment_tokens); turns as in format_turns().

    mask: for each turn (at, start, end), in characters of formatted, end exclusive: where its segment begins, and
    the content that counts towards the loss (the assistant's; empty for others). attachments: (number, kind, ref,
    n_tokens) in the order of their placeholders.
    """
    said = format_turns(turns)
    chats = said.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn_no", "segment", "mask", "files"))).alias("t"))
    files = F.flatten(F.transform("t", lambda x: x["files"]))
    return chats.select(
        "conv_id",
        F.array_join(F.transform("t", lambda x: x["segment"]), "").alias("formatted"),
        F.transform("t", lambda x: x["mask"]).alias("mask"),
        files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda a, f: a + f["n_tokens"]).alias("n_attachment_tokens"),
    )


def segments(formatted: Column) -> Column:
    """The turns of a formatted string, in order, without their ends."""
    return F.filter(F.split(formatted, r"<\|done\|>\n", -1), lambda x: x.startswith(TURN))


def read_turns(formatted: Column) -> Column:
    """array of (role, text), unescaped; placeholders stay in the text."""
    return F.transform(segments(formatted), lambda x: F.struct(unescape(F.substring_index(F.substr(x, F.lit(len(TURN) + 1)), SAYS, 1)).alias("role"), unescape(F.substr(x, F.instr(x, SAYS) + len(SAYS))).alias("text")))


def read_loss(formatted: Column, mask: Column) -> Column:
    """array of the unescaped texts under the mask, in order."""
    return F.filter(F.zip_with(segments(formatted), mask, lambda s, m: unescape(F.substr(s, (m["start"] - m["at"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))), lambda x: x != "")
