"""Chat formatting of typed content parts, in DataFrame functions only.

A turn is a role and an ordered list of parts: text, image, audio or document. A visitor, one case for each type,
flattens the parts in order: a text becomes itself with control strings escaped, any other part becomes a placeholder
and an attachment record with its reference and the tokens it expands to (a price for each unit of its size: tiles,
seconds, pages). Turns become ``<|turn|>role<|text|>content<|end|>`` and a conversation their concatenation.

Escaping: wherever an opener (``<`` or ``[``), any carets and the rest of a control string stand together, one caret is
added after the opener; unescaping takes one off. So no text contains a control string, and every text comes back.
Besides this template's own strings, which all start with ``<|``, the usual ones of other templates are escaped.
A content is escaped as a whole, after its parts are joined, so a control string split over several text parts is found too.
While that happens attachments are marks that no text holds (U+0001 and a letter; a U+0001 in a text is doubled up by a
letter of its own), so only a real attachment becomes a bare placeholder. Reading back splits a content at its
placeholders, so a text that looks like one and an attachment stay apart.

The loss covers each assistant text once; ``loss`` names the turn and the place of its characters in the output.

Turns are formatted row by row before they are gathered. A conversation is one output row, so its turns do meet in
one task; that is the result's own form.

Defined results: a null text, role or part list is empty; a null reference or size stays null and counts no tokens; a
part of another type is written as an attachment placeholder of kind ``file`` with no tokens; turns are ordered by turn, role and text,
null first, so ties are stable; rows with a null conversation id are one conversation; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_CONTROL = r"(\||/?s>|/?INST\])"
#: Tokens that one unit of a part's size expands to: an image's tiles, an audio's seconds, a document's pages.
TOKENS = {"image": 256, "audio": 25, "document": 512}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\^*)" + _CONTROL, "$1^$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\^(\^*)" + _CONTROL, "$1$2$3")


def text_parts(text: Column) -> Column:
    """A plain text as a part list."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("size")))


#: Stands for an attachment while a content is escaped; the letter after it tells the kind, "t" a U+0001 of a text.
_MARK = "\u0001"
_MARKS = {"image": "i", "audio": "a", "document": "d", "file": "f"}


def visit(part: Column) -> Column:
    """What a part becomes before escaping: a text with its marks made unmistakable, or an attachment's mark."""
    text = F.replace(F.coalesce(part["text"], F.lit("")), F.lit(_MARK), F.lit(_MARK + "t"))
    out = F.when(part["type"] == "text", text)
    for kind in TOKENS:
        out = out.when(part["type"] == kind, F.lit(_MARK + _MARKS[kind]))
    return out.otherwise(F.lit(_MARK + _MARKS["file"]))


def flatten(parts: Column) -> Column:
    """The content of a part list: texts escaped over all part borders, attachments as placeholders."""
    out = escape(F.array_join(F.transform(parts, visit), ""))
    for kind, letter in _MARKS.items():
        out = F.replace(out, F.lit(_MARK + letter), F.lit(f"<|{kind}|>"))
    return F.replace(out, F.lit(_MARK + "t"), F.lit(_MARK))


def tokens(part: Column) -> Column:
    """The tokens that an attachment's placeholder expands to."""
    out = F.lit(0)
    for kind, price in TOKENS.items():
        out = F.when(part["type"] == kind, F.coalesce(part["size"], F.lit(0)) * F.lit(price)).otherwise(out)
    return out.cast("long")


def format_turns(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """``turns`` (conv_id, turn, role and a part list) with the content, the formatted turn and its attachments."""
    listed = F.coalesce(F.col(parts), F.array().cast(turns.schema[parts].dataType))
    attached = F.transform(F.filter(listed, lambda p: ~p["type"].eqNullSafe(F.lit("text"))), lambda p: F.struct(
        F.when(p["type"].isin(*TOKENS), p["type"]).otherwise(F.lit("file")).alias("kind"), p["ref"].alias("ref"),
        tokens(p).alias("tokens")))
    role = F.coalesce(F.col("role"), F.lit(""))
    content = flatten(listed)
    return turns.select("conv_id", "turn", role.alias("role"), content.alias("content"),
                        attached.alias("attached")).withColumn(
        "formatted", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT), "content", F.lit(END)))


def format_conversations(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """conv_id, formatted, loss (turn, start, length), attachments (turn, kind, ref, tokens), expanded_tokens."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "content")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = format_turns(turns, parts).select(
        "conv_id", "role", "content", "attached", "formatted", F.row_number().over(order).alias("place"),
        F.coalesce(F.sum(F.length("formatted").cast("long")).over(before), F.lit(0).cast("long")).alias("offset"))
    lead = F.length(F.lit(TURN)) + F.length(escape(F.col("role"))) + F.length(F.lit(TEXT))
    one = F.struct("place", "formatted", (F.col("role") == "assistant").alias("learn"),
                   (F.col("offset") + lead).alias("start"), F.length("content").cast("long").alias("length"),
                   F.col("attached").alias("attached"))
    listed = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    loss = F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(
        t["place"].alias("turn"), t["start"].alias("start"), t["length"].alias("length")))
    attachments = F.flatten(F.transform("turns", lambda t: F.transform(t["attached"], lambda a: F.struct(
        t["place"].alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    out = listed.select("conv_id", F.array_join(F.transform("turns", lambda t: t["formatted"]), "").alias("formatted"),
                        loss.alias("loss"), attachments.alias("attachments"))
    return out.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"),
                                                         lambda total, a: total + a["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns``: role, text and parts of each turn, unescaped, read from the output alone.

    ``text`` is what the turn's text parts say, joined; ``parts`` its texts and attachments (type and text) in order,
    neighbouring texts as one.
    """
    whole = F.filter(F.split(F.col("formatted"), r"<\|end\|>"), lambda t: t != "")
    turn = lambda t: F.split(F.substring(t, len(TURN) + 1, 1 << 30), r"<\|text\|>", 2)
    kinds = rf"<\|({'|'.join(_MARKS)})\|>"

    def parts(content: Column) -> Column:
        texts = F.transform(F.split(content, kinds), lambda t: F.struct(F.lit("text").alias("type"), unescape(t).alias("text")))
        found = F.transform(F.regexp_extract_all(content, F.lit(kinds), F.lit(1)),
                            lambda k: F.struct(k.alias("type"), F.lit(None).cast("string").alias("text")))
        both = F.flatten(F.transform(F.arrays_zip(texts.alias("x"), found.alias("y")), lambda z: F.array(z["x"], z["y"])))
        return F.filter(both, lambda p: p["type"].isNotNull() & F.coalesce(p["text"] != "", F.lit(True)))

    def read(t: Column) -> Column:
        own = parts(t[1])
        said = F.array_join(F.transform(own, lambda p: F.coalesce(p["text"], F.lit(""))), "")
        return F.struct(unescape(t[0]).alias("role"), said.alias("text"), own.alias("parts"))

    return formatted.withColumn("turns", F.transform(F.transform(whole, turn), read))


def digest(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the output."""
    back = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss", lambda s: F.element_at("turns", s["turn"])["text"]), "")
    return back.withColumn("learned", learned).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
