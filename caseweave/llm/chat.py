"""Chat formatting of typed content parts.

A turn's content is a list of typed parts. A visitor turns each part into text or into an ordered placeholder,
and notes the attachment it stands for and the tokens it will expand to. The template marks turns with strings
that begin with `<`; inside texts and roles `<`, `[` and backslashes are escaped, so no text can hold a mark,
and unescaping gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<turn>", "<body>", "<end>"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH = 28  # pixels of an image side that make a token
TOKENS_A_SECOND, TOKENS_A_PAGE = 25, 512


def escaped(text: Column) -> Column:
    r"""`\` becomes `\\`, `<` becomes `\l`, `[` becomes `\b`."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescaped(text: Column) -> Column:
    """The text that escaped() was given. Pairs of backslashes are taken from the left."""
    parts = F.transform(
        F.split(text, r"\\\\", -1),
        lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")),
    )
    return F.array_join(parts, "\\")


def text_part(text: Column) -> Column:
    """Content that is one text; null counts as empty."""
    fields = [F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).alias("ref"),
              F.lit(None).alias("width"), F.lit(None).alias("height"), F.lit(None).alias("seconds"), F.lit(None).alias("pages")]
    return F.array(F.struct(*fields)).cast(f"array<{PART}>")


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment takes in place of its placeholder; at least one."""
    image = F.ceil(F.coalesce(part["width"], F.lit(PATCH)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(PATCH)) / PATCH)
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * TOKENS_A_SECOND)
    document = F.coalesce(part["pages"], F.lit(1)) * TOKENS_A_PAGE
    found = F.when(part["kind"] == "image", image).when(part["kind"] == "audio", audio).when(
        part["kind"] == "document", document
    )
    return F.greatest(F.coalesce(found, F.lit(1)), F.lit(1)).cast("long")


def visit(part: Column) -> Column:
    """A text part escaped; any other part as the placeholder of its kind."""
    shown = F.when(part["kind"] == "text", escaped(F.coalesce(part["text"], F.lit(""))))
    return shown.otherwise(F.concat(F.lit("<"), F.coalesce(part["kind"], F.lit("unknown")), F.lit(">")))


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row a conversation: conv_col, formatted, n_turns, loss_spans (start, end: code points of formatted),
    attachments in the order of their placeholders (kind, ref, tokens) and attachment_tokens.

    Turns follow turn_col (null first); ties and repeated rows are all kept, by role and content. A null role
    counts as empty; null or empty content gives an empty body. Part kinds other than text, image, audio and
    document get a placeholder too. Rows with a null conversation are one conversation. An empty table gives an
    empty one; other columns are not read. A conversation is one string, so it must fit a row.
    """
    parts = F.coalesce(F.col(parts_col), F.expr(f"cast(array() as array<{PART}>)"))
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.array_join(F.transform(parts, visit), "").alias("body"),
        F.transform(
            F.filter(parts, lambda p: ~F.coalesce(p["kind"] == "text", F.lit(False))),
            lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")),
        ).alias("attachments"),
    )
    rows = rows.withColumn("head", F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(BODY)))
    order = Window.partitionBy("conv").orderBy("turn", "role", "body")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    size = F.char_length("head") + F.char_length("body") + len(END)
    placed = rows.withColumn("i", F.row_number().over(order)).withColumn("stop", F.sum(size).over(upto) - len(END))
    span = F.struct((F.col("stop") - F.char_length("body")).alias("start"), F.col("stop").alias("end"))
    turn = F.struct(
        "i",
        F.concat("head", "body", F.lit(END)).alias("shown"),
        F.when(F.col("role").isin(*loss_roles), span).alias("span"),
        "attachments",
    )
    chats = placed.groupBy("conv").agg(F.array_sort(F.collect_list(turn), _by_place).alias("turns"))
    attachments = F.flatten(F.transform("turns", lambda t: t["attachments"]))
    return chats.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
        F.size("turns").cast("long").alias("n_turns"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def _by_place(a: Column, b: Column) -> Column:
    return a["i"] - b["i"]


def read_turns(formatted: Column) -> Column:
    """Role and text of each turn, read back from a formatted conversation (placeholders stay as they are)."""
    shown = F.slice(F.split(formatted, TURN, -1), 2, 1 << 30)

    def turn(piece: Column) -> Column:
        body = F.element_at(F.split(piece, BODY, -1), 2)
        return F.struct(
            unescaped(F.element_at(F.split(piece, BODY, -1), 1)).alias("role"),
            unescaped(F.element_at(F.split(body, END, -1), 1)).alias("text"),
        )

    return F.transform(shown, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, span after span."""
    pieces = F.transform(
        spans,
        lambda s: unescaped(F.substring(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))),
    )
    return F.array_join(pieces, "")
