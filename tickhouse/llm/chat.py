"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context, and only
that reply is trainable. A closing row carries the whole conversation without a trainable part,
so that turns after the last reply, and conversations without any reply, are in the output too.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts
``&``, ``<``, ``[`` (and the line feed in roles) are written as ``&amp;``, ``&lt;``, ``&#91;`` and
``&#10;``. No control string of this or another template that starts with one of them survives in
a text, and undoing the escapes in reverse order gives back exactly the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template.
START, END = "<|im_start|>", "<|im_end|>\n"
REPLY = "assistant"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
BREAK = ("\n", "&#10;")


def escape(text: Column, pairs=ESCAPES) -> Column:
    for raw, written in pairs:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    for raw, written in reversed(pairs):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


def formatted_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation with the array of its written turns, in order.

    Turns are ordered by (turn, role, text), nulls first, so ties and repeated rows have one
    order. Null roles and texts are written as empty; a null ``conv_id`` is a conversation of
    its own. Other columns are ignored. An example holds a whole conversation, so a
    conversation has to fit in a row.
    """
    head = F.concat(
        F.lit(START), escape(F.coalesce("role", F.lit("")), (*ESCAPES, BREAK)), F.lit("\n")
    )
    segment = F.concat(head, escape(F.coalesce("text", F.lit(""))), F.lit(END))
    entry = F.struct(
        F.col("turn"),
        F.col("role"),
        F.col("text"),
        segment.alias("segment"),
        F.length(head).alias("head_chars"),
    )
    return (
        turns.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(entry), _in_order).alias("turns"))
        .select(
            "conv_id",
            F.transform(
                "turns",
                lambda t: F.struct(
                    t["segment"].alias("segment"),
                    t["head_chars"].alias("head_chars"),
                    F.coalesce(t["role"] == REPLY, F.lit(False)).alias("reply"),
                ),
            ).alias("turns"),
        )
    )


def _in_order(a: Column, b: Column) -> Column:
    def step(name, rest):
        x, y = a[name], b[name]
        return (
            F.when(x.eqNullSafe(y), rest)
            .when(x.isNull(), F.lit(-1))
            .when(y.isNull(), F.lit(1))
            .when(x < y, F.lit(-1))
            .otherwise(F.lit(1))
        )

    return step("turn", step("role", step("text", F.lit(0))))


def prefix_examples(turns: DataFrame) -> DataFrame:
    """Examples of ``turns`` (conv_id, turn, role, text): one per assistant turn, plus a closing row.

    Returns conv_id, example (1, 2, ... per conversation; null on the closing row), formatted (the
    written text) and loss_start, loss_chars (the trainable characters of it, 0-based; null and 0
    on the closing row, in which nothing is trainable). An empty table gives an empty table.
    """
    grouped = formatted_turns(turns).withColumn(
        "targets",
        F.filter(
            F.sequence(F.lit(1), F.size("turns")),
            lambda k: F.element_at(F.col("turns"), k)["reply"],
        ),
    )
    numbered = grouped.select(
        "conv_id",
        "turns",
        F.explode(
            F.concat(
                F.transform(
                    "targets", lambda k, i: F.struct((i + 1).alias("example"), k.alias("last"))
                ),
                F.array(
                    F.struct(F.lit(None).cast("int").alias("example"), F.size("turns").alias("last"))
                ),
            )
        ).alias("at"),
    )
    segments = F.transform(F.slice("turns", 1, F.col("at.last")), lambda t: t["segment"])
    target = F.element_at("turns", F.col("at.last"))
    reply = F.col("at.example").isNotNull()
    chars = F.length(target["segment"])
    return numbered.select(
        "conv_id",
        F.col("at.example").alias("example"),
        F.array_join(segments, "").alias("formatted"),
        F.when(reply, chars - target["head_chars"] - len(END)).otherwise(0).alias("loss_chars"),
        F.when(reply, chars - target["head_chars"]).alias("_tail"),
    ).select(
        "conv_id",
        "example",
        "formatted",
        (F.length("formatted") - F.col("_tail")).alias("loss_start"),
        "loss_chars",
    )


def loss_text(formatted: Column, start: Column, chars: Column) -> Column:
    """The trainable text of an example, unescaped."""
    return unescape(F.substring(formatted, start + 1, chars))


def parse_turns(formatted: Column) -> Column:
    """An array of (role, text), read back from a written conversation."""
    parts = F.filter(F.split(formatted, "<\\|im_end\\|>\n"), lambda s: s != "")

    def turn(part):
        role = F.substring_index(F.substr(part, F.lit(len(START) + 1)), "\n", 1)
        text = F.substr(part, F.length(role) + len(START) + 2)
        return F.struct(
            unescape(role, (*ESCAPES, BREAK)).alias("role"), unescape(text).alias("text")
        )

    return F.transform(parts, turn)
