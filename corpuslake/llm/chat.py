"""Chat formatting: turns of a conversation to one marked text and its loss mask, in Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, NEXT, LINE = "<|im_start|>", "<|im_end|>\n", "<|im_next|>", "<|im_line|>"
MARK = "<|"


def escape(text: Column) -> Column:
    """Double the bar of every ``<|``: no control string is left, and ``unescape`` takes it back."""
    return F.replace(text, F.lit(MARK), F.lit(MARK + "|"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit(MARK + "|"), F.lit(MARK))


def _parts(text: Column, mark: str) -> Column:
    return F.split(text, "\\Q" + mark + "\\E", -1)


def format_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``loss_spans`` (array of start, end in characters).

    Turns are sorted by number (NULL first; ties by role, then text). Neighbours of one role become one block
    ``<|im_start|>role``, newline, texts, ``<|im_end|>``, newline, with ``<|im_next|>`` between its texts so that
    turns can be read back. The loss mask covers the texts of ``learn`` and no marks. Control strings in texts
    and roles are escaped reversibly. NULL role and text are empty; rows without ``conv`` are one conversation.
    A conversation is one value, so it must fit into a row.
    """
    clean_role = F.replace(escape(F.coalesce(F.col(f"`{role}`"), F.lit(""))), F.lit("\n"), F.lit(LINE))
    item = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        clean_role.alias("role"),
        escape(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text"),
    )
    rows = turns.select(F.col(f"`{conv}`").alias(conv), item.alias("item"))
    grouped = rows.groupBy(conv).agg(F.sort_array(F.collect_list("item")).alias("turns"))
    n = F.size("turns")
    at = lambda i: F.get(F.col("turns"), i)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (at(i)["role"] != at(i - 1)["role"]))
    blocks = F.transform("starts", lambda s, k: F.struct(
        at(s)["role"].alias("role"),
        F.transform(
            F.slice("turns", s + 1, F.coalesce(F.get(F.col("starts"), k + 1), n) - s), lambda t: t["text"]
        ).alias("texts"),
    ))
    written = F.transform("blocks", lambda b: F.concat(
        F.lit(START), b["role"], F.lit("\n"), F.array_join(b["texts"], NEXT), F.lit(END)
    ))
    # Length of what stands before each text, and of the text.
    pieces = F.flatten(F.transform("blocks", lambda b, k: F.transform(b["texts"], lambda t, j: F.struct(
        (F.when(j > 0, F.lit(len(NEXT)))
         .otherwise(F.length(b["role"]) + len(START) + 1 + F.when(k > 0, F.lit(len(END))).otherwise(0))).alias("gap"),
        F.length(t).alias("size"),
        (b["role"] == F.lit(learn)).alias("learn"),
    ))))
    none = F.from_json(F.lit("[]"), "array<struct<start:int,end:int>>")
    spans = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["size"]).alias("at"),
            F.when(p["learn"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + p["gap"]).alias("start"), (acc["at"] + p["gap"] + p["size"]).alias("end")
            )))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return (
        grouped.withColumn("starts", starts).withColumn("blocks", blocks)
        .select(conv, F.array_join(written, "").alias("formatted"), spans.alias("loss_spans"))
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), as they were put in."""
    blocks = F.filter(_parts(formatted, END), lambda b: b != "")
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        _parts(F.substring(b, F.instr(b, "\n") + 1, F.length(b)), NEXT),
        lambda t: F.struct(
            unescape(F.replace(
                F.substring(b, F.lit(len(START) + 1), F.instr(b, "\n") - len(START) - 1), F.lit(LINE), F.lit("\n")
            )).alias("role"),
            unescape(t).alias("text"),
        ),
    )))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), ""
    )
