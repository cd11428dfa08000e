"""Chat formatting with relational operations and expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one
role become one block; blocks are concatenated:

    <s>[ROLE]user[/ROLE]first text[NEXT]second text</s>[ROLE]assistant[/ROLE]...</s>

``[NEXT]`` stands where rows were merged, so that the rows can be read back. Inside roles
and texts a backslash is doubled and every control string gets one after its first
character, so that none is left there; taking single backslashes away and halving double
ones restores the text.

The loss mask is a list of (start, length) in code points of the formatted text, one per
row of the learnt role; control strings are never under it.

Order and edge cases: rows go by turn, then role, then text, nulls first and as empty
strings; repeated rows are kept, each a turn. A null conv_id is a conversation like any
other. Empty conversations don't occur: no rows, no output; an empty table gives none.
Other columns are not read. A conversation is one row of output, however long; rows of
different conversations never meet, and a row reaches its conversation once.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, ROLE, END_ROLE, NEXT, END = "<s>", "[ROLE]", "[/ROLE]", "[NEXT]", "</s>"
#: Also escaped, since other templates give them a meaning.
FOREIGN = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")


def escape(text: Column) -> Column:
    """``text`` without control strings."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), (BEGIN, ROLE, END_ROLE, NEXT, END, *FOREIGN), doubled)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def format_chats(rows: DataFrame, learnt: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss (array of start and length) of each conversation of rows (conv_id, turn, role, text)."""
    turn = F.struct("turn", _text("role").alias("role"), _text("text").alias("text"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    last = F.size("turns") - 1
    # Each block's first turn; with the place after the last one, the blocks' edges.
    heads = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"]))
    edges = turns.select("conv_id", "turns", F.concat(heads, F.array(last + 1)).alias("edges"))

    def block(i: Column) -> Column:
        own = F.slice("turns", F.col("edges")[i] + 1, F.col("edges")[i + 1] - F.col("edges")[i])
        return F.struct(own[0]["role"].alias("role"), F.transform(own, lambda t: escape(t["text"])).alias("texts"))

    blocks = edges.select("conv_id", F.transform(F.sequence(F.lit(0), F.size("edges") - 2), block).alias("blocks"))
    head = lambda b: F.concat(F.lit(ROLE), escape(b["role"]), F.lit(END_ROLE))
    written = F.concat(F.lit(BEGIN), F.array_join(F.transform("blocks", lambda b: F.concat(head(b), F.array_join(b["texts"], NEXT), F.lit(END))), ""))
    # Per row, in order: what stands before its text, the text's length, whether it is learnt.
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.transform(
                b["texts"],
                lambda t, i: F.struct(
                    F.when(i == 0, F.length(head(b))).otherwise(len(NEXT)).alias("before"),
                    F.length(t).alias("length"),
                    F.when(i == F.size(b["texts"]) - 1, len(END)).otherwise(0).alias("after"),
                    (b["role"] == learnt).alias("learnt"),
                ),
            ),
        )
    )
    zero = F.struct(F.lit(len(BEGIN)).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    walked = F.aggregate(
        pieces,
        zero,
        lambda a, p: F.struct(
            (a["at"] + p["before"] + p["length"] + p["after"]).alias("at"),
            F.when(p["learnt"], F.array_append(a["spans"], F.struct((a["at"] + p["before"]).alias("start"), p["length"].alias("length")))).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return blocks.select("conv_id", written.alias("formatted"), walked.alias("loss"))


def read_back(formatted: Column) -> Column:
    """The rows of a formatted conversation, as an array of (role, text)."""
    body = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted))
    blocks = F.split(body, "</s>")
    rows = F.transform(
        F.slice(blocks, F.lit(1), F.size(blocks) - 1),
        lambda b: F.transform(
            F.split(F.substring(b, F.locate(END_ROLE, b) + len(END_ROLE), F.length(b)), r"\[NEXT\]"),
            lambda t: F.struct(unescape(F.substring(b, F.lit(len(ROLE) + 1), F.locate(END_ROLE, b) - len(ROLE) - 1)).alias("role"), unescape(t).alias("text")),
        ),
    )
    return F.flatten(rows)


def under_mask(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
