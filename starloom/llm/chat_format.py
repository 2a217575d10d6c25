"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is a sequence of turns ``<s>role[INST]text</s>``.  The parser is deterministic: it cuts at ``</s>``,
then at the first ``[INST]``, and takes one backslash out of each control string that holds some.  A conversation is
rendered as it is and parsed again; if the turns differ from the source, roles and texts are escaped (one backslash
goes behind the first character of each control string, whether it holds backslashes already or not), rendered and
parsed once more, which gives the source back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>", "[INST]", "</s>"
LEARNED = "assistant"

_ESCAPE = r"<(?=\\*/?s>)|\[(?=\\*/?INST\])"
_CONTROL = r"</?s>|\[/?INST\]"
_UNESCAPE = r"(<(?=\\+/?s>)|\[(?=\\+/?INST\]))\\"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE), F.lit("$1"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct(role, text), null where a control string stands inside."""
    blocks = F.slice(F.split(formatted, CLOSE), F.lit(1), F.greatest(F.lit(0), F.size(F.split(formatted, CLOSE)) - 1))

    def turn(block: Column) -> Column:
        at = F.instr(block, MIDDLE)
        role = F.substring(block, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        text = F.substring(block, at + len(MIDDLE), F.length(block))
        read = [F.when(~x.rlike(_CONTROL), unescaped(x)).alias(n) for x, n in ((role, "role"), (text, "text"))]
        return F.struct(*read)

    return F.transform(blocks, turn)


def formatted(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Every conversation's formatted string, its turns read back from it, and its loss mask.

    Returns id, formatted, turns (array of role and text, parsed from formatted) and loss (array of the start, from 1,
    and length, in code points, of each assistant text in formatted).  Turns stand by turn, role and text; null turns
    come first.  A null role or text is empty; empty texts are turns too.  Rows of a null id are one conversation.
    Repeated rows are turns each.  An empty table gives an empty result.  Other columns are ignored.
    """
    rows = turns.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).select(
        "*",
        rendered(F.col("role"), F.col("text")).alias("plain"),
        rendered(escaped(F.col("role")), escaped(F.col("text"))).alias("safe"),
        F.length(escaped(F.col("text"))).alias("length"),
    )
    in_order = Window.partitionBy("id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.length("safe")).over(in_order)).withColumn(
        "place", F.row_number().over(Window.partitionBy("id").orderBy("turn", "role", "text"))
    )
    rows = rows.withColumn("start", F.col("end") - len(CLOSE) - F.col("length") + 1)
    grouped = rows.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "text", "plain", "safe", "start", "length"))).alias("t")
    )
    source = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    plain = F.array_join(F.transform("t", lambda x: x["plain"]), "")
    safe = F.array_join(F.transform("t", lambda x: x["safe"]), "")
    loss = F.transform(
        F.filter("t", lambda x: x["role"] == LEARNED),
        lambda x: F.struct(x["start"].cast("int").alias("start"), x["length"].alias("length")),
    )
    chosen = F.when(parsed(plain) == source, plain).otherwise(safe)
    out = grouped.select(F.col("id").alias(id_col), source.alias("source"), chosen.alias("formatted"), loss.alias("loss"))
    out = out.withColumn("turns", parsed(F.col("formatted")))
    same = F.when(F.col("turns") == F.col("source"), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a conversation does not come back from its format"))
    )
    return out.select(id_col, same.alias("formatted"), "turns", "loss")


def text_under_loss(formatted_col: str = "formatted", loss_col: str = "loss") -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(loss_col, lambda x: unescaped(F.substring(F.col(formatted_col), x["start"], x["length"]))), ""
    )
