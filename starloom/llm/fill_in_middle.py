"""Fill-in-middle transformation by a regex with counted quantifiers, in DataFrame functions only.

``regexp_count`` gives the number n of units of a text.  Two seeded places a <= b in 0..n make a pattern for each row,
with possessive groups of unit{a} and unit{b - a} and a last group for the rest, so that one match from the left
captures prefix, middle and suffix, and its replacement writes them in the order of the row's form.  Possessive
quantifiers step through a text without recursion, so texts of any length match.  Rows are independent: nothing is
shuffled, and a lost task is run again with the same result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CODE_POINT = "."
STRIDE = 1024  # units that are counted together


def unit_count(text: Column, unit: str = CODE_POINT) -> Column:
    """Units of a text, counted in strides first, so that no array of single units of a long text is made."""
    stride = f"(?:{unit}){{{STRIDE}}}+"
    rest = F.regexp_replace(text, F.lit(rf"(?s)\A(?:{stride})*+"), F.lit(""))
    return (
        F.regexp_count(text, F.lit(f"(?s){stride}")).cast("long") * STRIDE
        + F.regexp_count(rest, F.lit(f"(?s){unit}")).cast("long")
    )


def drawn(key: Column, seed: int, group: int) -> Column:
    """The group-th 8 hex digits of the SHA-256 of ``seed:key``, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def _check(sentinels: tuple[str, str, str]) -> None:
    """Sentinels must be found again in any text that holds none: no end of one may be a beginning of another."""
    for x in sentinels:
        for y in sentinels:
            if not x or (x is not y and x in y) or any(x[-k:] == y[:k] for k in range(1, min(len(x), len(y)))):
                raise ValueError(f"sentinels {x!r} and {y!r} can overlap")
    if len(set(sentinels)) < 3:
        raise ValueError("sentinels must differ")


def _replacement(text: str) -> str:
    return re.sub(r"([\\$])", r"\\\1", text)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output of a form was made from."""
    p, s, m = (re.escape(x) for x in sentinels)
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    plain_from: int = 90,
    spm_below: int = 20,
    unit: str = CODE_POINT,
    sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every document's id, n (its units), form, prefix_units, middle_units and output.

    ``unit`` is a regex that matches at every place of a text up to its end (a code point by default); sentinels stand
    for prefix, suffix and middle.  Form "psm" writes prefix, suffix, middle, each behind its sentinel, and "spm"
    suffix, prefix, middle.  Form "plain" is the text itself: it is empty or holds a sentinel, or its third draw,
    modulo 100, is at least ``plain_from``; its unit columns are null.  Of the others those whose fourth draw, modulo
    100, is below ``spm_below`` are "spm".  Draws depend on seed and id alone, so rows of equal id draw alike; a null
    id draws as an empty one.  A null text is empty.  Repeated rows return each; an empty table gives an empty
    result.  Other columns are ignored, so their names cannot clash.
    """
    _check(sentinels)
    p, s, m = (_replacement(x) for x in sentinels)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("*", unit_count(F.col("text"), unit).alias("n"))
    held = F.lit(False)
    for x in sentinels:
        held = held | F.col("text").contains(x)
    rows = rows.select(
        "*",
        *(F.pmod(drawn(F.col("id"), seed, g), F.col("n") + 1).alias(c) for g, c in ((0, "one"), (1, "two"))),
        F.when((F.col("text") == "") | held | (drawn(F.col("id"), seed, 2) % 100 >= plain_from), "plain")
        .when(drawn(F.col("id"), seed, 3) % 100 < spm_below, "spm")
        .otherwise("psm")
        .alias("form"),
    )
    first, gap = F.least("one", "two"), F.abs(F.col("one") - F.col("two"))
    cut = F.concat(F.lit(rf"(?s)\A((?:{unit}){{"), first, F.lit(rf"}}+)((?:{unit}){{"), gap, F.lit(r"}+)(.*+)\z"))
    order = F.when(F.col("form") == "psm", F.lit(f"{p}$1{s}$3{m}$2")).otherwise(F.lit(f"{s}$3{p}$1{m}$2"))
    plain = F.col("form") == "plain"
    return rows.select(
        F.col("id").alias(id_col),
        "n",
        "form",
        F.when(~plain, first).alias("prefix_units"),
        F.when(~plain, gap).alias("middle_units"),
        F.when(plain, F.col("text")).otherwise(F.regexp_replace("text", cut, order)).alias("output"),
    )
