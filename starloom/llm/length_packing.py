"""Packing into optimal length buckets.

The global histogram of lengths is cut into a few buckets; documents of a bucket are padded to its longest length.
Dynamic programming chooses the cuts with the least padding in all.  Inside each bucket, documents in a seeded order
fill batches of a token budget.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_through
from .counting import place_in_slot, slots_before, with_slot, word_count

BUCKETS = 8
BUDGET = 16_384  # tokens of a batch, padding included
SEED = 29


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """The longest length of each of at most ``buckets`` buckets, such that padding is least.

    The padding of the first j lengths in k buckets is the least, over the i where the last bucket begins, of the
    padding of the first i in k - 1 plus (lengths[j] * documents - tokens) between i and j.  For given i this is a
    line in lengths[j], and the lines' slopes fall with i, so the lower hull answers all j in one pass.
    """
    n = len(lengths)
    docs, tokens = [0], [0]
    for size, count in zip(lengths, counts, strict=True):
        docs.append(docs[-1] + count)
        tokens.append(tokens[-1] + size * count)
    best = [0, *(lengths[j - 1] * docs[j] - tokens[j] for j in range(1, n + 1))]
    begins = [[0] * (n + 1)]
    for _ in range(1, min(buckets, n)):
        hull: list[int] = []
        front, now, begin = 0, [0], [0]
        height = [best[i] + tokens[i] for i in range(n + 1)]
        for j in range(1, n + 1):
            i = j - 1
            while len(hull) - front >= 2:
                a, b = hull[-2], hull[-1]
                if (height[b] - height[a]) * (docs[i] - docs[b]) >= (height[i] - height[b]) * (docs[b] - docs[a]):
                    hull.pop()
                else:
                    break
            hull.append(i)
            x = lengths[j - 1]
            while len(hull) - front >= 2 and height[hull[front + 1]] - x * docs[hull[front + 1]] <= height[hull[front]] - x * docs[hull[front]]:
                front += 1
            i = hull[front]
            now.append(height[i] - x * docs[i] + x * docs[j] - tokens[j])
            begin.append(i)
        best = now
        begins.append(begin)
    out, j = [], n
    for begin in reversed(begins):
        if j:
            out.append(lengths[j - 1])
            j = begin[j]
    return out[::-1]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """Every row with n_tokens (its words), bucket_length, batch (counted from 0 in its bucket) and place in the batch.

    A batch of a bucket holds budget // bucket_length documents, one at least: a document longer than the budget is a
    batch of its own.  A null or empty text has no tokens and goes to the first bucket.  Order is by a seeded number,
    then id; rows of equal id and length are exchangeable.  Repeated rows are packed each.  An empty table gives an
    empty result.  Other columns are ignored.
    """
    sized = write_through(docs.select(F.col(id_col).alias("_id"), word_count(F.col(text_col)).alias("n_tokens")), "sizes")
    histogram = sized.groupBy("n_tokens").agg(F.count("*").alias("held"))

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([*frames]).sort_values("n_tokens")  # one row for each length
        yield pd.DataFrame({"bucket_length": boundaries(pdf["n_tokens"].tolist(), pdf["held"].tolist(), buckets)})

    chosen = sorted(r[0] for r in histogram.coalesce(1).mapInPandas(choose, "bucket_length long").collect())
    at = F.lit(None).cast("long")
    for length in reversed(chosen):
        at = F.when(F.col("n_tokens") <= length, F.lit(length).cast("long")).otherwise(at)
    placed = sized.withColumn("bucket_length", at)
    held = placed.groupBy("bucket_length").agg(F.count("*").alias("held")).collect()  # one row for each bucket
    size = F.lit(0).cast("long")
    for r in held:
        size = F.when(F.col("bucket_length") == r["bucket_length"], F.lit(r["held"])).otherwise(size)
    drawn = with_slot(placed.withColumn("held", size), "_id", "held", SEED).drop("held")
    slots = drawn.groupBy("bucket_length", "slot").agg(F.count("*").alias("held"))
    slots = write_through(slots_before(slots, ["bucket_length"]).select("bucket_length", "slot", "before"), "slots")
    rank = F.col("before") + place_in_slot(["bucket_length"], "_id") - 1
    fits = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("bucket_length"))))
    out = drawn.join(slots, ["bucket_length", "slot"]).withColumn("rank", rank).withColumn("fits", fits)
    return out.select(
        F.col("_id").alias(id_col),
        "n_tokens",
        "bucket_length",
        F.floor(F.col("rank") / F.col("fits")).alias("batch"),
        F.pmod("rank", "fits").alias("place"),
    )
