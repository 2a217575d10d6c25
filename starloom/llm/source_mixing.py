"""Mixing sources to target weights, by subset-sum budget fitting.

Documents of a source are counted by exact length.  Each is taken as often as the target holds the whole source; the
rest of the target is a budget for one more copy of some documents.  The budget is dealt to all lengths in proportion,
what rounding leaves goes to long documents, and a bounded-knapsack dynamic program over the remaining counts fits the
last words exactly if any choice does.  The documents of a length are chosen by a seeded order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_through
from .counting import place_in_slot, slots_before, with_slot, word_count

WEIGHTS = (5, 2, 1)
MOST = 3  # copies of a document
SEED = 17
RESERVE = 4096  # words that are left to the dynamic program at least
MEMORY = 1 << 28  # bytes of its tables; beyond, the best sum found so far is taken


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> list[float]:
    """Shares of the sum of all sizes by weight, ``most`` times the own size at most, the excess reshared by weight."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out, free, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while free:
        each = left / sum(weight[i] for i in free)
        full = [i for i in free if each * weight[i] > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = each * weight[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
        free = [i for i in free if i not in set(full)]
    return out


def fitted(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take so that their words come as near to ``budget`` as can be found."""
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    taken = [c * max(0, budget - RESERVE) // total if total else 0 for c in counts]
    left = budget - sum(n * t for n, t in zip(lengths, taken, strict=True))
    order = sorted((i for i in range(len(lengths)) if lengths[i]), key=lambda i: -lengths[i])
    for i in order:
        more = min(counts[i] - taken[i], max(0, left - RESERVE) // lengths[i])
        taken[i] += more
        left -= more * lengths[i]
    # Reachable sums as bits of one integer; a length's free documents in parts of 1, 2, 4, ...
    full, reached, steps, used = (1 << (left + 1)) - 1, 1, [], 0
    for i in reversed(order):
        free, part = min(counts[i] - taken[i], left // lengths[i]), 1
        while free and not reached >> left & 1 and used < MEMORY:
            part = min(part, free)
            steps.append((i, part, reached))
            used += left // 8 + 64
            reached |= (reached << (part * lengths[i])) & full
            free, part = free - part, part * 2
    at = reached.bit_length() - 1
    for i, part, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += part
            at -= part * lengths[i]
    gap = budget - sum(n * t for n, t in zip(lengths, taken, strict=True))
    more = [i for i in order if taken[i] < counts[i] and lengths[i] < 2 * gap]
    if more:  # one document more comes nearer, though beyond the budget
        taken[min(more, key=lambda i: abs(lengths[i] - gap))] += 1
    return taken


def _plans(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("size", ignore_index=True)
    total, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    whole, rest = divmod(int(np.floor(target + 0.5)), total) if total else (0, 0)
    extra = fitted(pdf["size"].tolist(), pdf["held"].tolist(), rest)
    return pdf.assign(whole=whole, extra=extra)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every row with its size in words, its source's size and target, and copies: how often the mix takes it.

    Sources stand in order of code points, null last, and weigh ``weights`` in turn.  A null text has size 0 and is
    taken as often as its source is taken whole.  The choice depends on ids, lengths and sources alone, so reruns
    agree; rows of equal id, source and length are exchangeable.  Repeated rows count each.  An empty table gives an
    empty result.  Returns id, the ``carry`` columns, size, source_size, target, copies; other columns are ignored.
    """
    names = [f"_c{i}" for i in range(len(carry))]
    sized = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("null")).alias("from"),
        F.col(source_col).isNull().alias("nameless"),
        word_count(F.col(text_col)).alias("size"),
        *(F.col(c).alias(n) for c, n in zip(carry, names, strict=True)),
    )
    if not carry:
        sized = write_through(sized, "sizes")
    counted = write_through(sized.groupBy("from", "nameless", "size").agg(F.count("*").alias("held")), "lengths")
    totals = counted.groupBy("from", "nameless").agg(F.sum(F.col("size") * F.col("held")).alias("source_size"))

    def share(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([*frames])  # one row for each source
        pdf = pdf.assign(order=pdf["from"].str.encode("utf-8")).sort_values(["nameless", "order"], ignore_index=True)
        pdf["target"] = targets([int(x) for x in pdf["source_size"]], weights)
        yield pdf[["from", "source_size", "target"]]

    aims = write_through(
        totals.coalesce(1).mapInPandas(share, "from string, source_size long, target double"), "targets"
    )
    plan = counted.drop("nameless").join(aims, "from").groupBy("from").applyInPandas(
        _plans, "from string, size long, held long, source_size long, target double, whole long, extra long"
    )
    plan = write_through(plan, "plan")
    key = ["from", "size"]
    drawn = with_slot(sized.drop("nameless").join(plan, key), "_id", "held", SEED)
    slots = drawn.groupBy(*key, "extra", "slot").agg(F.count("*").alias("held"))
    slots = write_through(slots_before(slots, key).select(*key, "slot", "before"), "slots")
    out = drawn.join(slots, [*key, "slot"]).withColumn("place", F.col("before") + place_in_slot(key, "_id"))
    return out.select(
        F.col("_id").alias(id_col),
        *(F.col(n).alias(c) for c, n in zip(carry, names, strict=True)),
        "size",
        "source_size",
        "target",
        (F.col("whole") + (F.col("place") <= F.col("extra")).cast("long")).alias("copies"),
    )
