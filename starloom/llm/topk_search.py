"""Exact top-k search by inner product, with the three-phase uniform threshold.

Vectors are cut into slices of components; a score is the sum of a query's partial scores over the slices.

1. Each block of candidates lists, for every query and slice, the k best partial scores, scores what is on the lists
   and sends the k best of those.  Lists are merged a few dozen at a time until one is left for each block of queries.
   Its k-th best is a score that k candidates reach: the cutoff.
2. The cutoff goes back to the blocks.  A candidate that reaches it has a partial score of at least cutoff / slices in
   some slice; only such entries are collected.
3. Their scores are resolved exactly, and the k best that reach the cutoff leave the block for the final order.

Queries and candidates meet in cells, a block of each; sizes of blocks bound what a task holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 20
SLICES = 4
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 2048
MERGED = 64  # lists that one task merges
NO_SCORE = -np.inf


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    rows = column.combine_chunks()
    rows = pa.concat_arrays(rows.chunks) if isinstance(rows, pa.ChunkedArray) else rows
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = rows.flatten().to_numpy(zero_copy_only=False).astype(float)
    out = np.zeros((len(lengths), max(1, lengths.max(initial=0))))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by([("vec_id", "ascending"), ("twin", "ascending")])


def _partials(queries: pa.Table, candidates: pa.Table) -> list[np.ndarray]:
    """Partial scores of every query and candidate, one matrix for each slice; the query's own id has none."""
    q, c = _matrix(queries["vector"]), _matrix(candidates["vector"])
    width = min(q.shape[1], c.shape[1])
    edges = [width * i // SLICES for i in range(SLICES + 1)]
    out = [q[:, a:b] @ c[:, a:b].T for a, b in zip(edges[:-1], edges[1:], strict=True)]
    own = queries["vec_id"].to_numpy()[:, None] == candidates["vec_id"].to_numpy()[None, :]
    out[0][own] = NO_SCORE
    return out


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k highest of each row in falling order, NO_SCORE where there are fewer."""
    k_here = min(k, scores.shape[1])
    top = -np.sort(-np.partition(scores, scores.shape[1] - k_here, axis=1)[:, scores.shape[1] - k_here :], axis=1)
    return np.pad(top, ((0, 0), (0, k - k_here)), constant_values=NO_SCORE)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "vector",
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """The k rows of ``vectors`` with the highest inner product with each row of ``queries``, ties to the smaller id.

    Components are whole numbers of less than 2^53 in all sums, so scores are exact.  Rows with a null id, a null
    vector or a null or non-finite component take no part.  A candidate of the query's id is the query's own and not
    returned.  Rows that repeat (equal id and vector) count once; several vectors of one id count each.  Vectors of
    unequal length are compared over the components that both have.  Fewer than k candidates give all of them, an
    empty table an empty result.  Returns query_id, rank (from 1), id and score.  Other columns are ignored.
    """

    def taken(df: DataFrame) -> DataFrame:
        v = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        v = v.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & good)
        return v.withColumn("twin", F.xxhash64("vector")).dropDuplicates(["vec_id", "twin"])

    asked, found = taken(queries), taken(vectors)
    rows = -(-asked.count() // query_block) or 1
    columns = -(-found.count() // candidate_block) or 1

    def block(blocks: int):
        return F.pmod(F.xxhash64("vec_id", "twin"), F.lit(blocks)).cast("int")

    def all_of(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    asked = asked.withColumn("q", block(rows))
    cells = found.withColumn("c", block(columns)).withColumn("q", all_of(rows)).groupBy("q", "c")

    def gather(key, left: pa.Table, right: pa.Table) -> pa.Table:
        payloads = []
        if left.num_rows and right.num_rows:
            parts = _partials(_sorted(left), right)
            total = sum(parts)
            listed = np.zeros(total.shape, bool)
            n = min(k, total.shape[1])
            for part in parts:
                np.put_along_axis(listed, np.argpartition(part, total.shape[1] - n, axis=1)[:, -n:], True, axis=1)
            payloads = [_best(np.where(listed, total, NO_SCORE), k).tobytes()]
        at = [pa.array([x.as_py()] * len(payloads), pa.int32()) for x in key]
        return pa.table({"q": at[0], "c": at[1], "scores": pa.array(payloads, pa.binary())})

    def merged(lists: pa.Table) -> np.ndarray:
        best = None
        for payload in lists["scores"].to_pylist():
            scores = np.frombuffer(payload).reshape(-1, k)
            best = scores if best is None else _best(np.hstack([best, scores]), k)
        return best

    def merge(key, lists):
        at = [pa.array([x.as_py()], pa.int32()) for x in key]
        return pa.table({"q": at[0], "c": at[1], "scores": pa.array([merged(lists).tobytes()], pa.binary())})

    def cutoffs(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _sorted(left)
        best = merged(right) if left.num_rows and right.num_rows else np.full((left.num_rows, k), NO_SCORE)
        return left.append_column("cutoff", pa.array(best[:, k - 1]))

    def resolve(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = np.zeros(0, np.int64)
        query, ids, twins, scores = [empty], [empty], [empty], [empty]
        if left.num_rows and right.num_rows:
            right = _sorted(right)
            cutoff = left["cutoff"].to_numpy()
            parts = _partials(left, right)
            entry = np.zeros(parts[0].shape, bool)
            for part in parts:
                entry |= part >= cutoff[:, None] / SLICES
            own = left["vec_id"].to_numpy()[:, None] == right["vec_id"].to_numpy()[None, :]
            row, column = np.nonzero(entry & ~own)
            score = sum(part[row, column] for part in parts)
            good = score >= cutoff[row]
            row, column, score = row[good], column[good], score[good].astype(np.int64)
            order = np.lexsort((column, -score, row))  # columns ascend by id
            row, column, score = row[order], column[order], score[order]
            first = np.searchsorted(row, row, "left")
            keep = np.arange(len(row)) - first < k
            query.append(left["vec_id"].to_numpy()[row[keep]])
            twins.append(left["twin"].to_numpy()[row[keep]])
            ids.append(right["vec_id"].to_numpy()[column[keep]])
            scores.append(score[keep])
        names = {"query_id": query, "twin": twins, "vec_id": ids, "score": scores}
        return pa.table({n: pa.array(np.concatenate(v)) for n, v in names.items()})

    lists = "q int, c int, scores binary"
    local, left = asked.withColumn("c", all_of(columns)).groupBy("q", "c").cogroup(cells).applyInArrow(gather, lists), columns
    while left > MERGED:
        local = local.withColumn("c", (F.col("c") / MERGED).cast("int")).groupBy("q", "c").applyInArrow(merge, lists)
        left = -(-left // MERGED)
    bounded = asked.groupBy("q").cogroup(local.groupBy("q")).applyInArrow(
        cutoffs, "vec_id long, vector array<double>, twin long, q int, cutoff double"
    )
    entries = (
        bounded.withColumn("c", all_of(columns))
        .groupBy("q", "c")
        .cogroup(cells)
        .applyInArrow(resolve, "query_id long, twin long, vec_id long, score long")
    )
    w = Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id")
    return (
        entries.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
    )
