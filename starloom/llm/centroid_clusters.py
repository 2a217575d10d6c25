"""Centroid clustering of integer vectors, with the Shallot search and exact integer results.

Each vector keeps its centroid, the second-nearest one that was last found, an upper bound on its distance to the
first and a lower bound on its distance to every other.  When centroids move, the bounds move with them.  Where they
(or half the distance from the centroid to its nearest neighbour) no longer prove that the vector stays, its distances
to both remembered centroids are taken and the search starts at the closer one: its neighbours come in order of their
distance from it, and one farther away than the start's distance plus the second-best distance so far can be
neither best nor second, nor can those behind it.  Each better centroid makes this ball smaller.  Survivors are
compared by squared integer distance, ties by number, so rounding decides nothing.

Only the centroids pass through the driver: k vectors, whatever the table.  A round writes the vectors with their
bounds; sums are taken over the vectors that moved alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_through

K = 16
ROUNDS = 3
WIDTH = 64
LARGEST = 1 << 27  # of a component: squared distances of 64 such fit into 63 bits
PIECE = 4096  # vectors whose differences are held at once
WIDER = 1e-9  # bounds give way by this share, far more than rounding takes

STATE = "vec_id long, vector binary, cluster int, before int, second int, upper double, lower double"
_KINDS = {1: np.int8, 2: np.int16, 4: np.int32}


# Vectors -------------------------------------------------------------------------------------------------------


def packed(vectors: np.ndarray) -> list[bytes]:
    """Each vector's components in the fewest bytes that hold the largest of these vectors."""
    top = int(np.abs(vectors).max(initial=0))
    kind = np.int8 if top < 1 << 7 else np.int16 if top < 1 << 15 else np.int32
    return [v.tobytes() for v in vectors.astype(kind)]


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    values = column.to_pylist()
    out = np.empty((len(values), width), np.int64)
    lengths = np.array([len(x) for x in values], int)
    for size in np.unique(lengths):
        at = np.flatnonzero(lengths == size)
        data = np.frombuffer(b"".join(values[i] for i in at), _KINDS[size // width])
        out[at] = data.reshape(-1, width)
    return out


def squared(vectors: np.ndarray, centroids: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Squared distance of each vector to the centroid of its number."""
    out = np.empty(len(vectors), np.int64)
    for a in range(0, len(vectors), PIECE):
        gap = vectors[a : a + PIECE] - centroids[which[a : a + PIECE]]
        out[a : a + PIECE] = np.einsum("ij,ij->i", gap, gap)
    return out


# Search --------------------------------------------------------------------------------------------------------


class Centroids:
    """Centroids of a round, their distances to each other, and how far they moved since the round before."""

    def __init__(self, now: np.ndarray, earlier: np.ndarray | None = None):
        self.now = now
        k = len(now)
        gaps = [np.sqrt(squared(now, now, np.full(k, j)).astype(float)) for j in range(k)]
        self.apart = np.array(gaps).reshape(k, k)
        others = self.apart + np.diag(np.full(k, -1.0))
        self.near = np.argsort(others, axis=1, kind="stable")  # itself first
        self.half = np.where(k > 1, np.sort(others, axis=1)[:, min(1, k - 1)] / 2, np.inf)
        self.moved = np.zeros(k) if earlier is None else np.sqrt(squared(now, earlier, np.arange(k)).astype(float))
        far = np.argsort(-self.moved)
        self.others_moved = np.full(k, self.moved[far[0]])  # the farthest move of any other
        self.others_moved[far[0]] = self.moved[far[1]] if k > 1 else 0.0

    def assign(self, vectors, first, second, upper, lower) -> tuple[np.ndarray, ...]:
        """Nearest and second-nearest centroids of the vectors, with new bounds.

        ``second`` is any other centroid of a vector that keeps its first; bounds are to the centroids before.
        """
        first, second = first.copy(), second.copy()
        upper = (upper + self.moved[first]) * (1 + WIDER)
        lower = lower - self.others_moved[first] - WIDER * (lower + self.others_moved[first])
        if len(self.now) < 2:
            return first, second, upper, lower
        open_ = np.flatnonzero(upper >= np.maximum(lower, self.half[first] * (1 - WIDER)))
        exact = squared(vectors[open_], self.now, first[open_])
        upper[open_] = np.sqrt(exact.astype(float)) * (1 + WIDER)
        still = upper[open_] >= np.maximum(lower[open_], self.half[first[open_]] * (1 - WIDER))
        open_, best = open_[still], exact[still]
        if len(open_):
            a, s, one, two = self._search(vectors[open_], first[open_], second[open_], best)
            first[open_], second[open_] = a, s
            upper[open_] = np.sqrt(one.astype(float)) * (1 + WIDER)
            lower[open_] = np.sqrt(two.astype(float)) * (1 - WIDER)
        return first, second, upper, lower

    def _search(self, vectors, first, second, best) -> tuple[np.ndarray, ...]:
        other = squared(vectors, self.now, second)
        swap = (other < best) | ((other == best) & (second < first))
        a, s = np.where(swap, second, first), np.where(swap, first, second)
        one, two = np.where(swap, other, best), np.where(swap, best, other)
        start, reach = a.copy(), np.sqrt(one.astype(float))
        remembered = s.copy()
        live = np.arange(len(vectors))
        for step in range(1, len(self.now)):
            j = self.near[start[live], step]
            ball = (reach[live] + np.sqrt(two[live].astype(float))) * (1 + WIDER)
            inside = self.apart[start[live], j] <= ball  # those left out stay out: neighbours come by distance
            live, j = live[inside], j[inside]
            if not len(live):
                break
            new = j != remembered[live]
            at, c = live[new], j[new]
            d = squared(vectors[at], self.now, c)
            wins = (d < one[at]) | ((d == one[at]) & (c < a[at]))
            follows = ~wins & ((d < two[at]) | ((d == two[at]) & (c < s[at])))
            w = at[wins]
            two[w], s[w] = one[w], a[w]
            one[w], a[w] = d[wins], c[wins]
            f = at[follows]
            two[f], s[f] = d[follows], c[follows]
        return a, s, one, two


# Spark ---------------------------------------------------------------------------------------------------------


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float, width: int) -> DataFrame:
    """Ids and floor(scale * x) of the vectors of ``width`` finite components."""
    x = F.col(vector_col).cast("array<double>")
    good = (F.size(x) == width) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * scale) < LARGEST))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    return rows.filter(F.coalesce(good, F.lit(False))).select(
        "vec_id", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("vector")
    )


def seeded_order(key: Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)


def cluster(
    vectors: DataFrame,
    k: int = K,
    rounds: int = ROUNDS,
    seed: int = 1,
    scale: float = 64.0,
    width: int = WIDTH,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Every vector's id, cluster, distance (squared, to its centroid), cluster_inertia, inertia and centroid.

    Components become integers floor(scale * x).  Vectors that are null, are not ``width`` long, or hold a null, a
    non-finite component or one of 2^27 or more after scaling take no part.  Centroids start as the ``k`` vectors
    with the smallest SHA-256 of ``seed:id`` (equal ones by vector; a null id hashes as an empty one), in that order;
    with fewer vectors there are as many centroids.  A round assigns every vector to the nearest centroid, ties to the
    smaller number, and then moves every centroid with vectors to the floor of their mean; after the last round they
    are assigned again.  Inertia is null where it exceeds a long.  Repeated rows are vectors each; an empty table
    gives an empty result.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_col, vector_col, scale, width)
    starts = whole.orderBy(seeded_order(F.col("vec_id"), seed), "vector").limit(k).select("vector").collect()
    centres = np.array([r["vector"] for r in starts], np.int64).reshape(-1, width)
    names = [f.strip().split()[0] for f in STATE.split(",")]

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            column = b.column(1)
            x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, width)
            yield from step(pa.RecordBatch.from_arrays([b.column(0)], names=["vec_id"]), x, None, Centroids(centres))

    def step(batch, x, state, now: Centroids) -> Iterator[pa.RecordBatch]:
        n = len(x)
        if state is None:
            before = np.full(n, -1)
            state = np.zeros(n, int), np.full(n, min(1, len(now.now) - 1)), np.full(n, np.inf), np.zeros(n)
        else:
            before = state[0]
        first, second, upper, lower = now.assign(x, *state)
        arrays = [
            batch.column(0),
            pa.array(packed(x), pa.binary()),
            pa.array(first.astype(np.int32)),
            pa.array(before.astype(np.int32)),
            pa.array(second.astype(np.int32)),
            pa.array(upper),
            pa.array(lower),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    def next_round(now: Centroids):
        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ints = [b.column(i).to_numpy().astype(int) for i in (2, 4)]
                floats = [b.column(i).to_numpy() for i in (5, 6)]
                yield from step(b, unpacked(b.column(1), width), (*ints, *floats), now)

        return assign

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((len(centres), width), np.int64), np.zeros(len(centres), np.int64)
        for b in batches:
            x = unpacked(b.column(0), width)
            for column, sign in ((b.column(1).to_numpy(), 1), (b.column(2).to_numpy(), -1)):
                there = column >= 0
                np.add.at(total, column[there], sign * x[there])
                np.add.at(count, column[there], sign)
        rows = [pa.array(np.arange(len(centres), dtype=np.int32)), pa.array(total.tolist(), pa.list_(pa.int64())), pa.array(count)]
        yield pa.RecordBatch.from_arrays(rows, names=["cluster", "total", "vectors"])

    state = write_through(whole.mapInArrow(begin, STATE), "clusters")
    totals = [[0] * width for _ in centres]
    counts = [0] * len(centres)
    for last in range(rounds if len(centres) else 0):
        moved = state.filter(F.col("cluster") != F.col("before")).select("vector", "cluster", "before")
        change = (
            moved.mapInArrow(sums, "cluster int, total array<long>, vectors long")
            .select("cluster", "vectors", F.posexplode("total").alias("at", "part"))
            .groupBy("cluster", "at")
            .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"), F.sum("vectors").alias("vectors"))
        )
        for r in change.collect():  # k * width rows
            totals[r["cluster"]][r["at"]] += int(r["part"])
            counts[r["cluster"]] += r["vectors"] if r["at"] == 0 else 0
        earlier, centres = centres, centres.copy()
        for c, n in enumerate(counts):
            if n:
                centres[c] = [t // n for t in totals[c]]
        state = write_through(state.mapInArrow(next_round(Centroids(centres, earlier)), STATE), f"clusters-{last}")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            which = b.column(2).to_numpy()
            d = squared(unpacked(b.column(1), width), centres, which)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(d)], names=["vec_id", "cluster", "distance"])

    out = state.select("vec_id", "vector", "cluster").mapInArrow(measured, "vec_id long, cluster int, distance long")
    own = out.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia")).collect()  # k rows
    known = {r["cluster"]: r["cluster_inertia"] for r in own}
    parts = [known.get(c, 0) for c in range(len(centres))]
    whole_sum = None if None in parts or sum(parts) >= 1 << 63 else sum(parts)
    table = [(c, p, whole_sum, [int(v) for v in centres[c]]) for c, p in enumerate(parts)]
    kinds = "cluster int, cluster_inertia long, inertia long, centroid array<long>"
    return (
        out.join(F.broadcast(spark.createDataFrame(table, kinds)), "cluster")  # k rows
        .select(F.col("vec_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
    )
