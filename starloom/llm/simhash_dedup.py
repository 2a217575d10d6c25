"""SimHash near-duplicates, found by pigeonring filtering.

A fingerprint of 64 bits is cut into d + 1 segments on a ring, d being the largest distance of a link.  Two linked
fingerprints have a segment from which every chain of l following segments differs in at most floor(l * d / (d + 1))
bits: none in the first, at most one in the first two, and so on.  The first two segments make the key under which
candidates meet (equal, and equal but for one bit), the longer chains prune them, and the whole distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_through
from . import packed as p
from .components import component_roots

SHINGLE = 3
DISTANCE = 3
SEED = 42
PER_BUCKET = 2048  # distinct fingerprints for each bucket of keys
PAIRS = 1 << 21  # candidate pairs that a task holds at once

_SET = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, each 1 if set in over half of the hashes of the text's shingles; 0 without words."""
    words = (text or "").encode().lower().split()  # lowers A-Z only, splits at the six ASCII white spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.r_[0, ends[: n - 1] + 1].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):
        hashes = [xxhash.xxh64_intdigest(joined[x:y], SEED) for x, y in zip(starts[a : a + (1 << 16)], stops[a : a + (1 << 16)], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """The rows with their fingerprint as a (signed) long."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables:
            marks = np.array([fingerprint(x.as_py(), shingle) for x in t.column(text_col)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*t.columns, pa.array(marks.view(np.int64))], names=[*t.schema.names, name]
            )

    return docs.mapInArrow(run, schema)


# Links ---------------------------------------------------------------------------------------------------------


def _segments(distance: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each segment."""
    edges = [64 * i // (distance + 1) for i in range(distance + 2)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _segment(marks: np.ndarray, part: tuple[int, int]) -> np.ndarray:
    return (marks >> np.uint64(part[0])) & np.uint64((1 << part[1]) - 1)


def differing_bits(a: np.ndarray) -> np.ndarray:
    low = np.uint64(0xFFFF)
    return sum(_SET[(a >> np.uint64(s)) & low].astype(np.int64) for s in (0, 16, 32, 48))


def _keys(marks: np.ndarray, start: int, segments: list) -> np.ndarray:
    second = segments[(start + 1) % len(segments)]
    key = (_segment(marks, segments[start]) << np.uint64(second[1])) | _segment(marks, second)
    return p.mixed(key + np.uint64(0x9E3779B97F4A7C15 * (start + 1) % 2**64))


def _variants(marks: np.ndarray, start: int, segments: list) -> Iterator[np.ndarray]:
    """The fingerprints as they are, and with one bit of the second segment changed."""
    yield marks
    if len(segments) > 1:
        low, width = segments[(start + 1) % len(segments)]
        for bit in range(low, low + width):
            yield marks ^ np.uint64(1 << bit)


def _chains_hold(difference: np.ndarray, start: int, segments: list) -> np.ndarray:
    total, good = np.zeros(len(difference), np.int64), np.ones(len(difference), bool)
    for length in range(1, len(segments) + 1):
        total += differing_bits(_segment(difference, segments[(start + length - 1) % len(segments)]))
        good &= total <= length * (len(segments) - 1) // len(segments)
    return good


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node with the smallest node that the edges connect it with, without those smallest themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        old = root.copy()
        for side in (x, y):
            np.minimum.at(root, root[side], low)
            np.minimum.at(root, side, low)
        root = root[root]
        if (root == old).all():
            break
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def links(marks: DataFrame, distance: int, buckets: int) -> DataFrame:
    """Edges (a, b) that connect what chains of links connect, for distinct fingerprints in column ``mark``.

    A bucket joins its links to a forest before it returns them, so a dense group of n fingerprints returns fewer
    than n edges, not all its pairs.  A key's fingerprints share all bits of two segments; pairs are made in blocks.
    """
    segments = _segments(distance)

    def send(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables:
            own = t.column("mark").to_numpy().view(np.uint64)
            mark, kind, bucket = [], [], []
            for start in range(len(segments)):
                for v, variant in enumerate(_variants(own, start, segments)):
                    key = _keys(variant, start, segments)
                    for role in (0, 1) if v == 0 else (1,):  # 0: is found, 1: looks for others
                        mark.append(own)
                        kind.append(np.full(len(own), start * 256 + role * 128 + v, np.uint16))
                        bucket.append((key % np.uint64(buckets)).astype(np.int64))
            out = p.by_bucket(0, np.concatenate(bucket), np.concatenate(mark), np.concatenate(kind))
            yield from out.select(["bucket", "payload"]).to_batches()

    def meet(table: pa.Table) -> pa.Table:
        (mark, kind), _ = p.gathered(table, np.uint64, np.uint16)
        found_a, found_b = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        for start in range(len(segments)):
            rows = np.flatnonzero(kind >> 8 == start)
            m, k = mark[rows], kind[rows] & 255
            there = m[k < 128]
            there_keys = _keys(there, start, segments)
            order = np.argsort(there_keys)
            there, there_keys = there[order], there_keys[order]
            looking, flips = m[k >= 128], k[k >= 128] - 128
            low = np.uint64(segments[(start + 1) % len(segments)][0])
            flip = np.where(flips > 0, np.uint64(1) << (low + np.maximum(flips, 1).astype(np.uint64) - np.uint64(1)), np.uint64(0))
            keys = _keys(looking ^ flip, start, segments)
            first = np.searchsorted(there_keys, keys, "left")
            counts = np.searchsorted(there_keys, keys, "right") - first
            ends = np.cumsum(counts)
            at = 0
            while at < len(counts):
                done = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
                n = counts[at:to]
                a, b = np.repeat(looking[at:to], n), there[p.ranges(first[at:to], n)]
                a, b = a[a < b], b[a < b]
                good = _chains_hold(a ^ b, start, segments)
                good[good] = differing_bits(a[good] ^ b[good]) <= distance
                found_a, found_b = np.r_[found_a, a[good]], np.r_[found_b, b[good]]
                if len(found_a) > PAIRS:
                    found_a, found_b = _forest(found_a, found_b)
                at = to
        a, b = _forest(found_a, found_b)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return (
        marks.select("mark")
        .mapInArrow(send, "bucket int, payload binary")
        .groupBy("bucket")
        .applyInArrow(meet, "a long, b long")
    )


def components_of(marked: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """For a written table of ``doc_id`` and ``mark``: each mark with its component's smallest mark and smallest doc_id."""
    buckets = max(1, -(-marked.count() // PER_BUCKET))
    marks = write_through(marked.groupBy("mark").agg(F.min("doc_id").alias("first")), "marks")
    roots = component_roots(links(marks, distance, buckets))
    rooted = marks.join(roots.withColumnRenamed("a", "mark"), "mark", "left").select(
        "mark", "first", F.coalesce("b", "mark").alias("root")
    )
    rooted = write_through(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return write_through(rooted.join(write_through(least, "least"), "root").select("mark", "root", "component_id"), "components")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """Every row's id, fingerprint (16 lowercase hex digits) and component_id.

    Texts are lower-cased (A-Z) and cut into words ``[^\\x20\\x09-\\x0D]+``; shingles of ``shingle`` words, repeats
    included, are hashed with XXH64 (seed 42).  A text with fewer words is one shingle; a text without words, or a
    null, has fingerprint zero, linked like any other.  Fingerprints link at ``distance`` differing bits or fewer;
    the component is the smallest id reachable by links (nulls are left out; null if there is no other).  Equal texts
    share a fingerprint; every row returns once.  An empty table gives an empty result.  Other columns are ignored.
    """
    marked = with_fingerprint(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")),
        "text",
        "mark",
        shingle,
    ).select("doc_id", "mark")
    marked = write_through(marked, "fingerprints")
    return marked.join(components_of(marked, distance), "mark").select(
        F.col("doc_id").alias(id_col),
        F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: that of the smallest id, of equal ids that of the smallest fingerprint.

    Where no row of a component has an id, one of the smallest fingerprint and text hash stays.
    """
    mark, key = "_fingerprint_of_text", "_hash_of_text"
    whole = with_fingerprint(docs, text_col, mark).withColumn(key, F.xxhash64(F.col(text_col).cast("string")))
    marked = write_through(whole.select(F.col(id_col).alias("doc_id"), F.col(mark).alias("mark"), key), "fingerprints")
    components = components_of(marked.select("doc_id", "mark"))
    first = marked.join(components, "mark").filter("doc_id <=> component_id")
    first = first.groupBy("root", "doc_id").agg(F.min(F.struct("mark", key)).alias("least")).select("doc_id", "least.*")
    same = whole[id_col].eqNullSafe(first["doc_id"]) & (whole[mark] == first["mark"]) & (whole[key] == first[key])
    return whole.join(first, same, "left_semi").dropDuplicates([id_col, mark, key]).drop(mark, key)
