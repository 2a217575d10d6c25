"""Numpy work on batches of whole texts, and key exchanges between batches.

A batch is the set of documents whose id and text hash to one number, so its size does not depend on sources, groups
of copies, rows without ids or keys.  Batches send keys to buckets, one packed row for each batch and bucket; a key
stands there at most once, so a key that a third of all documents hold costs a bucket one entry for each batch, not
one for each document.  Buckets answer the batches in the same form.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id: later than every other
SHIFT = np.uint64(32)
REST = np.uint64(0xFFFFFFFF)
SMALL_BATCH, LARGE_BATCH, MANY, BATCHES_A_BUCKET = 1 << 20, 16 << 20, 1024, 4

PARTS = "bucket int, batch int, payload binary"
REPLIES = "batch int, bucket int, payload binary"

CACHED = 1 << 15  # bytes that are hashed together, so that hashes stay in a processor's cache
DEALT = 32 << 20  # bytes of text that are dealt over packed batches together
LEVEL = 3  # of zstd

_BYTE = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def batch_counts(df: DataFrame, text: str) -> tuple[int, int]:
    """Batches of about a megabyte of text (beyond a thousand they grow, up to sixteen megabytes), and buckets.

    A bucket serves several batches' worth of keys: the packed rows between them are as many as their product.
    """
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    batches = max(1, min(-(-total // SMALL_BATCH), max(MANY, -(-total // LARGE_BATCH))))
    return batches, -(-batches // BATCHES_A_BUCKET)


def in_batches(df: DataFrame, key: str, text: str, batches: int) -> DataFrame:
    return df.withColumn("batch", F.pmod(F.xxhash64(key, text), F.lit(batches)).cast("int"))


def in_packed_batches(df: DataFrame, key: str, text: str, batches: int) -> DataFrame:
    """As in_batches, but rows (a long and a text) that are read together share a squeezed payload for each batch."""

    def deal(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in (s for b in rows for s in in_steps(b, 2, DEALT)):
            table = pa.Table.from_batches([step]).sort_by("batch")
            keys, (data, offsets) = table[key], text_buffer(table[text])
            ids, known = pc.fill_null(keys, 0).to_numpy(), keys.is_valid().to_numpy()
            sizes, batch = np.diff(offsets), table["batch"].to_numpy()
            edges = np.flatnonzero(np.r_[True, batch[1:] != batch[:-1], True])
            payloads = [
                squeezed(ids[a:z], known[a:z], sizes[a:z], data[offsets[a] : offsets[z]])
                for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch[edges[:-1]]), pa.array(payloads, pa.binary())], names=["batch", "payload"]
            )

    return in_batches(df, key, text, batches).select("batch", key, text).mapInArrow(deal, "batch int, payload binary")


def unpacked_rows(table: pa.Table, key: str = "doc_id", text: str = "text") -> pa.Table:
    """The rows of the payloads that in_packed_batches made; a null text has become empty."""
    kinds = np.int64, bool, np.int64, np.uint8
    rows = [opened(x, *kinds) for x in table["payload"].to_pylist()]
    ids, known, sizes, data = (np.concatenate([np.zeros(0, k), *(r[i] for r in rows)]) for i, k in enumerate(kinds))
    texts = string_array(data, np.r_[0, np.cumsum(sizes)], pa.string())
    return pa.table({key: pa.array(ids, pa.int64(), mask=~known), text: texts})


# Text of a batch -----------------------------------------------------------------------------------------------


def ordered(table: pa.Table, key: str = "doc_id", text: str = "text") -> pa.Table:
    """Rows in an order that does not depend on how they arrived."""
    return table.sort_by([(key, "ascending"), (text, "ascending")])


def ids_of(table: pa.Table, key: str = "doc_id") -> np.ndarray:
    return pc.fill_null(table[key], NO_ID).to_numpy().astype(np.int64)


def text_buffer(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and where each starts; null is empty."""
    texts = pc.fill_null(column, "").combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def in_steps(batch: pa.RecordBatch, text: int, size: int = SMALL_BATCH) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in steps of about a megabyte of text, or ``size``; a longer text is a step of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(lengths), 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - lengths[at] + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def string_array(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(kind, len(offsets) - 1, buffers)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and the number of the first word of each text."""
    inside = np.r_[~_SEPARATOR[data], False]
    before = np.r_[False, inside[:-1]]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge | ~before))
    ends = np.flatnonzero(before & (edge | ~inside))
    return starts, ends, np.searchsorted(starts, offsets)


# Hashes --------------------------------------------------------------------------------------------------------


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(max(n, 1), base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash, modulo 2^64, of each span of a sequence; equal content gives equal hashes anywhere."""
    sums = np.r_[np.uint64(0), np.cumsum(values * _powers(_BASE, len(values))[: len(values)])]
    return (sums[ends] - sums[starts]) * _powers(_INVERSE, len(values) + 1)[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed(span_hashes(_BYTE[data], starts, ends))


def byte_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` bytes that start at each byte, by doubling."""
    total, length, block, width = None, 0, _BYTE[data], 1
    while True:
        if size & 1:
            if total is None:
                total, length = block, width
            else:
                n = max(0, min(len(total), len(block) - length))
                total = total[:n] * np.uint64(pow(_BASE, width, 2**64)) + block[length : length + n]
                length += width
        size >>= 1
        if not size:
            return mixed(total)
        block = block[: max(0, len(block) - width)] * np.uint64(pow(_BASE, width, 2**64)) + block[width:]
        width *= 2


def smallest_in_window(h: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` hashes the place of its smallest, the leftmost of equals.

    Only the upper 40 bits are compared; places take the other 24, so longer sequences are cut into overlapping ones.
    """
    n, step = len(h) - width + 1, (1 << 24) - width
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.empty(n, np.int64)
    for a in range(0, n, step):
        piece = h[a : a + step + width - 1]
        m = (piece & ~np.uint64(0xFFFFFF)) | np.arange(len(piece), dtype=np.uint64)
        size = 1
        while 2 * size <= width:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if size < width:
            m = np.minimum(m[: len(m) - (width - size)], m[width - size :])
        out[a : a + len(m)] = (m & np.uint64(0xFFFFFF)).astype(np.int64) + a
    return out


def anchors_of(data: np.ndarray, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of the smallest hash of ``size`` bytes in the window that starts at each byte, and all such hashes."""
    hashes, anchor = np.zeros(len(data), np.uint64), np.zeros(max(0, len(data) - window + 1), np.int64)
    for a in range(0, len(anchor), CACHED):
        piece = byte_hashes(data[a : a + CACHED + window - 1], size)
        hashes[a : a + len(piece)] = piece
        found = smallest_in_window(piece, window - size + 1)
        anchor[a : a + len(found)] = found + a
    return anchor, hashes


# Exchanges -----------------------------------------------------------------------------------------------------


def by_bucket(batch: int, bucket: np.ndarray, *columns: np.ndarray) -> pa.Table:
    """One row for each bucket: the columns' entries for it, packed one column after the other."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    payloads = [
        b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(first, np.r_[first[1:], len(bucket)], strict=True)
    ]
    return pa.table(
        {
            "bucket": pa.array(bucket[first].astype(np.int32)),
            "batch": pa.array(np.full(len(first), batch, np.int32)),
            "payload": pa.array(payloads, pa.binary()),
        }
    )


def unpacked(payload: bytes, *kinds: type) -> list[np.ndarray]:
    n = len(payload) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        out.append(np.frombuffer(payload, k, n, at))
        at += n * np.dtype(k).itemsize
    return out


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of any lengths, one after the other, in a third to a half less than Spark's own compression leaves."""
    whole = b"".join([np.array([c.nbytes for c in columns], np.int64).tobytes(), *(c.tobytes() for c in columns)])
    return np.int64(len(whole)).tobytes() + pa.Codec("zstd", LEVEL).compress(whole, asbytes=True)


def opened(payload: bytes, *kinds: type) -> list[np.ndarray]:
    whole = pa.Codec("zstd").decompress(payload[8:], int(np.frombuffer(payload, np.int64, 1)[0]), asbytes=True)
    out, at = [], 8 * len(kinds)
    for kind, size in zip(kinds, np.frombuffer(whole, np.int64, len(kinds)).tolist(), strict=True):
        out.append(np.frombuffer(whole, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def gathered(table: pa.Table, *kinds: type) -> tuple[list[np.ndarray], np.ndarray]:
    """All entries of the packed rows of ``table``, and the number of the row that each comes from."""
    rows = [unpacked(p, *kinds) for p in table["payload"].to_pylist()]
    columns = [np.concatenate([r[i] for r in rows]) if rows else np.zeros(0, k) for i, k in enumerate(kinds)]
    return columns, np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])


def split_key(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each key, and the 32 bits that stand for it there."""
    return ((keys >> SHIFT) % np.uint64(buckets)).astype(np.int64), (keys & REST).astype(np.uint32)


def count_part(batch: int, keys: np.ndarray, documents: np.ndarray, buckets: int) -> pa.Table:
    """The distinct keys of a batch with the number of its documents that hold them, 255 at most."""
    order = np.lexsort((documents, keys))
    k, d = keys[order], documents[order]
    new_key = np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, bool)
    new_pair = new_key | np.r_[True, d[1:] != d[:-1]] if len(k) else new_key
    first = np.flatnonzero(new_key)
    counts = np.add.reduceat(new_pair, first) if len(first) else np.zeros(0, np.int64)
    bucket, rest = split_key(k[first], buckets)
    return by_bucket(batch, bucket, rest, np.minimum(counts, 255).astype(np.uint8))


def repeated_keys(often: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Answers each batch with those of its keys that two documents or more hold, and whether ``often`` do."""

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        (rest, counts), row = gathered(table, np.uint32, np.uint8)
        order = np.argsort(rest, kind="stable")
        r = rest[order]
        first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else np.zeros(0, np.int64)
        totals = np.add.reduceat(counts[order].astype(np.int64), first) if len(first) else first
        each = np.empty(len(rest), np.int64)
        each[order] = np.repeat(totals, np.diff(np.r_[first, len(r)]))
        keep = each >= 2
        return answers(key, table, row[keep], rest[keep], (each[keep] >= often).astype(np.uint8))

    return answer


def answers(key: tuple, table: pa.Table, row: np.ndarray, *columns: np.ndarray) -> pa.Table:
    """A packed row for each row of ``table`` that has entries; ``row`` ascends."""
    bounds = np.searchsorted(row, np.arange(table.num_rows + 1))
    used = np.flatnonzero(np.diff(bounds))
    batches = table["batch"].to_numpy()[used].astype(np.int32)
    payloads = [b"".join(c[bounds[i] : bounds[i + 1]].tobytes() for c in columns) for i in used]
    bucket = np.full(len(used), key[0].as_py(), np.int32)
    return pa.table({"batch": pa.array(batches), "bucket": pa.array(bucket), "payload": pa.array(payloads, pa.binary())})


def known(replies: pa.Table, *kinds: type) -> tuple[np.ndarray, list[np.ndarray]]:
    """The answered keys as sorted (bucket, rest) codes, with their other columns."""
    (rest, *others), row = gathered(replies, np.uint32, *kinds)
    bucket = replies["bucket"].to_numpy().astype(np.uint64)[row] if len(row) else np.zeros(0, np.uint64)
    codes = (bucket << SHIFT) | rest.astype(np.uint64)
    order = np.argsort(codes)
    return codes[order], [c[order] for c in others]


def places(codes: np.ndarray, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each key stands among the sorted codes, -1 if it does not."""
    if not len(codes):
        return np.full(len(keys), -1)
    bucket, rest = split_key(keys, buckets)
    wanted = (bucket.astype(np.uint64) << SHIFT) | rest.astype(np.uint64)
    at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where(codes[at] == wanted, at, -1)
