"""Substring deduplication over words, by level-wise doubling.

A repeated window of 50 words consists of repeated windows of 25, and those of repeated windows of 13.  So shorter
windows are counted first, and only where they repeat across documents are they extended to twice the length:

- 13 words: each 50-word window names its smallest 13-word hash, which depends on the window's words alone; equal
  windows name equal hashes, and neighbours mostly name the same, so few are counted;
- 25 words: counted at both halves of the windows whose named hash repeats;
- 50 words: windows with two repeated halves meet with the smallest doc_id that holds them.

With other window lengths the levels are the halves, rounded up, while they have eight words or more.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed as p

WINDOW = 50
LEAST = 8
SECOND = np.uint64(0xD6E8FEB86659FD93)


class _Words:
    """The words of a batch and the hashes of their windows."""

    def __init__(self, table: pa.Table, window: int):
        self.table = p.ordered(table)
        self.ids = p.ids_of(self.table)
        self.data, self.offsets = p.text_buffer(self.table["text"])
        self.starts, self.ends, self.first = p.words_of(self.data, self.offsets)
        self.hashes = p.word_hashes(self.data, self.starts, self.ends)
        self.row = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        self.window = window

    def fits(self, size: int) -> np.ndarray:
        """The words that a window of ``size`` words of one text starts at."""
        return np.flatnonzero(np.arange(len(self.row)) + size <= self.first[1:][self.row])

    def hash_at(self, at: np.ndarray, size: int, seed: np.uint64 = np.uint64(0)) -> np.ndarray:
        return p.mixed(p.span_hashes(p.mixed(self.hashes ^ seed) if seed else self.hashes, at, at + size))

    def anchors(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Each whole window's start, and the place of the smallest hash of ``size`` words in it."""
        whole = self.fits(self.window)
        every = np.arange(max(0, len(self.row) - size + 1))
        named = p.smallest_in_window(self.hash_at(every, size), self.window - size + 1)
        return whole, named[whole]


def levels(window: int) -> list[int]:
    out = [window]
    while -(-out[0] // 2) >= LEAST:
        out.insert(0, -(-out[0] // 2))
    return out


def _batch(key: tuple) -> int:
    return key[0].as_py()


def _nothing(schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.table({c.split()[0]: pa.array([], kinds[c.split()[1]]) for c in schema.split(", ")})


def _smallest_holder(key: tuple, table: pa.Table) -> pa.Table:
    """The smallest doc_id of every key that several documents hold, for the batches that hold a later one."""
    (keys, ids, several), row = p.gathered(table, np.uint64, np.int64, np.uint8)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    least = np.empty(len(keys), np.int64)
    smallest = np.minimum.reduceat(ids[order], first) if len(first) else first
    least[order] = np.repeat(smallest, np.diff(np.r_[first, len(k)]))
    keep = (least < ids) | (several > 0)
    return p.answers(key, table, row[keep], keys[keep], least[keep])


def remove_repeated_windows(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Remove every word covered by a ``window`` of words that also starts in a document with a smaller id.

    Words are ``[^\\x20\\x09-\\x0D]+``.  Returns id, the ``carry`` columns, n_words, n_removed and kept (the kept
    words joined by one space).  A null text has no words; texts shorter than the window lose nothing.  A null id
    counts as later than every other.  Rows with equal ids never remove each other's words; every row returns once.
    An empty table gives an empty result.  Columns that are not named are ignored, so their names cannot clash.
    """
    sizes = levels(window)
    chosen = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    kept_columns = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    batches, buckets = p.batch_counts(docs, text_col)
    texts = p.in_batches(docs.select(*chosen), "doc_id", "text", batches)
    whole = p.in_batches(docs.select(*chosen, *kept_columns), "doc_id", "text", batches) if carry else texts

    def anchors(key, table):
        words = _Words(table, window)
        _, named = words.anchors(sizes[0])
        named = np.unique(named)
        return p.count_part(_batch(key), words.hash_at(named, sizes[0]), words.ids[words.row[named]], buckets)

    def halves(size, below):
        """Counts windows of ``size`` words wherever what lies below them repeats."""

        def count(key, left, right):
            if not left.num_rows or not right.num_rows:
                return _nothing(p.PARTS)
            words = _Words(left, window)
            at = survivors(words, right, size, below)
            return p.count_part(_batch(key), words.hash_at(at, size), words.ids[words.row[at]], buckets)

        return count

    def survivors(words, replies, size, below):
        """Starts of windows of ``size`` words whose parts of ``below`` words all repeat."""
        codes, _ = p.known(replies, np.uint8)
        if below == sizes[0]:
            starts, named = words.anchors(below)
            distinct, which = np.unique(named, return_inverse=True)
            found = p.places(codes, words.hash_at(distinct, below), buckets) >= 0
            starts = starts[found[which]]
            if size == window:
                return starts
            return np.unique(np.concatenate([starts + x for x in _parts(window, size)]))
        at = words.fits(below)
        repeats = np.zeros(len(words.row) + 1, bool)
        repeats[at] = p.places(codes, words.hash_at(at, below), buckets) >= 0
        longer = words.fits(size)
        return longer[repeats[longer] & repeats[longer + size - below]]

    def holders(key, left, right):
        if not left.num_rows or not right.num_rows:
            return _nothing(p.PARTS)
        words = _Words(left, window)
        at = survivors(words, right, window, sizes[-2] if len(sizes) > 1 else window)
        keys, ids = words.hash_at(at, window), words.ids[words.row[at]]
        places = p.split_key(words.hash_at(at, window, SECOND), buckets)[0]
        order = np.lexsort((ids, keys))
        k, d = keys[order], ids[order]
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
        last = np.r_[first[1:], len(k)] - 1 if len(k) else first
        return p.by_bucket(_batch(key), places[order][first], k[first], d[first], (d[first] < d[last]).astype(np.uint8))

    def cut(left, right):
        words = _Words(left, window)
        (keys, least), _ = p.gathered(right, np.uint64, np.int64)
        order = np.argsort(keys)
        keys, least = keys[order], least[order]
        at = words.fits(window)
        if len(keys) and len(at):
            h = words.hash_at(at, window)
            found = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            at = at[(keys[found] == h) & (least[found] < words.ids[words.row[at]])]
        else:
            at = at[:0]
        cover = np.zeros(len(words.row) + 1, np.int32)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + window, -1)
        return _kept(words, np.cumsum(cover[:-1]) == 0, len(carry))

    parts = texts.groupBy("batch").applyInArrow(anchors, p.PARTS)
    for below, size in zip(sizes[:-1], sizes[1:], strict=True):
        replies = parts.groupBy("bucket").applyInArrow(p.repeated_keys(1 << 62), p.REPLIES)
        step = holders if size == window else halves(size, below)
        parts = texts.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(_keyed(step), p.PARTS)
    if len(sizes) == 1:
        replies = parts.groupBy("bucket").applyInArrow(p.repeated_keys(1 << 62), p.REPLIES)
        parts = texts.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(_keyed(holders), p.PARTS)
    replies = parts.groupBy("bucket").applyInArrow(_smallest_holder, p.REPLIES)

    types = dict(whole.dtypes)
    carried = "".join(f", carry_{i} {types[f'carry_{i}']}" for i in range(len(carry)))
    out = whole.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(
        cut, f"doc_id long, n_words long, n_removed long, kept string{carried}"
    )
    return reduce(lambda df, x: df.withColumnRenamed(f"carry_{x[0]}", x[1]), enumerate(carry), out).withColumnRenamed(
        "doc_id", id_col
    )


def _parts(window: int, size: int) -> range:
    """Where windows of ``size`` words start in a longer one so that each level above finds both its halves."""
    return range(0, window - size + 1) if window > 2 * size else (0, window - size)


def _keyed(step):
    """Cogrouped functions take their key first; a group of one side only still has it."""

    def call(key, left, right):
        return step(key, left, right)

    return call


def _kept(words: _Words, keep: np.ndarray, carried: int) -> pa.Table:
    """A row for each text, with its kept words joined by one space."""
    counts = np.diff(words.first)
    row = words.row[keep]
    lengths = (words.ends - words.starts)[keep]
    last = np.r_[row[1:] != row[:-1], True] if len(row) else np.zeros(0, bool)
    sizes = lengths + ~last
    at = np.cumsum(sizes) - sizes
    data = np.full(int(sizes.sum()), 0x20, np.uint8)
    data[p.ranges(at, lengths)] = words.data[p.ranges(words.starts[keep], lengths)]
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.add.at(offsets, row + 1, sizes)
    out = {
        "doc_id": words.table["doc_id"],
        "n_words": pa.array(counts.astype(np.int64)),
        "n_removed": pa.array(counts - np.bincount(row, minlength=len(counts)).astype(np.int64)),
        "kept": p.string_array(data, np.cumsum(offsets), pa.string()),
    }
    return pa.table(out | {f"carry_{i}": words.table[f"carry_{i}"] for i in range(carried)})
