"""Quality rules: base rules, then robust multivariate outliers for each language and source.

Every text becomes a vector of four transformed statistics.  For each group of equal language and source the
minimum-covariance-determinant estimate is sought by concentration steps, as Spark aggregates over all its rows that
pass the base rules: rank rows by Mahalanobis distance, take the closest half, estimate again, until no determinant
falls.  Two starts (all rows; median and deviation) are taken, and after three steps the estimate of smaller
determinant goes on alone.  It is scaled to normal rows, and estimated once more from all rows that lie near it.
Equal texts count once, so copies of one text cannot become the majority; every row is judged.  Near copies may be a
third of a group that spreads about as wide as FLOORS; in wider groups so many near copies can have the smaller
determinant, as in every such estimate.  Distances are ranked in fixed bins, the last of which counts by the share
that completes the half; the statistics are whole numbers of ten-thousandths, so sums are exact and reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_through
from . import packed as p

SPAN = 8  # words of a repeated window
LEAST_WORDS = 20
REPEATED = 30  # percent of the words
BOTH = 3  # steps of both starts
FALL, STEPS = 1e-3, 30  # steps end when no logarithm of a determinant falls by more; thirty at most
NEAR = 0.975  # of normal rows lie within the distance up to which rows enter the last estimate
UNIT = 10_000
BINS = 64  # for each doubling of the squared distance
GROUPS_A_FILE = 10_000  # of estimates: few files, so that Spark sees how small they are and broadcasts them
#: Standard deviations below which no estimate falls, in the order of VECTOR: in units of them, no direction's deviation
#: is less than one.  They keep the estimate regular where nearly all rows agree (most texts have no symbol), and say
#: which differences are too small to matter.  The last two have ranges of 0 to 1 and (after the base rules) 0 to 0.3.
FLOORS = (0.12, 0.20, 0.10, 0.05)
CUTOFF = 18.467  # squared Mahalanobis distance: 0.999 of the chi-square distribution of four degrees
VECTOR = ("v0", "v1", "v2", "v3")
SYMBOLS = b"#*$%&|<>"

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def text_statistics(texts: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    """STATISTICS of whole texts; a null text is empty."""
    data, offsets = p.text_buffer(pa.chunked_array([texts]) if isinstance(texts, pa.Array) else texts)
    starts, ends, first = p.words_of(data, offsets)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(n_words)), n_words)

    symbol, char = np.zeros(256, bool), ((np.arange(256) & 0xC0) != 0x80) & ~p._SEPARATOR
    symbol[list(SYMBOLS)] = True

    def total(kind: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(kind[data])][offsets])

    at = np.flatnonzero(np.arange(len(row)) + SPAN <= first[1:][row])
    keys = p.span_hashes(p.word_hashes(data, starts, ends), at, at + SPAN)
    order = np.lexsort((keys, row[at]))
    same = (keys[order][1:] == keys[order][:-1]) & (row[at][order][1:] == row[at][order][:-1])
    twice = at[order[np.r_[False, same] | np.r_[same, False]]] if len(at) else at
    cover = np.zeros(len(row) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + SPAN, -1)
    repeated = np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=len(n_words))

    n_lines, n_dup = np.zeros(len(n_words), np.int64), np.zeros(len(n_words), np.int64)
    whole = data.tobytes()
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        lines = [x for x in whole[a:b].split(b"\n") if x.strip()]
        n_lines[i], n_dup[i] = len(lines), len(lines) - len(set(lines))
    return [n_words, total(char), total(symbol), n_dup, repeated, n_lines]


def with_statistics(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and STATISTICS."""
    kept = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([*kept.schema.fields[:-1], *(T.StructField(s, T.LongType()) for s in STATISTICS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (step for whole in batches for step in p.in_steps(whole, whole.num_columns - 1)):
            values = [pa.array(np.asarray(x, np.int64)) for x in text_statistics(b.column(b.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *values], names=schema.names)

    return kept.mapInArrow(run, schema)


# Estimates -----------------------------------------------------------------------------------------------------


def _vector() -> list[Column]:
    """Ratios are taken over a little more than the text, so that a few words cannot make an extreme one."""
    words = F.col("n_words") + 20
    values = [
        F.log((F.col("word_chars") + 100) / words),
        F.log1p(10 * F.col("n_symbols") / words),
        F.col("n_dup_lines") / (F.col("n_lines") + 2),
        F.col("n_repeat_words") / words,
    ]
    return [F.round(x * UNIT).cast("long").alias(v) for x, v in zip(values, VECTOR, strict=True)]


def _group(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def _sums() -> list[Column]:
    pairs = [(i, j) for i in range(4) for j in range(i, 4)]
    return [
        F.count("*").alias("n"),
        *(F.sum(F.col(v).cast("decimal(20,0)")).alias(f"s{i}") for i, v in enumerate(VECTOR)),
        *(F.sum((F.col(VECTOR[i]) * F.col(VECTOR[j])).cast("decimal(20,0)")).alias(f"s{i}{j}") for i, j in pairs),
    ]


def _within(x: np.ndarray, more: int = 0) -> np.ndarray:
    """The chi-square distribution of four degrees (six with ``more`` = 1) up to ``x``."""
    return 1 - np.exp(-x / 2) * (1 + x / 2 + more * x * x / 8)


def _chi_square(share: np.ndarray | float) -> np.ndarray:
    """Quantiles of the chi-square distribution of four degrees."""
    low, high = np.zeros(np.shape(share)), np.full(np.shape(share), 200.0)
    for _ in range(100):
        middle = (low + high) / 2
        less = _within(middle) < share
        low, high = np.where(less, middle, low), np.where(less, high, middle)
    return (low + high) / 2


def _to_normal(share: np.ndarray) -> np.ndarray:
    """What the covariance of the ``share`` of normal rows nearest to their centre is multiplied with."""
    return share / _within(_chi_square(share), 1)


_SUM_NAMES = ["n", *(f"s{i}" for i in range(4)), *(f"s{i}{j}" for i in range(4) for j in range(i, 4))]
_ESTIMATE = (
    "lang_key string, source_key string, start int, det double, "
    + ", ".join(f"m{i} double" for i in range(4))
    + ", "
    + ", ".join(f"w{i}{j} double" for i in range(4) for j in range(i, 4))
)


def _inverted(pdf: pd.DataFrame, centres: np.ndarray, covariances: np.ndarray) -> pd.DataFrame:
    out = pdf[["lang_key", "source_key", "start"]].copy()
    floors = np.array(FLOORS) * UNIT
    sizes, axes = np.linalg.eigh(covariances / np.outer(floors, floors))
    covariances = np.einsum("nij,nj,nkj->nik", axes, np.maximum(sizes, 1), axes) * np.outer(floors, floors)
    inverse = np.linalg.inv(covariances) if len(out) else covariances
    out["det"] = np.linalg.slogdet(covariances)[1] if len(out) else []
    for i in range(4):
        out[f"m{i}"] = centres[:, i]
    for i in range(4):
        for j in range(i, 4):
            out[f"w{i}{j}"] = inverse[:, i, j]
    return out


def _from_sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``share`` of the normal rows are in the sums.  Of the sums named e_, ``taken`` rows' worth is added."""
    for pdf in frames:
        sums = {c: pdf[c].astype(float).to_numpy() for c in _SUM_NAMES}
        if "taken" in pdf:
            part = pdf["taken"].astype(float).to_numpy() / pdf["e_n"].astype(float).to_numpy()
            sums = {c: x + part * pdf[f"e_{c}"].astype(float).to_numpy() for c, x in sums.items()}
        n = sums["n"]
        centre = np.stack([sums[f"s{i}"] / n for i in range(4)], axis=1)
        cov = np.zeros((len(pdf), 4, 4))
        for i in range(4):
            for j in range(i, 4):
                cov[:, i, j] = cov[:, j, i] = sums[f"s{i}{j}"] / n - centre[:, i] * centre[:, j]
        yield _inverted(pdf, centre, cov * _to_normal(pdf["share"].to_numpy(float))[:, None, None])


def _from_medians(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        centre = np.stack([pdf[f"m{i}"].to_numpy(float) for i in range(4)], axis=1)
        spread = np.stack([pdf[f"d{i}"].to_numpy(float) * 1.4826 for i in range(4)], axis=1)
        yield _inverted(pdf, centre, np.einsum("ij,jk->ijk", np.square(spread), np.eye(4)))


def _quantile(counted: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """The first of each group's counted values up to which ``share`` of its rows lie."""
    w = Window.partitionBy(*keys)
    return (
        counted.withColumn("_upto", F.sum("n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_all", F.sum("n").over(w))
        .filter(F.col("_upto") >= F.ceil(F.col("_all") * share))
        .groupBy(*keys)
        .agg(F.min(value).alias(value))
    )


def _medians(rows: DataFrame) -> DataFrame:
    """Median and median deviation of each component, in hundredths: a group has few distinct values of them."""
    keys, step = ["lang_key", "source_key", "axis"], UNIT // 100
    long = rows.select("lang_key", "source_key", F.posexplode(F.array(*VECTOR)).alias("axis", "x")).withColumn(
        "x", F.floor(F.col("x") / step) * step
    )
    counted = write_through(long.groupBy(*keys, "x").agg(F.count("*").alias("n")), "values")
    middle = write_through(_quantile(counted, keys, "x", 0.5).withColumnRenamed("x", "m"), "medians")
    away = counted.join(middle, keys).withColumn("d", F.abs(F.col("x") - F.col("m")))
    spread = _quantile(away.groupBy(*keys, "d").agg(F.sum("n").alias("n")), keys, "d", 0.5)
    both = middle.join(spread, keys)
    picked = [F.max(F.when(F.col("axis") == i, F.col(c))).cast("double").alias(f"{c}{i}") for c in "md" for i in range(4)]
    return both.groupBy("lang_key", "source_key").agg(*picked).withColumn("start", F.lit(1))


def _distance(prefix: str = "") -> Column:
    away = [F.col(v) - F.col(f"m{i}") for i, v in enumerate(VECTOR)]
    terms = [away[i] * away[j] * F.col(f"w{i}{j}") * (1 if i == j else 2) for i in range(4) for j in range(i, 4)]
    return reduce(lambda a, b: a + b, terms)


def estimates(rows: DataFrame) -> DataFrame:
    """The estimate of each group of ``rows`` (lang_key, source_key and VECTOR)."""
    groups = ["lang_key", "source_key"]
    every = write_through(rows.groupBy(*groups).agg(*_sums()), "groups")
    files = 1 + every.count() // GROUPS_A_FILE

    def stored(estimate: DataFrame) -> DataFrame:
        return write_through(estimate.repartition(files), "estimates")

    every = every.withColumns({"start": F.lit(0), "share": F.lit(1.0)})
    now = stored(every.mapInPandas(_from_sums, _ESTIMATE).union(_medians(rows).mapInPandas(_from_medians, _ESTIMATE)))
    for step in range(STEPS):
        bins = F.floor(F.log2(1 + F.greatest(_distance(), F.lit(0.0))) * BINS).alias("bin")
        counted = rows.join(now, groups).groupBy(*groups, "start", bins).agg(*_sums())
        w = Window.partitionBy(*groups, "start")
        half = F.least("_all", F.floor((F.col("_all") + len(VECTOR) + 1) / 2))
        near = (
            counted.withColumn("_below", F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("_all", F.sum("n").over(w))
            .withColumn("_taken", half - F.coalesce("_below", F.lit(0)))
            .filter("_taken > 0")
        )
        last = F.col("_taken") <= F.col("n")
        subset = near.groupBy(*groups, "start").agg(
            *(F.sum(F.when(last, F.lit(0)).otherwise(F.col(c))).alias(c) for c in _SUM_NAMES),
            *(F.max(F.when(last, F.col(c))).alias(f"e_{c}") for c in _SUM_NAMES),
            F.max(F.when(last, F.col("_taken"))).alias("taken"),
            F.first(half / F.col("_all")).alias("share"),
        )
        before = now.select(*groups, "start", F.col("det").alias("_det"))
        now = stored(subset.mapInPandas(_from_sums, _ESTIMATE))
        if step + 1 == BOTH:
            best = Window.partitionBy(*groups).orderBy("det", "start")
            now = stored(now.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r"))
        elif step >= BOTH and now.join(before, [*groups, "start"]).filter(F.col("det") < F.col("_det") - FALL).isEmpty():
            break
    close = rows.join(now, groups).filter(_distance() <= float(_chi_square(NEAR)))
    again = close.groupBy(*groups).agg(*_sums()).withColumns({"start": F.lit(0), "share": F.lit(NEAR)})
    return stored(again.mapInPandas(_from_sums, _ESTIMATE))


def judged(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    keep: tuple[str, ...] = ("doc_id",),
    cutoff: float = CUTOFF,
) -> DataFrame:
    """The ``keep`` columns of every row, its STATISTICS, base_failed, distance (squared Mahalanobis) and kept.

    Words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has none and fails the base rules, which reject texts of
    under 20 words and those of which over 30 percent lie in 8-word windows found twice or more.  The distance is
    null for them.  Null languages and sources are groups of their own.  Groups of any size are estimated: the floors
    keep small and uniform ones regular.  Rows are judged one by one, so repeated rows and ids get equal verdicts.
    An empty table gives an empty result.  Other columns are ignored.
    """
    names = [f"_k{i}" for i in range(len(keep))]
    inner = docs.select(
        *(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)),
        _group(lang_col).alias("lang_key"),
        _group(source_col).alias("source_key"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_key"),
        F.col(text_col).alias("_t"),
    )
    rows = with_statistics(inner, "_t", [*names, "lang_key", "source_key", "text_key"])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    rows = write_through(rows.withColumn("base_failed", failed).select("*", *_vector()), "statistics")
    passed = rows.filter("NOT base_failed").select("lang_key", "source_key", "text_key", *VECTOR).distinct()
    found = estimates(write_through(passed.drop("text_key"), "texts")).drop("start", "det")
    out = rows.join(found, ["lang_key", "source_key"], "left").withColumn(
        "distance", F.when(~F.col("base_failed"), _distance())
    )
    return out.select(
        *(F.col(n).alias(c) for c, n in zip(keep, names, strict=True)),
        *STATISTICS,
        "base_failed",
        "distance",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"),
    )
