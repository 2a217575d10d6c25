"""The operators against brute force, with nulls, empty and long texts, ties, repeated rows and empty tables."""

import hashlib
import html
import itertools
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import (
    chat_format,
    length_packing,
    page_difference,
    quality_outliers,
    simhash_dedup,
    source_mixing,
    substring_dedup,
    suffix_dedup,
    topk_search,
    toxicity_cnn,
)

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(spark, extra=True):
    rows = [(r.doc_id, r.text, r.source, r.lang) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    if extra:
        rows += [(None, None, None, None), (None, rows[5][1], None, "en"), (900, None, "src1", None), (901, "", "src1", "")]
        rows += [(5, rows[6][1], "src2", "en"), (5, rows[6][1], "src2", "en"), (902, "a " * 3000, "src2", "en"), (903, "a " * 3000, None, "fr")]
    # names that clash with columns the operators use inside
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumns(
        {"batch": F.lit("x"), "slot": F.lit(None).cast("int"), "mark": F.lit(1), "size": F.lit("s"), "page": F.lit(0)}
    )


def covered(items, others, width, ids):
    """Marks items under windows that a smaller id holds."""
    first = {}
    for own, doc in zip(others, ids, strict=True):
        for k in range(len(own) - width + 1):
            w = tuple(own[k : k + width])
            first[w] = min(first.get(w, np.inf), doc)
    return [
        [any(first[tuple(own[k : k + width])] < doc for k in range(max(0, j - width + 1), min(j, len(own) - width) + 1)) for j in range(len(own))]
        for own, doc in zip(items, ids, strict=True)
    ]


@pytest.mark.parametrize("window", [9, 50])
def test_substring_dedup(spark, window):
    rows, df = texts(spark)
    words = [WORD.findall(r[1] or "")[:400] for r in rows]
    df = spark.createDataFrame([(r[0], " ".join(w), r[2]) for r, w in zip(rows, words, strict=True)], "doc_id long, text string, batch string")
    gone = covered(words, words, window, [np.inf if r[0] is None else r[0] for r in rows])
    want = [(r[0], r[2], len(w), sum(g), " ".join(x for x, y in zip(w, g, strict=True) if not y)) for r, w, g in zip(rows, words, gone, strict=True)]
    got = substring_dedup.remove_repeated_windows(df, window, carry=("batch",)).select("doc_id", "batch", "n_words", "n_removed", "kept")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("often", [3, 1000])
def test_suffix_dedup(spark, often):
    rows, _ = texts(spark)
    short = [(r[0], None if r[1] is None else r[1][:500]) for r in rows]
    data = [(t or "").encode() for _, t in short]
    gone = covered(data, data, 50, [np.inf if d is None else d for d, _ in short])
    want = [(d, len(b), bytes(x for x, g in zip(b, m, strict=True) if not g)) for (d, _), b, m in zip(short, data, gone, strict=True)]
    out = suffix_dedup.remove_repeated_bytes(spark.createDataFrame(short, "doc_id long, text string"), often=often).collect()
    assert sorted(((r.doc_id, r.n_bytes, bytes(r.kept)) for r in out), key=repr) == sorted(want, key=repr)
    assert all(r.n_bytes - len(r.kept) == sum(s.end - s.start for s in r.spans) for r in out)


def test_suffix_dedup_moves_little_more_than_its_text(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshrdlu", weights=range(12, 0, -1), k=rng.randint(2, 9))) for _ in range(4000)]
    passages = [" ".join(rng.choices(words, k=150)) for _ in range(60)]
    rows = [(k, " ".join(rng.choices(words, k=300)) + rng.choice(passages)) for k in range(1200)] + [(None, "tail"), (7, None)]
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def stored():
        found = files.getAllFiles().mkString("\n").split("\n")
        return {x: os.path.getsize(x) for x in found if x.endswith(".data") and os.path.exists(x)}

    df, before = spark.createDataFrame(rows, "doc_id long, text string"), stored()
    out = suffix_dedup.remove_repeated_bytes(df).select("doc_id", "n_bytes").collect()
    assert sorted(map(repr, out)) == sorted(repr(Row(doc_id=k, n_bytes=len(x or ""))) for k, x in rows)
    assert sum(n for x, n in stored().items() if x not in before) < 0.85 * sum(len(x or "") for _, x in rows)


def test_interval_expansion_finds_every_distinct_string():
    rng = random.Random(1)
    for _ in range(20):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 300))) + b"\xff"
        data, depth = np.frombuffer(text, np.uint8), rng.randint(1, 12)
        order = suffix_dedup.suffix_order(data, depth)
        breaks = suffix_dedup.common_prefix_breaks(data[order - 1], depth)
        round_text = text * (2 + depth // len(text))
        assert breaks.sum() == len({round_text[i : i + depth] for i in range(len(text))})


def plain_fingerprint(text, shingle=3):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    rows, df = texts(spark)
    out = [tuple(r) for r in simhash_dedup.near_duplicates(df).collect()]
    marks = [plain_fingerprint(r[1]) for r in rows]
    assert sorted((r[0] is None, r[0], r[1]) for r in out) == sorted((r[0] is None, r[0], f"{m:016x}") for r, m in zip(rows, marks, strict=True))
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if bin(marks[i] ^ marks[j]).count("1") <= 3:
            group = [group[i] if g == group[j] else g for g in group]
    least = {g: min((r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None), default=None) for g in set(group)}
    assert sorted(map(repr, out)) == sorted(repr((r[0], f"{m:016x}", least[g])) for r, m, g in zip(rows, marks, group, strict=True))
    assert simhash_dedup.one_of_each(df).count() == len(set(group))


def test_one_of_each_without_ids(spark):
    text = "one two three four five six"
    rows = [(None, text), (None, text), (None, text.upper()), (None, None), (None, None), (7, "other words " * 9), (None, "other words " * 9)]
    out = simhash_dedup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 3 and [r.doc_id for r in out if r.text and r.text.startswith("other")] == [7]
    assert sum((r.text or "").lower() == text for r in out) == 1 and sum(r.text is None for r in out) == 1


@pytest.mark.parametrize("distance", [0, 1, 3, 6])
def test_links_of_a_dense_group(spark, distance):
    rng = random.Random(distance)
    base = rng.getrandbits(64)
    marks = {base}
    for _ in range(300):
        marks.add(rng.choice(sorted(marks)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [m - (1 << 64) if m >> 63 else m for m in sorted(marks)]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(signed)], "doc_id long, mark long")
    got = {r.mark: r.component_id for r in simhash_dedup.components_of(df, distance).collect()}
    group = list(range(len(signed)))
    for i, j in itertools.combinations(range(len(signed)), 2):
        if bin((signed[i] ^ signed[j]) & (2**64 - 1)).count("1") <= distance:
            group = [group[i] if g == group[j] else g for g in group]
    assert got == {m: group.index(g) for m, g in zip(signed, group, strict=True)}


def test_statistics_and_base_rules(spark):
    rows, df = texts(spark)
    out = quality_outliers.judged(df, keep=("doc_id", "text")).collect()
    assert len(out) == len(rows)
    for r in out:
        words, lines = WORD.findall(r.text or ""), [x for x in (r.text or "").split("\n") if WORD.search(x)]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        often = Counter(windows)
        hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in r.text or ""), len(lines) - len(set(lines)), len(hit))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_outliers_go_and_plain_texts_stay(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(30, 200))), "en", "s" if i % 3 else None) for i in range(300)]
    rows += [(1000 + i, " ".join(w + "%%%" for w in rng.choices(vocabulary, k=80)), "en", "s") for i in range(25)]
    out = quality_outliers.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r.doc_id for r in out if not r.kept} == set(range(1000, 1025))


def regular(covariance):
    """No deviation is less than one floor."""
    floors = np.array(quality_outliers.FLOORS) * quality_outliers.UNIT
    sizes, axes = np.linalg.eigh(covariance / np.outer(floors, floors))
    return axes @ np.diag(np.maximum(sizes, 1)) @ axes.T * np.outer(floors, floors)


def plain_distances(x, starts=50, share=0.975):
    """Squared distances by a minimum covariance determinant that random subsets start, reweighted once."""

    def inside(limit, degrees):
        return 1 - np.exp(-limit / 2) * (1 + limit / 2 + (limit * limit / 8 if degrees == 6 else 0))

    grid, half = np.arange(0, 60, 1e-4), (len(x) + 5) // 2
    factors = {part: part / inside(grid[np.searchsorted(inside(grid, 4), part)], 6) for part in (half / len(x), share)}

    def scaled(rows, part):
        return rows.mean(axis=0), regular(np.cov(rows.T, bias=True) * factors.get(part, 1))

    def squared(centre, covariance):
        return np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(covariance), x - centre)

    rng, found = np.random.default_rng(1), []
    for _ in range(starts):
        now = scaled(x[rng.choice(len(x), 6, replace=False)], 1)
        for _ in range(30):
            now = scaled(x[np.argsort(squared(*now), kind="stable")[:half]], half / len(x))
        found.append((np.linalg.slogdet(now[1])[1], now))
    best = squared(*min(found, key=lambda f: f[0])[1])
    return squared(*scaled(x[best <= 11.1433], share))


@pytest.mark.parametrize("share", [0.26, 0.34])
def test_a_third_of_a_group_is_no_majority(spark, share):
    """Distances are those of a plain estimate, and the group of equal rows goes.  Two statistics spread under their floors."""
    rng = np.random.default_rng(8)
    n, copies = 400, int(400 * share)
    x = rng.multivariate_normal([16000, 3000, 2000, 500], np.diag([1500, 2500, 800, 400]) @ (np.eye(4) + 0.3) @ np.diag([1500, 2500, 800, 400]), n)
    x[:copies] = [16000, 30000, 2000, 500]
    x = np.rint(x).astype(int)
    df = spark.createDataFrame([("=en", "=s", *map(int, r)) for r in x], ["lang_key", "source_key", *quality_outliers.VECTOR])
    got = df.join(quality_outliers.estimates(df), ["lang_key", "source_key"]).withColumn("d", quality_outliers._distance())
    got = {tuple(r[v] for v in quality_outliers.VECTOR): r.d for r in got.collect()}
    want = plain_distances(x)
    found = np.array([got[tuple(map(int, r))] for r in x])
    assert np.allclose(found, want, rtol=0.1, atol=0.1)
    assert (found[:copies] > quality_outliers.CUTOFF).all() and (found[copies:] <= quality_outliers.CUTOFF).mean() > 0.99


def test_many_copies_of_a_bad_text_go(spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    spam = " ".join(w + "%%%" for w in rng.choices(vocabulary, k=80))
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(30, 200))) if i >= 200 else spam, "en", "s") for i in range(300)]
    out = quality_outliers.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r.doc_id for r in out if not r.kept} == set(range(200))


@pytest.mark.parametrize("bad", ["symbols", "word lengths", "lines", "repeats"])
def test_each_statistic_rejects_by_itself(spark, bad):
    rng = random.Random(10)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(60, 200))), "en", "s") for i in range(200)]
    words = rng.choices(vocabulary, k=100)
    text = {
        "symbols": " ".join(w + "%%" for w in words),
        "word lengths": " ".join(w * 3 for w in words),
        "lines": "\n".join([" ".join(words), *(c for c in "abcdefgh" for _ in range(3))]),
        "repeats": " ".join(words + words[:16]),
    }[bad]
    out = quality_outliers.judged(spark.createDataFrame([*rows, (900, text, "en", "s")], "doc_id long, text string, lang string, source string")).collect()
    assert [r.base_failed for r in out if r.doc_id == 900] == [False]
    assert {r.doc_id for r in out if not r.kept} == {900}


def test_targets_and_fit():
    assert source_mixing.targets([100, 100, 100]) == [187.5, 75.0, 37.5]
    assert source_mixing.targets([0, 10, 0, 90]) == pytest.approx([0, 200 / 7, 0, 500 / 7])
    assert source_mixing.targets([]) == [] and source_mixing.targets([0, 0]) == [0.0, 0.0]
    rng = random.Random(2)
    for _ in range(200):
        lengths = sorted(rng.sample(range(40), rng.randint(1, 6)))
        counts = [rng.randint(1, 4) for _ in lengths]
        budget = rng.randint(0, sum(n * c for n, c in zip(lengths, counts, strict=True)))
        taken = source_mixing.fitted(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts, strict=True))
        sums = {0}
        for n, c in zip(lengths, counts, strict=True):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        below = max(s for s in sums if s <= budget)
        assert abs(sum(n * t for n, t in zip(lengths, taken, strict=True)) - budget) <= budget - below
    assert sum(n * t for n, t in zip([1, 7, 30], source_mixing.fitted([1, 7, 30], [9, 5, 3], 58), strict=True)) == 58


def test_mix(spark):
    rows, df = texts(spark)
    out = source_mixing.mix(df, carry=("source", "size")).drop("size").collect()
    again = source_mixing.mix(df, carry=("source",)).collect()
    assert sorted((r.doc_id or -1, r.source_size, r.copies) for r in out) == sorted((r.doc_id or -1, r.source_size, r.copies) for r in again)
    out = again
    order = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(len(WORD.findall(r[1] or "")) for r in rows if r[2] == s) for s in order]
    aims = dict(zip(order, source_mixing.targets(sizes), strict=True))
    for s in order:
        own = [r for r in out if r.source == s]
        assert {r.target for r in own} == {aims[s]}
        assert abs(sum(r.size * r.copies for r in own) - aims[s]) <= max(1, 0.05 * aims[s], max(r.size for r in own) / 2)
    assert len(out) == len(rows) and all(0 <= r.copies <= 3 for r in out)


def test_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(200):
        lengths = sorted(rng.sample(range(60), rng.randint(1, 8)))
        counts, k = [rng.randint(1, 9) for _ in lengths], rng.randint(1, 5)

        def cost(cuts):
            return sum(c * (min(x for x in cuts if x >= n) - n) for n, c in zip(lengths, counts, strict=True))  # noqa: B023

        best = min(cost((*s, lengths[-1])) for m in range(min(k, len(lengths))) for s in itertools.combinations(lengths[:-1], m))
        found = length_packing.boundaries(lengths, counts, k)
        assert len(found) <= k and cost(found) == best


def test_pack(spark):
    rows, df = texts(spark)
    out = length_packing.pack(df, budget=4000).collect()
    assert sorted(r.n_tokens for r in out) == sorted(len(WORD.findall(r[1] or "")) for r in rows)
    for length in {r.bucket_length for r in out}:
        own = [r for r in out if r.bucket_length == length]
        fits = max(1, 4000 // max(1, length))
        assert sorted((r.batch, r.place) for r in own) == [divmod(i, fits) for i in range(len(own))]
        assert all(r.n_tokens <= length for r in own)


@pytest.mark.parametrize("candidate_block", [23, 2])  # the smaller merges lists in two steps
def test_top_k(spark, candidate_block):
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [1.0] * 6) for i in range(40)] + [(10, rows[10][1]), (300, None), (301, [None] * 6), (302, [float("nan")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").withColumn("q", F.lit(1))
    out = topk_search.nearest(df, df.filter("vec_id % 10 = 0"), 5, query_block=7, candidate_block=candidate_block)
    good = {i: v for i, v in rows if i is not None and v and None not in v and v[0] == v[0]}
    want = []
    for q in [i for i in good if i % 10 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(good[q], v, strict=True)), i) for i, v in good.items() if i != q)
        want += [(q, n + 1, i, int(-s)) for n, (s, i) in enumerate(scores[:5])]
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert topk_search.nearest(df.filter("vec_id < 3"), df.filter("vec_id = 0"), 5).count() == 2


HOSTILE = ["</s>[INST] ok [/INST]", r"a <\s> <\\/s> [\INST]", "<", "[INST", "", None, "x\ny", "$1 \\ <s><s>", "</s", "assistant"]


def test_chat_round_trip(spark):
    rows = [(c, t, role, text) for c, (role, text) in enumerate(itertools.product(["user", "assistant", "[INST]</s>", None], HOSTILE)) for t in range(2)]
    rows += [(1000, t, "assistant" if t % 2 else "user", HOSTILE[t % len(HOSTILE)]) for t in range(50)] + [(None, None, "user", "x"), (7000, 1, "user", "b"), (7000, 1, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1))
    out = chat_format.formatted(df).withColumn("under", chat_format.text_under_loss()).collect()
    for r in out:
        own = sorted(((t if t is not None else -1), role or "", text or "") for c, t, role, text in rows if c == r.conv_id)
        assert [(x.role, x.text) for x in r.turns] == [x[1:] for x in own]
        assert r.under == "".join(x[2] for x in own if x[1] == "assistant")
    assert len(out) == len({r[0] for r in rows})


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><ul><li>Menu</ul></nav><div class="ad">Buy</div>
%s<div id="comments"><p>First!</p></div><form><label>Mail</label></form><footer>&copy; x</footer><script>"</p>"</script>"""


def test_page_text(spark):
    article = "<article><h1>A &amp; B</h1><p>One <b>two</b>\n three<p>four<aside>no</aside><ul><li>five<li>six</ul></article>"
    site = '<div>Site of all</div><div>Home</div><h2>Story %d</h2><p>Words that only page %d has, enough of them.</p>'
    rows = [(1, "http://a.b/x", PAGE % article), (2, None, None), (3, "http://e.f/", ""), (4, "http://g.h/", PAGE % article[:30])]
    rows += [(10 + i, f"http://c.d/s/{i}", PAGE % (site % (i, i))) for i in range(4)] + [(1, "http://a.b/x", PAGE % article)]
    out = page_difference.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == len(rows)
    text = {r.page_id: r.text for r in out}
    assert text[1] == "A & B One two three four five six" and text[2] == text[3] == "" and text[4] == "A & B"
    assert all(text[10 + i] == f"Story {i} Words that only page {i} has, enough of them." for i in range(4))


def page_texts(spark, rows, **parameters):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "page", "site", "rank")})
    return {r.page_id: (r.text, r.n_deleted) for r in page_difference.main_texts(df, **parameters).collect()}


@pytest.mark.parametrize(("block", "margin"), [(1, 9), (3, 9), (1024, 64)])
def test_lines_of_the_site_go(spark, block, margin):
    menu = "".join(f"<div>Menu entry number {k} of the site</div>" for k in range(30))
    teaser = "<article><p>Teaser.</p></article>"
    quoted = "<p>A passage that two pages of the site quote.</p>"
    rows = [(i, f"http://a.b/x/{i}", f"<article><p>Share this page</p><p>Story {i} of its own, with enough words.</p>{quoted if i < 2 else ''}</article>") for i in range(5)]
    rows += [(10 + i, f"http://c.d/{i}.html", f"{menu}<p>Short {i}.</p>") for i in range(4)]
    rows += [(20 + i, f"http://e.f/{i}", f"<div>Home</div>{teaser}<div>The body of page {i}, which stands beside the teaser in a div.</div>") for i in range(4)]
    rows += [(30, "http://g.h/1", "<article><p>One line.</p></article>"), (31, None, "<p>No address</p>"), (32, "http://g.h/2", None)]
    out = page_texts(spark, rows, block=block, margin=margin)
    for i in range(5):
        assert out[i] == (f"Story {i} of its own, with enough words." + (" A passage that two pages of the site quote." if i < 2 else ""), 1)
    for i in range(4):
        assert out[10 + i] == (f"Short {i}.", 30)
        assert out[20 + i] == (f"The body of page {i}, which stands beside the teaser in a div.", 2)
    assert out[30] == ("One line.", 0) and out[31] == ("No address", 0) and out[32] == ("", 0)


def test_copies_of_a_page_stay_whole(spark):
    def body(i, n, edit=None):
        return "".join(f"<p>Line {k} of story {i}{'!' if k == edit else ''}</p>" for k in range(n))

    foot = "<div>All rights kept by the site</div>"
    rows = [(i, f"http://a.b/{i}", body(i, 6) + foot) for i in range(6)]
    rows += [(100 + i, f"http://a.b/2?copy={i}", body(2, 6) + foot) for i in range(3)]  # equal pages
    rows += [(200 + i, f"http://a.b/3/{i}", body(3, 6, i) + foot) for i in range(2)]  # near copies
    rows += [(300, "http://two.pages/1", body(7, 5)), (301, "http://two.pages/2", body(7, 5, 2))]
    rows += [(400 + i, f"http://near.copies/{i}", "<article>" + body(8, 6, i) + "</article>") for i in range(5)]
    out = page_texts(spark, rows)
    lines = {r[0]: [t for t, _ in page_difference.lines_of(r[2])] for r in rows}
    for i, (text, _) in out.items():
        assert text == " ".join(x for x in lines[i] if not x.startswith("All rights")), i


def test_page_text_of_the_tables(spark):
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        inner = re.sub(r"<[^>]*(>|\Z)", "", re.sub(r"</?(h1|p|br)>", "\n", inner))
        want = " ".join(x for x in (" ".join(html.unescape(y).split()) for y in inner.split("\n")) if x)
        assert " ".join(t for t, own in page_difference.lines_of(r.html) if own) == want


def test_shared_lines_is_longest_common_subsequence():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(9))] for _ in range(2))
        best = max(len(s) for n in range(len(a) + 1) for s in itertools.combinations(a, n) if all(any(x == y for y in it) for it in [iter(b)] for x in s))
        found = page_difference.shared_lines(a, b)
        it = iter(b)
        assert len(found) == best and all(any(a[i] == y for y in it) for i in sorted(found))


def test_toxicity(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("aeioubdklmnrst") for _ in range(rng.randint(2, 7))) for _ in range(500)]
    rows, labels = [], []
    for i in range(900):
        text = rng.choices(words, k=rng.randint(5, 60))
        toxic = i % 4 == 0
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["vileword", "badstuff"]))
        rows.append((i, " ".join(text).capitalize(), "en" if i % 2 else None))
        labels.append((i, int(toxic)))
    rows += [(2000, None, "en"), (None, "", None), (5, rows[5][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([*labels, (3000, 1), (1, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity_cnn.toxicity(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id < 900]
    assert len(held) > 100 and sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)


def test_toxicity_learns_from_every_labelled_text(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("aeioubdklmnrst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=12) + (["vileword"] if i % 3 == 0 else [])), "en") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(1500)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity_cnn, "SHARD_TEXTS", 250)
    monkeypatch.setattr(toxicity_cnn, "STEPS", 200)
    used = []
    fitted = toxicity_cnn._fitted

    def seen(stored, shards):
        used.append((stored.count(), stored.select("shard").distinct().count(), shards))
        return fitted(stored, shards)

    monkeypatch.setattr(toxicity_cnn, "_fitted", seen)
    first, again = (toxicity_cnn.toxicity(docs, labels).orderBy("doc_id").collect() for _ in range(2))
    assert first == again
    held = [r for r in first if r.held_out]
    assert used[0] == (1500 - len(held), 5, 5)
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in held) >= 0.95 * len(held)


@pytest.mark.parametrize("shard_texts", [120, 1000])
def test_toxicity_network_is_fitted_on_rows_that_calibrate_too(spark, monkeypatch, shard_texts):
    """A word of which every place is in a row that the first fit leaves out is learned."""
    rng = random.Random(4)
    words = ["".join(rng.choice("aeioubdklmnrst") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    rows = [(i, " ".join([*rng.choices(words, k=12), *["vileword"] * (i % 3 == 0)]), "en") for i in range(700)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(700)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity_cnn, "SHARD_TEXTS", shard_texts)
    monkeypatch.setattr(toxicity_cnn, "STEPS", 100)

    def frame(x):
        return spark.createDataFrame(x, "doc_id long, text string, lang string")

    columns = "doc_id", "text", "lang", "toxic"
    stored, shards = toxicity_cnn._labelled(frame(rows), labels, *columns)
    assert (shards > 1) == (shard_texts == 120)
    left_out = set()
    for k in range(shards):
        left_out |= set(sorted(r.draw for r in stored.filter(F.col("shard") == k).collect())[4::5])
    draws = {r.doc_id: r.draw for r in labels.select("doc_id", F.xxhash64("doc_id", F.lit(toxicity_cnn.SEED)).alias("draw")).collect()}
    rows = [(i, x + " zzyzx" * (draws[i] in left_out), "en") for i, x, _ in rows]
    net, _, _ = toxicity_cnn.load(toxicity_cnn.trained(frame(rows), labels, *columns))
    slots = toxicity_cnn.tokens_of(pa.chunked_array([pa.array(["zzyzx vileword qqqqqqqq"])]))[0]
    assert net.embedding[slots].any(axis=1).tolist() == [True, True, False]


@pytest.mark.parametrize("n", [3, 40])
def test_toxicity_scores_a_text_alone(n):
    rng = np.random.default_rng(n)
    net = toxicity_cnn.Network(rng)
    texts = pa.chunked_array([pa.array([" ".join(rng.choice(list("abcdefgh"), k)) for k in [0, 1, 2, *rng.integers(1, 30, n)]])])
    tokens = toxicity_cnn.tokens_of(texts)
    alone = [toxicity_cnn._logits(net, toxicity_cnn._slice(tokens, np.array([i])))[0] for i in range(len(texts))]
    assert np.allclose(toxicity_cnn._logits(net, tokens), alone, atol=1e-6)
    assert np.allclose(net.forward(*tokens, winners=True)[3], net.forward(*tokens)[3])


def test_toxicity_of_few_rows_uses_all_epochs(spark, monkeypatch):
    """Of fewer than five rows none is kept back, so none speaks for fewer epochs."""
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:4]
    docs = spark.createDataFrame([(i, f"good day {'vileword' * (i == ids[0])}", "en") for i in ids], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i == ids[0])) for i in ids], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity_cnn, "SEEN", 1)
    monkeypatch.setattr(toxicity_cnn, "STEPS", 40)
    told = {r.doc_id: r.predicted for r in toxicity_cnn.toxicity(docs, labels).collect()}
    assert told == {i: int(i == ids[0]) for i in ids}


def test_threshold_of_counted_scores():
    cut = toxicity_cnn.best_threshold(np.array([1.0, 0.5, -1.0]), np.array([3, 0, 1]), np.array([3, 2, 9]))
    assert cut == 0.75
    assert toxicity_cnn.best_threshold(np.array([1.0]), np.array([2]), np.array([2])) == 0


def test_longest_texts_are_steps_of_their_own():
    from starloom.llm import packed

    batch = pa.record_batch({"t": pa.array(["a", None, "x " * 600_000, "b"])})
    assert [b.num_rows for b in packed.in_steps(batch, 0)] == [2, 1, 1]


def test_empty_tables(spark):
    _, df = texts(spark)
    none = df.limit(0)
    assert substring_dedup.remove_repeated_windows(none).count() == 0
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0
    assert simhash_dedup.near_duplicates(none).count() == 0
    assert quality_outliers.judged(none).count() == 0
    assert source_mixing.mix(none).count() == 0
    assert length_packing.pack(none).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, vector array<double>")
    assert topk_search.nearest(vectors, vectors).count() == 0
    assert chat_format.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert page_difference.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert toxicity_cnn.toxicity(none, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.write_through(stage(spark, docs, FOLDER), name)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        if name in ("quality", "near_duplicates"):
            assert all(before[r.doc_id] == r for r in docs.collect())
        if name == "repeated_passages":
            assert all(hashlib.sha256((r.text or "").encode()).hexdigest() and r.n_chars == len(r.text) for r in docs.collect())
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count()
