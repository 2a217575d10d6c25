"""Fill-in-middle, centroid clusters and licence scans against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import centroid_clusters, fill_in_middle, license_scan

FOLDER = "/root/testdata/sf0.001"


def clashing(df):
    """Adds columns named as those that the operators use inside."""
    names = ("id", "n", "form", "one", "cluster", "vector", "second", "found", "at", "words", "best")
    return df.withColumns({c: F.lit("x") for c in names})


# Fill-in-middle ------------------------------------------------------------------------------------------------


def cut_by_hand(doc, text, seed, units):
    text = text or ""
    parts = units(text)
    n, digest = len(parts), hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    plain = not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
    form = "plain" if plain else "spm" if h[3] % 100 < 20 else "psm"
    p, m, s = ("".join(x) for x in (parts[:a], parts[a:b], parts[b:]))
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return doc, n, form, None if plain else a, None if plain else b - a, out, text


FILL_ROWS = [
    (1, "a\nb😀c\r\n x \x85"), (2, None), (3, ""), (None, "without id"), (None, None), (4, "x<P>y"), (5, "😀é" * 300000),
    (6, "$1\\ <S <M> "), (7, "a" * 1024), (8, "b" * 1023), (9, "c" * 1025), (7, "$0\\Q\\E<"), (7, "$0\\Q\\E<"), (10, "é" * 5000),
    (11, "x"), (12, "<S"), (13, "<P<P"), (-14, " \t"), (15, ">P>S>M>"),
]


@pytest.mark.parametrize("seed", [1, 2, 9])
def test_fill_in_middle(spark, seed):
    rows = [*FILL_ROWS, *((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    out = fill_in_middle.fill_in_middle(df, seed=seed)
    back = fill_in_middle.restored(F.col("output"), F.col("form")).alias("back")
    got = [tuple(r) for r in out.select("doc_id", "n", "form", "prefix_units", "middle_units", "output", back).collect()]
    want = [cut_by_hand(*r, seed, list) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_words(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i)) + " " * (i % 3)) for i in range(60)] + [(99, "a b\n" * 40000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = fill_in_middle.fill_in_middle(df, unit=r"\s*+\S++|\s++")
    back = fill_in_middle.restored(F.col("output"), F.col("form")).alias("back")
    got = [tuple(r) for r in out.select("doc_id", "n", "form", "prefix_units", "middle_units", "output", back).collect()]
    want = [cut_by_hand(*r, 1, lambda t: re.findall(r"\s*\S+|\s+", t)) for r in rows]
    assert sorted(got) == sorted(want)


def test_fill_in_middle_sentinels_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fill_in_middle.fill_in_middle(none).count() == 0
    for bad in (("<P>", "<S>", "<P>"), ("aba", "<S>", "<M>"), ("<P>", "x<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle.fill_in_middle(none, sentinels=bad)
    odd = ("$1", "\\2", "[.*]")
    rows = [(i, f"text {i} \\ $ .") for i in range(40)]
    out = fill_in_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), sentinels=odd)
    back = fill_in_middle.restored(F.col("output"), F.col("form"), odd)
    assert sorted(tuple(r) for r in out.select("doc_id", back).collect()) == rows
    assert all(all(x in r.output for x in odd) for r in out.filter("form <> 'plain'").collect())


# Centroid clusters ---------------------------------------------------------------------------------------------


def clusters_by_hand(rows, k=16, rounds=3, width=64):
    kept = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    x = np.array([v for _, v in kept], object).reshape(len(kept), width)
    name = lambda j: hashlib.sha256(f"1:{'' if kept[j][0] is None else kept[j][0]}".encode()).hexdigest()
    centres = [list(kept[j][1]) for j in sorted(range(len(kept)), key=lambda j: (name(j), kept[j][1]))[:k]]

    def assign():
        d = [[((v - np.array(c, object)) ** 2).sum() for c in centres] for v in x]
        return [min((e, j) for j, e in enumerate(r)) for r in d]

    for _ in range(rounds):
        near = assign()
        for j in range(len(centres)):
            own = [x[i] for i, (_, c) in enumerate(near) if c == j]
            if own:
                centres[j] = [int(sum(col)) // len(own) for col in zip(*own, strict=True)]
    near = assign()
    total = sum(d for d, _ in near)
    return [(kept[i][0], c, d, sum(e for e, o in near if o == c), total, centres[c]) for i, (d, c) in enumerate(near)]


def clusters(spark, rows, **parameters):
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    return [tuple(r) for r in centroid_clusters.cluster(df, **parameters).collect()]


def test_clusters_of_the_table(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    assert sorted(clusters(spark, rows)) == sorted(clusters_by_hand(rows))


@pytest.mark.parametrize(("k", "rounds"), [(1, 2), (2, 0), (5, 4), (16, 3), (300, 2)])
def test_clusters_with_ties_and_odd_rows(spark, k, rounds):
    rng = random.Random(k)
    value = lambda: float(np.float32(rng.choice([0, 0.02, -0.02, 1, 300.7, -90000.3])))
    rows = [(i, [value() for _ in range(3)]) for i in range(150)]
    rows += [(None, [1.0, 2.0, 3.0]), (5, [1.0, 2.0, 3.0]), (5, [1.0, 2.0, 3.0]), (6, None), (7, [1.0, None, 2.0]), (7, [])]
    rows += [(8, [math.nan] * 3), (9, [math.inf] * 3), (10, [1.0]), (11, [1.0] * 4)]
    got = clusters(spark, rows, k=k, rounds=rounds, width=3)
    assert sorted(got, key=repr) == sorted(clusters_by_hand(rows, k, rounds, 3), key=repr)


def test_clusters_of_nothing(spark):
    assert clusters(spark, []) == []
    assert clusters(spark, [(1, None), (2, [1.0])]) == []


def test_bounds_hold_while_centroids_move():
    rng = np.random.default_rng(5)
    x = rng.integers(-60, 60, (3000, 6))
    centres = x[:12].copy()
    now = centroid_clusters.Centroids(centres)
    state = np.zeros(len(x), int), np.ones(len(x), int), np.full(len(x), np.inf), np.zeros(len(x))
    for _ in range(15):
        state = now.assign(x, *state)
        d = ((x[:, None, :] - centres[None]) ** 2).sum(2)
        assert (state[0] == d.argmin(1)).all()
        others = np.where(np.arange(12)[None] == state[0][:, None], np.inf, np.sqrt(d)).min(1)
        assert (state[2] >= np.sqrt(d.min(1))).all() and (state[3] <= others).all()
        moved = centres + rng.integers(-6, 7, centres.shape)
        now, centres = centroid_clusters.Centroids(moved, centres), moved


# Licences ------------------------------------------------------------------------------------------------------


def scan_by_hand(texts):
    m = license_scan
    lowered = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "") for t in texts]
    docs = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t) for t in lowered]

    def bits(word):
        return ((len(docs) + 1) // (sum(word in d for d in docs) + 1)).bit_length()

    index = []
    for t in m.TEMPLATES:
        own = sorted(set(t.words) - m.COMMON, key=lambda w: (-bits(w), w))[: m.RARE]
        index.append([(w, i, bits(w)) for i, w in enumerate(t.words) if w in own])

    def stands(d, phrase, at):
        return at >= 0 and d[at : at + len(phrase.split())] == phrase.split()

    out = []
    for d in docs:
        base = [(i, label) for x, label in m.PHRASES.items() for i in range(len(d)) if stands(d, x, i)]
        share, labels = 0.0, set()
        for t, postings in zip(m.TEMPLATES, index, strict=True):
            total = sum(w for *_, w in postings)
            for start in range(-len(t.words), len(d)):
                agree = sum(w for word, i, w in postings if 0 <= start + i < len(d) and d[start + i] == word)
                if 5 * agree >= 3 * total and all(stands(d, x, start + t.place(x)) for x in t.phrases):
                    share = max(share, agree / total)
                    labels.add(t.label)
        own = {label for _, label in base}
        score = max(share, 0.5 if base else 0.0)
        out.append((len(d), sorted(i for i, _ in base), sorted(own), sorted(labels), sorted(own | labels), score))
    return out


NOTICES = [
    None, "", "  ,;", "MIT License", "the mit\tlicense; mit-license. MITLICENSE mit licenses", "cc by cc by CC-BY-NC 4.0",
    "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at",
    "Licensed under the Apache Licence, Version 2.0", "apache license version 2", "Licensed under CC BY-NC 4.0. Licensed under CC BY-SA 4.0!",
    "This work is licensed under the GNU General Public License, version 2.", "ünlicensed under cc by nc 4 0 é",
    "K apacheK license apache license", "gnu general public", "license mit apache cc",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including",
    "Permission is hereby granted to deal in the Software without restriction", "x " * 9000 + "released under the mit license",
    "Released under the MIT License. " * 800, "# Redistribution and use in source and binary forms, with or without\n# modification, are "
    "permitted provided that the following conditions are met:",
]


def test_license_scan(spark):
    texts = [*NOTICES, NOTICES[6], *(r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())]
    df = clashing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    out = sorted(license_scan.scanned(df).collect())
    got = [(r.n_words, [p["at"] for p in r.places], r.base_labels, r.method_labels, r.labels, r.score) for r in out]
    assert got == scan_by_hand(texts)
    found = {label for r in out for label in r.method_labels}
    assert {"mit", "apache-2.0", "cc-by-nc-4.0", "cc-by-sa-4.0", "bsd"} <= found
    # The notice with a word misspelt has no base phrase, and without its mandatory phrase no label either.
    assert out[7].labels == [] and out[10].method_labels == [] and out[16].labels == []


def test_license_scan_without_rows_or_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.scanned(none).count() == 0
    two = spark.createDataFrame([(None, "mit license"), (None, "mit license")], "doc_id long, text string")
    assert [tuple(r)[1:4] for r in license_scan.scanned(two).collect()] == [(2, [(0, "mit")], ["mit"])] * 2
    with pytest.raises(ValueError):
        license_scan.scanned(none, phrases={"Größe": "x"})
