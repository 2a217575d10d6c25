"""Licence labels from a positional index of rare words, in DataFrame functions only.

Templates are short notices.  Every word of a template weighs its inverse document frequency over all documents; the
index holds the postings (template, position) of each template's rarest words.  A document's words are looked up in
it: each posting of a word at place p votes for its template starting at p less the posting's position, so words that
agree on a start stand to each other as in the template.  A start is a match where the agreeing words carry
most of the template's weight in the index and every mandatory phrase of the template stands at its place from
that start.

One pass over the texts finds the words of templates and phrases and writes them with their places; counts and votes
are taken from that table.  Votes of a document are sorted and folded once, so a document of many notices costs
little more than its length, and nothing is shuffled but one count for each word of the templates.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_through

WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"  # as [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, which takes Java seven times as long
RARE = 6  # words of a template in the index
AGREE, OF = 3, 5  # share of a template's weight in the index that must agree on a start
PLAIN = 0.5  # score of a document with a base phrase and no template

# Words that are common in any corpus of English; they take no part in the index.
COMMON = frozenset(
    "a all an and any are as at be but by for from if in into is it may not of on or other that the this to use was with you"
    .split()
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]  # each must stand in the document where it stands first in the text

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def place(self, phrase: str) -> int:
        words, wanted = self.words, phrase.split()
        return next(i for i in range(len(words)) if words[i : i + len(wanted)] == wanted)


# Phrases and the labels they give.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices that public licences ask for, in words of lower case, and the phrases that must be there.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ("file except", "compliance"),
    ),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "licensed under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("hereby granted free", "without restriction"),
    ),
    Template(
        "gpl-3.0",
        "this work is licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-3.0",
        "under the terms of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version",
        ("gnu general public license", "either version 3"),
    ),
    Template(
        "gpl-2.0",
        "under the terms of the gnu general public license as published by the free software foundation either "
        "version 2 of the license or at your option any later version",
        ("gnu general public license", "either version 2"),
    ),
    Template(
        "lgpl",
        "under the terms of the gnu lesser general public license as published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl-3.0",
        "under the terms of the gnu affero general public license as published by the free software foundation",
        ("gnu affero general public license",),
    ),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template(
        "cc-by-4.0",
        "licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4",),
    ),
    Template(
        "cc-by-sa-4.0",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        ("creative commons attribution sharealike",),
    ),
    Template(
        "cc-by-nc-4.0",
        "licensed under a creative commons attribution noncommercial 4 0 international license",
        ("creative commons attribution noncommercial",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution", "binary forms", "met"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("use copy modify", "without fee", "hereby granted"),
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    Template("epl-2.0", "under the terms of the eclipse public license v 2 0", ("eclipse public license",)),
    Template("bsl-1.0", "distributed under the boost software license version 1 0", ("boost software license",)),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released", "public domain"),
    ),
)


def _check(templates: tuple[Template, ...], phrases: dict[str, str]) -> None:
    for text in (*phrases, *(t.text for t in templates), *(x for t in templates for x in t.phrases)):
        if not re.fullmatch(r"[0-9a-z]+( [0-9a-z]+)*", text):
            raise ValueError(f"not words of a to z and digits with one space between: {text!r}")


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)


def found_words(docs: DataFrame, vocabulary: list[str], id_col: str, text_col: str) -> DataFrame:
    """id, n_words and found: places and words of the vocabulary, in order."""
    words = F.regexp_extract_all(lowered(F.col(text_col)), F.lit(WORD), F.lit(0))
    rows = docs.select(F.col(id_col).alias("id"), words.alias("words"))
    known = F.transform(
        "words", lambda w, i: F.when(w.isin(vocabulary), F.struct(i.cast("int").alias("at"), w.alias("word")))
    )
    return rows.select(
        "id", F.size("words").cast("long").alias("n_words"), F.filter(known, lambda x: x.isNotNull()).alias("found")
    )


def phrase_starts(phrase: str, found: Column) -> Column:
    """Places of a phrase: where its words follow each other in the text and so in ``found``."""
    words = phrase.split()

    def at(x: Column, i: Column) -> Column:
        here = x["word"] == words[0]
        for step, word in enumerate(words[1:], 1):
            other = F.get(found, i + step)
            here = here & F.coalesce((other["word"] == word) & (other["at"] == x["at"] + step), F.lit(False))
        return F.when(here, x["at"])

    return F.filter(F.transform(found, at), lambda x: x.isNotNull())


def document_counts(found: DataFrame) -> tuple[dict[str, int], int]:
    """In how many documents each word of the vocabulary stands, and how many documents there are."""
    held = found.select(F.explode(F.array_distinct(F.transform("found", lambda x: x["word"]))).alias("word"))
    counts = held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each word of the templates
    return {r["word"]: r["n"] for r in counts}, found.count()


def weight(documents: int, holding: int) -> int:
    """Inverse document frequency in bits, a whole number from 1."""
    return ((documents + 1) // (holding + 1)).bit_length()


def rare_postings(
    templates: tuple[Template, ...], counts: dict[str, int], documents: int, rare: int
) -> list[list[tuple[str, int, int]]]:
    """For each template the postings (word, position, weight) of its ``rare`` rarest words, ties by word."""
    out = []
    for t in templates:
        weights = {w: weight(documents, counts.get(w, 0)) for w in t.words if w not in COMMON}
        best = sorted(weights, key=lambda w: (-weights[w], w))[:rare]
        out.append([(w, i, weights[w]) for i, w in enumerate(t.words) if w in best])
    return out


def _votes(index: list[list[tuple[str, int, int]]], templates: tuple[Template, ...], found: Column) -> Column:
    """Votes (template, start, weight, phrases) of a document, in order."""
    vote = "struct<template:int,start:int,weight:int,phrases:int>"
    by_word = defaultdict(list)
    for t, postings in enumerate(index):
        for word, place, idf in postings:
            by_word[word].append(F.struct(F.lit(t).alias("template"), F.lit(place).alias("place"), F.lit(idf).alias("idf")))
    table = F.create_map(*(x for w, ps in sorted(by_word.items()) for x in (F.lit(w), F.array(*ps))))

    def of_word(x: Column) -> Column:
        return F.transform(
            F.try_element_at(table, x["word"]),
            lambda p: F.struct(p["template"], x["at"] - p["place"], p["idf"], F.lit(0)).cast(vote),
        )

    indexed = F.filter(found, lambda x: x["word"].isin(list(by_word)))
    parts = [F.flatten(F.transform(indexed, of_word))]
    places = defaultdict(list)
    for t, template in enumerate(templates):
        for phrase in template.phrases:
            places[phrase].append((t, template.place(phrase)))

    def of_phrase(phrase: str, where: list[tuple[int, int]]) -> Column:
        starts = phrase_starts(phrase, found)
        return F.flatten(
            F.transform(
                starts,
                lambda at: F.array(*(F.struct(F.lit(t), at - p, F.lit(0), F.lit(1)).cast(vote) for t, p in where)),
            )
        )

    return F.array_sort(F.concat(*parts, *(of_phrase(x, where) for x, where in places.items())))


def _best(votes: Column, totals: list[int], needed: list[int]) -> Column:
    """For each template the greatest weight that agrees on a start with all its phrases, 0 where none does."""
    total, need = (F.array(*map(F.lit, x)) for x in (totals, needed))

    def closed(acc: Column) -> Column:
        """The best weights, with the group of votes that ends."""
        t = acc["template"]
        match = (acc["weight"] * OF >= F.get(total, t) * AGREE) & (acc["phrases"] == F.get(need, t))
        raised = F.transform(acc["best"], lambda x, i: F.when(i == t, F.greatest(x, acc["weight"])).otherwise(x))
        return F.when((t >= 0) & match, raised).otherwise(acc["best"])

    def step(acc: Column, v: Column) -> Column:
        same = (acc["template"] == v["template"]) & (acc["start"] == v["start"])
        return F.struct(
            v["template"].alias("template"),
            v["start"].alias("start"),
            (F.when(same, acc["weight"]).otherwise(0) + v["weight"]).alias("weight"),
            (F.when(same, acc["phrases"]).otherwise(0) + v["phrases"]).alias("phrases"),
            F.when(same, acc["best"]).otherwise(closed(acc)).alias("best"),
        )

    start = F.struct(
        F.lit(-1).alias("template"),
        F.lit(0).alias("start"),
        F.lit(0).alias("weight"),
        F.lit(0).alias("phrases"),
        F.array_repeat(F.lit(0), len(totals)).alias("best"),
    )
    return F.aggregate(votes, start, step, closed)


def scanned(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    rare: int = RARE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every document's id, n_words, places (of base phrases, in order), base_labels, method_labels, labels, score.

    A to Z are lowered; words are runs of other characters than ASCII ones that are no letter or digit.  ``phrases``
    give base labels wherever their words follow each other.  A template gives its label where it matches at
    some start (see above).  ``labels`` are both, sorted.  The score is the greatest agreeing share of a matching
    template's weight; a document without a match has 0.5 with a base phrase, else 0.  A null or empty text has no words
    and no label.  Repeated rows return each and each counts as a document; an empty table gives an empty result.
    Other columns are ignored, so their names cannot clash.
    """
    _check(templates, phrases)
    named = [*phrases, *(x for t in templates for x in t.phrases)]
    vocabulary = sorted({w for t in templates for w in t.words} - COMMON | {w for x in named for w in x.split()})
    found = write_through(found_words(docs, vocabulary, id_col, text_col), "license-words")
    counts, documents = document_counts(found)
    index = rare_postings(templates, counts, documents, rare)
    totals = [sum(idf for *_, idf in postings) for postings in index]
    needed = [len(t.phrases) for t in templates]


    def labelled(phrase: str, label: str) -> Column:
        starts = phrase_starts(phrase, F.col("found"))
        return F.transform(starts, lambda at: F.struct(at.alias("at"), F.lit(label).alias("label")))

    base = F.array_sort(F.concat(*(labelled(x, label) for x, label in phrases.items())))
    labels = F.array(*(F.lit(t.label) for t in templates))
    total = F.array(*map(F.lit, totals))
    rows = found.select(
        "id", "n_words", base.alias("places"), _best(_votes(index, templates, F.col("found")), totals, needed).alias("best")
    )
    rows = rows.select(
        "id",
        "n_words",
        "places",
        F.array_sort(F.array_distinct(F.transform("places", lambda x: x["label"]))).alias("base_labels"),
        F.array_sort(
            F.array_distinct(
                F.filter(
                    F.transform("best", lambda w, t: F.when(w > 0, F.get(labels, t))), lambda x: x.isNotNull()
                )
            )
        ).alias("method_labels"),
        F.array_max(F.transform("best", lambda w, t: w / F.get(total, t))).alias("share"),
    )
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        "places",
        "base_labels",
        "method_labels",
        F.array_sort(F.array_union("base_labels", "method_labels")).alias("labels"),
        F.greatest("share", F.when(F.size("places") > 0, PLAIN).otherwise(0.0)).alias("score"),
    )
