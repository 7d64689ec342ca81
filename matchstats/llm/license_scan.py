"""Licence scan by a positional rare-token index (operator 2), DataFrame
functions only.

A licence is named by short references (sets of key phrases) or by its notice
(a paragraph of its text).  Over all documents the share of documents that hold
each licence word gives its IDF.  A phrase is indexed under its ``RARE`` words
of highest IDF, a notice under its ``RARE_IN_NOTICE``, with their places in it.
A document's words are looked up in that index.  A phrase is a candidate where
all its indexed words imply the same start (postings intersected by relative
position) and counts where the whole phrase then stands word by word.  A notice
is a candidate where at least ``AGREEING`` of its indexed words imply the same
start, give or take ``SLACK`` words; there the share of its words, weighted by
IDF, that stand at their place (with the same slack) is measured.

A label holds when all mandatory phrases of a reference are found, or when a
notice's share reaches ``LEAST_SHARE`` and its mandatory phrase is found.  The
score is the best over all references and notices of share * e / (e + ``HALF``),
with e the weight of the words found: a long notice found whole comes near 1, a
short reference stays below, a part of either gives its part.

Defined results: null and empty texts have no words, no places and score 0;
repeated rows get the same result each; overlapping places all count; labels
are distinct and sorted; an empty table gives an empty result; extra columns
are ignored.  No row leaves its task: there is no shuffle but that of the word
statistics, which are at most one row per licence word and task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstats.llm.common import text_key

#: Base phrases and their labels; fixed by the result's definition.
BASE_PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
#: The method's own templates: label -> (mandatory phrases, all needed).
TEMPLATES = {
    "agpl-3": ["gnu affero general public license", "version 3"],
    "apache-2": ["licensed under the apache license"],
    "bsd": ["redistribution and use in source and binary forms", "provided that the following conditions are met"],
    "cc-by-nc": ["licensed under cc by nc"],
    "cc-by-sa": ["creative commons attribution sharealike"],
    "cc0": ["cc0 1 0 universal"],
    "gpl-3": ["gnu general public license", "version 3"],
    "gpl-2": ["gnu general public license", "version 2"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose"],
    "lgpl-3": ["gnu lesser general public license", "version 3"],
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy"],
    "mpl-2": ["mozilla public license", "version 2 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}
#: Notices: label -> (mandatory phrase, paragraph); words as the scan sees them.
NOTICES = {
    "agpl-3": ("gnu affero general public license",
               "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public "
               "license as published by the free software foundation either version 3 of the license or at your option any later version"),
    "apache-2": ("except in compliance with the license",
                 "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
                 "license you may obtain a copy of the license at"),
    "bsd": ("redistributions of source code must retain the above copyright notice",
            "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
            "conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer"),
    "bsl-1": ("covered by this license",
              "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
              "accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit "
              "the software"),
    "cc0": ("waive all copyright and related or neighboring rights",
            "to the extent possible under law the author has dedicated all copyright and related and neighboring rights and agreed to "
            "waive all copyright and related or neighboring rights to this work"),
    "gpl-2": ("either version 2 of the license",
              "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
              "as published by the free software foundation either version 2 of the license or at your option any later version"),
    "gpl-3": ("either version 3 of the license",
              "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
              "as published by the free software foundation either version 3 of the license or at your option any later version"),
    "isc": ("with or without fee",
            "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    "lgpl-3": ("gnu lesser general public license",
               "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
               "license as published by the free software foundation either version 3 of the license or at your option any later version"),
    "mit": ("without restriction including without limitation the rights",
            "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
            "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
            "merge publish distribute sublicense and or sell copies of the software"),
    "mpl-2": ("mozilla public license",
              "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed "
              "with this file you can obtain one at"),
    "unlicense": ("released into the public domain",
                  "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
                  "compile sell or distribute this software either in source code form or as a compiled binary for any purpose"),
    "zlib": ("must not be misrepresented",
             "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any "
             "damages arising from the use of this software the origin of this software must not be misrepresented"),
}
#: Words of highest IDF that a phrase and a notice are indexed under, how many
#: of a notice's must agree, by how many words places may be off, the share of
#: a notice that counts, and the weight of found words that scores a half.
RARE, RARE_IN_NOTICE, AGREEING, SLACK = 2, 8, 3, 3
LEAST_SHARE = 0.75
HALF = 10.0

_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_column(text: Column) -> Column:
    """Words of a text.  ``lower`` also changes letters beyond A-Z, but only to
    letters, so words stay words; only the Kelvin sign would become an ASCII
    letter, and it is kept from that."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e5")))
    return F.array_remove(F.split(plain, _SPLIT, -1), "")


def phrases() -> list[str]:
    return sorted({*BASE_PHRASES.values(), *(p for ps in TEMPLATES.values() for p in ps), *(p for p, _ in NOTICES.values())})


def word_idf(docs: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """IDF of every licence word over all documents."""
    held = F.array_intersect(words_column(F.col("text")), F.array(*[F.lit(w) for w in vocabulary]))
    rows = docs.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("word"))  # "" counts the documents
    counts = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.count("*").alias("n")).collect()}
    n = counts.get("", 0)
    return {w: math.log1p((n + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}


def rare_index(idf: dict[str, float]) -> dict[str, list[tuple[int, str]]]:
    """phrase -> its RARE words of highest IDF, as (place, word)."""
    out = {}
    for p in phrases():
        ws = p.split(" ")
        places = sorted(range(len(ws)), key=lambda i: (-idf[ws[i]], i))[:RARE]
        out[p] = [(i, ws[i]) for i in places]
    return out


def notice_index(idf: dict[str, float]) -> dict[str, list[tuple[int, str]]]:
    """label -> its notice's RARE_IN_NOTICE words of highest IDF that stand
    once in it, as (place, word)."""
    out = {}
    for label, (_, text) in NOTICES.items():
        ws = text.split(" ")
        once = [i for i, w in enumerate(ws) if ws.count(w) == 1]
        out[label] = [(i, ws[i]) for i in sorted(once, key=lambda i: (-idf[ws[i]], i))[:RARE_IN_NOTICE]]
    return out


def implied_starts(indexed: list[tuple[int, str]]) -> Column:
    """Sorted starts that the found indexed words of a notice imply."""
    return F.array_sort(F.concat(*[F.transform(F.filter("places", _is(word)), _less(at)) for at, word in indexed]))


def notice_share(text: str, starts: str, idf: dict[str, float]) -> Column:
    """Largest weighted share of a notice's words at their places, over all
    of its implied starts that enough words agree on.  ``starts`` is a column,
    as each element looks at its followers; linear in the words found."""
    ws = text.split(" ")
    # a run of starts within the slack: its middle is a candidate
    agreed = F.filter(F.transform(starts, lambda x, i: F.when(
        F.get(starts, i + F.lit(AGREEING - 1)) - x <= SLACK, F.get(starts, i + F.lit(AGREEING // 2)))), lambda x: x.isNotNull())
    total = sum(idf[w] for w in ws)
    words = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(w).alias("word"), F.lit(idf[w] / total).alias("share"))
                      for i, w in enumerate(ws)])

    def found(start):
        def add(acc, x):
            near = F.slice("w", F.greatest(start + x["at"] - SLACK + 1, F.lit(1)),
                           F.greatest(F.least(start + x["at"], F.lit(SLACK)) + SLACK + 1, F.lit(0)))
            return acc + F.when(F.array_contains(near, x["word"]), x["share"]).otherwise(0.0)
        return F.aggregate(words, F.lit(0.0), add)

    return F.coalesce(F.array_max(F.transform(F.array_distinct(agreed), found)), F.lit(0.0))


def _is(word: str):
    return lambda x: x["word"] == word


def _less(at: int):
    return lambda x: x["at"] - at


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score and tkey of every row."""
    every = phrases()
    idf = word_idf(docs, sorted({w for p in [*every, *(t for _, t in NOTICES.values())] for w in p.split(" ")}))
    index, in_notice = rare_index(idf), notice_index(idf)
    anchors = sorted({index[p][0][1] for p in every} | {w for ws in in_notice.values() for _, w in ws})

    # words, then the places of the index's words (none for most documents)
    d = docs.select("doc_id", text_key(), words_column(F.col("text")).alias("w"))
    d = d.withColumn("hit", F.arrays_overlap("w", F.array(*[F.lit(a) for a in anchors])))
    anchor_list = F.array(*[F.lit(a) for a in anchors])
    places = F.filter(F.transform("w", lambda x, i: F.when(F.array_contains(anchor_list, x), F.struct(
        i.alias("at"), x.alias("word")))), lambda x: x.isNotNull())
    d = d.withColumn("places", F.when(F.col("hit"), places).otherwise(
        F.array().cast("array<struct<at:int,word:string>>")))

    # the starts of every notice, a column each: computed once a row
    none = F.array().cast("array<int>")
    d = d.select("*", *[F.when(F.col("hit"), implied_starts(in_notice[label])).otherwise(none).alias(f"s{i}")
                        for i, label in enumerate(NOTICES)])

    def starts(p: str) -> Column:
        ws = p.split(" ")
        (at0, word0), *others = index[p]
        first = F.filter("places", lambda x: (x["word"] == word0) & (x["at"] >= at0)
                         & (x["at"] - at0 + len(ws) <= F.size("w")))
        shifted = F.transform(first, lambda x: x["at"] - at0)

        def whole(s):
            ok = F.lit(True)
            for at, word in others:  # intersect by relative position first
                ok = ok & (F.get("w", s + at) == word)
            return ok & (F.slice("w", s + 1, F.lit(len(ws))) == F.array(*[F.lit(x) for x in ws]))

        return F.filter(shifted, whole)

    d = d.select("doc_id", "tkey", F.size("w").cast("long").alias("n_words"), F.col("hit"), *[
        F.when(F.col("hit"), starts(p)).otherwise(none).alias(f"p{i}") for i, p in enumerate(every)], *[
        F.when(F.size(f"s{i}") >= AGREEING, notice_share(text, f"s{i}", idf)).otherwise(0.0).alias(f"notice_{label}")
        for i, (label, (_, text)) in enumerate(NOTICES.items())])
    at = {p: F.col(f"p{i}") for i, p in enumerate(every)}
    base = F.concat(*[at[p] for p in BASE_PHRASES.values()])
    base_labels = [F.when(F.size(at[p]) > 0, F.lit(label)) for label, p in sorted(BASE_PHRASES.items())]
    by_label: dict[str, list[Column]] = {}
    score = F.lit(0.0)
    for label, ps in [*TEMPLATES.items(), *((label, [p]) for label, p in BASE_PHRASES.items())]:
        all_found, weight, whole = F.lit(True), F.lit(0.0), sum(idf[w] for p in ps for w in p.split(" "))
        for p in ps:
            all_found = all_found & (F.size(at[p]) > 0)
            weight = weight + F.when(F.size(at[p]) > 0, F.lit(sum(idf[w] for w in p.split(" ")))).otherwise(0.0)
        by_label.setdefault(label, []).append(all_found)
        score = F.greatest(score, weight / whole * weight / (weight + HALF))
    for label, (p, text) in NOTICES.items():
        share = F.col(f"notice_{label}")
        by_label.setdefault(label, []).append((share >= LEAST_SHARE) & (F.size(at[p]) > 0))
        weight = share * sum(idf[w] for w in text.split(" "))
        score = F.greatest(score, share * weight / (weight + HALF))
    labels = []
    for label, tests in sorted(by_label.items()):
        any_of = tests[0]
        for t in tests[1:]:
            any_of = any_of | t
        labels.append(F.when(any_of, F.lit(label)))
    n_base = F.size(base).cast("long")
    named = F.concat_ws(",", *labels)
    return d.select(
        "doc_id", "n_words", n_base.alias("n_base"), F.array_min(base).cast("long").alias("first_word"),
        F.array_max(base).cast("long").alias("last_word"), F.concat_ws(",", *base_labels).alias("base_labels"),
        named.alias("labels"), F.least(score, F.lit(1.0)).alias("score"), "tkey")
