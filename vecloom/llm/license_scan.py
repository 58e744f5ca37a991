"""Operator 3: licence notices in whole texts, by a positional index of rare words.

Each notice is indexed by its `RARE` words of highest IDF, with their places; IDF is counted over
all documents. The index is one array of postings. A text's words are intersected once with the
rarest word of every notice, which leaves few or no postings to look at. For those, the text's
places of the rarest word, less its place in the notice, are where the whole notice may begin; a beginning
stays if the other rare words stand at the same distance as in the notice, and if the notice's mandatory
key phrase stands there word by word. Base phrases are notices like any other.

Only DataFrame functions are used, in one pass over the texts after one for the IDF. A text's cost is one
hash set of its words and a scan for each notice whose rarest word it has: it hardly grows with the
number of notices. Nothing is shuffled but the word counts.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE = 4

# Base phrases and their labels.
BASE = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

# Label, notice, and the phrase in it that must stand as it is.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("mit", "released under the mit license", "mit license"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "source and binary forms"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2", "under the terms of the gnu general public license version 2", "gnu general public license version 2"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the rights "
     "to use copy modify merge publish distribute sublicense and or sell copies of the software",
     "to deal in the software without restriction"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies",
     "for any purpose with or without fee"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to "
     "alter it and redistribute it freely subject to the following restrictions", "alter it and redistribute it freely"),
    ("bsd-2", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
     "following disclaimer in the documentation and or other materials provided with the distribution",
     "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3", "may be used to endorse or promote products derived from this software without specific prior written permission",
     "endorse or promote products"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without "
     "fee and without a written agreement is hereby granted", "without a written agreement"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at",
     "except in compliance with the license"),
    ("gpl-2", "it under the terms of the gnu general public license as published by the free software foundation either "
     "version 2 of the license or at your option any later version", "either version 2 of the license"),
    ("gpl-3", "it under the terms of the gnu general public license as published by the free software foundation either "
     "version 3 of the license or at your option any later version", "either version 3 of the license"),
    ("lgpl-2", "under the terms of the gnu lesser general public license as published by the free software foundation either "
     "version 2 1 of the license or at your option any later version", "either version 2 1 of the license"),
    ("lgpl-3", "under the terms of the gnu lesser general public license as published by the free software foundation either "
     "version 3 of the license or at your option any later version", "either version 3 of the license"),
    ("agpl-3", "it under the terms of the gnu affero general public license as published by the free software foundation",
     "gnu affero general public license"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free "
     "documentation license", "gnu free documentation license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
     "distributed with this file you can obtain one at", "if a copy of the mpl was not distributed with this file"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
     "eclipse public license 2 0"),
    ("cddl", "subject to the terms of the common development and distribution license",
     "common development and distribution license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
    ("wtfpl", "do what the fuck you want to public license", "want to public license"),
    ("boost-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software "
     "and accompanying documentation covered by this license", "to any person or organization obtaining a copy"),
    ("boost-1", "distributed under the boost software license version 1 0", "boost software license"),
    ("artistic-2", "under the terms of the artistic license 2 0", "artistic license 2 0"),
    ("eupl", "licensed under the european union public licence", "european union public licence"),
    ("ofl", "this font software is licensed under the sil open font license version 1 1", "sil open font license"),
    ("ms-pl", "licensed under the microsoft public license", "microsoft public license"),
    ("odbl", "made available under the open database license", "open database license"),
    ("cc0", "to the extent possible under law the person who associated cc0 with this work has waived all copyright and "
     "related or neighboring rights to this work", "has waived all copyright and related or neighboring rights"),
    ("cc-by-sa", "licensed under the creative commons attribution share alike 4 0 international license",
     "creative commons attribution share alike"),
    ("cc-by-sa", "licensed under the creative commons attribution sharealike 4 0 international license",
     "creative commons attribution sharealike"),
    ("cc-by-nc", "licensed under the creative commons attribution noncommercial 4 0 international license",
     "creative commons attribution noncommercial"),
    ("cc-by-nd", "licensed under the creative commons attribution noderivatives 4 0 international license",
     "creative commons attribution noderivatives"),
    ("cc-by", "licensed under the creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
]

ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "places", "score")

_POSTING = (
    "array<struct<label:string,base:boolean,word:string,place:int,needed:array<struct<word:string,place:int>>,share:double>>"
)
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KELVIN = "K"  # the one letter outside ASCII whose lower case is in ASCII


def words(text: Column) -> Column:
    """Words of a text: runs of digits, letters and whatever is not ASCII, A-Z lower-cased.

    Other letters may be lower-cased too, which no template or count can tell.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit("ĸ")))
    return F.array_remove(F.split(plain, _BREAK), "")


def _literal(some: list[str]) -> Column:
    return F.split(F.lit(" ".join(some)), " ")


def _rarest(phrase: list[str], counts: dict[str, int], n: int) -> list[tuple[str, int]]:
    """The n words of highest IDF with their first places; ties by word."""
    return sorted(
        ((w, phrase.index(w)) for w in set(phrase)), key=lambda x: (counts.get(x[0], 0), x[0])
    )[:n]


def document_counts(docs: DataFrame, text: str) -> dict[str, int]:
    """In how many documents each template word stands: a few hundred counts over all texts."""
    vocabulary = sorted({w for _, t, _ in TEMPLATES for w in t.split()} | {w for p in BASE.values() for w in p.split()})
    some = F.array_intersect(words(F.col(text)), _literal(vocabulary))
    rows = docs.select(F.explode(some).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return {r["word"]: r["n"] for r in rows.collect()}


def _postings(counts: dict[str, int], rare: int = RARE) -> Column:
    """The index: for each notice its rarest word, the other rare ones, and its key phrase, with their places."""
    listed = [(label, phrase, phrase, True) for label, phrase in BASE.items()] + [(*t, False) for t in TEMPLATES]
    entries = []
    for label, notice, key, base in listed:
        parts, phrase = notice.split(), key.split()
        at = len(notice[: f" {notice} ".index(f" {key} ")].split())
        (word, place), *others = _rarest(parts, counts, rare)
        confirmed = {p for _, p in others} | {place} | set(range(at, at + len(phrase)))
        needed = [*others, *((w, at + i) for i, w in enumerate(phrase))]
        entries.append(
            {
                "label": label,
                "base": base,
                "word": word,
                "place": place,
                "needed": [{"word": w, "place": p} for w, p in needed],
                "share": len(confirmed) / len(parts),
            }
        )
    return F.from_json(F.lit(json.dumps(entries)), _POSTING)  # folded into one literal


def _found(all_words: Column, postings: Column, present: Column) -> Column:
    """(label, base, word, share) of every place where a notice stands."""

    def begins(t: Column) -> Column:
        hits = F.filter(F.sequence(F.lit(0), F.size(all_words) - 1), lambda i: F.get(all_words, i) == t["word"])
        starts = F.transform(hits, lambda i: i - t["place"])
        stands = lambda s: F.forall(t["needed"], lambda x: F.get(all_words, s + x["place"]) == x["word"])
        return F.transform(
            F.filter(starts, lambda s: F.coalesce(stands(s), F.lit(False))),
            lambda s: F.struct(t["label"].alias("label"), t["base"].alias("base"), s.alias("word"), t["share"].alias("share")),
        )

    live = F.filter(postings, lambda t: F.array_contains(present, t["word"]))
    none = F.array().cast("array<struct<label:string,base:boolean,word:int,share:double>>")
    return F.when(F.size(present) > 0, F.flatten(F.transform(live, begins))).otherwise(none)


def scan_licenses(docs: DataFrame, text: str = "text", names: dict[str, str] | None = None) -> DataFrame:
    """`docs` with n_words, n_base, first_word, last_word, base_labels, labels, places and score.

    `n_base` counts all places of base phrases; `first_word` and `last_word` are the least and
    greatest of them (words from 0; NULL if none). `labels` adds those of the notices; both
    are distinct, sorted and joined by commas. `places` has label and first word of each find; a notice of
    which the text lacks the beginning may have begun before word 0. `score` is 1 with a base phrase, else the
    largest share of a found notice's words that its key phrase and rare words confirm, else 0. NULL and
    empty texts have no words. All rows and columns stay; `names` gives other names to the added columns
    where the table has them already, which is an error.
    """
    added = {name: (names or {}).get(name, name) for name in ADDED}
    clash = set(added.values()) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; choose other output names")
    own = "__scan"
    while any(c.lower().startswith(own) for c in docs.columns):
        own = f"_{own}"
    counts = document_counts(docs, text)
    postings = _postings(counts)
    first = sorted({_rarest(n.split(), counts, 1)[0][0] for n in [*BASE.values(), *(t[1] for t in TEMPLATES)]})
    all_words, present, found = (F.col(f"{own}_{name}") for name in ("words", "present", "found"))
    rows = docs.withColumn(f"{own}_words", words(F.col(text)))
    rows = rows.withColumn(f"{own}_present", F.array_intersect(all_words, _literal(first)))
    rows = rows.withColumn(f"{own}_found", _found(all_words, postings, present))
    base = F.filter(found, lambda x: x["base"])
    starts = F.transform(base, lambda x: x["word"])
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda x: x["label"]))), ",")
    values = {
        "n_words": F.size(all_words).cast("long"),
        "n_base": F.size(base).cast("long"),
        "first_word": F.array_min(starts).cast("long"),
        "last_word": F.array_max(starts).cast("long"),
        "base_labels": labels(base),
        "labels": labels(found),
        "places": F.transform(found, lambda x: F.struct(x["label"].alias("label"), x["word"].alias("word"))),
        "score": F.when(F.size(base) > 0, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max(F.transform(found, lambda x: x["share"])), F.lit(0.0))
        ),
    }
    return rows.select(*docs.columns, *(values[name].alias(added[name]) for name in ADDED))
