"""Licence notices in texts, by a positional index of rare licence words. Built-in functions only.

1. One pass counts in how many documents each word of the licence templates stands: at most one row per
   template word comes back.
2. Each template is indexed by the highest-IDF words of its key phrase: word -> (template, position).
3. In each document the indexed words are looked up. A word at i that stands at q in a template proposes
   that the template begins at i - q. A proposal holds if enough of the template's rare words stand in their places
   relative to it and its key phrase stands whole. Its score is the IDF share of the template's words that stand in
   place. Everything stays within the row: no row meets another.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and their labels that every scan counts.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Label, words of a notice, and the phrase in it that must stand whole.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     "hereby granted free of charge to any person obtaining"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
     "except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
     "redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     "redistribution and use in source and binary forms"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "copy modify and or distribute this software for any purpose"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
)
RARE = 4
NEED = 2
# A proposal travels as one number, (begin + BEFORE) * len(TEMPLATES) + template: sets of numbers are hashed, sets of structs are not.
BEFORE = max(len(notice.split()) for _, notice, _ in TEMPLATES)
SEPARATED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words, A-Z lower-cased.

    lower() changes characters beyond ASCII too, which no template has; the one that it would turn into an
    ASCII letter alone, the Kelvin sign, is put aside first.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212A"), F.lit("\uFFFD")))
    return F.regexp_extract_all(plain, F.lit(SEPARATED), F.lit(0))


def template_words() -> list[str]:
    return sorted({w for _, notice, _ in TEMPLATES for w in notice.split()})


def word_idf(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """IDF of every template word over all documents."""
    known = F.array(*(F.lit(w) for w in template_words()))
    counts = (docs.select(F.array_intersect(words_of(F.col(text_col)), known).alias("w"))
              .select(F.explode(F.array_append("w", F.lit(""))).alias("w")).groupBy("w").count().collect())
    seen = {r["w"]: r["count"] for r in counts}
    # Every document counts under the empty word.
    n = seen.get("", 0)
    return {w: math.log((n + 1) / (seen.get(w, 0) + 1)) + 1e-3 for w in template_words()}


def key_start(notice: str, key: str) -> int:
    words, own = notice.split(), key.split()
    return next(i for i in range(len(words)) if words[i:i + len(own)] == own)


def rare_words(idf: dict[str, float]) -> list[list[tuple[str, int]]]:
    """For every template the RARE words of highest IDF of its key phrase, each with a position.

    The phrase must stand whole, so these words are there wherever the template is.
    """
    out = []
    for _, notice, key in TEMPLATES:
        words = key.split()
        best = sorted(set(words), key=lambda w: (-idf[w], w))[:RARE]
        out.append([(w, key_start(notice, key) + words.index(w)) for w in best])
    return out


def _text(value: str) -> str:
    assert re.fullmatch(r"[a-z0-9 -]*", value)
    return f"'{value}'"


def _index_sql(idf: dict[str, float]) -> tuple[str, str, str]:
    """SQL literals: the templates, the words that are indexed, and the postings of each, as proposals of a hit at word 0."""
    rare = rare_words(idf)
    templates = []
    for (label, notice, key), own in zip(TEMPLATES, rare):
        words, at = notice.split(), key_start(notice, key)
        total = sum(idf[w] for w in words)
        templates.append("named_struct('label', {}, 'words', array({}), 'weights', array({}), 'rare', array({}), 'at', {}, 'key', array({}))".format(
            _text(label), ", ".join(map(_text, words)), ", ".join(f"{idf[w] / total!r}D" for w in words),
            ", ".join(f"named_struct('w', {_text(w)}, 'q', {q})" for w, q in own), at, ", ".join(map(_text, key.split()))))
    indexed = sorted({w for own in rare for w, _ in own})
    proposals = {w: [(BEFORE - q) * len(TEMPLATES) + t for t, own in enumerate(rare) for x, q in own if x == w] for w in indexed}
    postings = [f"{_text(w)}, array({', '.join(f'{p}L' for p in own)})" for w, own in proposals.items()]
    return f"array({', '.join(templates)})", f"array({', '.join(map(_text, indexed))})", f"map({', '.join(postings)})"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row for each input row.

    Base columns count the fixed phrases. labels adds those of the templates found; score is the best
    template's, 0 if none is found. Labels are distinct, in order, joined by commas; empty without any. A null or empty
    text has no words; without base phrases first_word and last_word are null. Repeated rows give equal rows.
    Other columns are not read. An empty table gives no rows.
    """
    templates, indexed, postings = _index_sql(word_idf(docs, text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("w"))
    # Base phrases end in the same word; only texts with that word are gone through.
    last = {phrase.split()[-1] for phrase, _ in BASE}
    assert len(last) == 1
    ends = f"filter(sequence(0, size(w) - 1), i -> w[i] = {_text(last.pop())})"
    rows = rows.withColumn("ends", F.expr(f"if(array_contains(w, {_text(BASE[0][0].split()[-1])}), {ends}, array())"))
    found = []
    for phrase, label in BASE:
        own = phrase.split()
        same = " and ".join(f"get(w, i - {len(own) - 1 - k}) = {_text(x)}" for k, x in enumerate(own))
        found.append(f"transform(filter(ends, i -> {same}), i -> named_struct('p', cast(i - {len(own) - 1} as bigint), 'l', {_text(label)}))")
    rows = rows.withColumn("base", F.expr(f"concat({', '.join(found)})"))
    proposed = (f"array_distinct(flatten(transform(filter(sequence(0, size(w) - 1), i -> array_contains({indexed}, w[i])), "
                f"i -> transform({postings}[w[i]], p -> i * {len(TEMPLATES)}L + p))))")
    rows = rows.withColumn("proposed", F.expr(f"if(size(array_intersect(w, {indexed})) >= {NEED}, {proposed}, array())"))
    t = f"({templates})[cast(c % {len(TEMPLATES)} as int)]"
    o = f"(cast(c div {len(TEMPLATES)} as int) - {BEFORE})"
    hits = f"size(filter({t}.rare, r -> get(w, {o} + r.q) = r.w)) >= least({NEED}, size({t}.rare))"
    key = f"forall(sequence(0, size({t}.key) - 1), j -> coalesce(get(w, {o} + {t}.at + j) = {t}.key[j], false))"
    share = f"aggregate(sequence(0, size({t}.words) - 1), 0D, (a, j) -> a + if(coalesce(get(w, {o} + j) = {t}.words[j], false), {t}.weights[j], 0D))"
    rows = rows.withColumn("held", F.expr(f"transform(filter(proposed, c -> {hits} and {key}), c -> named_struct('l', {t}.label, 's', {share}))"))
    joined = lambda c: f"array_join(array_sort(array_distinct({c})), ',')"
    return rows.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.size("base").cast("long").alias("n_base"),
        F.expr("array_min(transform(base, b -> b.p))").alias("first_word"), F.expr("array_max(transform(base, b -> b.p))").alias("last_word"),
        F.expr(joined("transform(base, b -> b.l)")).alias("base_labels"),
        F.expr(joined("concat(transform(base, b -> b.l), transform(held, h -> h.l))")).alias("labels"),
        F.expr("least(1D, coalesce(array_max(transform(held, h -> h.s)), 0D))").alias("score"))
