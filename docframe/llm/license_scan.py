"""License scan: text blocks that contain the words of a license notice.

Words are runs of ASCII letters and digits and non-ASCII characters, A-Z lower-cased; a block is a line, or a
run of words that goes over line breaks, ``REACH`` times as long as the template and begun by one of its
words: every notice wrapped over lines lies in such a run, with as many other words in between. The SQL knows
lines only. A block matches a template if it holds at least ``threshold`` of the template's distinct words. The join is
exact: the words of the templates are ordered by how many documents of the corpus hold them, rarest first; a
block can only match if it holds one of a template's first words (prefix filter) and enough distinct words
(length filter), and if the words from its first hit on are enough (positional filter). Only blocks that pass
are compared. Beside the templates, fixed phrases give base labels, with the places where they stand.

Everything is a column expression over whole texts; only the document frequencies of the templates' words
come to the driver, one row per word. Null texts are empty ones. Repeated rows get the same result each.
Without templates only the phrases count. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notices as the licenses word them.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.8
#: Length of a run over line breaks, in lengths of the template.
REACH = 2


def _folded() -> Column:
    return F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def frequencies(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """In how many documents each of ``words`` stands, over all documents."""
    held = docs.select(F.explode(F.array_intersect(_words(_folded()), F.array(*map(F.lit, words)))).alias("word"))
    return dict.fromkeys(words, 0) | {r[0]: r[1] for r in held.groupBy("word").count().collect()}


def _places(words: Column, phrase: list[str]) -> Column:
    """Numbers of the words at which the phrase starts."""
    numbers = F.when(F.size(words) >= len(phrase), F.sequence(F.lit(0), F.size(words) - len(phrase))).otherwise(F.array().cast("array<int>"))

    def here(i: Column) -> Column:
        found = words[i] == phrase[0]
        for k, w in enumerate(phrase[1:], 1):
            found &= words[i + k] == w
        return found

    return F.filter(numbers, here)


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """For each row: words, places of phrases with their labels, labels of all kinds, and the best containment.

    ``score`` is 1 where a phrase stands, else the largest share of a template's words that a matching block
    holds, else 0.
    """
    sets = [(label, sorted(set(text.split()))) for label, text in templates]
    vocabulary = sorted({w for _, words in sets for w in words})
    common = frequencies(docs, vocabulary) if vocabulary else {}
    ordered = [(label, sorted(words, key=lambda w: (common[w], w))) for label, words in sets]
    least = [max(1, math.ceil(threshold * len(words) - 1e-9)) for _, words in ordered]
    prefix = sorted({w for (_, words), need in zip(ordered, least, strict=True) for w in words[: len(words) - need + 1]})

    folded = F.col("folded")
    gate = f"{SEPARATOR}+"
    likely = "|".join(gate.join(p.split()) for p, _ in phrases)
    phrase_words = [p.split() for p, _ in phrases]
    slim = docs.select("doc_id", _folded().alias("folded"))
    blocks = F.transform(F.split(folded, "\n"), _words)
    held = slim.select("doc_id", (folded.rlike(likely) if phrases else F.lit(False)).alias("phrased"), blocks.alias("blocks"))

    def containment(block: Column, number: int) -> Column:
        """Share of template ``number`` in the block, 0 if a filter rules it out."""
        words, need = ordered[number][1], least[number]
        first = F.array(*map(F.lit, words[: len(words) - need + 1]))
        whole = F.array(*map(F.lit, words))
        # Of the template's words in rare-first order, those from the block's first hit on must be enough.
        hit = F.element_at(F.array_intersect(first, block), 1)
        rest = F.lit(len(words) + 1) - F.array_position(whole, hit)
        shared = F.size(F.array_intersect(whole, block))
        enough = (F.size(block) >= need) & F.arrays_overlap(first, block)
        return F.when(enough, F.when((rest >= need) & (shared >= need), shared / F.lit(float(len(words)))))

    near = F.filter("blocks", lambda b: F.arrays_overlap(b, F.array(*map(F.lit, prefix)))) if prefix else F.array().cast("array<array<string>>")
    held = held.select("doc_id", "phrased", "blocks", near.alias("near"))
    # Without a line that holds a first word no run of words holds one.
    words = F.when(F.col("phrased") | (F.size("near") > 0), F.flatten("blocks"))
    held = held.select("doc_id", words.alias("words"), F.aggregate("blocks", F.lit(0), lambda n, b: n + F.size(b)).cast("long").alias("n_words"), "near")

    def wrapped(number: int) -> Column:
        """Largest share of template ``number`` in a run of words, whatever lines it stands on."""
        whole = F.array(*map(F.lit, ordered[number][1]))
        length = REACH * len(templates[number][1].split())
        # A best run can start at a word of the template: moved there, it loses none.
        starts = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains(whole, F.col("words")[i]))
        best = F.array_max(F.transform(starts, lambda i: containment(F.slice("words", i + 1, F.lit(length)), number)))
        return F.when(containment(F.col("words"), number).isNotNull(), best)

    def largest(number: int) -> Column:
        return F.greatest(F.array_max(F.transform("near", lambda b: containment(b, number))), wrapped(number))

    best = [largest(k) for k in range(len(ordered))]
    places = [F.coalesce(_places(F.col("words"), p), F.array().cast("array<int>")) for p in phrase_words]
    held = held.select(
        "doc_id",
        "n_words",
        F.array(*places).alias("places") if places else F.array().cast("array<array<int>>").alias("places"),
        F.when(F.size("near") > 0, F.array(*best)).alias("shares") if best else F.lit(None).cast("array<double>").alias("shares"),
    )
    every = F.flatten("places")
    base = [F.when(F.size(F.col("places")[k]) > 0, F.lit(label)) for k, (_, label) in enumerate(phrases)]
    own = [F.when(F.col("shares")[k].isNotNull(), F.lit(label)) for k, (label, _) in enumerate(ordered)]

    def joined(labels: list[Column]) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",") if labels else F.lit("")

    return held.select(
        "doc_id",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined([*base, *own]).alias("labels"),
        F.when(F.size(every) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("shares"), F.lit(0.0))).alias("score"),
    )


def oracle() -> str:
    """The scan in DuckDB's SQL, without filters: every line against every template."""
    word = WORD.replace("'", "''")
    templates = ", ".join(f"('{label}', {sorted(set(text.split()))!r})" for label, text in TEMPLATES)
    places = []
    for phrase, _ in PHRASES:
        parts = phrase.split()
        test = " AND ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(parts))
        places.append(f"list_filter(range(1, len(w) - {len(parts) - 2}), lambda i: {test})")
    labels = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(PHRASES))
    return f"""
WITH t(label, words) AS (VALUES {templates}),
d AS (SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS f FROM documents),
l AS (SELECT r, unnest(string_split(f, chr(10))) AS line FROM d),
b AS (SELECT r, list_distinct(regexp_extract_all(line, '{word}')) AS ws FROM l),
m AS (SELECT r, label, max(len(list_intersect(words, ws)) / len(words)) AS share FROM b, t
      WHERE len(list_intersect(words, ws)) >= ceil({THRESHOLD} * len(words) - 1e-9) GROUP BY r, label),
s AS (SELECT r, list(label) AS own, max(share) AS share FROM m GROUP BY r),
w AS (SELECT doc_id, r, regexp_extract_all(f, '{word}') AS w FROM d),
p AS (SELECT doc_id, r, len(w) AS n_words, {", ".join(f"{x} AS p{k}" for k, x in enumerate(places))} FROM w),
q AS (SELECT *, flatten([{", ".join(f"p{k}" for k in range(len(PHRASES)))}]) AS every,
             list_filter([{labels}], lambda x: x IS NOT NULL) AS base FROM p)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(every) AS BIGINT) AS n_base,
       CAST(list_min(every) - 1 AS BIGINT) AS first_word, CAST(list_max(every) - 1 AS BIGINT) AS last_word,
       array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(own, [])))), ',') AS labels,
       CASE WHEN len(every) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM q LEFT JOIN s USING (r)
"""
