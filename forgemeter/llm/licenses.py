"""Licence notices in documents by diagonal voting.

1. Every word k-gram of a text that begins with a word some template k-gram begins with is joined,
   by hash and then by its words, to the places of the templates that have it. All other k-grams can
   match nothing, so they are left in the row.
2. A hit votes for a diagonal: its place in the text less its place in the template. A copied
   passage is one diagonal; a word put in or left out moves the rest to a neighbouring one.
3. Diagonals of one text and template that lie close together, in the text and in offset, are merged.
4. A merged span is verified: the template words it covers are a share of all the template's words,
   and not scattered over too much text.

All of it is column functions, joins, aggregates and one window over the diagonals of one text
and template. Rows are told apart by doc_id and 128 bits of the text, so equal rows get equal results and
are counted once; a null text is an empty one. Templates come from the driver as a short list; the join
broadcasts them only up to BROADCAST_WORDS words in all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgemeter.llm import tables

GRAM = 4
# Diagonals so near, in words, are one span.
BAND = 6
GAP = 12
# Shares of the template's words, and of the span's words in the text, that a confirmed span covers.
CONFIRMED = 0.6
DENSE = 0.5
BROADCAST_WORDS = 200_000
# With more different first words than this the k-grams are not filtered by them.
FIRST_WORDS = 5_000

# The phrases and labels of the base rule.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices and licence texts by the label they give.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the "
        "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
        "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation",
    ),
    (
        "lgpl",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies.",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    """The words of a text in lower case: digits, a-z, and every character beyond ASCII."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, _BETWEEN), "")


def _grams(words: Column, starts: Column) -> Column:
    """(at, hash, gram) of the k-grams that begin at these places, counted from 1."""

    def gram(at: Column) -> Column:
        return F.array_join(F.slice(words, at, GRAM), " ")

    return F.transform(
        starts, lambda at: F.struct(at.alias("at"), F.xxhash64(gram(at)).alias("hash"), gram(at).alias("gram"))
    )


def _starts(words: Column, first_words: Sequence[str] | None) -> Column:
    """Places where a whole k-gram begins, of those with such a first word if these are given."""
    last = F.size(words) - (GRAM - 1)
    places = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(
        F.array().cast("array<int>")
    )
    if first_words is None:
        return places
    return F.filter(places, lambda at: F.element_at(words, at).isin(list(first_words)))


def template_places(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """(template, label, size, hash, gram, t): every k-gram of every template."""
    rows = F.array(
        *[F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("body"))
          for i, (label, text) in enumerate(templates)]
    )
    listed = spark.range(1).select(F.inline(rows)).withColumn("words", license_words(F.col("body")))
    found = F.explode(_grams(F.col("words"), _starts(F.col("words"), None)))
    return listed.select("template", "label", F.size("words").alias("size"), found.alias("g")).select(
        "template", "label", "size", "g.hash", "g.gram", F.col("g.at").alias("t")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
        license_words(text).alias("words"),
    )


KEY = ("doc_id", "h1", "h2")


def hits(docs: DataFrame, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """(key, template, label, size, at, t): places of texts that hold a template's k-gram."""
    spark = docs.sparkSession
    places = template_places(spark, templates)
    bodies = [text for _, text in templates]
    size = sum(len(text.split()) for text in bodies)
    # What a k-gram can begin with; the driver holds the templates anyway.
    first = {r["w"] for r in places.select(F.substring_index("gram", " ", 1).alias("w")).distinct().collect()}
    first_words = sorted(first) if len(first) <= FIRST_WORDS else None
    grams = _keyed(docs).select(
        *KEY, F.inline(_grams(F.col("words"), _starts(F.col("words"), first_words)))
    )
    small = F.broadcast(places) if size <= BROADCAST_WORDS else places
    return grams.join(small, ["hash", "gram"]).select(*KEY, "template", "label", "size", "at", "t")


def spans(found: DataFrame) -> DataFrame:
    """(key, label, template, first, last, coverage, confirmed) of the merged diagonals."""
    votes = found.groupBy(*KEY, "template", "label", "size", (F.col("at") - F.col("t")).alias("diagonal")).agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.collect_set("t").alias("ts")
    )
    order = Window.partitionBy(*KEY, "template").orderBy("first", "diagonal")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    apart = (F.col("first") > F.max("last").over(before) + GRAM + GAP) | (
        F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > BAND
    )
    numbered = votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn(
        "span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    merged = numbered.groupBy(*KEY, "template", "label", "size", "span").agg(
        F.min("first").alias("first"),
        (F.max("last") + GRAM - 1).alias("last"),
        F.flatten(F.collect_list("ts")).alias("ts"),
    )
    covered = F.size(
        F.array_distinct(F.flatten(F.transform("ts", lambda t: F.sequence(t, t + F.lit(GRAM - 1)))))
    )
    share = covered / F.col("size")
    dense = covered >= DENSE * (F.col("last") - F.col("first") + 1)
    return merged.select(
        *KEY, "label", "template", "first", "last", share.alias("coverage"),
        ((share >= CONFIRMED) & dense).alias("confirmed"),
    )


def _base(docs: DataFrame) -> DataFrame:
    """The base rule of each row: how often, where, and which phrases."""
    words = F.col("words")
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    inside = [F.contains(F.col("joined"), F.lit(f" {phrase} ")) for phrase, _ in PHRASES]

    def begins(at: Column) -> Column:
        tests = []
        for phrase, _ in PHRASES:
            parts = phrase.split(" ")
            same = [F.get(words, at + i) == part for i, part in enumerate(parts)]
            test = same[0]
            for other in same[1:]:
                test = test & other
            tests.append(test)
        either = tests[0]
        for test in tests[1:]:
            either = either | test
        return F.coalesce(either, F.lit(False))

    some = inside[0]
    for test in inside[1:]:
        some = some | test
    none = F.array().cast("array<int>")
    places = F.when(some, F.filter(F.sequence(F.lit(0), F.size(words)), begins)).otherwise(none)
    labels = F.array_compact(F.array(*[F.when(t, F.lit(label)) for t, (_, label) in zip(inside, PHRASES)]))
    return (
        _keyed(docs)
        .withColumn("joined", joined)
        .select(*KEY, F.size(words).cast("long").alias("n_words"), places.alias("places"), labels.alias("base"))
    )


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score and the confirmed ``spans`` (label, first, last, coverage; words from 0).

    ``score`` is 1 with a base phrase, else the greatest share of a template's words that one span covers. A
    null or blank text has no words and no labels; a null doc_id is kept; other columns are ignored."""
    found = tables.stage(spans(hits(docs, templates)), "license-spans")
    where = F.struct(
        "label", (F.col("first") - 1).alias("first"), (F.col("last") - 1).alias("last"), "coverage"
    )
    voted = found.groupBy(*KEY).agg(
        F.max("coverage").alias("best"),
        F.collect_set(F.when(F.col("confirmed"), F.col("label"))).alias("own"),
        F.sort_array(F.collect_list(F.when(F.col("confirmed"), where))).alias("spans"),
    )
    base = _base(docs)
    same = (
        base["doc_id"].eqNullSafe(voted["doc_id"]) & (base["h1"] == voted["h1"]) & (base["h2"] == voted["h2"])
    )
    own = F.coalesce("own", F.array().cast("array<string>"))
    return base.join(voted, same, "left").select(
        base["doc_id"],
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", own)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        "spans",
    )


def op13_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan(tables.read_table(spark, folder, "documents")).drop("spans")


def _sql() -> str:
    quoted = ", ".join(
        "({}, '{}', '{}')".format(i, label, text.replace("'", "''")) for i, (label, text) in enumerate(TEMPLATES)
    )
    phrases = ", ".join(f"('{phrase}', '{label}')" for phrase, label in PHRASES)
    return rf"""
        WITH templates(template, label, body) AS (VALUES {quoted}),
        phrases(phrase, label) AS (VALUES {phrases}),
        docs AS (
            SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_BETWEEN}'), lambda x: x <> '') AS ws
            FROM documents),
        bodies AS (
            SELECT template, label, list_filter(regexp_split_to_array(
                translate(body, '{_UPPER}', '{_LOWER}'), '{_BETWEEN}'), lambda x: x <> '') AS ws
            FROM templates),
        t AS (
            SELECT template, label, len(ws) AS size, p AS t, array_to_string(ws[p:p + {GRAM - 1}], ' ') AS gram
            FROM bodies, unnest(generate_series(1, len(ws) - {GRAM - 1})) u(p)),
        g AS (
            SELECT r, p AS "at", array_to_string(ws[p:p + {GRAM - 1}], ' ') AS gram
            FROM docs, unnest(generate_series(1, len(ws) - {GRAM - 1})) u(p)),
        votes AS (
            SELECT r, template, label, size, "at" - t AS diagonal, min("at") AS first, max("at") AS last,
                list(t) AS ts
            FROM g JOIN t USING (gram) GROUP BY ALL),
        marked AS (
            SELECT *, CASE WHEN first > max(last) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                        + {GRAM + GAP}
                    OR abs(diagonal - lag(diagonal) OVER w) > {BAND} THEN 1
                WHEN lag(diagonal) OVER w IS NULL THEN 1 ELSE 0 END AS new
            FROM votes WINDOW w AS (PARTITION BY r, template ORDER BY first, diagonal)),
        numbered AS (
            SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY first, diagonal
                ROWS UNBOUNDED PRECEDING) AS span FROM marked),
        merged AS (
            SELECT r, label, size, min(first) AS first, max(last) + {GRAM - 1} AS last,
                len(list_distinct(flatten(list_transform(flatten(list(ts)),
                    lambda x: generate_series(x, x + {GRAM - 1}))))) AS covered
            FROM numbered GROUP BY r, template, label, size, span),
        voted AS (
            SELECT r, max(covered / size) AS best, list(DISTINCT label) FILTER (
                WHERE covered / size >= {CONFIRMED} AND covered >= {DENSE} * (last - first + 1)) AS own
            FROM merged GROUP BY r),
        placed AS (
            SELECT r, p - 1 AS place, phrases.label
            FROM docs, unnest(generate_series(1, len(ws))) u(p), phrases
            WHERE ws[p] = string_split(phrase, ' ')[1]
                AND array_to_string(ws[p:p + len(string_split(phrase, ' ')) - 1], ' ') = phrase),
        base AS (
            SELECT r, count(*) AS n, min(place) AS first, max(place) AS last, list(DISTINCT label) AS labels
            FROM placed GROUP BY r)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base,
            base.first::BIGINT AS first_word, base.last::BIGINT AS last_word,
            array_to_string(list_sort(coalesce(labels, [])), ',') AS base_labels,
            array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), coalesce(own, [])))), ',')
                AS labels,
            CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
        FROM docs LEFT JOIN voted USING (r) LEFT JOIN base USING (r)
    """


QUERIES = {"op13_licenses": op13_licenses}
ORACLES = {"op13_licenses": _sql()}
