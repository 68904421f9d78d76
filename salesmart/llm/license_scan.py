"""License notices in texts by diagonal voting.

Every run of three words of every text is hashed and joined with the places that the run has in the
templates. A match votes for the *diagonal* (place in the text minus place in the template): votes
of an exact copy share one. Votes are added up per text, template and diagonal; neighbouring
diagonals, as inserted or missing words make them, are merged into one span; and spans are verified
on the words themselves: a template's word counts where the text has it on a diagonal of the span.
A span is a finding if it covers at least ``COVERED`` of its template and no notice that overlaps it
shows more of its own words, or as many of fewer (versions of one license differ in a word). Phrases have to stand as
they are, word by word, on one diagonal.

The templates are a fixed list, so their table is broadcast. Only votes are shuffled, and only texts
with votes; the key is a 128-bit hash of the text, as equal texts have equal findings. The number of
votes of a text is bounded by its length.

Words are those of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z. Defined results: a NULL
text is an empty text and has no words and no findings; texts with fewer words than three have no
findings; every row is returned once, also equal rows and rows without an id; findings that tie are
all returned. Columns of the caller are kept; one that has the name of a result gives way to it. An
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import let, maybe_among, or_empty, quoted, with_columns
from salesmart.workspace import Workspace

#: Words of a run. No template is shorter.
RUN = 3

#: Merged diagonals are at most so far apart, in words.
NEAR = 4

#: Part of a template's words that a finding has.
COVERED = 0.8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a license, and its label.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# The public notices by which works state their license, and its label.
NOTICES = [
    ("agpl-3", "you can redistribute it and/or modify it under the terms of the GNU Affero General "
     "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a "
     "copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("boost-1", "Distributed under the Boost Software License, Version 1.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "has waived all copyright and related or neighboring rights to this work"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl-2", "under the terms of the GNU General Public License as published by the Free Software "
     "Foundation; either version 2 of the License"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-3", "under the terms of the GNU General Public License as published by the Free Software "
     "Foundation, either version 3 of the License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies."),
    ("lgpl-2", "under the terms of the GNU Lesser General Public License as published by the Free "
     "Software Foundation; either version 2.1 of the License"),
    ("lgpl-3", "under the terms of the GNU Lesser General Public License as published by the Free "
     "Software Foundation, either version 3 of the License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software without "
     "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event "
     "will the authors be held liable for any damages arising from the use of this software."),
]


def license_words(text: Column) -> Column:
    """Words of a text with small letters, in order; NULL has none."""
    return F.array_remove(F.split(F.translate(or_empty(text), UPPER, LOWER), BETWEEN), "")


def templates(spark) -> DataFrame:
    """(template, label, phrase, wanted): the words of each template."""
    rows = [(label, text, kind) for kind, found in ((True, PHRASES), (False, NOTICES))
            for label, text in found]
    table = spark.createDataFrame(
        [(n, *row) for n, row in enumerate(rows)], "template int, label string, text string, phrase boolean")
    return table.select("template", "label", "phrase", license_words(F.col("text")).alias("wanted"))


def runs(words: Column) -> Column:
    """Hashes of all runs of `RUN` words, in order."""
    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return let(hashes, lambda h: F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - (RUN - 1), F.lit(0))),
        lambda first, i: F.xxhash64(first, *[F.get(h, i + k) for k in range(1, RUN)]),
    ))


def votes(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(k1, k2, template, diagonal, first, last): where runs of the texts meet a template."""
    places = known.select("template", F.posexplode(runs(F.col("wanted"))).alias("at", "run"))
    words = rows.select("k1", "k2", license_words(F.col("text")).alias("words"))
    listed = words.select("k1", "k2", F.posexplode(runs(F.col("words"))).alias("place", "run"))
    met = listed.join(F.broadcast(places), "run")
    diagonal = (F.col("place") - F.col("at")).alias("diagonal")
    return met.groupBy("k1", "k2", "template", diagonal).agg(
        F.min("place").alias("first"), F.max("place").alias("last"))


def merged(voted: DataFrame) -> DataFrame:
    """(k1, k2, template, diagonals) of each span: neighbouring diagonals whose votes are near."""
    text = Window.partitionBy("k1", "k2", "template").orderBy("diagonal")
    far = (
        (F.col("diagonal") - F.lag("diagonal").over(text) > NEAR)
        | (F.col("first") - F.lag("last").over(text) > RUN + NEAR)
        | (F.lag("first").over(text) - F.col("last") > RUN + NEAR)
    )
    spans = voted.withColumn("far", F.coalesce(far, F.lit(True)).cast("int")).withColumn(
        "span", F.sum("far").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy("k1", "k2", "template", "span").agg(
        F.sort_array(F.collect_list("diagonal")).alias("diagonals"),
        F.min("first").alias("first"), (F.max("last") + RUN).alias("after"),
    ).drop("span")


def _verified(words: Column, span: Column) -> Column:
    """The span with the part of its template that the words show, and exact places of it."""
    size = F.size(span["wanted"])
    shown = F.filter(
        span["wanted"],
        lambda word, i: F.exists(span["diagonals"], lambda d: F.get(words, d + i) == word),
    )
    exact = F.filter(
        span["diagonals"],
        lambda d: (d >= 0) & (F.slice(words, F.greatest(d, F.lit(0)) + 1, size) == span["wanted"]),
    )
    return F.struct(
        span["label"].alias("label"), span["template"].alias("template"), span["phrase"].alias("phrase"),
        span["first"].alias("first_word"), span["after"].alias("after_word"),
        F.size(shown).alias("shown"), (F.size(shown) / size).alias("covered"), exact.alias("places"),
    )


def _findings(words: Column, spans: Column) -> Column:
    """Spans that are findings."""
    def enough(span):
        return F.when(span["phrase"], F.size(span["places"]) > 0).otherwise(span["covered"] >= COVERED)

    def beaten(span, other):
        overlap = ((other["first_word"] < span["after_word"])
                   & (span["first_word"] < other["after_word"]))
        better = (other["shown"] > span["shown"]) | (
            (other["shown"] == span["shown"]) & (other["covered"] > span["covered"]))
        return ~span["phrase"] & ~other["phrase"] & overlap & better

    found = F.filter(F.transform(spans, lambda span: _verified(words, span)), enough)
    return let(found, lambda found: F.filter(
        found, lambda span: ~F.exists(found, lambda other: beaten(span, other))))


FINDING = ("array<struct<label:string,template:int,phrase:boolean,first_word:int,after_word:int,"
           "shown:int,covered:double,places:array<int>>>")


def scan(docs: DataFrame, space: Workspace, text: str = "text") -> DataFrame:
    """``docs`` with n_words and licenses: findings (label, template, phrase, first_word,
    after_word, shown, covered, places), by template and place. ``places`` are those where the whole
    template stands."""
    names = [name for name in docs.columns if name.lower() not in ("n_words", "licenses")]
    value = docs[quoted(text)].cast("string")
    key = [or_empty(value)]  # equal texts have equal findings, so a text is its own key
    rows = docs.select(
        F.struct(F.lit(0).alias("_"), *map(quoted, names)).alias("row"), or_empty(value).alias("text"),
        F.xxhash64(*key).alias("k1"), F.xxhash64(F.lit("second"), *key).alias("k2"),
    )
    known = templates(docs.sparkSession)
    spans = merged(votes(rows, known)).join(F.broadcast(known), "template")
    found = spans.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct(
        "template", "first", "after", "label", "phrase", "wanted", "diagonals"))).alias("spans"))
    found = space.store("spans", found)  # read by both branches below
    without = maybe_among(rows, found, "k1", "left_anti").select(
        "row", F.size(license_words(F.col("text"))).cast("bigint").alias("n_words"),
        F.array().cast(FINDING).alias("licenses"),
    )
    perhaps = maybe_among(rows, found, "k1").join(found, ["k1", "k2"], "left")
    checked = perhaps.select("row", "spans", license_words(F.col("text")).alias("words")).select(
        "row", F.size("words").cast("bigint").alias("n_words"),
        F.when(F.col("spans").isNull(), F.array().cast(FINDING))
        .otherwise(_findings(F.col("words"), F.col("spans")).cast(FINDING)).alias("licenses"),
    )
    both = checked.unionByName(without)
    back = [F.col(f"row.{quoted(name)}").alias(name) for name in names]
    return both.select(*back, "n_words", "licenses")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query from those of `scan`."""
    phrases = F.filter("licenses", lambda s: s["phrase"])
    starts = F.flatten(F.transform(phrases, lambda s: s["places"]))
    labels = lambda spans: F.array_join(
        F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    score = F.array_max(F.transform("licenses", lambda s: F.when(s["phrase"], 1.0).otherwise(s["covered"])))
    return found.select(
        "doc_id", "n_words", F.size(starts).cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"),
        labels(phrases).alias("base_labels"), labels(F.col("licenses")).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    )


def op11_licenses(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = with_columns(docs, {"doc_id": "bigint", "text": "string"})
    return digest(scan(docs, Workspace(spark)))
