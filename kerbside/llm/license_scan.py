"""License scans with DataFrame operations only.

A text's words are cut into overlapping windows of a few five-word shingles. Every window has a MinHash value a band; a band in
which a window of the text and one of a template agree retrieves the template. Exact containment of the template's shingles in
the text's then verifies it.

Texts and templates have a window at every STRIDE words, so any two shingles that stand side by side in both share a whole window,
which agrees in every band: a template copied whole, or with some words changed, is retrieved for certain. A shingle that stands
between different neighbours on the two sides, or that is all there is of a template, is retrieved by a band in which it comes before one
neighbour on each side. The bands' orders come in opposite pairs, so of any two shingles each comes first in half of the bands: a template
of one shingle, which has no neighbour of its own, is retrieved for certain too.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 5
WINDOW = 2
STRIDE = 1
BANDS = 8
PERCENT = 80
#: Shingles of all templates together.
MOST_SHINGLES = 10_000

# Short notices by which works name their license, by the license's SPDX identifier.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "LGPL-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    "AGPL-header": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT-warranty": "The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability",
    "Apache-2.0-warranty": "software distributed under the License is distributed on an as is basis, without warranties or conditions of any kind",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "BSL-1.0": "Boost Software License, Version 1.0",
    "reserved": "All rights reserved.",
}


def words_of(text: Column) -> Column:
    """Runs of ASCII letters and digits, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))


def _shingles(words: Column, bare: Column) -> Column:
    """Hashes of all five-word shingles, followed by those of short phrases."""
    long = F.transform(F.sequence(F.lit(1), F.size(words) - (SIZE - 1)), lambda i: F.xxhash64(*(F.get(words, i + (k - 1)) for k in range(SIZE))))
    return F.concat(F.when(F.size(words) >= SIZE, long).otherwise(F.array().cast("array<long>")), bare)


#: What ends a phrase: the ends of lines, and punctuation before white space or at the end of the text.
BREAKS = r"\n|[.,;:!?()]+(?:\s|$)"


def _short_phrases(text: Column) -> Column:
    """A hash for each phrase of one to four words."""
    found = F.transform(F.split(F.lower(text), BREAKS), lambda x: F.regexp_extract_all(x, F.lit("([a-z0-9]+)"), F.lit(1)))
    return F.transform(F.filter(found, lambda w: F.size(w).between(1, SIZE - 1)), lambda w: F.xxhash64(F.array_join(w, " ")))


#: The order of hashes XORed with a mask is a band's permutation; every second mask turns the order before it round.
_DRAWN = [int.from_bytes(hashlib.sha256(f"band {b}".encode()).digest()[:8], "big", signed=True) for b in range(BANDS // 2)]
_MASKS = [m for drawn in _DRAWN for m in (drawn, ~drawn)]


def _bands(hashes: Column, stride: int) -> Column:
    """The MinHash values of all windows in all bands; a text's last windows may be shorter."""

    def window(i: Column) -> Column:
        return F.array(*(F.least(*(F.get(hashes, i + k).bitwiseXOR(F.lit(m)) for k in range(WINDOW))) for m in _MASKS))

    starts = F.sequence(F.lit(0), F.size(hashes) - 1, F.lit(stride))
    return F.when(F.size(hashes) > 0, F.flatten(F.transform(starts, window))).otherwise(F.array().cast("array<long>"))


def _hashed(rows: DataFrame, named: list[str] | None = None) -> DataFrame:
    """(id, hashes) of (id, text) rows; short phrases only of texts that hold one of the words ``named``, if given."""
    bare = _short_phrases(F.col("text"))
    if named is not None:
        holds = [F.contains(F.lower("text"), F.lit(w)) for w in named]
        bare = F.when(reduce(Column.__or__, holds, F.lit(False)), bare).otherwise(F.array().cast("array<long>"))
    parted = rows.select("id", words_of(F.col("text")).alias("words"), bare.alias("bare"))
    return parted.select("id", _shingles(F.col("words"), F.col("bare")).alias("hashes"))


def _plain_words(text: str) -> str:
    """A template's words: it has no phrases, or is one."""
    return " ".join(re.findall("[a-z0-9]+", text.lower()))


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, template, n_shingles, n_matched and containment of each template that a whole text contains.

    A template is contained if at least ``percent`` % of its distinct shingles are among the text's. A template of fewer than five
    words is one shingle, found where a text has it as a phrase of its own: between line ends or punctuation, as in "Copyright
    2024, all rights reserved.". Null and empty texts contain nothing; of repeated rows of an id the best counts, once. Texts of any
    length are scanned whole, in one row. Other columns are not read. Band values of the templates are literals and their
    shingles are broadcast, so a library of more than MOST_SHINGLES shingles is refused.
    """
    spark: SparkSession = docs.sparkSession
    plain = [(name, _plain_words(text)) for name, text in sorted(templates.items())]
    library = _hashed(spark.createDataFrame(plain, "id string, text string"))
    known = library.select("id", F.array_distinct("hashes").alias("own"), F.array_distinct(_bands(F.col("hashes"), 1)).alias("keys")).collect()
    if sum(len(r["own"]) for r in known) > MOST_SHINGLES:
        raise ValueError(f"a library of more than {MOST_SHINGLES} shingles")
    own = F.broadcast(spark.createDataFrame([(r["id"], r["own"]) for r in known], "template string, own array<long>"))
    owners: dict[int, list[str]] = {}
    for r in known:
        for key in r["keys"]:
            owners.setdefault(key, []).append(r["id"])
    named = F.from_json(F.lit(json.dumps(owners)), "map<string,array<string>>")
    # A text without the longest word of any short template has no phrase that matters.
    short = sorted({max(t.split(), key=len) for _, t in plain if 0 < len(t.split()) < SIZE})
    hashed = _hashed(docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), short)
    hits = F.array_distinct(F.filter(_bands(F.col("hashes"), STRIDE), lambda k: k.isin(*map(F.lit, sorted(owners)))))
    # Each template that any key retrieves is verified once.
    retrieved = F.array_distinct(F.flatten(F.transform("hits", lambda k: F.element_at(named, k.cast("string")))))
    # The outer explode keeps the filter above it: below, it would have all hashes computed twice.
    met = hashed.withColumn("hits", hits).select("id", "hashes", F.explode_outer(retrieved).alias("template")).where("template is not null")
    checked = met.join(own, "template").select("id", "template", F.size("own").alias("n"), F.size(F.array_intersect("own", "hashes")).alias("m"))
    contained = checked.where(F.col("m") * 100 >= F.col("n") * percent).groupBy("id", "template").agg(F.max("n").alias("n"), F.max("m").alias("m"))
    return contained.select(
        F.col("id").alias("doc_id"), "template", F.col("n").cast("long").alias("n_shingles"), F.col("m").cast("long").alias("n_matched"),
        (F.col("m") / F.col("n")).alias("containment"),
    )


def containment_sql(templates: dict[str, str] = TEMPLATES, percent: int = PERCENT) -> str:
    """The same rows from comparing every text with every template, for DuckDB."""
    quoted = ", ".join("('{}', '{}')".format(k, _plain_words(v)) for k, v in sorted(templates.items()))
    shingled = """
        SELECT id, list_distinct(list_concat(
            CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) ELSE [] END,
            list_transform(list_filter(list_transform(regexp_split_to_array(lower(text), '\\n|[.,;:!?()]+(?:\\s|$)'),
                lambda x: regexp_extract_all(x, '[a-z0-9]+')), lambda w: len(w) BETWEEN 1 AND 4), lambda w: array_to_string(w, ' '))
        )) AS own FROM (SELECT id, text, regexp_extract_all(lower(text), '[a-z0-9]+') AS words FROM {rows})"""
    return f"""
        WITH library(id, text) AS (VALUES {quoted}), t AS ({shingled.format(rows="library")}),
        d AS ({shingled.format(rows="(SELECT doc_id AS id, text FROM documents WHERE text IS NOT NULL)")}),
        both_sides AS (SELECT d.id AS doc_id, t.id AS template, len(t.own) AS n, len(list_intersect(t.own, d.own)) AS m FROM d, t)
        SELECT doc_id, template, n::BIGINT AS n_shingles, m::BIGINT AS n_matched, m / n AS containment FROM both_sides WHERE m * 100 >= n * {percent}"""
