"""License scans by MinHash bands over text windows, in DataFrame functions.

Words are runs of letters and digits, lower-cased; shingles are five words.
Templates are put in length classes: a class of ``M`` shingles (a power of
two) holds templates of more than ``M/2`` and at most ``M``.  A document's
windows for the class are ``2M - 1`` shingles long and start every ``M``, so
any run of ``M`` shingles lies whole in one window.

A window and a template are candidates if any of ``BANDS`` one-row bands of
their MinHash signatures agree.  A window that contains at least ``LEAST`` of
a template has a Jaccard similarity of at least 0.8 (M/2) / (0.2 (M/2) + 2M)
> 0.19 with it, so it is missed with a chance below 0.81 ** BANDS (2e-6).
A band can only agree where the window holds the template's smallest shingle
under that band's order, so windows that hold no shingle of any template of
their class need no signature; all others get one.

Candidates are verified exactly: the share of the template's distinct
shingles (as texts) that the window holds, at least ``LEAST``.

Templates are scanned in blocks of at most ``BLOCK_SHINGLES`` shingles, as
many passes as they need, so what a plan carries and broadcasts is bounded.

Edge cases: null, empty and short texts (under five words) match nothing,
and so do templates under five words; repeated rows and templates count
once; a null id is reported as null; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import stage

WORDS = 5
LEAST = 0.8
BANDS = 64
BLOCK_SHINGLES = 4000

# Usual wordings of public license notices.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mit", "Released under the MIT License."),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-2.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("lgpl-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl-2.1", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("lgpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nd-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-sa-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("cc-by-nc-nd-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by-nc-nd-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def notices(spark: SparkSession) -> DataFrame:
    """The built-in templates as ``(license, text)``."""
    rows = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(t).alias("text")) for k, t in NOTICES])
    return spark.range(1).select(F.inline(rows))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def _runs(words: Column) -> Column:
    """Start of every shingle (an empty array under five words)."""
    return F.when(F.size(words) >= WORDS, F.sequence(F.lit(1), F.size(words) - (WORDS - 1))).otherwise(F.array().cast("array<int>"))


def _hashes(words: Column) -> Column:
    return F.transform(_runs(words), lambda i: F.xxhash64(F.slice(words, i, WORDS)))


def _texts(words: Column) -> Column:
    return F.array_distinct(F.transform(_runs(words), lambda i: F.array_join(F.slice(words, i, WORDS), " ")))


def _signature(hashes: Column) -> Column:
    """Smallest hash under each of ``BANDS`` orders: the hash with its bits
    flipped by a random mask, compared as a number."""
    masks = F.array(*[F.xxhash64(F.lit("order"), F.lit(b)) for b in range(BANDS)])
    return F.transform(masks, lambda m: F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(m))))


def prepared(templates: DataFrame, license_col: str = "license", text_col: str = "text") -> DataFrame:
    """Staged ``(license, template, words, shingles, size, class)``."""
    words = templates.select(F.col(license_col).alias("license"), words_of(F.col(text_col)).alias("words")).where(F.size("words") >= WORDS).distinct()
    rows = words.withColumn("shingles", _texts(F.col("words"))).withColumn("size", F.size("shingles"))
    runs = F.size("words") - (WORDS - 1)
    cls = F.pow(F.lit(2.0), F.ceil(F.log2(runs.cast("double")))).cast("int")
    return stage(rows.withColumns({"class": cls, "template": F.xxhash64("license", "words")}), "license-templates")


def scan(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, license, containment)``: the best containment of each
    license found in each document."""
    ready = prepared(templates)
    total = ready.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-int(total) // BLOCK_SHINGLES))
    numbered = ready.withColumn("block", F.pmod("template", F.lit(blocks)))
    found = None
    for block in range(blocks):
        part = _scan_block(docs, numbered.where(F.col("block") == block).drop("block"), id_col, text_col)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"))


def _windows_hit(size: int, hashes: list[int]) -> Column:
    """Windows ``(class, k)`` of one class that hold a hit on its templates."""
    at = F.transform(F.filter("hits", lambda s: s["h"].isin(hashes)), lambda s: s["i"])
    windows = F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(F.floor(i / size) - 1, F.floor(i / size)))))
    return F.transform(F.filter(windows, lambda k: k >= 0), lambda k: F.struct(F.lit(size).alias("class"), k.alias("k")))


def _scan_block(docs: DataFrame, templates: DataFrame, id_col: str, text_col: str) -> DataFrame:
    # At most a block's shingles, which ``scan`` has counted.
    by_class: dict[int, set[int]] = {}
    for r in templates.select("class", F.explode(_hashes(F.col("words"))).alias("h")).collect():
        by_class.setdefault(r["class"], set()).add(r["h"])
    any_of = sorted(set().union(*by_class.values()))
    words = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    numbered = F.transform(_hashes(F.col("words")), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    # The row number keeps the filter below from being moved under this
    # projection, where the shingles would be hashed twice.
    hits = words.select("doc_id", F.monotonically_increasing_id().alias("row_no"), "words", F.filter(numbered, lambda s: s["h"].isin(any_of)).alias("hits"))
    hits = hits.where(F.size("hits") > 0)
    per_class = [_windows_hit(size, sorted(hashes)) for size, hashes in sorted(by_class.items())]
    none = F.array().cast("array<struct<class:int,k:bigint>>")
    each = hits.select("doc_id", "row_no", "words", F.explode(F.concat(none, *per_class)).alias("at"))
    length = 2 * F.col("at.class") - 1 + WORDS - 1
    windows = each.select("doc_id", "row_no", "at.class", "at.k", F.slice("words", (F.col("at.k") * F.col("at.class") + 1).cast("int"), length).alias("words"))
    windows = stage(windows, "license-windows")

    signed = lambda rows, *keys: rows.select(*keys, "class", F.posexplode(_signature(_hashes(F.col("words")))).alias("band", "value"))
    bands = signed(templates, "template")
    pairs = signed(windows, "row_no", "k").join(F.broadcast(bands), ["class", "band", "value"]).select("row_no", "class", "k", "template").distinct()
    checked = windows.join(pairs, ["row_no", "class", "k"]).join(F.broadcast(templates.select("template", "license", "shingles", "size")), "template")
    share = F.size(F.array_intersect(_texts(F.col("words")), F.col("shingles"))) / F.col("size")
    return checked.select("doc_id", "license", share.alias("containment")).where(F.col("containment") >= LEAST)
