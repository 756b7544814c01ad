"""License scans by MinHash bands over overlapping text windows, in DataFrame operations only.

Words are runs of letters and digits, lower-cased. A text's word pairs are cut into windows of WINDOW pairs that
move by STEP, and so are the templates'. Each window has BANDS minima, one for each mask that is XORed into the
64-bit hashes of its pairs; every minimum is a band of its own. A notice of four pairs, the shortest here, lies
whole in some window, which shares a given band with it with a chance of 4/6, so that all BANDS fail with
a chance of 3**-BANDS (0.02 %) at most; longer ones have such shares in several windows. The templates'
minima are a bounded table, as the list of templates is a parameter.

What a band retrieves is verified exactly: of the template's shingles of five words (all of it, if it has fewer)
CONTAINMENT or more must occur in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

WINDOW, STEP, BANDS = 6, 3, 8
SHINGLE, CONTAINMENT = 5, 0.8
#: License notices, as their licenses recommend or as they are commonly written.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: One mask for each band: multiples of the 64-bit golden ratio.
MASKS = [((i + 1) * 0x9E3779B97F4A7C15) % 2**64 - 2**63 for i in range(BANDS)]


def _once(column: Column) -> Column:
    """The column, computed once a row: the optimizer copies no expression from above into or below a generator."""
    return F.explode(F.array(column))


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.array().cast("array<string>"))


def _pairs(words: Column) -> Column:
    one = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i)))
    return F.when(F.size(words) >= 2, one).otherwise(F.array().cast("array<bigint>"))


def _masked(pairs: Column) -> Column:
    one = lambda mask: F.transform(pairs, lambda x: x.bitwiseXOR(F.lit(mask)))
    return F.array(*map(one, MASKS))


def _minima(masked: Column) -> Column:
    """The minima of all windows, from the pairs under one mask."""
    at = F.sequence(F.lit(0), F.size(masked) - 1, F.lit(STEP))
    low = F.transform(at, lambda s: F.array_min(F.slice(masked, s + 1, WINDOW)))
    return F.when(F.size(masked) > 0, low).otherwise(F.array().cast("array<bigint>"))


def _shingles(words: Column) -> Column:
    n = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    every = F.transform(F.sequence(F.lit(0), n), lambda i: F.array_join(F.slice(words, i + 1, SHINGLE), " "))
    return F.when(F.size(words) > 0, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def _templates(spark, templates: dict[str, str]) -> DataFrame:
    """(template, band, minimum, shingles): BANDS rows for each window of each template."""
    t = spark.createDataFrame(sorted(templates.items()), "template string, notice string").withColumn("words", _words(F.col("notice")))
    t = t.select("template", _masked(_pairs(F.col("words"))).alias("masked"), _shingles(F.col("words")).alias("shingles"))
    band = lambda i: F.transform(_minima(F.col("masked")[i]), lambda m: F.struct(F.lit(i).alias("band"), m.alias("minimum")))
    return t.select("template", "shingles", F.inline(F.concat(*map(band, range(BANDS))))).distinct()


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document and template found in it: doc_id, template, n_found, n_shingles, containment.

    A null text and one of fewer than two words match nothing. Repeated rows give repeated results; other
    columns are ignored; an empty table gives an empty result.
    """
    known = _templates(docs.sparkSession, templates or TEMPLATES)
    of_band = {r["band"]: r["minima"] for r in known.groupBy("band").agg(F.collect_set("minimum").alias("minima")).collect()}
    hit = lambda i: F.transform(F.filter(_minima(F.col("masked")[i]), lambda m: m.isin(of_band[i])), lambda m: F.struct(F.lit(i).alias("band"), m.alias("minimum")))
    d = docs.select("doc_id", _once(_words(F.col("text"))).alias("words")).select("doc_id", "words", _once(_pairs(F.col("words"))).alias("pairs"))
    d = d.select("doc_id", "words", _once(_masked(F.col("pairs"))).alias("masked"))
    d = d.select("doc_id", "words", _once(F.array_distinct(F.concat(*[hit(i) for i in sorted(of_band)]))).alias("hits")).where(F.size("hits") > 0)
    # templates are named within each document's row, so that repeated rows stay apart
    listed = known.groupBy("band", "minimum").agg(F.collect_set(F.struct("template", "shingles")).alias("t"))
    table = F.broadcast(listed.agg(F.map_from_entries(F.collect_list(F.struct(F.struct("band", "minimum"), "t"))).alias("named")))  # one row, of the templates alone
    named = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.col("named")[h])))
    d = d.join(table).select("doc_id", _once(_shingles(F.col("words"))).alias("own"), named.alias("t")).select("doc_id", "own", F.explode("t").alias("t"))
    found = F.size(F.array_intersect(F.col("t.shingles"), F.col("own")))
    out = d.select("doc_id", F.col("t.template").alias("template"), found.alias("n_found"), F.size("t.shingles").alias("n_shingles"))
    return out.withColumn("containment", F.col("n_found") / F.col("n_shingles")).where(F.col("containment") >= containment)


def op2_license_scan(spark, sf_dir):
    return license_matches(documents(spark, sf_dir))


def _sql() -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in sorted(TEMPLATES.items()))
    shingles = f"list_distinct(list_transform(range(0, greatest(len(w) - {SHINGLE}, 0) + 1), lambda i: array_to_string(w[i + 1 : i + {SHINGLE}], ' ')))"
    return rf"""
WITH t AS (SELECT template, regexp_extract_all(lower(notice), '[\p{{L}}\p{{N}}]+') AS w FROM (VALUES {rows}) v(template, notice)),
ts AS (SELECT template, {shingles} AS s FROM t),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
ds AS (SELECT doc_id, unnest({shingles}) AS g FROM d WHERE len(w) >= 2),
tg AS (SELECT template, len(s) AS n_shingles, unnest(s) AS g FROM ts),
m AS (SELECT doc_id, template, n_shingles, count(*) AS n_found FROM ds JOIN tg USING (g) GROUP BY ALL)
SELECT doc_id, template, n_found::INT AS n_found, n_shingles::INT AS n_shingles, n_found::DOUBLE / n_shingles AS containment
FROM m WHERE n_found::DOUBLE / n_shingles >= {CONTAINMENT}
"""


SQL = _sql()
