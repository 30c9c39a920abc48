"""Licence scan: sparse TF-IDF cosine of lines and licence files to templates, then inheritance.

Every line of every file and every run of up to ``MOST_LINES`` neighbouring lines, in which a
wrapped header lies, is compared with the templates, and licence files (by name) also as a
whole. A run counts where it scores higher than all that it contains. The space has the templates' terms as axes; a term weighs its count times
``ln((1 + files) / (1 + files with it)) + 1``, counted over all files. Only lines with an
anchor term are compared: the terms of a template outside its anchors hold less than the
threshold of its length, so a line without anchors can't reach it. In the same way files and
runs are left out whose terms hold less than that of every template.

A file with a line or run above the threshold has that licence itself. A file that mostly is a
licence, or is named like one, is the licence file of its directory, and files without a
licence of their own take the one of the nearest directory above them.

All steps are DataFrame functions. Defined results: a null or empty text has no licence
of its own and inherits like any other; a null path is in no directory; rows that share
a path are one file; ties go to the smaller licence name, and of several licence files
in a directory the smallest path counts; an empty table gives an empty result. Only the
two named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.session import stage

THRESHOLD = 0.75
#: Share of its words in licence lines that makes a file a licence file.
FILE_SHARE = 0.3
#: Lines of a run at most: the longest template takes four at 72 columns, seven at 40.
MOST_LINES = 8
FILE_NAME = r"(?i)(^|/)(un)?(licen[cs]e|copying|notice)([.-][^/]*)?$"
PLACES = 9

# The customary notices of common licences.
TEMPLATES = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # Titles at the head of the licences' own texts, which tell one family's members apart.
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
SPLIT = "[^a-z0-9]+"


def tokens(text: str) -> list[str]:
    plain = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower())
    return plain.split()


def words(text: Column) -> Column:
    return F.split(F.lower(text), SPLIT)


def weights(counts: dict[str, int], files: int, templates=TEMPLATES) -> tuple[dict[str, float], list[dict[str, float]]]:
    """``(weight of one occurrence of each term, unit vector of each template)``."""
    terms = {t for _, text in templates for t in tokens(text)}
    idf = {t: math.log((1 + files) / (1 + counts.get(t, 0))) + 1 for t in terms}
    vectors = []
    for _, text in templates:
        own = tokens(text)
        raw = {t: own.count(t) * idf[t] for t in set(own)}
        length = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append({t: w / length for t, w in raw.items()})
    return idf, vectors


def anchors(vectors: list[dict[str, float]], threshold: float) -> list[str]:
    """Terms of which every line has one that reaches the threshold with some template."""
    found = set()
    for vector in vectors:
        rest = 0.0
        for term, w in sorted(vector.items(), key=lambda x: (x[1], x[0])):
            rest += w * w
            if rest >= (threshold * 0.999) ** 2:
                found.add(term)
    return sorted(found)


def within_reach(text: Column, vectors: list[dict[str, float]], threshold: float) -> Column:
    """Whether the text's terms hold enough of some template's length for the threshold."""
    part = lambda term, w: F.struct(F.lit(term).alias("term"), F.lit(w * w).alias("square"))
    templates = F.array(*(F.array(*(part(t, w) for t, w in sorted(v.items()))) for v in vectors))
    terms = F.array(*map(F.lit, sorted({t for v in vectors for t in v})))
    cut = (threshold * 0.999) ** 2
    held = lambda own, t: F.aggregate(t, F.lit(0.0), lambda a, p: a + F.when(F.array_contains(own, p["term"]), p["square"]).otherwise(0.0))
    # As an element of an array, the text's terms are found once, not for every template.
    return F.exists(F.array(F.array_intersect(words(text), terms)), lambda own: F.exists(templates, lambda t: held(own, t) >= cut))


def runs(lines: Column, fits) -> Column:
    """``start, size, line, parts`` of the lines and the runs of lines that fit."""

    def at(own: Column, k: Column) -> Column:
        longest = F.least(F.lit(MOST_LINES), F.size(own) - k + 1)
        parts = F.transform(F.sequence(F.lit(1), longest), lambda n: F.slice(own, k, n))
        made = F.transform(parts, lambda x: F.struct(k.alias("start"), F.size(x).alias("size"), F.array_join(x, " ").alias("line"), x.alias("parts")))
        return F.filter(made, lambda x: fits(x["line"]))

    every = F.transform(F.array(lines), lambda own: F.flatten(F.transform(F.sequence(F.lit(1), F.size(own)), lambda k: at(own, k))))
    return F.flatten(every)


def improving(hits: DataFrame) -> DataFrame:
    """The hits that score higher than every hit inside them."""
    inside = hits.filter(F.col("start") > 0).select("path", "body", "start", "size", "score")
    inside = inside.withColumn("before", F.explode(F.sequence(F.lit(0), F.lit(MOST_LINES) - F.col("size"))))
    inside = inside.withColumn("around", F.explode(F.sequence(F.col("before") + F.col("size"), F.lit(MOST_LINES))))
    inside = inside.filter(F.col("around") > F.col("size"))
    keys = ["path", "body", "start", "size"]
    inside = inside.select("path", "body", (F.col("start") - F.col("before")).alias("start"), F.col("around").alias("size"), "score")
    inside = inside.groupBy(*keys).agg(F.max("score").alias("inside"))
    return hits.join(inside, keys, "left").filter(F.col("inside").isNull() | (F.col("score") > F.col("inside"))).drop("inside")


def compare(lines: DataFrame, idf: dict[str, float], vectors, templates, threshold: float) -> DataFrame:
    """``key, license, score`` of the lines that reach the threshold, given as ``key, used``: their terms."""
    spark = lines.sparkSession
    axes = [(t, idf[t], k, name, v[t]) for k, ((name, _), v) in enumerate(zip(templates, vectors)) for t in v]
    # One row per term of each template: fixed by the templates, so its size is bounded.
    axes = spark.createDataFrame(axes, "term string, idf double, template int, license string, part double")
    counts = lines.select("key", F.explode("used").alias("term")).groupBy("key", "term").agg(F.count("*").alias("n"))
    values = F.broadcast(axes.select("term", "idf").distinct())
    counts = counts.join(values, "term").withColumn("w", F.col("n") * F.col("idf"))
    length = counts.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dot = counts.join(F.broadcast(axes.drop("idf")), "term").groupBy("key", "template", "license").agg(F.sum(F.col("w") * F.col("part")).alias("dot"))
    score = F.round(F.col("dot") / F.col("length"), PLACES)
    scored = dot.join(length, "key").select("key", "license", score.alias("score")).filter(F.col("score") >= threshold)
    best = F.min(F.struct((-F.col("score")).alias("below"), "license")).alias("best")
    return scored.groupBy("key").agg(best).select("key", "best.license", (-F.col("best.below")).alias("score"))


def scan(files: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES, path: str = "path", text: str = "text") -> DataFrame:
    """``path, license, score, origin, from_path`` of every row.

    ``origin`` is ``own`` or ``inherited``; without a licence all four are null.
    """
    rows = files.select(F.col(path).alias("path"), F.col(text).alias("text"))
    terms = sorted({t for _, own in templates for t in tokens(own)})
    held = rows.select(F.array_intersect(words(F.col("text")), F.array(*map(F.lit, terms))).alias("terms"))
    counted = held.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    total = rows.count()
    idf, vectors = weights({r["term"]: r["count"] for r in counted}, total, templates)
    marks = F.array(*map(F.lit, anchors(vectors, threshold)))

    likely = rows.filter(F.arrays_overlap(words(F.col("text")), marks)).filter(within_reach(F.col("text"), vectors, threshold))
    fits = lambda x: F.arrays_overlap(words(x), marks) & within_reach(x, vectors, threshold)
    named = F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False))
    joined = F.translate("text", "\n", " ")
    whole = F.struct(F.lit(0).alias("start"), F.lit(0).alias("size"), joined.alias("line"), F.array(joined).alias("parts"))
    found = F.concat(runs(F.split("text", "\n"), fits), F.filter(F.array(whole), lambda x: named))
    size = lambda x: F.size(F.array_remove(words(x), ""))
    body = F.xxhash64("text").alias("body")
    units = likely.select("path", body, named.alias("named"), size(F.col("text")).alias("all"), F.explode(found).alias("unit"))
    # Terms travel under a digest of their line, not under its whole text.
    used = F.filter(words(F.col("unit.line")), lambda x: F.array_contains(F.array(*map(F.lit, terms)), x)).alias("used")
    units = units.select("path", "body", "named", "all", "unit.start", "unit.size", "unit.parts", F.sha2("unit.line", 256).alias("key"), used)
    units = stage(units, "lines")

    scored = stage(compare(units.select("key", "used").distinct(), idf, vectors, templates, threshold), "scored")
    hits = improving(stage(units.drop("used").join(scored, "key").drop("key"), "hits"))
    best = F.min(F.struct((-F.col("score")).alias("below"), "license")).alias("best")
    # Equal lines of a text count once in its share.
    own = hits.select("path", "body", "named", "all", "license", "score", F.explode("parts").alias("part"))
    own = own.groupBy("path", "body", "part").agg(best, F.max("named").alias("named"), F.max("all").alias("all"))
    share = F.sum(F.least(size(F.col("part")), "all")) / F.max("all")
    own = own.groupBy("path").agg(F.min("best").alias("best"), (F.max("named") | (share >= FILE_SHARE)).alias("is_file"))
    own = stage(own.select("path", "best.license", (-F.col("best.below")).alias("score"), "is_file"), "own")

    folder = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.lit(""))
    first = F.min(F.struct("path", "license", "score")).alias("first")
    holders = own.filter("is_file and path is not null").groupBy(folder.alias("folder")).agg(first)
    holders = stage(holders.select("folder", F.col("first.path").alias("from_path"), F.col("first.license"), F.col("first.score")), "holders")

    # A folder's nearest holder is the same for all its files, so only folders are joined.
    folders = rows.filter("path is not null").select(folder.alias("folder")).distinct()
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    above = folders.select("folder", F.explode(F.array_union(F.array(F.lit("")), above)).alias("above"))
    near = above.join(holders.withColumnRenamed("folder", "above"), "above")
    deepest = F.max(F.struct(F.length("above").alias("depth"), "from_path", "license", "score")).alias("near")
    near = near.groupBy("folder").agg(deepest).select(
        "folder", F.col("near.from_path"), F.col("near.license").alias("taken"), F.col("near.score").alias("taken_score")
    )
    near = stage(near, "inherited")

    out = rows.select("path", folder.alias("folder")).join(own.drop("is_file"), "path", "left").join(near, "folder", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        "path",
        F.coalesce("license", "taken").alias("license"),
        F.when(mine, F.col("score")).otherwise(F.col("taken_score")).alias("score"),
        F.when(mine, "own").when(F.col("taken").isNotNull(), "inherited").alias("origin"),
        F.when(mine, F.col("path")).otherwise(F.col("from_path")).alias("from_path"),
    )


def oracle(threshold: float = THRESHOLD, templates=TEMPLATES) -> str:
    """The scan of ``documents`` as DuckDB SQL, comparing every line."""
    values = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(templates))
    split = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"
    return f"""
WITH files AS (
    SELECT doc_id, coalesce(source, '') || '/' || coalesce(lang, '') || '/' || coalesce(CAST(doc_id AS VARCHAR), '') AS path, text
    FROM documents),
templates(template, license, text) AS (VALUES {values}),
counted AS (
    SELECT template, license, term, count(*) AS n
    FROM (SELECT template, license, unnest({split.format('text')}) AS term FROM templates) GROUP BY ALL),
holding AS (
    SELECT term, count(*) AS df
    FROM (SELECT unnest(list_distinct({split.format('text')})) AS term FROM files) WHERE term IN (SELECT term FROM counted) GROUP BY term),
terms AS (
    SELECT DISTINCT term, ln((1 + (SELECT count(*) FROM files)) / (1.0 + coalesce(df, 0))) + 1 AS idf
    FROM (SELECT DISTINCT term FROM counted) LEFT JOIN holding USING (term)),
axes AS (
    SELECT template, license, term, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY template)) AS part
    FROM counted JOIN terms USING (term)),
lines AS (SELECT DISTINCT path, text, line FROM (SELECT path, text, unnest(string_split(text, chr(10))) AS line FROM files)),
distinct_lines AS (SELECT DISTINCT line FROM lines),
weighted AS (
    SELECT line, term, count(*) * any_value(idf) AS w
    FROM (SELECT line, unnest({split.format('line')}) AS term FROM distinct_lines) JOIN terms USING (term) GROUP BY line, term),
lengths AS (SELECT line, sqrt(sum(w * w)) AS length FROM weighted GROUP BY line),
scored AS (
    SELECT line, license, round(sum(w * part) / any_value(length), {PLACES}) AS score
    FROM weighted JOIN axes USING (term) JOIN lengths USING (line) GROUP BY line, template, license),
best AS (
    SELECT line, license, score FROM scored WHERE score >= {threshold}
    QUALIFY row_number() OVER (PARTITION BY line ORDER BY score DESC, license) = 1),
own AS (
    SELECT path, license, score, share >= {FILE_SHARE} AS is_file
    FROM (
        SELECT path, license, score, row_number() OVER (PARTITION BY path ORDER BY score DESC, license) AS place,
            sum(len({split.format('line')})) OVER (PARTITION BY path) / max(len({split.format('text')})) OVER (PARTITION BY path) AS share
        FROM lines JOIN best USING (line)) WHERE place = 1),
holders AS (
    SELECT regexp_replace(path, '/[^/]*$', '') AS folder, min(path) AS from_path FROM own WHERE is_file GROUP BY 1),
placed AS (
    SELECT doc_id, path, regexp_replace(path, '/[^/]*$', '') AS folder FROM files),
taken AS (
    SELECT folder, coalesce(a.from_path, b.from_path) AS from_path
    FROM (SELECT DISTINCT folder FROM placed) f
    LEFT JOIN holders a USING (folder)
    LEFT JOIN holders b ON b.folder = regexp_replace(f.folder, '/[^/]*$', ''))
SELECT p.doc_id, p.path, coalesce(o.license, h.license) AS license, coalesce(o.score, h.score) AS score,
    CASE WHEN o.path IS NOT NULL THEN 'own' WHEN h.path IS NOT NULL THEN 'inherited' END AS origin,
    CASE WHEN o.path IS NOT NULL THEN p.path ELSE h.path END AS from_path
FROM placed p LEFT JOIN own o ON o.path = p.path LEFT JOIN taken t ON t.folder = p.folder
LEFT JOIN own h ON h.path = t.from_path
"""
