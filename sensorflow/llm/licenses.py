"""Licence scan with DataFrame operations only.

Lines, paragraphs and whole licence files become sparse TF-IDF vectors and are
compared with licence templates by cosine.  A file without a licence of its own
takes that of a licence file in its nearest ancestor directory, found by joining
paths.

Most text holds no licence words and is passed over without loss, in two steps.
A text without an anchor term stays below the threshold: outside the anchors every
template has at most LEFT of its squared length, and LEFT is below the threshold
squared (Cauchy-Schwarz).  And no cosine is above the sum, over the text's words,
of idf times the word's largest weight in a template, divided by the length of the
text's part that no template has.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorflow.llm.common import stored, table, text_or_empty

# Wording that licences are known by.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
THRESHOLD = 0.7
SPLIT = "[^a-z0-9]+"
# Most squared weight of a template that the terms left out of the anchors may have; below THRESHOLD squared.
LEFT = 0.45
# Words too common to tell licences apart; they weigh least and are left out of the anchors first.
COMMON = set("""a all am an and any are as at be been but by can do does for from had has have he if in into is it its
may more most no not of on one or other she so than that the their then there these they this those to under use
was we were what when where which who will with without would you""".split())
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)[^/]*$"


def _weights(templates: list[tuple[str, str]]) -> tuple[dict[str, float], float, list[dict[str, float]]]:
    """(idf of template terms and common words, idf of all other terms, unit vector of each template)."""
    bags = [Counter(w for w in re.split(SPLIT, t.lower()) if w) for _, t in templates]
    df = Counter(w for b in bags for w in b)
    # common words count as if they were in every template
    idf = {w: math.log((1 + len(bags)) / (1 + n)) + 1 for w, n in df.items()} | dict.fromkeys(COMMON, 1.0)
    vectors = []
    for b in bags:
        norm = math.sqrt(sum((n * idf[w]) ** 2 for w, n in b.items()))
        vectors.append({w: n * idf[w] / norm for w, n in b.items()})
    return idf, math.log(1 + len(bags)) + 1, vectors


def _anchors(vectors: list[dict[str, float]]) -> list[str]:
    """Terms left when common words, then widespread terms, are left out while every template keeps all but LEFT."""
    spread = Counter(w for v in vectors for w in v)
    left = [0.0] * len(vectors)
    out = []
    for w in sorted(spread, key=lambda w: (w not in COMMON, -spread[w], w)):
        mass = [left[i] + v.get(w, 0.0) ** 2 for i, v in enumerate(vectors)]
        if max(mass) <= LEFT:
            left = mass
        else:
            out.append(w)
    return out


def _words(text: Column) -> Column:
    return F.split(F.lower(text), SPLIT)


def detect(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(file, license, cosine): the best template of each file of (file, path, content) that reaches the threshold.

    Of equal cosines the first template wins.
    """
    idf, other, vectors = _weights(templates)
    if threshold ** 2 <= LEFT:
        raise ValueError(f"thresholds are above {math.sqrt(LEFT):.2f}")
    anchors, terms_known = F.array(*map(F.lit, _anchors(vectors))), F.array(*map(F.lit, idf))
    largest = {w: max(v.get(w, 0.0) for v in vectors) for v in vectors for w in v}
    lead = F.create_map(*[F.lit(x) for w, y in largest.items() for x in (w, idf[w] * y)])
    content = text_or_empty("content")
    near = files.where(F.arrays_overlap(_words(content), anchors)).select("file", "path", content.alias("content"))
    parts = F.array_distinct(F.concat(
        F.split("content", "\n"), F.split("content", r"\n[ \t\r]*\n"),
        F.when(F.coalesce(F.col("path").rlike(LICENSE_FILE), F.lit(False)), F.array("content"))
        .otherwise(F.array().cast("array<string>"))))
    # no less than any cosine's numerator, and no more than the text's length
    most = F.aggregate("words", F.lit(0.0), lambda n, w: n + F.coalesce(lead[w], F.lit(0.0)))
    least = F.sqrt(F.greatest(F.size(F.array_except("words", terms_known)) - 1, F.lit(0))) * other
    units = (near.select("file", F.explode(parts).alias("unit"))
             .select("file", F.xxhash64("unit").alias("unit"), _words(F.col("unit")).alias("words"))
             .where(F.arrays_overlap("words", anchors)).where(most >= threshold * least - 1e-9))
    # one row per template term, whatever the input
    known = F.create_map(*[F.lit(x) for w, v in idf.items() for x in (w, v)])
    terms = (units.select("file", "unit", F.explode("words").alias("term")).where("term != ''")
             .groupBy("file", "unit", "term").agg(F.count("*").alias("tf"))
             .withColumn("x", F.col("tf") * F.coalesce(known[F.col("term")], F.lit(other))))
    spark = files.sparkSession
    rows = [F.struct(F.lit(w).alias("term"), F.lit(i).alias("template"), F.lit(x).alias("y"))
            for i, v in enumerate(vectors) for w, x in v.items()]
    wording = spark.range(1).select(F.inline(F.array(*rows)))
    unit = Window.partitionBy("file", "unit")
    scored = (terms.withColumn("norm", F.sqrt(F.sum(F.col("x") * F.col("x")).over(unit)))
              .join(F.broadcast(wording), "term")
              .groupBy("file", "unit", "template").agg((F.sum(F.col("x") * F.col("y")) / F.first("norm")).alias("cosine"))
              .where(F.col("cosine") >= threshold))
    names = F.array(*[F.lit(n) for n, _ in templates])
    best = scored.groupBy("file").agg(F.max(F.struct(F.round("cosine", 9).alias("cosine"), (-F.col("template")).alias("t"))).alias("b"))
    return best.select("file", names[-F.col("b.t")].alias("license"), F.col("b.cosine").alias("cosine"))


def directory(path: Column) -> Column:
    """The folder of a path; the root is the empty string."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def ancestors(folder: Column) -> Column:
    """A folder and all folders above it, nearest first, the root last."""
    steps = F.split(folder, "/")
    up = F.transform(F.sequence(F.size(steps), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    return F.array_distinct(F.concat(up, F.array(F.lit(""))))


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``files`` (file, repo, path, content): own and inherited licence.

    Columns: file, repo, path, own_license, own_cosine, license_dir, license.  A
    null or empty content has no licence of its own; a null path lies in the root
    and is no licence file; a null repo is one repo.  Of several licence files of
    a folder the one with the highest cosine counts, then the smallest licence
    name.  ``file`` names a row; rows repeated under one name share what is found
    in any.  An empty table gives no rows; other columns are ignored.
    """
    rows = files.select("file", F.coalesce("repo", F.lit("")).alias("r"), directory(F.coalesce("path", F.lit(""))).alias("dir"),
                        "repo", "path")
    found = stored(detect(files.select("file", "path", "content"), templates, threshold), "licenses")
    own = (rows.join(found, "file", "left")
           .select("file", "r", "dir", "repo", "path", F.col("license").alias("own_license"), F.col("cosine").alias("own_cosine")))
    own = stored(own, "files")
    given = (own.where(F.col("own_license").isNotNull() & F.coalesce(F.col("path").rlike(LICENSE_FILE), F.lit(False)))
             .groupBy("r", "dir").agg(F.min(F.struct((-F.col("own_cosine")).alias("c"), F.col("own_license").alias("name"))).alias("best"))
             .select("r", F.col("dir").alias("license_dir"), F.col("best.name").alias("given")))
    # folders, not files, climb to their ancestors
    folders = own.select("r", "dir").distinct()
    steps = folders.select("r", "dir", F.posexplode(ancestors(F.col("dir"))).alias("up", "license_dir"))
    nearest = (steps.join(given, ["r", "license_dir"]).groupBy("r", "dir")
               .agg(F.min(F.struct("up", "license_dir", "given")).alias("n"))
               .select("r", "dir", F.col("n.license_dir").alias("license_dir"), F.col("n.given").alias("given")))
    # written: a folder with a third of all files is joined between fresh exchanges, which may be split
    nearest = stored(nearest, "nearest")
    inherits = F.col("own_license").isNull()
    return (own.join(nearest, ["r", "dir"], "left")
            .select("file", "repo", "path", "own_license", "own_cosine",
                    F.when(inherits, F.col("license_dir")).alias("license_dir"),
                    F.coalesce("own_license", "given").alias("license")))


def file_tree(docs: DataFrame) -> DataFrame:
    """Stand-in rows in the scan's schema: a source is a repo, the id names folder and file."""
    i = F.col("doc_id")
    name = F.when(i % 40 == 0, "LICENSE").otherwise(F.concat(F.lit("doc"), i.cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", F.concat(F.lit("a"), (i % 5).cast("string")), F.concat(F.lit("b"), (i % 35).cast("string")), name)
    return docs.select(i.alias("file"), F.col("source").alias("repo"), path.alias("path"), F.col("text").alias("content"))


def oracle() -> str:
    """The scan of the stand-in tree in SQL, without the anchors."""
    idf, other, vectors = _weights(TEMPLATES)
    values = lambda rows: ", ".join("(" + ", ".join(repr(x) for x in r) + ")" for r in rows)
    return rf"""
WITH w(term, idf) AS (VALUES {values(idf.items())}),
y(term, template, y) AS (VALUES {values((t, i, x) for i, v in enumerate(vectors) for t, x in v.items())}),
names(template, name) AS (VALUES {values((i, n) for i, (n, _) in enumerate(TEMPLATES))}),
f AS (SELECT doc_id, source AS repo, coalesce(source, '') AS r, coalesce(text, '') AS content, doc_id % 40 = 0 AS is_license,
             'a' || (doc_id % 5) || '/b' || (doc_id % 35) AS dir FROM documents),
u AS (SELECT DISTINCT * FROM (SELECT doc_id, unnest(string_split(content, chr(10))) AS unit FROM f
      UNION ALL SELECT doc_id, unnest(regexp_split_to_array(content, '\n[ \t\r]*\n')) FROM f
      UNION ALL SELECT doc_id, content FROM f WHERE is_license)),
t AS (SELECT doc_id, unit, term, count(*) AS tf FROM (SELECT doc_id, unit,
      unnest(regexp_split_to_array(lower(unit), '[^a-z0-9]+')) AS term FROM u) WHERE term <> '' GROUP BY ALL),
x AS (SELECT doc_id, unit, term, tf * coalesce(idf::DOUBLE, {other!r}::DOUBLE) AS x FROM t LEFT JOIN w USING (term)),
n AS (SELECT doc_id, unit, sqrt(sum(x * x)) AS norm FROM x GROUP BY ALL),
c AS (SELECT doc_id, template, sum(x * y::DOUBLE) / any_value(norm) AS cosine FROM x JOIN y USING (term) JOIN n USING (doc_id, unit)
      GROUP BY doc_id, unit, template HAVING sum(x * y::DOUBLE) / any_value(norm) >= {THRESHOLD}),
o AS (SELECT doc_id, name AS own_license, round(cosine, 9) AS own_cosine FROM c JOIN names USING (template)
      QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(cosine, 9) DESC, template) = 1),
g AS (SELECT r, dir AS license_dir, own_license AS given FROM f JOIN o USING (doc_id) WHERE is_license
      QUALIFY row_number() OVER (PARTITION BY r, dir ORDER BY own_cosine DESC, own_license) = 1),
i AS (SELECT doc_id, license_dir, given FROM f JOIN g ON f.r = g.r AND
      (dir = license_dir OR license_dir = '' OR starts_with(dir, license_dir || '/'))
      QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(license_dir) DESC) = 1)
SELECT doc_id, repo, dir || '/' || CASE WHEN is_license THEN 'LICENSE' ELSE 'doc' || doc_id || '.txt' END AS path, own_license,
       round(own_cosine, 6) AS own_cosine, CASE WHEN own_license IS NULL THEN license_dir END AS license_dir,
       coalesce(own_license, given) AS license
FROM f LEFT JOIN o USING (doc_id) LEFT JOIN i USING (doc_id)
"""


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, read as files of a tree."""
    found = scan(file_tree(table(spark, sf_dir, "documents"))).withColumnRenamed("file", "doc_id")
    return found.withColumn("own_cosine", F.round("own_cosine", 6))
