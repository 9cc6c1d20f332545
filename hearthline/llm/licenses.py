"""License scans: sparse TF-IDF cosine to templates, then inheritance from directories.

Every line of a file is a vector of its words weighted by TF-IDF, with document
frequencies counted over all files; the licence of a file is the template nearest to any
of its lines, from a cosine of ``LIKE`` on. A file without a licence of its own takes the
one of the nearest directory above it that holds a licence file. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import sized
from hearthline.sources.scratch import cut

LIKE = 0.6

# What notices of each licence say.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Apache License Version 2.0, January 2004",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Use of this source code is governed by a BSD-style license",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "GNU General Public License as published by the Free Software Foundation, either version 3",
    ),
    "MIT": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
}

#: Names of licence files.
LICENSE_FILE = "^(?i:licen[cs]e|copying|copyright)([.-].*)?$"

_PARTS = "[^\\p{L}\\p{N}]+"


def words(of: str | F.Column) -> F.Column:
    return F.array_remove(F.split(F.lower(of), _PARTS), "")


def template_words(templates: dict[str, tuple[str, ...]]) -> list[tuple[str, int, dict[str, int]]]:
    """(licence, which of its notices, count of each word)."""
    out = []
    for name in sorted(templates):
        for k, notice in enumerate(templates[name]):
            counts: dict[str, int] = {}
            for w in "".join(c if c.isalnum() else " " for c in notice.lower()).split():
                counts[w] = counts.get(w, 0) + 1
            out.append((name, k, counts))
    return out


def frequencies(files: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """The number of files, and of those that hold each word of the (small) vocabulary."""
    held = F.array_intersect(words("text"), F.lit(vocabulary))
    rows = (
        files.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("word"))  # "" counts every file
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .collect()
    )
    counts = {r["word"]: r["n"] for r in rows}
    return counts.pop("", 0), counts


def own_licenses(files: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """``files`` with ``own_license`` and ``own_score``, both null if no line comes near enough.

    Of equally near templates the first by name wins. Only lines with a telling word can
    come near: without the words that make up most of a template's length its cosine
    stays under ``LIKE``, whatever else the line says.
    """
    notices = template_words(templates)
    vocabulary = sorted({w for _, _, counts in notices for w in counts})
    n, held = frequencies(files, vocabulary)
    idf = {w: math.log((1 + n) / (1 + held.get(w, 0))) + 1 for w in vocabulary}
    unknown = math.log(1 + n) + 1
    telling, vectors = set(), []
    for name, _, counts in notices:
        weights = {w: k * idf[w] for w, k in counts.items()}
        length = math.sqrt(sum(v * v for v in weights.values()))
        vectors.append((name, weights, length))
        rest = length * length
        for w, v in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
            if rest < 0.999 * (LIKE * length) ** 2:
                break
            telling.add(w)
            rest -= v * v
    tells = f"(?<![\\p{{L}}\\p{{N}}])(?:{'|'.join(sorted(telling))})(?![\\p{{L}}\\p{{N}}])"
    weight_of = F.create_map(*(F.lit(x) for w in vocabulary for x in (w, idf[w])))

    def score(line: F.Column) -> F.Column:
        """The negated best cosine and its licence, of the words of one line."""
        tf = lambda w: F.size(F.filter(line, lambda x: x == w))
        squares = F.aggregate(
            F.array_distinct(line),
            F.lit(0.0),
            lambda sum_, w: sum_ + F.pow(tf(w) * F.coalesce(F.try_element_at(weight_of, w), F.lit(unknown)), F.lit(2.0)),
        )
        dots = [
            F.struct(
                (-sum((tf(F.lit(w)) * F.lit(v * idf[w]) for w, v in sorted(weights.items())), F.lit(0.0)) / (F.sqrt(squares) * length)).alias("less"),
                F.lit(name).alias("name"),
            )
            for name, weights, length in vectors
        ]
        return F.array_min(F.array(*dots))

    lines = F.filter(F.split(F.lower("text"), "\n", -1), lambda line: line.rlike(tells))
    scored = F.transform(F.transform(lines, words), score)
    best = F.array_min(F.when(F.lower("text").rlike(tells), scored))
    own = files.withColumn("own_best", best)
    near = -F.col("own_best.less") >= LIKE
    return own.select(
        *files.columns,
        F.when(near, F.col("own_best.name")).alias("own_license"),
        F.when(near, F.round(-F.col("own_best.less"), 4)).alias("own_score"),
    )


def folder_of(path: str) -> F.Column:
    """The path without its last part; "" for a path without a folder."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """``(path, ..., own_license, own_score, license, license_folder)`` for every file.

    ``files``: (path, text) and, if wanted, doc_id; other columns are not read. license is
    the file's own, or that of the nearest folder above it (its own folder first) with a
    licence file that has one, named in license_folder; null without any. Several licence
    files in a folder: the highest score, then the first path. A null text has no licence;
    a file with a null path inherits none. Repeated rows each get their row.
    """
    columns = [c for c in ("doc_id", "path") if c in files.columns]
    texts = files.select(*columns, F.coalesce("text", F.lit("")).alias("text"))
    own = cut(own_licenses(texts, templates).drop("text").withColumn("folder", folder_of("path")))
    named = own.filter(F.regexp_extract("path", "[^/]*$", 0).rlike(LICENSE_FILE) & F.col("own_license").isNotNull())
    of_folder = (
        named.groupBy("folder")
        .agg(F.min(F.struct((-F.col("own_score")).alias("less"), "path", "own_license")).alias("best"))
        .select(F.col("folder").alias("above"), F.col("best.own_license").alias("folder_license"))
    )
    # folders are few against files: each is joined to the folders above it once
    folders = own.select("folder").filter("folder IS NOT NULL").distinct()
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    nearest = (
        folders.select("folder", F.posexplode(above).alias("depth", "above"))
        .join(of_folder, "above")
        .groupBy("folder")
        .agg(F.max(F.struct("depth", "above", "folder_license")).alias("near"))
        .select("folder", F.col("near.above").alias("above"), F.col("near.folder_license").alias("folder_license"))
    )
    given = own.join(sized(cut(nearest)), "folder", "left")
    has_own = F.col("own_license").isNotNull()
    return given.select(
        *columns,
        "own_license",
        "own_score",
        F.coalesce("own_license", "folder_license").alias("license"),
        F.when(~has_own, F.col("above")).alias("license_folder"),
    )


#: Paths for the given documents, which have none: folders of 256 and of 16 ids under each
#: source, with the first document of each folder as its licence file. In both SQL dialects.
PATH_SQL = """concat(coalesce(source, 'none'), '/', CAST(CAST(floor(doc_id / 256) AS BIGINT) AS VARCHAR(20)), '/',
  CASE WHEN doc_id % 256 = 0 THEN 'LICENSE'
       WHEN doc_id % 16 = 0 THEN concat(CAST(CAST(floor(doc_id / 16) AS BIGINT) AS VARCHAR(20)), '/LICENSE')
       ELSE concat(CAST(CAST(floor(doc_id / 16) AS BIGINT) AS VARCHAR(20)), '/', CAST(doc_id AS VARCHAR(20)), '.txt') END)"""


def of_documents(docs: DataFrame) -> DataFrame:
    """The scan of documents under the paths of ``PATH_SQL``; a null id has no path."""
    return scan(docs.select("doc_id", "text", F.expr(PATH_SQL).alias("path")))


def oracle() -> str:
    """The rows of ``of_documents`` in DuckDB."""
    rows = ", ".join(
        f"('{name}', {k}, '{w}', {c})" for name, k, counts in template_words(TEMPLATES) for w, c in sorted(counts.items())
    )
    return f"""WITH notice(name, k, word, tf) AS (VALUES {rows}),
    files AS (SELECT doc_id, coalesce(text, '') AS text, {PATH_SQL} AS path FROM documents),
    spread AS (SELECT doc_id, k AS line, lower(l) AS said
      FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM files), unnest(ls) WITH ORDINALITY AS u(l, k)),
    tokens AS (SELECT doc_id, line, unnest(string_split_regex(said, '{_PARTS}')) AS word FROM spread),
    tf AS (SELECT doc_id, line, word, count(*) AS tf FROM tokens WHERE word <> '' GROUP BY ALL),
    total AS (SELECT count(*) AS n FROM files),
    idf AS (SELECT v.word, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf
      FROM (SELECT DISTINCT word FROM notice) v CROSS JOIN total
      LEFT JOIN (SELECT word, count(DISTINCT doc_id) AS df FROM tf GROUP BY word) d ON v.word = d.word),
    lengths AS (SELECT doc_id, line, sqrt(sum(pow(tf * coalesce(idf, ln(1 + n) + 1), 2))) AS length
      FROM tf CROSS JOIN total LEFT JOIN idf ON tf.word = idf.word GROUP BY doc_id, line),
    vectors AS (SELECT name, k, notice.word, notice.tf * idf AS w, idf FROM notice JOIN idf ON notice.word = idf.word),
    norms AS (SELECT name, k, sqrt(sum(w * w)) AS norm FROM vectors GROUP BY name, k),
    cosines AS (SELECT tf.doc_id, tf.line, v.name, sum(tf.tf * v.idf * v.w) / (any_value(length) * any_value(norm)) AS c
      FROM tf JOIN vectors v ON tf.word = v.word JOIN norms ON v.name = norms.name AND v.k = norms.k
      JOIN lengths ON tf.doc_id = lengths.doc_id AND tf.line = lengths.line GROUP BY tf.doc_id, tf.line, v.name, v.k),
    best AS (SELECT doc_id, name, round(c, 4) AS score,
        row_number() OVER (PARTITION BY doc_id ORDER BY round(c, 9) DESC, name) AS r FROM cosines WHERE c >= {LIKE}),
    own AS (SELECT f.doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS folder, b.name, b.score
      FROM files f LEFT JOIN best b ON f.doc_id = b.doc_id AND b.r = 1),
    licensed AS (SELECT folder, name FROM (SELECT folder, name,
        row_number() OVER (PARTITION BY folder ORDER BY score DESC, path) AS r
      FROM own WHERE name IS NOT NULL AND ends_with(path, '/LICENSE')) WHERE r = 1),
    near AS (SELECT own.doc_id, l.folder, l.name, row_number() OVER (PARTITION BY own.doc_id ORDER BY length(l.folder) DESC) AS r
      FROM own JOIN licensed l ON own.folder = l.folder OR starts_with(own.folder, l.folder || '/'))
    SELECT own.doc_id, path, own.name AS own_license, own.score AS own_score, coalesce(own.name, near.name) AS license,
      CASE WHEN own.name IS NULL THEN near.folder END AS license_folder
    FROM own LEFT JOIN near ON own.doc_id = near.doc_id AND near.r = 1"""
