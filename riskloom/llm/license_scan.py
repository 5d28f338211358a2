"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

Every sentence or line of a text that speaks of a licence is compared with the templates, in its
own row, and so are the sentences of its paragraphs once comment marks are gone and wrapped lines
are joined, whatever the width they were wrapped at: sorted terms give term counts, and weights come from maps of the few template terms. The
best template at or above the threshold is the file's own licence; a template that names versions
counts only where the sentence names the same ones. A file without one takes that of
the nearest directory at or above its own with a licensed licence file: the ancestors of each
distinct directory are joined with the licensed directories by path.

Edge cases: a null or empty text has no licence of its own; a null path no directory, so nothing is
inherited. Equal scores go to the earlier template, equal licence files of a directory to the
earlier licence, then path. Repeated rows get equal results. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.quality_rules import let
from riskloom.llm.scratch import written
from riskloom.operators.bounded import broadcast_if_small

# fixed values: how licences are named in headers and licence files
GNU = [("GPL", "General", ("2", "3")), ("LGPL", "Library General", ("2",)),
       ("LGPL", "Lesser General", ("2.1", "3")), ("AGPL", "Affero General", ("3",))]
CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike",
            "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
            "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
OTHER_TEMPLATES = [
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("ISC", "Licensed under the ISC License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
            "or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, version 2.0"),
    ("EPL-1.0", "made available under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]
NAMED_SPDX = ["MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "EPL-1.0",
              "EPL-2.0", "Unlicense", *[f"CC-{c}-4.0" for c in CREATIVE]]


def _templates() -> list[tuple[str, str]]:
    """The sentences above, those of the GNU and Creative Commons families, identifier lines."""
    out = list(OTHER_TEMPLATES)
    for short, family, versions in GNU:
        for v in versions:
            name = f"{short}-{v}" if "." in v else f"{short}-{v}.0"
            out += [
                (name, f"This work is licensed under the GNU {family} Public License, version {v}"),
                (name, f"you can redistribute it and/or modify it under the terms of the GNU "
                       f"{family} Public License as published by the Free Software Foundation, "
                       f"either version {v}"),
                *[(name, f"SPDX-License-Identifier: {name}{end}")
                  for end in ("", "+", "-only", "-or-later")]]
    for code, long in CREATIVE.items():
        out += [(f"CC-{code}-4.0", f"Licensed under CC {code} 4.0"),
                (f"CC-{code}-4.0", f"licensed under a Creative Commons {long} 4.0 International "
                                   "License")]
    return out + [(name, f"SPDX-License-Identifier: {name}") for name in NAMED_SPDX]


TEMPLATES = _templates()
# whole sentences, compared with joined lines only
JOINED_TEMPLATES = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
            "and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0"),
]
SPEAKS_OF = r"(?i)licen[cs]|spdx|redistribut|hereby granted|public domain"
UNIT_END = r"[.!?;]*[ \t\r]*\n|[.!?;][ \t]+"
# of the joined form: what begins and ends a line, a line's end inside a paragraph, a unit's end
LINE_START = r"(?mid)^[ \t]*(?:[/#*;%!>|]+|--+|<!--+|dnl[ \t]|rem[ \t])?[ \t]*"
LINE_STOP = r"(?md)[ \t\r]*(?:\*+/|--+>|[*#|]+)?[ \t\r]*$"
WRAPPED, JOINED_END = r"(?<!\n)\n(?!\n)", r"\n+|(?<![ ,]v)[.!?;][ \t]+"
TERM = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)(\.[a-z]+)?$"
THRESHOLD = 0.75


def template_terms() -> tuple[dict[str, float], float, list[dict[str, float]]]:
    """Weights of terms by how few templates have them, that of any other term, and the terms of
    each template, scaled to length 1."""
    counts = [Counter(re.findall(TERM, text.lower())) for _, text in TEMPLATES]
    seen = Counter(t for c in counts for t in c)
    weight = {t: log((1 + len(counts)) / (1 + n)) + 1 for t, n in sorted(seen.items())}
    vectors = [{t: n * weight[t] for t, n in c.items()} for c in counts]
    lengths = [sqrt(sum(w * w for w in v.values())) for v in vectors]
    return weight, log(1 + len(counts)) + 1, [
        {t: w / n for t, w in v.items()} for v, n in zip(vectors, lengths, strict=True)]


def versions_named(text: str) -> list[list[str]]:
    """For each version a template names, the terms that say the same."""
    bare = {re.sub(r"(?<=\d)\.0$", "", t.lstrip("v"))
            for t in re.findall(TERM, text.lower()) if re.fullmatch(r"v?\d[\d.]*", t)}
    return [[t + end for t in (n, "v" + n) for end in ("", *([".0"] if "." not in n else []))]
            for n in sorted(bare)]


def joined_terms() -> list[dict[str, float]]:
    """The terms of the joined templates, weighted as those of any text."""
    weight, other, _ = template_terms()
    out = []
    for _, text in JOINED_TEMPLATES:
        vector = {t: n * weight.get(t, other)
                  for t, n in Counter(re.findall(TERM, text.lower())).items()}
        length = sqrt(sum(w * w for w in vector.values()))
        out.append({t: w / length for t, w in vector.items()})
    return out


def joined_lines(text: Column) -> Column:
    """The text without comment marks, a line per paragraph, empty lines between."""
    bare = F.regexp_replace(F.regexp_replace(text, LINE_START, ""), LINE_STOP, "")
    return F.regexp_replace(bare, WRAPPED, " ")


def _lookup(table: dict[str, float], term: Column, other: float) -> Column:
    literal = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(literal, term), F.lit(other))


def own_license(text: Column) -> Column:
    """Struct of score and license of the best template, or null below the threshold."""
    weight, other, vectors = template_terms()
    line_forms = list(zip(TEMPLATES, vectors, strict=True))
    all_forms = line_forms + list(zip(JOINED_TEMPLATES, joined_terms(), strict=True))

    def terms(unit: Column) -> Column:
        """(term, weight in the unit), each term once. The pattern's repetition is made possessive:
        it gives back nothing, so a term of any length needs no stack."""
        ordered = F.array_sort(F.regexp_extract_all(F.lower(unit), F.lit(f"({TERM}+)"), F.lit(1)))
        return let(ordered, lambda s: let(
            F.filter(F.transform(s, lambda x, i: F.when(
                (i == 0) | (x != F.get(s, i - 1)), i)), lambda i: i.isNotNull()),
            lambda starts: F.transform(starts, lambda p, k: F.struct(
                s[p].alias("t"), ((F.coalesce(F.get(starts, k + 1), F.size(s)) - p) * _lookup(
                    weight, s[p], other)).alias("w")))))

    def best(unit: Column, forms: list) -> Column:
        def scored(found: Column) -> Column:
            length = F.sqrt(F.aggregate(found, F.lit(0.0), lambda a, x: a + x["w"] * x["w"]))

            def cosine(text: str, vector: dict[str, float]) -> Column:
                dot = F.aggregate(found, F.lit(0.0), lambda a, x: (
                    a + x["w"] * _lookup(vector, x["t"], 0.0)))
                value = F.round(F.coalesce(F.try_divide(dot, length), F.lit(0.0)), 6)
                for same in versions_named(text):
                    value = F.when(F.arrays_overlap(
                        F.transform(found, lambda x: x["t"]), F.array(*map(F.lit, same))),
                        value).otherwise(0.0)
                return value

            return F.array_max(F.array(*[
                F.struct(cosine(words, v).alias("score"), F.lit(-k).alias("order"),
                         F.lit(name).alias("license"))
                for k, ((name, words), v) in enumerate(forms)]))
        return let(terms(unit), scored)

    def units(t: Column, end: str) -> Column:
        return F.filter(F.split(t, end), lambda u: u.rlike(SPEAKS_OF))

    found = F.when(text.rlike(SPEAKS_OF), F.array_max(F.concat(
        F.transform(units(text, UNIT_END), lambda u: best(u, line_forms)),
        F.transform(units(joined_lines(text), JOINED_END), lambda u: best(u, all_forms)))))
    return F.when(found["score"] >= THRESHOLD, found)


def scan(files: DataFrame) -> DataFrame:
    """doc_id, path, license, score, origin (own, inherited, none), licensed_dir; one row per row
    of `files` (doc_id, path, text)."""
    parent = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    own = written(files.select("doc_id", "path", parent.alias("dir"),
                               own_license(F.col("text")).alias("own")), "license-own")
    given = own.where(F.col("own").isNotNull() & F.col("path").rlike(LICENCE_FILE)).groupBy(
        F.col("dir").alias("up")).agg(F.max_by("own.license", F.struct(
            "own.score", "own.order", F.col("path"))).alias("given"))
    parts = F.split("dir", "/")
    ancestors = own.select("dir").where("dir is not null").distinct().select(
        "dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(
            k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("up")))).alias("a"))
    inherited = ancestors.select("dir", "a.depth", "a.up").join(
        broadcast_if_small(written(given, "license-dirs")), "up").groupBy("dir").agg(
        F.max_by("given", "depth").alias("given"), F.max_by("up", "depth").alias("up"))
    joined = own.join(broadcast_if_small(written(inherited, "license-inherited")), "dir", "left")
    mine = F.col("own").isNotNull()
    return joined.select(
        "doc_id", "path",
        F.when(mine, F.col("own.license")).otherwise(F.col("given")).alias("license"),
        F.col("own.score").alias("score"),
        F.when(mine, "own").when(F.col("given").isNotNull(), "inherited").otherwise(
            "none").alias("origin"),
        F.when(~mine, F.col("up")).alias("licensed_dir"))


def documents_as_files(docs: DataFrame) -> DataFrame:
    """A tree with a folder per source, thousand and hundred of doc_id; every 25th document is
    the licence file of its folder."""
    doc = F.col("doc_id").cast("bigint")
    path = F.concat_ws(
        "/", F.coalesce(F.col("source").cast("string"), F.lit("unknown")),
        F.floor(doc / 1000).cast("string"), (F.floor(doc / 100) % 10).cast("string"),
        F.when(doc % 25 == 0, "LICENSE").otherwise(F.concat(doc.cast("string"), F.lit(".txt"))))
    return docs.select(doc.alias("doc_id"), F.when(doc.isNotNull(), path).alias("path"),
                       F.col("text").cast("string").alias("text"))


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(
        "'" + x.replace("'", "''") + "'" if isinstance(x, str) else repr(x) for x in r) + ")"
        for r in rows)


def oracle() -> str:
    weight, other, templates = template_terms()
    entries = [(-k, name, t, w) for k, ((name, _), v) in enumerate(
        zip(TEMPLATES, templates, strict=True)) for t, w in v.items()]
    versions = [(-k, n, t) for k, (_, text) in enumerate(TEMPLATES)
                for n, same in enumerate(versions_named(text)) for t in same]
    return f"""
WITH vocabulary(term, weight) AS (VALUES {_values(list(weight.items()))}),
templates("order", license, term, weight) AS (VALUES {_values(entries)}),
versions("order", version, term) AS (VALUES {_values(versions)}),
files AS (
  SELECT row_number() OVER () AS row_no, doc_id, text, CASE WHEN doc_id IS NOT NULL THEN
    coalesce(source, 'unknown') || '/' || CAST(doc_id // 1000 AS VARCHAR) || '/'
    || CAST(doc_id // 100 % 10 AS VARCHAR) || '/' || CASE WHEN doc_id % 25 = 0 THEN 'LICENSE'
    ELSE CAST(doc_id AS VARCHAR) || '.txt' END END AS path
  FROM documents),
units AS (
  SELECT row_no, unit, row_number() OVER () AS unit_no FROM (
    SELECT row_no, unnest(regexp_split_to_array(text, '{UNIT_END}')) AS unit FROM files
    WHERE regexp_matches(text, '{SPEAKS_OF}')) WHERE regexp_matches(unit, '{SPEAKS_OF}')),
terms AS (
  SELECT row_no, unit_no, term, count(*) * coalesce(any_value(weight), {other!r}) AS w FROM (
    SELECT row_no, unit_no, unnest(regexp_extract_all(lower(unit), '{TERM}')) AS term FROM units)
  LEFT JOIN vocabulary USING (term) GROUP BY ALL),
lengths AS (SELECT unit_no, sqrt(sum(w * w)) AS length FROM terms GROUP BY unit_no),
scores AS (
  SELECT row_no, round(sum(w * t.weight) / any_value(length), 6) AS score, "order", license
  FROM terms JOIN templates t USING (term) JOIN lengths USING (unit_no)
  WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT DISTINCT "order", version FROM versions) v WHERE v."order" = t."order"
    AND (unit_no, v."order", v.version) NOT IN (
      SELECT unit_no, "order", version FROM terms JOIN versions USING (term)))
  GROUP BY row_no, unit_no, "order", license),
own AS (
  SELECT row_no, arg_max(license, (score, "order")) AS license, max(score) AS score,
         arg_max("order", (score, "order")) AS "order"
  FROM scores WHERE score >= {THRESHOLD} GROUP BY row_no),
placed AS (
  SELECT f.row_no, doc_id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, license, score,
         "order"
  FROM files f LEFT JOIN own USING (row_no)),
given AS (
  SELECT dir AS up, arg_max(license, (score, "order", path)) AS given FROM placed
  WHERE license IS NOT NULL AND regexp_matches(path, '{LICENCE_FILE}') GROUP BY dir),
inherited AS (
  SELECT dir, arg_max(given, length(up)) AS given, arg_max(up, length(up)) AS up
  FROM (SELECT DISTINCT dir FROM placed) JOIN given
    ON dir = up OR up = '' OR starts_with(dir, up || '/') GROUP BY dir)
SELECT doc_id, path, coalesce(license, given) AS license, score,
       CASE WHEN license IS NOT NULL THEN 'own' WHEN given IS NOT NULL THEN 'inherited'
            ELSE 'none' END AS origin,
       CASE WHEN license IS NULL THEN up END AS licensed_dir
FROM placed LEFT JOIN inherited USING (dir)
"""
