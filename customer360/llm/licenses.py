"""Licence scan with DataFrame functions only.

A file's units are its lines, windows of consecutive lines (``WINDOWS``: so many
lines each, a new one beginning every half of that), in which headers and notices that
are wrapped over lines stand, and the file as a whole. Units are compared
to licence templates by the cosine of sparse TF-IDF vectors (lower-cased runs
of a-z and 0-9, so comment signs do not count, function words left out; idf over the templates, unknown words as rarest). A cosine of
``least`` needs one of a template's essential words: the heaviest ones, such
that the others' share of its norm is below ``least``; texts and then units
without any are left aside. So are units that do not hold ``least`` squared of a
template's squared weights, which such a cosine needs as well, and units whose
cosine could not reach it if every unknown word stood there once; so only few words are counted. The
template table is a constant of this module, so its broadcast has a fixed size.

A file's own licence is its best unit's. Licence files give it to their
directory, and a file without one inherits that of its nearest ancestor
directory: distinct directories are joined with their ancestors, files meet
the outcome once. A licence file is one named like one (LICENSE, COPYING,
NOTICE, with any ending) or, if asked for, one whose first line is a licence.

Defined results: NULL or empty texts have no units; a NULL path has no
directory and inherits nothing; identical rows are treated alike; of equal
scores the alphabetically first licence counts, of several licence files in a
directory the best score, then the smallest path; empty tables give no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer360.llm.skew import free_name
from customer360.plans import cut_lineage

LEAST = 0.7
#: Units (20 bytes each) that are broadcast to be counted; more are joined by a shuffle.
BROADCAST_UNITS = 500_000
#: Lines of a window; a new one begins every half of that, so a notice of any
#: length from two lines on nearly fills one.
WINDOWS = (2, 4, 8, 16, 32)
#: Longest window, three times the longest template: in a longer one the other words
#: outweigh a template's, and a notice in it stands in a shorter window, too.
WINDOW_CHARS = 2500

#: Licence identifiers and the notices that announce them, from one
#: sentence to the wrapped headers of source files and the titles of licence files.
TEMPLATES = [
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
                "either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
            "to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
                "either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU "
                "General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
            "or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
                "https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                  "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]

#: English words that no vector holds.
FUNCTION_WORDS = frozenset("a an and any are as at be by for from in into is it may not of on or that the this to under was one see shall should so will with you your".split())

_NAME = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"


def _vectors(templates: list[tuple[str, str]]) -> tuple[list[tuple], float, dict[str, float]]:
    """(template, licence, word, unit weight) rows, the idf of unknown words and the idf of known ones."""
    bags = [[w for w in re.findall(r"[a-z0-9]+", t.lower()) if w not in FUNCTION_WORDS] for _, t in templates]
    df: dict[str, int] = {}
    for b in bags:
        for w in set(b):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(1 + len(bags) / n) for w, n in df.items()}
    rows = []
    for i, ((name, _), b) in enumerate(zip(templates, bags, strict=True)):
        weight = {w: b.count(w) * idf[w] for w in set(b)}
        norm = math.sqrt(sum(v * v for v in weight.values()))
        rows += [(i, name, w, v / norm) for w, v in sorted(weight.items())]
    return rows, math.log(1 + len(bags)), idf


def _essential(rows: list[tuple], least: float) -> list[str]:
    """Words of which a unit with a cosine of ``least`` has one at least; numbers
    only where the other words of a template are too light."""
    out: set[str] = set()
    for i in {r[0] for r in rows}:
        rest = 1.0
        for _, v, w in sorted(((not r[2].isdigit(), r[3], r[2]) for r in rows if r[0] == i), reverse=True):
            if rest < (least * 0.999) ** 2:
                break
            out.add(w)
            rest -= v * v
    return sorted(out)


def own_licenses(files: DataFrame, least: float = LEAST, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(rk, license, score, first_line) of every distinct row of ``files`` (rk,
    text) with a licence; first_line tells whether it opens with one."""
    spark = files.sparkSession
    rows, unknown, idf = _vectors(templates)
    essential = F.array(*[F.lit(w) for w in _essential(rows, least)])

    def hopeful(c: str):
        """A superset of the texts that can reach the threshold."""
        return F.arrays_overlap(F.split(F.lower(c), "[^a-z0-9]+"), essential)

    known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "word string, idf double"))
    vectors = F.broadcast(spark.createDataFrame(rows, "template int, license string, word string, weight double"))

    # A cosine of ``least`` needs template words of ``least`` squared in squared
    # weight: few files hold so many of a template's, and few of their units.
    squares = F.broadcast(vectors.select("template", "word", (F.col("weight") * F.col("weight")).alias("square")))

    def holding(rows: DataFrame, text: str, *keys: str) -> DataFrame:
        words = rows.select(*keys, F.explode(F.array_distinct(F.split(F.lower(text), "[^a-z0-9]+"))).alias("word"))
        sums = words.join(squares, "word").groupBy(*keys, "template").agg(F.sum("square").alias("held"))
        out = cut_lineage(sums.where(F.col("held") >= least * least - 1e-6).select(*keys).distinct())
        return F.broadcast(out) if out.count() <= BROADCAST_UNITS else out

    hits = files.where(hopeful("text")).dropDuplicates(["rk"])
    hits = hits.join(holding(hits, "text", "rk"), "rk", "left_semi").withColumn("lines", F.split("text", "\n"))
    lines = hits.select("rk", F.posexplode("lines").alias("at", "unit")).withColumn("span", F.lit(1))
    several = hits.where(F.size("lines") > 1)
    # Windows of two lines at least; the last ones of a file are shorter than asked for.
    def windows_of(k: int):
        starts = F.sequence(F.lit(0), F.size("lines") - 2, F.lit(k // 2))
        return F.transform(starts, lambda i: F.struct(i.cast("int").alias("at"), F.array_join(F.slice("lines", i + 1, F.lit(k)), " ").alias("unit"), F.lit(k).alias("span")))

    windows = several.select("rk", F.inline(F.concat(*map(windows_of, WINDOWS))))
    units = lines.unionByName(windows.where(F.length("unit") <= WINDOW_CHARS)).where(hopeful("unit")).unionByName(several.select("rk", F.lit(0).alias("at"), F.col("text").alias("unit"), F.lit(0).alias("span")))
    unit = ["rk", "at", "span"]
    # An upper bound of each unit's cosines: exact for its template words, and every
    # other word counted once. Only units that it lets through have all words counted.
    stop = F.array(F.lit(""), *[F.lit(w) for w in sorted(FUNCTION_WORDS)])
    split = F.split(F.lower("unit"), "[^a-z0-9]+")
    told = units.select(*unit, F.size(F.array_except(split, stop)).alias("kinds"), F.explode(split).alias("word")).join(known, "word")
    told = told.groupBy(*unit, "kinds", "word").agg((F.count("*") * F.first("idf")).alias("w"))
    told = cut_lineage(told)
    least_norm = told.groupBy(*unit).agg(F.sqrt(F.sum(F.col("w") * F.col("w")) + (F.max("kinds") - F.count("*")) * unknown * unknown).alias("norm"))
    best_dot = told.join(vectors, "word").groupBy(*unit, "template").agg(F.sum(F.col("w") * F.col("weight")).alias("dot")).groupBy(*unit).agg(F.max("dot").alias("dot"))
    held = cut_lineage(best_dot.join(least_norm, unit).where(F.col("dot") >= (least - 1e-6) * F.col("norm")).select(*unit))
    held = F.broadcast(held) if held.count() <= BROADCAST_UNITS else held
    again = F.when(F.col("span") == 0, F.col("text")).otherwise(F.array_join(F.slice("lines", F.col("at") + 1, F.greatest("span", F.lit(1))), " "))
    units = hits.join(held, "rk").select(*unit, again.alias("unit"))
    words = units.select(*unit, F.explode(F.split(F.lower("unit"), "[^a-z0-9]+")).alias("word")).where((F.col("word") != "") & ~F.col("word").isin(*sorted(FUNCTION_WORDS)))
    bag = words.groupBy(*unit, "word").agg(F.count("*").alias("tf")).join(known, "word", "left")
    bag = bag.withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    norm = bag.groupBy(*unit).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = bag.where("idf is not null").join(vectors, "word").groupBy(*unit, "template", "license").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norm, unit).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= least)
    best = scored.groupBy("rk").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best"), F.max((F.col("at") == 0) & (F.col("span") > 0)).alias("first_line"))
    return best.select("rk", F.col("best.license").alias("license"), (-F.col("best.s")).alias("score"), "first_line")


def scan_licenses(files: DataFrame, least: float = LEAST, templates: list[tuple[str, str]] = TEMPLATES, first_line_files: bool = False) -> DataFrame:
    """``files`` (columns other than text kept) plus license, score, basis ('own',
    'inherited' or 'none') and license_path (the file that the licence is from)."""
    row_key_, own_, score_, first_, dir_, near_ = (free_name(n, files) for n in ("row_key", "own_license", "own_score", "opens", "directory", "near"))
    keyed = files.withColumn(row_key_, F.xxhash64("path", "text"))
    own = own_licenses(keyed.select(F.col(row_key_).alias("rk"), F.col("text").cast("string").alias("text")), least, templates)
    own = cut_lineage(own)  # few rows, read several times below
    rest = [F.col(f"`{c}`") for c in files.columns if c != "text"]
    out = keyed.select(*rest, row_key_).join(own.select(F.col("rk").alias(row_key_), F.col("license").alias(own_), F.col("score").alias(score_), F.col("first_line").alias(first_)), row_key_, "left")
    out = out.withColumn(dir_, F.regexp_extract("path", "^(.*)/[^/]*$", 1))

    named = F.element_at(F.split("path", "/"), -1).rlike(_NAME)
    gives = named | F.col(first_) if first_line_files else named
    given = out.where(F.col(own_).isNotNull() & gives).groupBy(dir_).agg(
        F.min(F.struct((-F.col(score_)).alias("s"), F.col("path").alias("from"), F.col(own_).alias("license"))).alias("g"))
    # Distinct directories against their ancestors ("" is the root), nearest first.
    parts = F.split(dir_, "/")
    up = F.when(F.col(dir_) == "", F.array(F.lit(""))).otherwise(
        F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))))
    above = out.where("path is not null").select(dir_).distinct().select(dir_, F.posexplode(up).alias("depth", "ancestor"))
    near = above.join(given.withColumnRenamed(dir_, "ancestor"), "ancestor").groupBy(dir_).agg(F.max(F.struct("depth", "g")).alias(near_))
    out = out.join(near, dir_, "left")
    inherited = F.col(f"{near_}.g.license")
    own_here = F.col(own_).isNotNull()
    return out.select(
        *rest,
        F.coalesce(F.col(own_), inherited).alias("license"),
        F.when(own_here, F.col(score_)).otherwise(-F.col(f"{near_}.g.s")).alias("score"),
        F.when(own_here, "own").when(inherited.isNotNull(), "inherited").otherwise("none").alias("basis"),
        F.when(own_here, F.col("path")).otherwise(F.col(f"{near_}.g.from")).alias("license_path"),
    )


def oracle(files: str, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> str:
    """The scan of the relation ``files`` (doc_id, path, text), licence files by
    first line, in DuckDB SQL: every unit is scored, without the word pattern."""
    stop = ", ".join(f"'{w}'" for w in sorted(FUNCTION_WORDS))
    spans = ", ".join(f"({k}, {k // 2})" for k in WINDOWS)
    values = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(templates))
    return f"""
WITH f AS ({files}),
t(template, license, body) AS (VALUES {values}),
tw AS (SELECT template, license, word, count(*) AS tf FROM (SELECT template, license, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS word FROM t) WHERE word NOT IN ({stop}) GROUP BY ALL),
idf AS (SELECT word, ln(1 + (SELECT count(*) FROM t) / count(*)) AS idf FROM tw GROUP BY word),
tv AS (SELECT template, license, word, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS weight FROM tw JOIN idf USING (word)),
g AS (SELECT DISTINCT doc_id, path, text, string_split(text, chr(10)) AS lines FROM f WHERE text IS NOT NULL),
units AS (
  SELECT doc_id, path, no - 1 AS pos, 1 AS span, lines[no] AS unit FROM g, unnest(range(1, len(lines) + 1)) AS r(no)
  UNION ALL SELECT * FROM (
    SELECT doc_id, path, no * step AS pos, k, array_to_string(list_slice(lines, no * step + 1, no * step + k), ' ') AS unit
    FROM g, (VALUES {spans}) AS s(k, step), unnest(range(0, (len(lines) - 2) // step + 1)) AS r(no) WHERE len(lines) > 1) WHERE length(unit) <= {WINDOW_CHARS}
  UNION ALL SELECT doc_id, path, 0, 0, text FROM g WHERE len(lines) > 1),
bag AS (
  SELECT doc_id, path, pos, span, word, count(*) AS tf
  FROM (SELECT doc_id, path, pos, span, unnest(regexp_extract_all(lower(unit), '[a-z0-9]+')) AS word FROM units) WHERE word NOT IN ({stop}) GROUP BY ALL),
w AS (SELECT bag.*, idf.idf, tf * coalesce(idf.idf, ln(1 + (SELECT count(*) FROM t))) AS v FROM bag LEFT JOIN idf USING (word)),
norm AS (SELECT doc_id, path, pos, span, sqrt(sum(v * v)) AS norm FROM w GROUP BY ALL),
hit AS (
  SELECT doc_id, path, pos, span, license, round(sum(v * weight) / any_value(norm), 6) AS score
  FROM w JOIN tv USING (word) JOIN norm USING (doc_id, path, pos, span) WHERE idf IS NOT NULL GROUP BY doc_id, path, pos, span, template, license),
own AS (SELECT doc_id, path, min({{'s': -score, 'l': license}}) AS b, bool_or(pos = 0 AND span > 0) AS first FROM hit WHERE score >= {least} GROUP BY ALL),
given AS (
  SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, min({{'s': b.s, 'p': path, 'l': b.l}}) AS g
  FROM own WHERE first OR regexp_matches(regexp_extract(path, '[^/]*$'), '(?i)^(licen[cs]e|copying|notice)([.-].*)?$') GROUP BY 1),
near AS (
  SELECT f.doc_id, f.path, arg_max(g, length(dir)) AS g
  FROM f JOIN given ON dir = '' OR starts_with(f.path, dir || '/') GROUP BY ALL)
SELECT f.doc_id, f.path, coalesce(own.b.l, near.g.l) AS license, coalesce(-own.b.s, -near.g.s) AS score,
  CASE WHEN own.b IS NOT NULL THEN 'own' WHEN near.g IS NOT NULL THEN 'inherited' ELSE 'none' END AS basis,
  CASE WHEN own.b IS NOT NULL THEN f.path ELSE near.g.p END AS license_path
FROM f LEFT JOIN own USING (doc_id, path) LEFT JOIN near USING (doc_id, path)"""
