"""Licences of files: TF-IDF cosine of their parts to templates, and inheritance by directory. DataFrame functions only.

A file's parts are its header, its whole text and each of its lines. The header is the leading block of
comment lines, or else the first paragraph. A part is a set of terms (ASCII letters lower-cased, cut at
all but letters and digits), and a term's weight ln((1 + lines) / (1 + lines with it)) + 1 over all lines
of all files. A licence has several templates: short notices, notices of file headers, and texts or titles
of licence files. The best template at THRESHOLD or more, ties by name, is the part's licence; the best
part's is the file's own. A file declares its own for its directory (of several the least path counts) if its
header, its whole text or its first or last line with terms has a licence. A file without a
licence of its own has that of the nearest directory above it with such a file.

Only the template terms' counts and the greatest other count come to the driver. A part that
reaches the threshold has terms of the template with that square's share of its weight, so one at least
of what is left of a template without its most common terms: files that hold no such term anywhere are
not cut into parts. Texts are cut into terms once, and these are stored. No term outside the templates weighs less than that of the greatest count, so a part is
scored only if it reaches the threshold with that weight for each; then those terms' counts are joined.

Defined results: null or empty text has no parts; a null path has no directory; rows that share a
path are one file each and inherit alike; extra columns pass through, but for ones named as those made here; equal scores take the least name.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace, small, without

#: The usual notices, headers, titles and texts of common licences.
TEMPLATES = {
    "AGPL-3.0": [
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "GPL-2.0": [
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-3.0": [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
        'MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0",
    ],
    "Proprietary": ["All rights reserved"],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}
THRESHOLD = 0.6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: str) -> list[str]:
    """The terms of a template."""
    import re

    return sorted(set(re.findall("[a-z0-9]+", text.translate(str.maketrans(_UPPER, _LOWER)))))


_BREAK, _COMMENT, _INK = r"\r\n|\n|\r", r"^[ \t]*(#|//|/\*|\*|--|;|%|<!--)", r"[^ \t\f]"
#: Places of parts that are no lines.
HEADER, WHOLE = -2, -1


def tokenised(files: DataFrame, text: str) -> DataFrame:
    """_path, _row, the terms of each line, and the first line of the header and its number of lines; each text is cut once."""
    parts = files.where(F.col(text).isNotNull()).select("_path", "_row", F.split(text, _BREAK).alias("parts"))
    position = lambda column, test: F.array_position(F.transform(column, test), True)
    ink = parts.select("*", F.greatest(position("parts", lambda x: x.rlike(_INK)), F.lit(1)).cast("int").alias("start"))
    rest = ink.select("*", F.slice("parts", F.col("start"), F.size("parts")).alias("rest"))
    comment = F.get("rest", F.lit(0)).rlike(_COMMENT)
    stop = F.when(comment, position("rest", lambda x: ~x.rlike(_COMMENT))).otherwise(position("rest", lambda x: ~x.rlike(_INK)))
    terms = lambda x: F.array_distinct(F.regexp_extract_all(F.translate(x, _UPPER, _LOWER), F.lit("[a-z0-9]+"), F.lit(0)))
    found = rest.select("_path", "_row", "start", "rest", stop.cast("int").alias("stop"), F.transform("parts", terms).alias("lines"))
    return found.select("_path", "_row", "lines", "start", F.when(F.col("stop") > 0, F.col("stop") - 1).otherwise(F.size("rest")).alias("length"))


def parts(files: DataFrame) -> DataFrame:
    """(_path, _row, place, terms) of headers, whole texts and lines of tokenised files."""
    one = lambda place, lists: F.struct(F.lit(place).alias("place"), F.array_distinct(F.flatten(lists)).alias("terms"))
    others = files.select("_path", "_row", F.inline(F.array(one(HEADER, F.slice("lines", F.col("start"), F.col("length"))), one(WHOLE, F.col("lines")))))
    return others.unionByName(files.select("_path", "_row", F.posexplode("lines").alias("place", "terms"))).where(F.size("terms") > 0)


def telling(by: dict[str, list[list[str]]], weight: dict[str, float], threshold: float) -> list[str]:
    """Terms of which every part that reaches the threshold has one: each template's but for its most common ones, whose squares together are under the threshold's share."""
    out = set()
    for templates in by.values():
        for own in templates:
            left, share = sorted(own, key=lambda t: (weight[t], t)), threshold**2 * sum(weight[t] ** 2 for t in own) * (1 - 1e-4)
            while left and (share := share - weight[left[0]] ** 2) > 0:
                left.pop(0)
            out.update(left)
    return sorted(out)


def own_licences(files: DataFrame, text: str, work: Workspace, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Parts with licence and score, those at the threshold only; files have _path and _row."""
    by = {name: [terms_of(t) for t in texts] for name, texts in templates.items()}
    vocabulary = sorted({t for texts in by.values() for own in texts for t in own})
    files = work.write(tokenised(files, text), "tokenised")
    n = files.agg(F.sum(F.size(F.filter("lines", lambda x: F.size(x) > 0)))).collect()[0][0] or 0
    counts = work.write(files.select(F.explode(F.flatten("lines")).alias("term")).groupBy("term").count(), "terms")
    seen = {r[0]: r[1] for r in counts.where(F.col("term").isin(*vocabulary)).collect()}  # one row for each template term
    weight = {t: math.log((1 + n) / (1 + seen.get(t, 0))) + 1 for t in vocabulary}
    lookup = F.create_map(*[F.lit(x) for t in vocabulary for x in (t, weight[t] ** 2)])
    squares = lambda terms: F.aggregate(terms, F.lit(0.0), lambda s, t: s + F.element_at(lookup, t))

    def scored(rows, outside):
        """rows with their best licence, at the threshold; outside is the sum of squares of the terms in no template."""
        norm = F.sqrt(squares("_in") + outside)
        one = lambda own: F.round(squares(F.array_intersect("_in", F.array(*map(F.lit, own)))) / (norm * F.lit(math.sqrt(sum(weight[t] ** 2 for t in own)))), 6)
        scores = [F.struct((-F.greatest(*map(one, texts), F.lit(0.0))).alias("s"), F.lit(name).alias("licence")) for name, texts in sorted(by.items())]
        return rows.withColumn("_best", F.array_min(F.array(*scores))).where(-F.col("_best.s") >= threshold)

    likely = files.where(F.arrays_overlap(F.flatten("lines"), F.array(*map(F.lit, telling(by, weight, threshold)))))
    known = F.array(*map(F.lit, vocabulary))
    sized = parts(likely).withColumn("_in", F.array_intersect("terms", known)).withColumn("_out", F.array_except("terms", known))
    # cosine t with a template needs that much of a part's squares to be the template's, so of its known terms
    most = counts.where(~F.col("term").isin(*vocabulary)).agg(F.max("count")).collect()[0][0] or 0
    least = (math.log((1 + n) / (1 + most)) + 1) ** 2 if n else 1.0  # no term outside weighs less
    outside = F.size("_out") * F.lit(least)
    sized = sized.where((F.size("_in") > 0) & (squares("_in") * (1 - threshold**2) * (1 + 1e-5) >= outside * threshold**2))
    near = work.write(scored(sized, outside).select("_path", "_row", "place", "_in", "_out").dropDuplicates(["_path", "_row", "place"]), "near")
    wanted = small(near.select(F.explode("_out").alias("term")).distinct())
    square = F.pow(F.log(F.lit(1.0 + n) / (1 + F.col("count"))) + 1, F.lit(2))
    weighed = small(work.write(counts.join(wanted, "term", "left_semi").select("term", square.alias("square")), "weights"))
    outer = near.select("_path", "_row", "place", "_in", F.explode_outer("_out").alias("term")).join(weighed, "term", "left")
    lines_ = outer.groupBy("_path", "_row", "place").agg(F.first("_in").alias("_in"), F.coalesce(F.sum("square"), F.lit(0.0)).alias("_square"))
    return scored(lines_, F.col("_square")).select("_path", "_row", "place", F.col("_best.licence").alias("licence"), (-F.col("_best.s")).alias("score"))


def scan(files: DataFrame, path: str = "path", text: str = "text", templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """files with own_licence, own_score, licence, origin (own, inherited or none) and from_directory."""
    work = Workspace(files.sparkSession, "licences")
    files = without(files, "own_licence", "own_score", "licence", "origin", "from_directory", "_row", "_path", "_p", "_r", "_own", "_first", "_last", "_folder", "_near")
    names = [c for c in files.columns if c != text]
    keyed = files.withColumn("_row", F.xxhash64(path, text))
    scored = work.write(own_licences(keyed.select(F.col(path).alias("_path"), "_row", text), text, work, templates, threshold), "parts")
    first = F.min(F.struct((-F.col("score")).alias("s"), "licence", "place"))
    line = F.when(F.col("place") >= 0, F.col("place"))
    own = scored.groupBy("_path", "_row").agg(first.alias("_own"), F.min(line).alias("_first"), F.max(line).alias("_last"), F.min("place").alias("_least"))
    own = work.write(own, "own")

    directory = lambda p: F.when(F.instr(p, "/") > 0, F.regexp_extract(p, "^(.*)/", 1))
    # a licence line opens or closes the file if no line before or after it has terms; only such files' texts are looked at again
    marked = small(own.where(F.col("_least") >= 0).select("_row", "_path", "_first", "_last").dropDuplicates(["_row"]))
    opening = keyed.withColumnRenamed(path, "_p").join(marked, "_row").where(F.col("_p").eqNullSafe(F.col("_path")))
    parts = F.split(text, r"\r\n|\n|\r")
    bare = lambda some: F.regexp_replace(F.translate(F.array_join(some, " "), _UPPER, _LOWER), "[^a-z0-9]+", "") == ""
    before, after = F.slice(parts, F.lit(1), F.col("_first")), F.slice(parts, F.col("_last") + 2, F.size(parts))
    opening = opening.where(bare(before) | bare(after)).select("_path", "_row").unionByName(own.where(F.col("_least") < 0).select("_path", "_row"))
    declared = opening.join(own, ["_path", "_row"]).select(directory(F.col("_path")).alias("directory"), F.struct("_path", "_own.licence").alias("by")).where("directory is not null")
    declared = work.write(declared.groupBy("directory").agg(F.min("by.licence").alias("one"), F.min("by").alias("by")).select("directory", F.col("by.licence").alias("licence")), "declared")

    folders = keyed.select(directory(F.col(path)).alias("folder")).where("folder is not null").distinct()
    parts = F.split("folder", "/")
    above = F.explode(F.sequence(F.lit(1), F.size(parts))).alias("depth")
    chain = folders.select("folder", above).withColumn("directory", F.array_join(F.slice(F.split("folder", "/"), F.lit(1), F.col("depth")), "/"))
    nearest = chain.join(declared, "directory").groupBy("folder").agg(F.max(F.struct("depth", "licence", "directory")).alias("_near"))
    nearest = work.write(nearest, "nearest")

    rows = keyed.drop(text).withColumn("_folder", directory(F.col(path)))
    mine = own.select(F.col("_row").alias("_r"), F.col("_path").alias("_p"), "_own")
    owned = rows.join(mine, (F.col("_row") == F.col("_r")) & F.col(path).eqNullSafe(F.col("_p")), "left")
    folded = owned.join(nearest.withColumnRenamed("folder", "_folder"), "_folder", "left")
    origin = F.when(F.col("_own").isNotNull(), "own").when(F.col("_near").isNotNull(), "inherited").otherwise("none")
    return folded.select(*names, F.col("_own.licence").alias("own_licence"), (-F.col("_own.s")).alias("own_score"), F.coalesce("_own.licence", "_near.licence").alias("licence"), origin.alias("origin"), F.when(F.col("_own").isNull(), F.col("_near.directory")).alias("from_directory"))


def oracle(files: str, key: str, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for scan over a query files(path, text, key) in which path and text identify a row. Every term weighs as all lines have it."""
    values = ", ".join(f"('{name}', {i}, '{text}')" for name, texts in templates.items() for i, text in enumerate(texts))
    split = lambda t: f"list_distinct(list_filter(regexp_split_to_array(translate({t}, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+'), lambda x: x <> ''))"
    until = lambda test: f"rest[1 : coalesce(list_position(list_transform(rest, lambda x: {test}), true) - 1, len(rest))]"
    return f"""
WITH files AS (SELECT row_number() OVER () AS r, nullif(path, '') AS path, text, {key} FROM ({files})),
templates AS (SELECT name, i, unnest({split('body')}) AS term FROM (VALUES {values}) v(name, i, body)),
raw AS (SELECT r, text, regexp_split_to_array(text, '\r\n|\n|\r') AS parts FROM files WHERE text IS NOT NULL),
lines AS (SELECT * FROM (SELECT r, i AS place, {split('parts[i]')} AS terms FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM raw)) WHERE len(terms) > 0),
started AS (SELECT r, text, parts[coalesce(nullif(list_position(list_transform(parts, lambda x: regexp_matches(x, '{_INK}')), true), 0), 1) :] AS rest FROM raw),
others AS (SELECT r, -2 AS place, {split(f"array_to_string(CASE WHEN regexp_matches(rest[1], '{_COMMENT}') THEN {until(f"NOT regexp_matches(x, '{_COMMENT}')")} ELSE {until(f"NOT regexp_matches(x, '{_INK}')")} END, ' ')")} AS terms FROM started
           UNION ALL SELECT r, -1, {split('text')} FROM raw),
part AS (SELECT * FROM lines UNION ALL SELECT * FROM others WHERE len(terms) > 0),
total AS (SELECT count(*) AS n FROM lines),
seen AS (SELECT term, count(*) AS n FROM (SELECT unnest(terms) AS term FROM lines) GROUP BY term),
weights AS (SELECT term, ln((1 + total.n) / (1 + coalesce(seen.n, 0))::DOUBLE) + 1 AS w FROM (SELECT term FROM seen UNION SELECT term FROM templates) LEFT JOIN seen USING (term), total),
norms AS (SELECT name, i, sqrt(sum(w * w)) AS norm FROM templates JOIN weights USING (term) GROUP BY name, i),
words AS (SELECT r, place, unnest(terms) AS term FROM part),
sized AS (SELECT r, place, sqrt(sum(w * w)) AS norm FROM words JOIN weights USING (term) GROUP BY ALL),
dots AS (SELECT r, place, name, i, sum(w * w) AS dot FROM words JOIN templates USING (term) JOIN weights USING (term) GROUP BY ALL),
scored AS (SELECT r, place, name, max(round(dot / (s.norm * t.norm), 6)) AS score FROM dots JOIN sized s USING (r, place) JOIN norms t USING (name, i) GROUP BY ALL),
hits AS (SELECT r, place, min(name) AS name, any_value(score) AS score FROM (SELECT *, max(score) OVER (PARTITION BY r, place) AS top FROM scored) WHERE score = top AND score >= {threshold} GROUP BY ALL),
own AS (SELECT r, min(row(-score, name, place)) AS best, min(place) FILTER (WHERE place >= 0) AS first_place, max(place) FILTER (WHERE place >= 0) AS last_place, min(place) AS least FROM hits GROUP BY r),
ends AS (SELECT r, min(place) AS first_line, max(place) AS last_line FROM lines GROUP BY r),
opening AS (SELECT path, best[2] AS name, regexp_extract(path, '^(.*)/', 1) AS directory FROM own JOIN files USING (r) JOIN ends USING (r) WHERE (least < 0 OR first_place = first_line OR last_place = last_line) AND path LIKE '%/%'),
declared AS (SELECT directory, arg_min(name, row(path, name)) AS name FROM opening GROUP BY directory),
folders AS (SELECT DISTINCT regexp_extract(path, '^(.*)/', 1) AS folder FROM files WHERE path LIKE '%/%'),
near AS (SELECT folder, arg_max(d.name, length(directory)) AS name, arg_max(directory, length(directory)) AS directory FROM folders f JOIN declared d ON folder = directory OR starts_with(folder, directory || '/') GROUP BY folder)
SELECT f.{key}, f.path, o.best[2] AS own_licence, -o.best[1] AS own_score, coalesce(o.best[2], n.name) AS licence,
       CASE WHEN o.best IS NOT NULL THEN 'own' WHEN n.name IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN o.best IS NULL THEN n.directory END AS from_directory
FROM files f LEFT JOIN own o USING (r) LEFT JOIN near n ON n.folder = regexp_extract(f.path, '^(.*)/', 1)
"""
