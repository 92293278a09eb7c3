import math

import duckdb
from lakegauge.llm import license_scan, queries

SF = "/root/testdata/sf0.01"


def same(spark, files):
    found = license_scan.scan(files).select("doc_id", "path", "own_licence", "own_score", "licence", "origin", "from_directory")
    data = files.select("doc_id", "path", "text").toArrow()  # noqa: F841
    want = duckdb.sql(license_scan.oracle("SELECT * FROM data", "doc_id")).fetchall()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, found.collect())) == sorted(map(key, want))
    return found


def test_documents_against_sql(spark):
    q = queries.op3_license_scan(spark, SF)
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = duckdb.sql(queries.oracle_sql()["op3_license_scan"])
    assert sorted(q.columns) == sorted(want.columns)
    got = sorted(tuple(str(x) for x in r) for r in q.select(*want.columns).collect())
    assert got == sorted(tuple(str(x) for x in r) for r in want.fetchall())
    assert {r[5] for r in want.fetchall()} >= {"own", "inherited"}


def test_nearest_directory_and_odd_rows(spark):
    rows = [
        (1, "r/LICENSE", "\n -- \nReleased under the MIT License.\nmore text here"), (2, "r/a/b/c.py", "no licence"), (3, "r/a/b/LICENSE", "Licensed under the Apache License, Version 2.0."),
        (4, "r/a/d.py", "x = 1"), (5, "r/ab/e.py", "code\nAll rights reserved."), (6, "t/f.py", None), (7, None, "Released under the MIT License"), (8, "top", "All rights reserved."),
        (9, "r/a/b/c.py", "no licence"), (10, "s/g", ""), (11, "s/h", "All Rights Reserved. Released under the MIT License."), (12, "r/a/b/NOTICE", "Released under the MIT License"), (13, "t/long", "word " * 50000),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    found = {r["doc_id"]: r for r in same(spark, files).collect()}
    assert (found[2]["licence"], found[2]["from_directory"]) == ("Apache-2.0", "r/a/b")
    assert (found[4]["licence"], found[4]["origin"]) == ("MIT", "inherited")
    assert (found[5]["licence"], found[5]["origin"]) == ("Proprietary", "own")
    assert found[6]["origin"] == found[13]["origin"] == "none" and found[7]["licence"] == "MIT"
    assert license_scan.scan(files.limit(0)).collect() == []
    extra = files.withColumn("licences", files.path).withColumn("score", files.doc_id).withColumn("directory", files.path)
    assert license_scan.scan(extra).count() == len(rows)


def test_every_term_has_its_own_weight(spark):
    notices = ["All rights reserved, as it was.", "Licensed under CC BY-NC 4.0, as it was for the rest on it.", "Released under the MIT License for all, as it was."]
    prose = [(i, f"p/{i}", f"it was a day{i} as it is for the rest on all") for i in range(400)]
    files = spark.createDataFrame(prose + [(1000 + i, f"n/{i}.txt", t) for i, t in enumerate(notices)], "doc_id long, path string, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(files).collect()}
    texts = prose + [(1000 + i, "", t) for i, t in enumerate(notices)]
    sets = {i: set(license_scan.terms_of(t)) for i, _, t in texts}
    weight = lambda term: math.log((1 + len(texts)) / (1 + sum(term in s for s in sets.values()))) + 1
    norm = lambda s: math.sqrt(sum(weight(x) ** 2 for x in s))
    for i, name in zip((1000, 1001, 1002), ("Proprietary", "CC-BY-NC-4.0", "MIT")):
        score = max(sum(weight(x) ** 2 for x in own & sets[i]) / (norm(own) * norm(sets[i])) for own in (set(license_scan.terms_of(t)) for t in license_scan.TEMPLATES[name]))
        assert found[i]["own_licence"] == name and abs(found[i]["own_score"] - score) < 2e-6
    assert all(found[i]["origin"] == "none" for i in range(400))


GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
#
# You should have received a copy of the GNU General Public License
# along with this program.  If not, see <https://www.gnu.org/licenses/>.
import os
print(os.name)
"""
APACHE = """
                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions.
""" + "   Words of the many sections that follow, which no template has, one after another.\n" * 40
MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""


def test_headers_and_licence_files(spark):
    prose = [(100 + i, f"other/{i}.txt", f"some prose of file {i}\nand a second line of it\n\nand more of the text of it") for i in range(60)]
    rows = [(1, "g/main.py", GPL), (2, "a/LICENSE", APACHE), (3, "m/LICENSE", MIT), (4, "a/src/x.py", "x = 1"), (5, "m/deep/er/y.py", "y = 2"), (6, "g/z.py", "z = 3"), (7, "b/LICENSE", APACHE.replace("\n", "\r\n")), (8, "c/h.c", "/*\n * " + license_scan.TEMPLATES["MPL-2.0"][1].replace(". ", ".\n * ") + "\n */\nint x;")]
    found = {r["doc_id"]: r for r in same(spark, spark.createDataFrame(rows + prose, "doc_id long, path string, text string")).collect()}
    assert [(found[i]["licence"], found[i]["origin"]) for i in (1, 2, 3, 7, 8)] == [(x, "own") for x in ("GPL-3.0", "Apache-2.0", "MIT", "Apache-2.0", "MPL-2.0")]
    assert [(found[i]["licence"], found[i]["from_directory"]) for i in (4, 5, 6)] == [("Apache-2.0", "a"), ("MIT", "m"), ("GPL-3.0", "g")]
    assert all(found[100 + i]["origin"] == "none" for i in range(60))


def test_every_template_finds_its_licence(spark):
    rows = [(i, f"t{i}/f", text) for i, (name, text) in enumerate((n, t) for n, texts in license_scan.TEMPLATES.items() for t in texts)]
    names = [n for n, texts in license_scan.TEMPLATES.items() for _ in texts]
    prose = [(1000 + i, f"p/{i}", "the of and in to a is it for this that with or you not any") for i in range(200)]
    found = {r["doc_id"]: r for r in same(spark, spark.createDataFrame(rows + prose, "doc_id long, path string, text string")).collect()}
    assert [found[i]["own_licence"] for i in range(len(rows))] == names
