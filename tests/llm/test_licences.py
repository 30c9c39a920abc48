import textwrap

import duckdb
import pytest

from tests.oracle_check import connect, differences
from vidpulse.llm import licences

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."


def scan(spark, rows):
    return {r.path: r for r in licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()}


def test_query_matches_sql(spark, sf_dir):
    assert differences(spark, "op2_licences", sf_dir, connect(sf_dir)) == []


def test_own_inherited_and_none(spark):
    code = "some code\n" * 30
    found = scan(
        spark,
        [
            ("LICENSE", GPL),
            ("a/LICENSE.txt", "mit\n" + MIT),
            ("a/x.py", code),
            ("a/b/c/y.py", code + "# " + MIT.upper()),
            ("a/b/c/z.py", code + "licence free words"),
            ("d/e.py", None),
            ("top.py", ""),
        ],
    )
    kinds = {p: (r.license, r.origin, r.from_path) for p, r in found.items()}
    assert kinds == {
        "LICENSE": ("GPL-3.0", "own", "LICENSE"),
        "a/LICENSE.txt": ("MIT", "own", "a/LICENSE.txt"),
        "a/x.py": ("MIT", "inherited", "a/LICENSE.txt"),
        "a/b/c/y.py": ("MIT", "own", "a/b/c/y.py"),
        "a/b/c/z.py": ("MIT", "inherited", "a/LICENSE.txt"),
        "d/e.py": ("GPL-3.0", "inherited", "LICENSE"),
        "top.py": ("GPL-3.0", "inherited", "LICENSE"),
    }


def test_licence_file_split_over_lines(spark):
    broken = "Redistribution and use in source and binary forms,\nwith or without modification, are permitted\nprovided that the following conditions are met"
    assert scan(spark, [("x/COPYING", broken), ("x/y", "z")])["x/y"].license == "BSD-3-Clause"


TITLES = {
    "AGPL-3.0": ("GNU AFFERO GENERAL PUBLIC LICENSE", "Version 3, 19 November 2007"),
    "GPL-3.0": ("GNU GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007"),
    "GPL-2.0": ("GNU GENERAL PUBLIC LICENSE", "Version 2, June 1991"),
    "LGPL-3.0": ("GNU LESSER GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007"),
    "LGPL-2.1": ("GNU LESSER GENERAL PUBLIC LICENSE", "Version 2.1, February 1999"),
    "Apache-2.0": ("Apache License", "Version 2.0, January 2004"),
}


def test_texts_of_one_family_are_told_apart(spark):
    rest = "\n\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n"
    rest += "\n  The licenses for most software and other practical works are designed\nto take away your freedom to share and change the works.\n" * 20
    rows = [(f"{name}/COPYING", f"{' ' * 20}{one}\n{' ' * 23}{two}{rest}") for name, (one, two) in TITLES.items()]
    rows += [(f"{name}/code.py", "x = 1") for name in TITLES]
    found = scan(spark, rows)
    assert {p: r.license for p, r in found.items()} == {p: p.split("/")[0] for p, _ in rows}


def test_wrapped_headers(spark):
    code = "\n\nsome code of the module\n" + "x = compute(y)\n" * 200
    rows, expected = [], {}
    for k, (name, text) in enumerate(licences.TEMPLATES):
        for mark in ("# ", " * ", "// "):
            path = f"{k}/{mark.strip()}x".replace("//", "s")
            header = textwrap.fill(text, 72, initial_indent=mark, subsequent_indent=mark)
            rows.append((path, "#!/bin/sh\n" + header + code))
            expected[path] = (name, "own", path)
    rows.append(("none/x", "free software of the public, and the terms\nof use and a copy" + code))
    found = scan(spark, rows)
    assert found.pop("none/x").license is None
    assert {p: (r.license, r.origin, r.from_path) for p, r in found.items()} == expected


def test_ties_repeats_and_nulls(spark):
    rows = [("d/b.txt", MIT), ("d/a.txt", GPL), ("d/a.txt", GPL), ("d/z", "nothing"), (None, GPL), (None, None), ("e/z", "nothing")]
    found = licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()
    assert len(found) == len(rows)
    by = {r.path: r for r in found}
    assert by["d/z"].from_path == "d/a.txt" and by["e/z"].license is None


def test_empty_table(spark):
    assert licences.scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_plan_has_no_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("source as path", "text")
    plan = licences.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("threshold", [0.5, 0.75, 0.95])
def test_lines_without_anchors_stay_below_the_threshold(threshold):
    counts = {t: 1 + 37 * k % 900 for k, t in enumerate(sorted({t for _, x in licences.TEMPLATES for t in licences.tokens(x)}))}
    _, vectors = licences.weights(counts, 1000)
    marks = set(licences.anchors(vectors, threshold))
    for v in vectors:
        assert sum(w * w for t, w in v.items() if t not in marks) ** 0.5 < threshold


def test_sql_runs_on_odd_rows():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT * FROM (VALUES (1, 'a', 'en', NULL), (NULL, NULL, NULL, 'x')) t(doc_id, source, lang, text)")
    assert len(con.execute(licences.oracle()).fetchall()) == 2
