"""Licence files as published: wrapped, titled, with copyright statements; the SQL beside them."""

import textwrap

import duckdb

from plumbline.llm import licenses, oracles


def test_wrapped_and_titled_files(spark):
    rows = []
    for name, text in licenses.LICENSES.items():
        for title in ("", *licenses.TITLES[name]):
            for width in (40, 60, 72, 79):
                body = "\n\n".join(textwrap.fill(x, width) for x in text.split("\n\n"))
                for line in ("Copyright (c) 2020, Some One", "Copyright 2020 Some One", "Copyright \u00a9 Some One", "Copyright Jane Doe", "Copyright: The Foo Authors", "Copyright Noah Holdt", "Copyright [year] [name]"):
                    rows.append((len(rows), f"{title}\n\n{line}\nAll rights reserved.\n\n{body}\n", name))
    rows.append((len(rows), "MIT License\n\nand nothing else", None))
    df = spark.createDataFrame(rows, "doc_id long, text string, want string")
    found = {r["doc_id"]: r["license"] for r in licenses.scan(df).collect()}
    assert [(t, found[i], w) for i, t, w in rows if found[i] != w] == []
    documents = df.toPandas()  # noqa: F841
    same = {i: name for i, _, name, _ in duckdb.sql(oracles.LICENSE_SCAN).fetchall()}
    assert {i: x or None for i, x in same.items()} == found


def test_body_lines_stay(spark):
    lines = [f"copyright {word} x" for word in licenses.BODY_WORDS]
    got = spark.createDataFrame([(x,) for x in lines], "t string").select(licenses.canonical(licenses.F.col("t")).alias("c")).collect()
    assert all(r["c"].startswith("copyright ") for r in got)


def test_ids_of_only_and_or_later(spark):
    ids = ["GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "CC-BY-SA-4.0"]
    df = spark.createDataFrame([(i, f"x\n# SPDX-License-Identifier: {x}\ny") for i, x in enumerate(ids)], "doc_id long, text string")
    assert [r["notices"] for r in licenses.scan(df).orderBy("doc_id").collect()] == ids


def test_known_texts_from_a_folder(spark, tmp_path):
    (tmp_path / "Beer-42.txt").write_text("As long as you retain this notice\nyou can do whatever you want with this stuff.\n")
    (tmp_path / "Short.md").write_text("Do as you please.")
    texts = licenses.license_files(spark, str(tmp_path))
    rows = [(1, "AS LONG AS you retain this notice, you can do whatever you want with this stuff"), (2, "x\ndo as you please!\ny"), (3, licenses.LICENSES["MIT"]), (4, None)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), texts)
    assert [tuple(r) for r in found.select("doc_id", "license", "notices").orderBy("doc_id").collect()] == [(1, "Beer-42", "Beer-42"), (2, None, "Short"), (3, None, ""), (4, None, "")]
    none = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), texts.limit(0))
    assert {(r["license"], r["notices"]) for r in none.collect()} == {(None, "")}


def test_very_long_texts(spark):
    mit = licenses.LICENSES["MIT"]
    rows = [(1, "word " * 400_000), (2, "\n".join(["Released under the MIT License."] * 50_000)), (3, mit + " " * 2_000_000), (4, "copyright " * 200_000)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r["license"], r["notices"]) for r in found] == [(None, ""), (None, "MIT"), ("MIT", ""), (None, "")]
