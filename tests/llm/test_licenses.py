"""Licence digests."""

from plumbline.llm import licenses

SCHEMA = "doc_id long, text string"


def test_canonical_forms_meet(spark):
    mit = licenses.LICENSES["MIT"]
    worn = "The MIT years\n".replace("The MIT years\n", "") + "Copyright (c) 2020 Some One\n (C) 2021 Other\nAll rights reserved.\n" + mit.upper().replace('"', "'").replace("\n", "\r\n  * ").replace("SUBLICENSE", "SUB-LICENCE").replace("NONINFRINGEMENT", "non-infringement")
    rows = [
        (1, mit), (2, worn), (3, mit + " and more"), (4, None), (5, ""), (6, licenses.LICENSES["Zlib"].replace("acknowledgment", "acknowledgement")),
        (7, "text\n released under the  M.I.T. ... \nReleased under the MIT licence!\nSPDX-License-Identifier: GPL-3.0\nRELEASED UNDER THE MIT LICENSE\nmore"), (7, "x"), (None, licenses.LICENSES["ISC"]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as digest", "2 as license", "3 as notices")
    found = sorted(((r["doc_id"], r["license"], r["notices"]) for r in licenses.scan(df).collect()), key=repr)
    want = [(1, "MIT", ""), (2, "MIT", ""), (3, None, ""), (4, None, ""), (5, None, ""), (6, "Zlib", ""), (7, None, "GPL-3.0,MIT"), (7, None, ""), (None, "ISC", "")]
    assert found == sorted(want, key=repr)


def test_known_digests_are_distinct(spark):
    known = licenses.known_licenses(spark).collect()
    assert len({r["digest"] for r in known}) == len(known) == len(licenses.LICENSES) + len(licenses.NOTICES) + len(licenses.SPDX)


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_adjacent_spellings(spark):
    row = spark.createDataFrame([("licence licence licence sub licence per cent", "license license license sublicense percent")], "a string, b string")
    assert row.select(licenses.digest(licenses.F.col("a")) == licenses.digest(licenses.F.col("b"))).first()[0]
