"""Licence scans against plain sets of bigrams and their SQL."""

from __future__ import annotations

import re

import duckdb

from changelake.llm.licences import TEMPLATES, plain_words, scan
from changelake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def brute(text, threshold=0.8):
    norm = re.sub(r"[^\w\n]|_", " ", (text or "").lower())
    found = set()
    for unit in [*norm.split("\n"), *re.split(r"\n *\n", norm), norm]:
        w = unit.split()
        a = set(zip(w, w[1:], strict=False))
        for name, template in TEMPLATES.items():
            t = plain_words(template)
            b = set(zip(t, t[1:], strict=False))
            if a and 2 * len(a & b) / (len(a) + len(b)) >= threshold:
                found.add((2 * len(a & b) / (len(a) + len(b)), name))
    best = max(found, default=(None, None))
    return sorted({name for _, name in found}), best[1], best[0]


MIT = TEMPLATES["MIT-notice"]
ODD = [
    None, "", "\n\n", "one", "Released under the MIT License.", "released UNDER the mit -- license", "before\nReleased under the MIT License!\nafter",
    "Released under the MIT License. And more words on this line, many more.", MIT, MIT.replace(" copy ", " copy\n").replace(", ", ",\n"),
    "prose here\n\n" + MIT.replace(" and ", "\nand ") + "\n\nmore prose", MIT.replace("Software", "Library"), " ".join(MIT.split()[:40]),
    "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.", "mit license " * 30_000, "Été über ñandú", "a_b c_d",
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in [*enumerate(ODD), (None, ODD[4]), (4, ODD[4])]], "doc_id bigint, text string, name string, b int")
    rows = scan(docs.repartition(3)).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        assert (r.licences, r.best_licence, r.best_dice) == brute(ODD[4 if r.doc_id is None else r.doc_id]), r
    assert scan(docs.limit(0)).collect() == []


def test_no_shuffle_and_no_python(spark):
    plan = scan(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Join", plan)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(f"SELECT doc_id, licences, best_licence, best_dice FROM ({ORACLES['op5_license_scan']})").fetchall()
    got = [(r.doc_id, r.licences, r.best_licence, r.best_dice) for r in QUERIES["op5_license_scan"](spark, SF).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and {n for _, x, _, _ in got for n in x.split(",")} >= {"MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0"}
