"""Licence notices inside lines and paragraphs, against plain sets of bigrams."""

from __future__ import annotations

import re

from changelake.llm.licences import NOTICES, plain_words, scan_windows
from changelake.llm.queries import QUERIES
from tests.llm.test_licences import MIT, ODD, SF


def bigrams(words):
    return frozenset(zip(words, words[1:], strict=False))


KNOWN = [(name, len(plain_words(text)), bigrams(plain_words(text))) for name, text in NOTICES]


def brute(text, threshold=0.8):
    norm = re.sub(r"[^\w\n]|_", " ", (text or "").lower())
    words = norm.split()
    units = {bigrams(u.split()) for u in [*norm.split("\n"), *re.split(r"\n *\n", norm), norm]}
    runs = {n: {bigrams(words[i : i + n]) for i in range(len(words) - n + 1)} for n in {n for _, n, _ in KNOWN}}
    found = set()
    for name, n, b in KNOWN:
        for a in units | runs[n]:
            if a and 2 * len(a & b) / (len(a) + len(b)) >= threshold:
                found.add((2 * len(a & b) / (len(a) + len(b)), name))
    best = max(found, default=(None, None))
    return sorted({name for _, name in found}), best[1], best[0]


INSIDE = {
    "This project is released under the MIT License.": "MIT",
    "(c) 2020 Foo. Released under the MIT License.": "MIT",
    "Licensed under the MIT License.": "MIT",
    "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "long prose before " * 50 + "licensed under\nCC BY-NC 4.0, and after " + "more prose " * 50: "CC-BY-NC-4.0",
    "x = 1\n" + MIT.replace(" and ", "\n// and ") + "\ny = 2 " + "z " * 200: "MIT-notice",
    "words at the start " * 30 + MIT[: len(MIT) - 60]: "MIT-notice",
    ("prose " * 300 + MIT + " ") * 5: "MIT-notice",
    "The work is under the GNU General Public License v3.0 or later": "GPL-3.0",
}


def test_notices_inside_lines_and_paragraphs(spark):
    texts = [*ODD, *INSIDE, "Licensed under the BSD license", "GNU General Public License v2", "the mit license said so", "two words"]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, name string, run int")
    rows = {r.doc_id: r for r in scan_windows(docs.repartition(3)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert (rows[i].licences, rows[i].best_licence, rows[i].best_dice) == brute(text), text
        if text in INSIDE:
            assert INSIDE[text] in rows[i].licences, text
    assert scan_windows(docs.limit(0)).collect() == []


def test_query_on_the_given_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op5_license_windows"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        if r.licences or r.doc_id % 10 == 0:
            names, best, dice = brute(docs[r.doc_id])
            assert (r.licences, r.best_licence, r.best_dice) == (",".join(names), best, dice), r.doc_id


def test_all_that_the_units_find_is_found(spark):
    units = {r.doc_id: r.licences for r in QUERIES["op5_license_scan"](spark, SF).collect()}
    runs = {r.doc_id: r.licences for r in QUERIES["op5_license_windows"](spark, SF).collect()}
    assert all(set(units[d].split(",")) <= set(runs[d].split(",")) for d in units if units[d])


def test_no_shuffle_and_no_python(spark):
    plan = scan_windows(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Join", plan)
