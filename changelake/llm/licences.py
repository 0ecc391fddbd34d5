"""Licence scans: Dice coefficients of word bigrams against templates.

A text is put into lower case and everything but letters and digits becomes a space. Its lines, its paragraphs of
several lines and the whole are *units*. A unit's distinct word bigrams are compared with those of each template whose
size allows the coefficient at all: for a threshold ``t`` and a template of ``b`` bigrams, a unit of fewer than
``b t / (2 - t)`` or more than ``b (2 - t) / t`` can't reach it. Everything happens inside a row, with the templates as
constants of the plan: no shuffle and no join.

``scan`` compares units only; ``scan_windows`` also compares every run of as many words as a template has, wherever it
begins and ends. A match at threshold ``t`` shares at least ``b t / (2 - t)`` bigrams with the template, so a text with
fewer is left out, and a run has to hold one of any ``b`` minus that plus one bigrams, for which those of rare words are
taken. Nothing is lost by either.

Null and empty texts match nothing. Each row is scanned by itself, so repeated rows and ids do not matter; columns of
other names are kept out. Among equal coefficients the later name in order of code points is the best.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.plans.once import computed_once

#: Public licence notices, by their usual short names.
TEMPLATES: dict[str, str] = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
    " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
    " option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
    " compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-clauses": "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
    " that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
    " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
    " later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
    ' associated documentation files (the "Software"), to deal in the Software without restriction, including without'
    " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
    " and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
    " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Other usual wordings of the short notices, for ``scan_windows``.
VARIANTS: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License 2.0"),
    ("Apache-2.0", "Licensed under the Apache 2.0 License"),
    ("Apache-2.0", "Released under the Apache License, Version 2.0"),
    ("Apache-2.0", "Released under the Apache 2.0 License"),
    ("Apache-2.0", "Distributed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-NC-4.0", "Released under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("GPL-3.0", "GNU General Public License v3"),
    ("GPL-3.0", "Licensed under the GPL v3"),
    ("GPL-3.0", "Licensed under the GPLv3"),
    ("GPL-3.0", "Released under the GPL v3"),
    ("GPL-3.0", "Released under the GPLv3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Distributed under the MIT License"),
    ("MIT", "Available under the MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "SPDX-License-Identifier: MIT"),
]
NOTICES: list[tuple[str, str]] = [*TEMPLATES.items(), *VARIANTS]
THRESHOLD = 0.8


def plain_words(text: str) -> list[str]:
    """Words of a template, normalised as texts are."""
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def _bigrams(words: Column) -> Column:
    places = F.sequence(F.lit(0), F.size(words) - 2)
    pairs = F.transform(places, lambda i: F.xxhash64(F.get(words, i), F.lit(" "), F.get(words, i + 1)))
    return F.when(F.size(words) >= 2, F.array_distinct(pairs)).otherwise(F.array().cast("array<bigint>"))


def _constants(docs: DataFrame, templates: Mapping[str, str], threshold: float) -> tuple[Column, int, int]:
    """The templates as one constant: name, bigrams and bounds of the size."""
    spark = docs.sparkSession
    words = [(name, plain_words(text)) for name, text in sorted(templates.items())]
    hashed = spark.createDataFrame(words, "name string, words array<string>").select("name", _bigrams(F.col("words")).alias("b"))
    rows = []
    for name, b in sorted((r["name"], r["b"]) for r in hashed.collect()):  # a row for each template
        low, high = ceil(len(b) * threshold / (2 - threshold) - 1e-9), floor(len(b) * (2 - threshold) / threshold + 1e-9)
        rows.append((name, b, low, high))
    fields = [
        F.struct(F.lit(n).alias("name"), F.array([F.lit(x).cast("bigint") for x in b]).alias("b"), F.lit(lo).alias("low"), F.lit(hi).alias("high"))
        for n, b, lo, hi in rows
        if b
    ]
    return F.array(*fields), min(r[2] for r in rows if r[1]), max(r[3] for r in rows if r[1])


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the ``licences`` found in order, ``best_licence`` and ``best_dice`` (null where there is none)."""
    known, least, most = _constants(docs, templates, threshold)
    text = F.lower(F.coalesce("text", F.lit("")))
    rows = computed_once(docs.select("doc_id", F.col("text").alias("text")), __norm=F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " "))
    paragraphs = F.split("__norm", r"\n *\n")
    several = F.filter(paragraphs, lambda p: F.contains(p, F.lit("\n")))
    whole = F.when(F.size(paragraphs) > 1, F.array("__norm")).otherwise(F.array().cast("array<string>"))
    units = F.concat(F.split("__norm", "\n"), several, whole)

    words = F.transform(units, lambda unit: F.split(F.btrim(unit, F.lit(" \n")), "[ \n]+"))
    rows = computed_once(rows.select("doc_id", "__norm"), __words=words)
    rows = computed_once(rows.select("doc_id", "__words"), __units=F.transform("__words", _bigrams))
    fitting = F.filter("__units", lambda b: (F.size(b) >= least) & (F.size(b) <= most))

    def dice(b: Column) -> Column:
        allowed = F.filter(known, lambda t: (F.size(b) >= t["low"]) & (F.size(b) <= t["high"]))
        scored = F.transform(
            allowed,
            lambda t: F.struct((2.0 * F.size(F.array_intersect(b, t["b"])) / (F.size(b) + F.size(t["b"]))).alias("dice"), t["name"].alias("name")),
        )
        return F.filter(scored, lambda m: m["dice"] >= threshold)

    rows = computed_once(rows.select("doc_id", fitting.alias("__fit")), __found=F.flatten(F.transform("__fit", dice)))
    names = F.array_sort(F.array_distinct(F.transform("__found", lambda m: m["name"])))
    best = F.array_max("__found")
    return rows.select("doc_id", names.alias("licences"), best["name"].alias("best_licence"), best["dice"].alias("best_dice"))


_COMMON = frozenset("a an and any are as at be by for from in is it not of on or that the this to with you".split())


def _notices(docs: DataFrame, notices: Iterable[tuple[str, str]], threshold: float) -> Column:
    """The notices as one constant: name, distinct bigrams, bounds of the size, anchors and bigrams of a run."""
    words = [(name, plain_words(text)) for name, text in sorted(notices)]
    pairs = [(i, k, *pair) for i, (_, w) in enumerate(words) for k, pair in enumerate(zip(w, w[1:], strict=False))]
    hashed = docs.sparkSession.createDataFrame(pairs, "i int, k int, a string, b string")
    found: dict[int, dict[int, tuple]] = {}
    for r in hashed.select("i", "a", "b", F.xxhash64("a", F.lit(" "), "b").alias("h")).collect():  # bigrams of the notices
        rarity = (sum(w in _COMMON for w in (r["a"], r["b"])), -len(r["a"] + r["b"]), r["a"], r["b"])
        found.setdefault(r["i"], {})[r["h"]] = rarity
    fields = []
    for i, b in sorted(found.items()):
        low, high = ceil(len(b) * threshold / (2 - threshold) - 1e-9), floor(len(b) * (2 - threshold) / threshold + 1e-9)
        anchors = sorted(b, key=b.get)[: len(b) - low + 1]
        many = lambda hashes: F.array([F.lit(h).cast("bigint") for h in hashes])
        fields.append(
            F.struct(
                F.lit(words[i][0]).alias("name"), many(sorted(b)).alias("b"), F.lit(low).alias("low"), F.lit(high).alias("high"),
                many(anchors).alias("anchors"), F.lit(len(words[i][1]) - 1).alias("run"),
            )
        )
    return F.array(*fields)


def scan_windows(docs: DataFrame, notices: Iterable[tuple[str, str]] = tuple(NOTICES), threshold: float = THRESHOLD) -> DataFrame:
    """As ``scan``, over units and over all runs of as many words as a notice has."""
    known = _notices(docs, notices, threshold)
    text = F.lower(F.coalesce("text", F.lit("")))
    rows = computed_once(docs.select("doc_id", F.col("text").alias("text")), __norm=F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " "))
    rows = computed_once(rows.select("doc_id", "__norm"), __words=F.split(F.btrim("__norm", F.lit(" \n")), "[ \n]+"))

    def pairs(words: Column) -> Column:
        hashes = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, F.lit(" "), b))
        return F.when(F.size(words) >= 2, F.slice(hashes, 1, F.size(words) - 1)).otherwise(F.array().cast("array<bigint>"))

    rows = computed_once(rows.select("doc_id", "__norm", "__words"), __pairs=pairs(F.col("__words")))
    every = F.array_distinct(F.flatten(F.transform(known, lambda t: t["b"])))
    rows = computed_once(rows.select("doc_id", "__norm", "__pairs"), __hits=F.array_intersect("__pairs", every))
    able = F.filter(known, lambda t: (F.size("__hits") >= t["low"]) & (F.size(F.array_intersect(F.col("__hits"), t["b"])) >= t["low"]))
    rows = computed_once(rows.select("doc_id", "__norm", "__pairs", "__hits"), __able=F.when(F.size("__hits") > 0, able))
    some = F.size("__able") > 0

    paragraphs = F.split("__norm", r"\n *\n")
    units = F.concat(F.split("__norm", "\n"), F.filter(paragraphs, lambda p: F.contains(p, F.lit("\n"))), F.array("__norm"))
    words = F.transform(units, lambda unit: F.split(F.btrim(unit, F.lit(" \n")), "[ \n]+"))
    rows = computed_once(rows.select("doc_id", "__norm", "__pairs", "__able"), __words=F.when(some, words))
    rows = computed_once(
        rows.select("doc_id", "__pairs", "__able", "__words"), __units=F.transform("__words", lambda w: F.array_distinct(pairs(w)))
    )

    def scored(bags: Column, t: Column) -> Column:
        fit = F.filter(bags, lambda b: (F.size(b) >= t["low"]) & (F.size(b) <= t["high"]))
        found = F.transform(
            fit,
            lambda b: F.struct((2.0 * F.size(F.array_intersect(b, t["b"])) / (F.size(b) + F.size(t["b"]))).alias("dice"), t["name"].alias("name")),
        )
        return F.filter(found, lambda m: m["dice"] >= threshold)

    def runs(t: Column) -> Column:
        all_pairs, last = F.col("__pairs"), F.size("__pairs") - t["run"]  # the last run's place
        places = F.filter(F.sequence(F.lit(0), F.size("__pairs") - 1), lambda i: F.array_contains(t["anchors"], F.get(all_pairs, i)))
        begins = F.transform(places, lambda i: F.sequence(F.greatest(F.lit(0), i - t["run"] + 1), F.least(i, last)))
        bags = F.transform(F.array_distinct(F.flatten(begins)), lambda i: F.array_distinct(F.slice(all_pairs, i + 1, t["run"])))
        return F.when(last >= 0, bags).otherwise(F.array().cast("array<array<bigint>>"))

    matches = F.flatten(F.transform("__able", lambda t: F.concat(scored(F.col("__units"), t), scored(runs(t), t))))
    none = F.array().cast("array<struct<dice: double, name: string>>")
    rows = computed_once(rows.select("doc_id", "__pairs", "__able", "__units"), __found=F.when(some, matches).otherwise(none))
    names = F.array_sort(F.array_distinct(F.transform("__found", lambda m: m["name"])))
    best = F.array_max("__found")
    return rows.select("doc_id", names.alias("licences"), best["name"].alias("best_licence"), best["dice"].alias("best_dice"))
