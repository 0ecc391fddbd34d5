"""The template scanner on cases by hand and on generated ones, against a plain reader of the same syntax."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as S

from changelake.functions.templates import scanned, string_leaves
from changelake.operators import params as P

READS = [
    "{{ var.value.t }}", "{{ {'a': {'b': 1}} and var.value.t }}", "{{ '}}' ~ var.value.t }}", "{% if '%}' and conn.x %}{% endif %}",
    "{{var}}", "{{- conn.a -}}", "{{ f(x, var) }}", "{{ f(a=var) }}", "{{ f(var == 1) }}", "{{ [1, {2: (var)}] }}", "{{ not var }}",
    "{% for x in var.y %}{% endfor %}", "{% set var = 1 %}", "{# var #}{{ conn }}", "{% raw %}{{ ds }}{% endraw %}{{ var }}",
    "{{ \"a\\\"}}\" ~ var }}", "{{ x['{{'] ~ conn.y }}", "{{\n\tvar\n}}", "a { {{ var }} }", "{{{'k': var}}}", "{{ x.y or var }}", "{{ x if var else y }}",
    "{% macro m(var=1) %}{% endmacro %}", "plain {{ ds }} and {{ var }} end", "{%- if var -%}{%- endif -%}", "{{ x|default(var) }}", "'{{ var }}'",
]
HARMLESS = [
    "", "var", "{{ 'var' }}", '{{ "conn.x" }}', "{{ x.var }}", "{{ x . conn }}", "{{ x|var }}", "{{ x is var }}", "{{ x is not conn }}", "{{ f(var=1) }}",
    "{# {{ var }} #}{{ ds }}", "{% raw %}{{ var }}{% endraw %}", "{%- raw -%} {{ conn.a }} {%- endraw -%}{{ ds }}", "{{ variable }}", "{{ my_var }}", "{{ ds }} var",
    "{ { var } }", "{{ var", "{% if var", "{{ 'var }}", "{# {{ var }}", "{{ {'a': var }}", "{% raw %}{{ var }}", "{{ ds }}{{ var", "var }}", "{{ var2 }}",
    "{{ '{{ var }}' }}", "{{ x['var'] }}", "conn {{ ds }} {# conn #}",
]
TEMPLATES = ["{{ x }}", "{% if x %}{% endif %}", "a {{ 'b' }}", "{% raw %}a{% endraw %}{{ x }}"]
TEXTS = ["", "plain", "{# only a comment #}", "{% raw %}{{ x }}{% endraw %}", "{ x }", "{{ open", "}} {{"]


def asked(spark, texts, names=("var", "conn")):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [(r["s"]["any"], r["s"]["named"]) for r in df.select("i", scanned(S.col("t"), names).alias("s")).orderBy("i").collect()]


def test_by_hand(spark):
    got = asked(spark, READS + HARMLESS)
    assert [t for t, (_, named) in zip(READS, got, strict=False) if not named] == []
    assert [t for t, (_, named) in zip(HARMLESS, got[len(READS):], strict=True) if named] == []
    got = [any_ for any_, _ in asked(spark, TEMPLATES + TEXTS)]
    assert got == [True] * len(TEMPLATES) + [False] * len(TEXTS)


def plainly(text):
    """(is a template, reads var or conn): a reader by recursive descent over characters."""
    at, any_, named = 0, False, False

    def spaces(i):
        while i < len(text) and text[i] in " \t\n\r":
            i += 1
        return i

    def code(i, end):
        """The place behind ``end`` and the tokens before it; None if it never comes."""
        tokens, stack = [], 0
        while i < len(text):
            c = text[i]
            if c in "'\"":
                j = i + 1
                while j < len(text) and text[j] != c:
                    j += 2 if text[j] == "\\" and text[j + 1 : j + 2] in ("'", '"', "\\") else 1
                if j >= len(text):
                    return None
                tokens.append(("s", "", stack))
                i = j + 1
            elif stack == 0 and text.startswith(end, i):
                return i + 2, tokens
            elif c == "\\":
                return None  # only strings have escapes
            elif c.isalnum() or c == "_":
                j = i
                while j < len(text) and (text[j].isalnum() or text[j] == "_"):
                    j += 1
                tokens.append(("w", text[i:j], stack))
                i = j
            else:
                stack = stack + 1 if c in "([{" else max(0, stack - 1) if c in ")]}" else stack
                if c not in " \t\n\r":
                    tokens.append(("o", c, stack))
                i += 1
        return None

    def reads(tokens):
        first = next((t[1] for t in tokens if t[1] not in ("-", "+")), "")
        for n, (kind, word, depth) in enumerate(tokens):
            if kind != "w" or word not in ("var", "conn"):
                continue
            before, after = [t[1] for t in tokens[max(0, n - 2) : n]], [t[1] for t in tokens[n + 1 : n + 3]]
            if before[-1:] in (["."], ["|"], ["is"]) or before == ["is", "not"]:
                continue
            if after[:1] == ["="] and after != ["=", "="] and depth > 0 and first != "macro":
                continue
            return True
        return False

    while at < len(text):
        kind = text[at : at + 2]
        if kind == "{#":
            end = text.find("#}", at + 2)
            if end < 0:
                return False, False
            at = end + 2
        elif kind in ("{{", "{%"):
            found = code(at + 2, "}}" if kind == "{{" else "%}")
            if found is None:
                return False, False
            at, tokens = found
            words = [t[1] for t in tokens if t[1] not in ("-", "+")]
            if kind == "{%" and words[:1] == ["raw"]:
                while True:
                    at = text.find("{%", at)
                    if at < 0:
                        return False, False
                    i = at + 2
                    while i < len(text) and text[i] in " \t\n\r-+":
                        i += 1
                    at = i
                    if text.startswith("endraw", i) and not (text[i + 6 : i + 7].isalnum() or text[i + 6 : i + 7] == "_"):
                        found = code(i, "%}")
                        if found is None:
                            return False, False
                        at = found[0]
                        break
            else:
                any_, named = True, named or reads(tokens)
        else:
            at += 1
    return any_, named


PARTS = ["{{", "}}", "{%", "%}", "{#", "#}", "{", "}", "'", '"', "\\'", "(", ")", "[", "]", " ", " ", "var", "conn", "x", "raw", "endraw", ".", "|", "is", "not", "=", "-", "if", ", ", "1"]


@pytest.mark.parametrize("seed", range(3))
def test_generated(spark, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(3000):
        inner = " ".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 9)))
        left, right = rng.choice([("{{ ", " }}"), ("{% ", " %}"), ("", ""), ("{# ", " #}")])
        texts.append(rng.choice(["", "a ", "{{ x }}"]) + left + inner + right + rng.choice(["", " var", "{{ conn }}"]))
    texts = [t for t in texts if "{{" in t or "{%" in t]
    wrong = [(t, g, plainly(t)) for t, g in zip(texts, asked(spark, texts), strict=True) if g != plainly(t)]
    assert not wrong, wrong[:5]


def test_leaves(spark):
    values = [
        {"a": "x", "b": ["y", {"c:": "z:", "d": 'q"uo\\te'}]}, "text", ["", "\n\t", "ü🎉", "a\\", '"'], {}, 5, None, {"k\"": ["\\\"", ":"]},
    ]

    def strings(v):
        if isinstance(v, str):
            return [v]
        return [s for x in (v.values() if isinstance(v, dict) else v if isinstance(v, list) else ()) for s in strings(x)]

    df = spark.createDataFrame([(i, json.dumps(v, separators=(",", ":"))) for i, v in enumerate(values)], "i int, t string")
    got = [r["leaves"] for r in df.select("i", string_leaves(S.col("t")).alias("leaves")).orderBy("i").collect()]
    assert got == [strings(v) for v in values]


def test_parameters_with_templates(spark):
    rows = [{"s": t, "deep": {"k": ["x", t]}, "var": "kept"} for t in READS] + [{"n": t, "deep": [{"{{ var }}": t}]} for t in HARMLESS]
    long = "{{ ds }} " * 5000
    rows += [{"long": long, "secret": long + "{{ conn.x }}"}, {"a": "\\{{ var }}", "b": 1}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, params string")
    got = [json.loads(r["params"]) for r in P.exclude_templated(df).orderBy("i").collect()]
    assert got == [{"var": "kept"}] * len(READS) + rows[len(READS) : -2] + [{"long": long}, {"b": 1}]
