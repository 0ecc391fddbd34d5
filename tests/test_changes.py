"""Reading the log: every case from tables of values, against plain Python."""

from __future__ import annotations

import fnmatch
import itertools
import json

import pytest
from pyspark.sql import functions as S

from changelake.functions import codes, jsoncols, patterns
from changelake.operators import changes as C
from changelake.plans.filters import F
from changelake.sources.schemas import WRITE_LOG
from tests.rows import BIN, HOME, SIDE, frame, history, line, meaning

ABSENT = object()


@pytest.mark.parametrize("scope", [None, HOME, SIDE])
def test_meaning_of_every_write(spark, scope):
    kinds, before, here = ("INSERT", "UPDATE", "DELETE", "TRUNCATE"), (ABSENT, None, HOME, SIDE, BIN), (None, HOME, SIDE, BIN)
    rows = [
        line(i, kind, "t", 1, {"name": "n"} | ({} if b is ABSENT else {"branch_id": b}), h)
        for i, (kind, b, h) in enumerate(itertools.product(kinds, before, here))
    ]
    rows += [line(1000, "UPDATE", "t", 1, "no json"), line(1001, "DELETE", "t", 1, "[1]"), line(1002, "UPDATE", "t", 1, None, SIDE)]
    got = {r["id"]: r["event"] for r in C.classify(frame(spark, rows, WRITE_LOG), scope).collect()}
    for r in rows:
        r["data"] = r["data"] if r["data"] != "[1]" else None
        assert got[r["id"]] == meaning(r, scope), r


@pytest.mark.parametrize("events", [["created"], ["updated"], ["deleted"], ["created", "deleted"], ["created", "updated", "deleted"]])
def test_candidates_hold_what_they_ask_for(spark, events):
    rows = history(3, "t", 9, 300) + [line(900, "INSERT", "u", 1)]
    log = C.classify(frame(spark, rows, WRITE_LOG), HOME)
    wanted = log.where(C.candidates("t", events, HOME))
    ids = {r["id"] for r in wanted.collect()}
    narrow = {r["id"] for r in log.where(C.scanned("t", events, HOME)).collect()}
    assert ids <= narrow and 900 not in narrow
    for r in rows[:-1]:
        on_home = r["branch_id"] == HOME or r["event_type"] == "UPDATE" and "deleted" in events
        if meaning(r, HOME) in events and on_home and '"branch_id": null' not in (r["data"] or ""):
            assert r["id"] in ids, r


def test_parts_of_a_write(spark):
    rows = [line(1, "UPDATE", "t", 5, {"b": 1, "a": None}, uid="x"), line(2, "INSERT", "t", 5), line(3, "UPDATE", "t", 5, "no json"), line(4, "DELETE", "t", 5, {"a": 1})]
    log = frame(spark, rows, WRITE_LOG)
    got = log.orderBy("id").select(C.changed_fields().alias("c"), C.previous_values().alias("p"), C.summary(log).alias("s")).collect()
    assert [r["c"] for r in got] == [["a", "b"], [], [], []] and [r["p"] for r in got][1] == "{}"
    assert got[0]["s"].asDict() == {k: v for k, v in rows[0].items() if k != "data"}


def test_positions(spark):
    rows = history(5, "t", 4, 40)
    log = frame(spark, rows, WRITE_LOG)
    for after, limit, down in itertools.product((None, 0, 17), (None, 1, 6), (False, True)):
        found = [r["id"] for r in C.read_log(log, F("event_type").is_in(["INSERT", "DELETE"]), after_id=after, limit=limit, descending=down).collect()]
        plain = sorted((r["id"] for r in rows if r["event_type"] in ("INSERT", "DELETE") and r["id"] > (after or 0)), reverse=down)[:limit]
        assert (found if limit else sorted(found, reverse=down)) == plain
    assert C.latest_id(log).first()[0] == 40 and C.latest_id(log.limit(0)).first()[0] == 0


def test_end_of_an_upload(spark):
    """Only an object, or its text, whose ``so`` is the number 1 or true, was ongoing."""
    values = [1, True, 0, 2, False, "1", None, [1], {"so": 1}]
    shapes = [lambda v: {"so": v}, lambda v: {"so": v, "more": 2}, lambda v: json.dumps({"so": v}), lambda v: v, lambda v: [{"so": v}], lambda v: {"os": v}]
    rows, want = [], {}
    for i, (shape, v) in enumerate(itertools.product(shapes, values)):
        aux = shape(v)
        try:
            inner = json.loads(aux) if isinstance(aux, str) else aux
        except ValueError:
            inner = None
        so = inner.get("so") if isinstance(inner, dict) else None
        want[i] = so is True or isinstance(so, int) and so == 1
        rows.append(line(i, "UPDATE", "t", i, {"_aux": aux}))
    rows += [line(500, "DELETE", "t", 1, {"_aux": {"so": 1}}), line(501, "UPDATE", "t", 1, {"key": "k"}), line(502, "UPDATE", "t", 1, "no json")]
    log = frame(spark, rows, WRITE_LOG)
    assert {r["id"] for r in log.where(C.is_upload_completion()).collect()} == {i for i, ends in want.items() if ends}
    assert {r["sqlrecord_id"] for r in C.upload_completions(log, "t").collect()} == {i for i, ends in want.items() if ends}


@pytest.mark.parametrize(("span", "cut"), [(1, 0), (3, 60), (1000, 100)])
def test_transitions(spark, span, cut):
    rows, now = [], {}
    for r in history(11, "t", 6, 150):
        value = r["id"] * 7 % 5
        if r["event_type"] == "UPDATE" and r["id"] % 3:
            rows.append(r | {"data": json.dumps({"state": now.get(r["sqlrecord_id"])})})
            now[r["sqlrecord_id"]] = value
        else:
            rows.append(r)
    current = spark.createDataFrame([(k, v) for k, v in now.items() if k != 6], "id long, state int")
    log = frame(spark, rows, WRITE_LOG)
    changes = [r for r in rows if r["event_type"] == "UPDATE" and "state" in (r["data"] or "")]
    want = {}
    for i, r in enumerate(changes):
        later = [c for c in changes[i + 1 :] if c["sqlrecord_id"] == r["sqlrecord_id"]]
        new = json.loads(later[0]["data"])["state"] if later else now[r["sqlrecord_id"]] if r["sqlrecord_id"] != 6 else None
        want[r["id"]] = (json.loads(r["data"])["state"], new)
    part = log if not cut else log.where(S.col("id") <= cut)
    got = C.field_transitions(part, current, "state", later=log if cut else None, span=span).collect()
    assert {r["id"]: (r["previous_value"], r["new_value"]) for r in got} == {i: v for i, v in want.items() if not cut or i <= cut}


def test_codes_and_names(spark):
    for table, name in ((codes.BRANCH_STATUS, codes.branch_status), (codes.RUN_STATUS, codes.run_status)):
        df = spark.createDataFrame([(v,) for v in [*table.values(), 99]], "code int")
        assert {r["code"]: r["name"] for r in df.select("code", name(S.col("code")).alias("name")).where("code <> 99").collect()} == {
            v: k for k, v in table.items()}
        assert codes.check_names(list(table), table, "status") == list(table) and codes.check_names(None, table, "status") is None
        with pytest.raises(ValueError):
            codes.check_names("no such name", table, "status")


def test_globs(spark):
    names = ["release-1", "release-10", "Release-1", "rel", "fix[1]", "fix-1", "a*b", "a.b", "", "x\ny"]
    globs = ["*", "release-*", "release-?", "fix[[]1]", "fix-[0-9]", "[!r]*", "a[*]b", "a.b", "??", ""]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for glob in globs:
        got = {r["name"] for r in df.where(patterns.glob_any(S.col("name"), [glob])).collect()}
        assert got == {n for n in names if fnmatch.fnmatchcase(n, glob)}, glob


def test_json_text_inside_json(spark):
    values = [1, True, None, "text", [1, "a"], {"k": {"n": 1}}]
    df = spark.createDataFrame([(i, json.dumps(v), json.dumps(json.dumps(v))) for i, v in enumerate(values)], "id int, once string, twice string")
    for r in df.select("id", S.to_json(jsoncols.parsed(S.col("once"))).alias("j")).collect():
        assert r["j"] is None or json.loads(r["j"]) == values[r["id"]]
