"""Criteria, membership and totals of many subscriptions against single watchers in plain Python."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as S

from changelake.operators import subscriptions as U
from changelake.operators.events import match_subscriptions
from changelake.streaming import streams
from tests.rows import BIN, HOME, SIDE, catalog_of, history, line, row
from tests.test_events import ASKED, before, plain_events

SCHEMA = "sub_id int, table_name string, events array<string>, branch_id long, changed_fields array<string>, start_id long"
FIELDS = (None, [], ["name"], ["branch_id", "name", "name"], ["nothing"], ["size", None, "name"])


@pytest.fixture(scope="module")
def watched(spark):
    log = history(33, "t_label", 8, 220) + [r | {"id": r["id"] + 500} for r in history(34, "t_user", 5, 60)]
    log += [line(2000, "INSERT", "t_other", 1), line(2001, "UPDATE", "t_label", 2, {"name": "x", "size": 1, "key": None}, HOME)]
    log += [line(2002, "VACUUM", "t_label", 2)]
    rng = random.Random(5)
    subs = [
        (n, rng.choice(["t_label", "t_label", "t_user"]), rng.choice(ASKED), rng.choice([None, HOME, SIDE, BIN]), rng.choice(FIELDS), rng.choice([None, 0, 100, 210, 530, 5000]))
        for n in range(150)
    ]
    subs += [(150, "t_label", [], HOME, None, None), (151, "t_label", ["renamed"], HOME, None, None), (152, "t_none", ["created"], None, None, None)]
    subs += [subs[0], (0, *subs[1][1:])]  # one subscriber twice, for the same and for other things
    return log, subs


def plain(log, subs, branchless=()):
    """subscription → log ids and events."""
    everything = {r["sqlrecord_id"] for r in log}
    by_id = {r["id"]: r for r in log}
    out = []
    for n, table, asked, branch, fields, start in subs:
        asked = [e for e in asked if e in ("created", "updated", "deleted")]
        fields = set(fields or ()) - {None}
        for i, event, _ in plain_events(log, table, everything, asked, None if table in branchless else branch) if asked else ():
            if i > (start if start is not None else -1) and (event != "updated" or not fields or fields & set(before(by_id[i]))):
                out.append((n, i, event))
    return sorted(out)


@pytest.mark.parametrize("branchless", [(), ("t_user",)])
def test_subscribers_get_what_single_watchers_get(spark, watched, branchless):
    log, subs = watched
    cat = catalog_of(spark, log)
    got = match_subscriptions(cat.log(), spark.createDataFrame(subs, SCHEMA), branchless=branchless)
    assert sorted((r["sub_id"], r["id"], r["event"]) for r in got.collect()) == plain(log, subs, branchless)


def test_criteria_are_shared_and_few(spark, watched):
    log, subs = watched
    criteria, membership = U.interned(spark.createDataFrame(subs, SCHEMA))
    rows = {r["criterion"]: r for r in criteria.collect()}
    asked = {
        (t, tuple(sorted(e)), b, tuple(sorted({f for f in fs or () if f})) if "updated" in e else ()) for _, t, e, b, fs, _ in subs if e and e != ["renamed"]
    }
    assert {(r["table_name"], tuple(r["events"]), r["branch_id"], tuple(r["changed_fields"] or ())) for r in rows.values()} == asked
    assert len(rows) == len(asked) == criteria.count() and membership.count() == len(subs) - 2
    matches = U.match_criteria(catalog_of(spark, log).log(), criteria).select("criterion", "id").collect()
    assert len(matches) == len(set(matches))  # a write meets a criterion once


@pytest.mark.parametrize("span", [7, 1_000_000])
def test_totals(spark, watched, span):
    log, subs = watched
    subs = [s for n, s in enumerate(subs) if n < 153]
    criteria, membership = U.interned(spark.createDataFrame(subs, SCHEMA))
    matches = U.match_criteria(catalog_of(spark, log).log(), criteria)
    want: dict = {}
    for n, i, _ in plain(log, subs):
        want.setdefault(n, []).append(i)
    rows = {r["sub_id"]: r for r in U.totals(matches, membership, span).collect()}
    assert set(rows) == {s[0] for s in subs} - {150, 151}
    for n, r in rows.items():
        ids = want.get(n, [])
        assert (r["n_events"], r["first_id"], r["last_id"]) == (len(ids), min(ids, default=None), max(ids, default=None)), subs[n]


def test_tables_without_branches(spark):
    from changelake.sources.schemas import USER

    assert U.tables_without_branches(catalog_of(spark, [], user=[row(USER, id=1)])) == ["t_branch", "t_user"]


def test_nobody_and_nothing(spark, watched):
    log, subs = watched
    cat = catalog_of(spark, log)
    nobody = spark.createDataFrame([], SCHEMA)
    assert match_subscriptions(cat.log(), nobody).collect() == []
    criteria, membership = U.interned(spark.createDataFrame(subs[:3], SCHEMA))
    none = U.match_criteria(cat.log().limit(0), criteria)
    assert none.collect() == [] and {r["n_events"] for r in U.totals(none, membership).collect()} == {0}


def test_one_stream_for_all(spark, watched, tmp_path):
    log, subs = watched
    cat = catalog_of(spark, log)
    for part, (low, high) in enumerate(itertools.pairwise((0, 80, 90, 300, 9999))):
        cat.log().where(f"id > {low} AND id <= {high}").coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    from changelake.sources.readers import read_log_stream

    stream = read_log_stream(spark, str(tmp_path / "log"), max_files=1)
    out = str(tmp_path / "out")
    query = streams.stream_events("subscriptions", stream, cat, out, str(tmp_path / "cp"), subscriptions=spark.createDataFrame(subs, SCHEMA), branchless=["t_user"])
    query.awaitTermination()
    assert len(query.recentProgress) >= 4
    got = spark.read.parquet(f"{out}/batch=*")
    assert sorted((r["sub_id"], r["id"], r["event"]) for r in got.collect()) == plain(log, subs, ("t_user",))


@pytest.mark.parametrize("span", [7, 1_000_000])
def test_totals_by_event_of_a_stream_of_criteria(spark, watched, tmp_path, span):
    from changelake.sources.readers import read_log_stream

    log, subs = watched
    subs = [s for n, s in enumerate(subs) if n < 153]
    cat = catalog_of(spark, log)
    for low, high in itertools.pairwise((0, 90, 300, 9999)):
        cat.log().where(f"id > {low} AND id <= {high}").coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    criteria, membership = U.interned(spark.createDataFrame(subs, SCHEMA))
    out = str(tmp_path / "out")
    streams.stream_events("criteria", read_log_stream(spark, str(tmp_path / "log"), max_files=1), cat, out, str(tmp_path / "cp"), criteria=criteria).awaitTermination()
    matches = spark.read.parquet(f"{out}/batch=*")
    assert matches.count() == U.match_criteria(cat.log(), criteria).count()  # not one row for each subscriber
    want: dict = {}
    for n, i, event in plain(log, subs):
        want.setdefault((n, event), []).append(i)
    got = U.totals(matches, membership, span, by=["event"]).collect()
    assert sorted(tuple(r)[:1] + tuple(r)[2:] for r in got) == sorted((n, e, len(ids), min(ids), max(ids)) for (n, e), ids in want.items())


def test_totals_move_only_blocks_with_starts(spark):
    matches = spark.range(1000).select(S.lit("c").alias("criterion"), "id")
    membership = spark.createDataFrame([(1, "c", None), (2, "c", 25), (3, "c", 999), (4, "c", -5), (5, "d", 3), (6, "c", 5000)], "sub_id int, criterion string, start_id long")
    got = {r["sub_id"]: (r["n_events"], r["first_id"], r["last_id"]) for r in U.totals(matches, membership, 10).collect()}
    assert got == {1: (1000, 0, 999), 2: (974, 26, 999), 3: (0, None, None), 4: (1000, 0, 999), 5: (0, None, None), 6: (0, None, None)}
    assert "__block" in U.totals(matches, membership)._jdf.queryExecution().toString()
