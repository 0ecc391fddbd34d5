from __future__ import annotations

import json

from pyspark.sql import functions as S

from changelake.operators import apply as A
from changelake.operators import changes as C
from changelake.operators import cursors as U
from changelake.plans.filters import F
from changelake.sources.catalog import Catalog
from changelake.sources.schemas import USER, WRITE_LOG
from tests.rows import TAG as LABEL
from tests.rows import frame as table
from tests.rows import line as write
from tests.rows import tag as label


def test_validation(spark):
    texts = [
        '{"id": 1, "uid": "a", "x": [1, 2], "y": null}', '{"id": "1"}', "broken", '{"id": 2, "handle": 3, "name": true}',
        '{"id": 3, "handle": null}', "[1]", None, '{"id": 1.5}', "null", "{}",
    ]
    good, bad = A.validate(spark.createDataFrame([(t,) for t in texts], "value string"), USER)
    assert [(r["id"], r["uid"], r["handle"]) for r in good.collect()] == [(1, "a", None), (3, None, None), (None, None, None)]
    assert good.first()["extra"] == {"x": "[1,2]", "y": "null"}
    assert [(r["value"], r["errors"]) for r in bad.collect()] == [
        (texts[1], ["id"]), ("broken", ["$"]), (texts[3], ["handle", "name"]), ("[1]", ["$"]), (None, ["$"]),
        (texts[7], ["id"]), ("null", ["$"]),
    ]
    times = A.validate(spark.createDataFrame([('{"created_at": "2026-09-30T08:00:00"}',), ('{"created_at": "x"}',)], "value string"), WRITE_LOG)
    assert (times[0].count(), times[1].count()) == (1, 1)
    assert times[0].first()["created_at"].hour == 8


def test_inserts(spark):
    df = table(spark, [label(3), label(8)], LABEL)
    new = spark.createDataFrame([(f"n{i}", "x", 1) for i in range(50)], "uid string, name string, branch_id int")
    for digits in (1, 4):
        rows = A.insert_records(df, new, digits=digits)
        assert sorted(r["id"] for r in rows.collect()) == list(range(9, 59))
        assert rows.schema["branch_id"].dataType.simpleString() == "bigint"
    assert A.insert_records(df.where("id < 0"), new.limit(1)).first()["id"] == 1


def test_updates(spark):
    df = table(spark, [label(i) for i in range(1, 8)], LABEL)
    patches = spark.createDataFrame(
        [
            ("u1", '{"name": null, "reference_type": "r"}'), ("u2", '{"branch_id": 42}'), ("u9", '{"name": "x"}'),
            ("u3", '{"name": 1}'), ("u4", '{"colour": "red"}'), ("u5", '{"id": 5}'), ("u6", "broken"), ("u7", '{"name": "a"}'),
            ("u7", '{"name": "b"}'), (None, "{}"),
        ],
        "uid string, patch string",
    )
    updated, rejected = A.update_records(df, patches)
    rows = {r["uid"]: r.asDict() for r in updated.collect()}
    assert len(rows) == 7
    assert rows["u1"] == label(1, name=None, reference_type="r")
    assert rows["u2"]["branch_id"] == 42 and rows["u2"]["name"] == "label"
    assert all(rows[f"u{i}"] == label(i, reference_type=None) for i in range(3, 8))
    reasons = {r["uid"]: r["reason"] for r in rejected.collect()}
    assert reasons == {
        "u9": "unknown uid", "u3": "field", "u4": "field", "u5": "field", "u6": "malformed", "u7": "repeated uid", None: "unknown uid",
    }


def test_emitted_log_describes_the_changes(spark):
    before = table(spark, [label(1, name='say "hi"'), label(2, reference_type=None)], LABEL)
    changes = spark.createDataFrame(
        [
            ("UPDATE", "u1", None, '{"name": "new", "branch_id": 42}', 7), ("DELETE", "u2", None, None, 7),
            ("INSERT", "u3", 3, '{"name": "x", "branch_id": 1}', None), ("UPDATE", "gone", None, '{"name": "x"}', 7),
        ],
        "op string, uid string, sqlrecord_id long, patch string, created_by_id long",
    )
    log = A.emit_log(before, changes, table_name="t_label", start_id=100)
    assert {"id", "uid", "event_type", "table_name", "sqlrecord_id", "data"} <= set(log.columns)
    assert log.select(WRITE_LOG.fieldNames()).schema == WRITE_LOG or [f.dataType for f in log.select(WRITE_LOG.fieldNames()).schema] == [f.dataType for f in WRITE_LOG]
    rows = {r["event_type"]: r for r in log.collect()}
    assert sorted(r["id"] for r in rows.values()) == [101, 102, 103]
    assert json.loads(rows["UPDATE"]["data"]) == {"name": 'say "hi"', "branch_id": 1}
    assert rows["UPDATE"]["branch_id"] == 42 and rows["UPDATE"]["sqlrecord_id"] == 1
    assert json.loads(rows["DELETE"]["data"]) == label(2, reference_type=None)
    assert rows["INSERT"]["data"] is None and rows["INSERT"]["sqlrecord_id"] == 3 and rows["INSERT"]["branch_id"] == 1
    # what was emitted reads back as the events it stands for
    events = {r["sqlrecord_id"]: r["event"] for r in C.classify(log, 1).collect()}
    assert events == {1: "deleted", 2: "deleted", 3: "created"}


def test_append_and_catalog(spark, tmp_path):
    path = str(tmp_path / "write_log")
    A.write_append(table(spark, [write(2, "INSERT", "t", 1)], WRITE_LOG), path)
    A.write_append(table(spark, [write(3, "INSERT", "t", 1)], WRITE_LOG), path)
    A.write_append(table(spark, [label(1)], LABEL), str(tmp_path / "labels"))
    cat = Catalog.from_parquet(spark, str(tmp_path), {"core.label": "labels"})
    assert cat.log().count() == 2 and cat.load("label").count() == 1
    assert cat.registry("label").table_name == "labels"


def _cursors(spark, rows):
    return spark.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v)) for k, v in rows], "key string, value string")


def test_cursors(spark):
    cursors = _cursors(
        spark,
        [
            ("a", {"dbwrite_id": 5, "instance_id": "i"}), ("a", {"dbwrite_id": 3, "instance_id": "i"}),
            ("a", {"dbwrite_id": 1, "instance_id": "other"}), ("b", {"dbwrite_id": "3", "instance_id": "i"}),
            ("c", {"dbwrite_id": -1, "instance_id": "i"}), ("d", "broken"), ("e", {"dbwrite_id": 0, "instance_id": "i"}),
            ("f", {"dbwrite_id": 9}),
        ],
    )
    assert {r["key"]: r["dbwrite_id"] for r in U.load_cursor(cursors, "i").collect()} == {"a": 3, "e": 0}
    log = table(spark, [write(77, "INSERT", "t", 1)], WRITE_LOG)
    starts = U.start_cursor(cursors.select("key").distinct(), cursors, log, "i")
    assert {r["key"]: r["start_id"] for r in starts.collect()} == {"a": 3, "e": 0, "b": 77, "c": 77, "d": 77, "f": 77}
    saved = U.save_cursor(cursors, spark.createDataFrame([("a", 8), ("a", 6), ("new", 1)], "key string, dbwrite_id long"), "i")
    assert {r["key"]: r["dbwrite_id"] for r in U.load_cursor(saved, "i").collect()} == {"a": 8, "e": 0, "new": 1}
    assert saved.where("key = 'd'").first()["value"] == "broken"


def test_job_keys():
    f = F("name").startswith("a") & (F("id") == 7)
    key = U.job_key("record", registry="label", filter=f, events=("created",))
    assert key == U.job_key("record", events=["created"], filter=f.to_dict(), registry="label")
    assert key != U.job_key("record", registry="label", filter=f, events=("deleted",))
    assert key.startswith("record.") and len(key) == len("record.") + 16


def test_previous_values_default(spark):
    df = spark.createDataFrame([(None,), ("{}",)], "data string")
    assert df.select(C.previous_values(S.col("data"))).distinct().count() == 1


def test_log_and_table_refuse_the_same(spark):
    before = table(spark, [label(i) for i in range(1, 6)], LABEL)
    patches = ["broken", '{"name": 5}', '{"colour": 1}', '{"name": "good"}', '{"id": 9}']
    rows = [("UPDATE", f"u{i}", None, p) for i, p in enumerate(patches, 1)] + [
        ("INSERT", "n1", 50, '{"name": "new"}'), ("INSERT", "n2", 51, None), ("INSERT", "n3", 52, '{"name": [1]}'), ("DELETE", "gone", None, None)]
    changes = spark.createDataFrame(rows, "op string, uid string, sqlrecord_id long, patch string")
    log = A.emit_log(before, changes, table_name="t_label", start_id=0)
    assert sorted((r["event_type"], r["sqlrecord_id"], r["branch_id"]) for r in log.collect()) == [("INSERT", 50, 1), ("INSERT", 51, 1), ("UPDATE", 4, 1)]
    reasons = {r["uid"]: r["reason"] for r in A.rejected_changes(before, changes).collect()}
    assert reasons == {"u1": "malformed", "u2": "field", "u3": "field", "u5": "field", "n3": "field", "gone": "unknown uid"}
