from __future__ import annotations

import pytest
from pyspark.sql import functions as S

from changelake.operators import gates as G
from changelake.plans.filters import F
from changelake.sources.schemas import ARTIFACT, BRANCH
from changelake.sources.schemas import BRANCH
from tests.rows import SIDE as FEATURE
from tests.rows import catalog_of, row
from tests.rows import file as artifact
from tests.rows import frame as table
from tests.rows import tag as label


def make_catalog(spark, writes=(), **records):
    return catalog_of(spark, writes, **records)


def branch(id, name, status):
    return row(BRANCH, id=id, name=name, _status_code=status)

UPLOADING = '{"so": 1}'


def _ids(df):
    return [r["id"] for r in df.orderBy(S.col("id").desc()).collect()]


def test_record_gate(spark):
    cat = make_catalog(spark, [], label=[label(i, FEATURE if i == 9 else 1) for i in range(10)], branch=[branch(FEATURE, "f", 0)])
    assert _ids(G.record_gate(cat, "label", limit=3, min_count=2)) == [8, 7, 6]
    assert _ids(G.record_gate(cat, "label", F("id") > 7, min_count=2)) == []
    assert _ids(G.record_gate(cat, "label", branch="f")) == [9]
    assert _ids(G.record_gate(cat, "label", F("id") > 7, branch=None, min_count=2)) == [9, 8]
    for bad in ({"min_count": 0}, {"min_count": 5, "limit": 4}):
        with pytest.raises(ValueError):
            G.record_gate(cat, "label", **bad)


def test_the_limit_comes_before_the_upload_check(spark):
    records = [artifact(1), artifact(2, aux=UPLOADING), artifact(3, aux=UPLOADING)]
    cat = make_catalog(spark, [], artifact=records)
    assert _ids(G.record_gate(cat, "artifact", limit=2)) == []
    assert _ids(G.record_gate(cat, "artifact", limit=3)) == [1]
    assert _ids(G.record_gate(cat, "artifact", limit=2, wait_for_upload=False)) == [3, 2]
    assert _ids(G.artifact_gate(cat, limit=3)) == [1]


def test_artifact_gate_criteria(spark):
    records = [artifact(1, "raw/a.csv"), artifact(2, "raw/b.txt", None), artifact(3, "logs/c.csv", "__internal_run__")]
    cat = make_catalog(spark, [], artifact=records)
    assert _ids(G.artifact_gate(cat)) == [2, 1]
    assert _ids(G.artifact_gate(cat, suffix=".csv")) == [1]
    assert _ids(G.artifact_gate(cat, kind="__internal_run__")) == [3]
    assert _ids(G.artifact_gate(cat, key_prefix="raw/", min_count=3)) == []


def test_branch_gate(spark):
    branches = table(spark, [branch(1, "a", -1), branch(2, "b", -2), branch(3, "c", 1), branch(4, "d", None)], BRANCH)
    gates = spark.createDataFrame([(i, n) for i, n in enumerate(["a", "b", "c", "d", "gone"])], "gate_id int, branch_name string")

    def verdicts(*args):
        return [r["verdict"] for r in G.branch_gate(branches, gates, *args).orderBy("gate_id").collect()]

    assert verdicts() == ["success", "failure", "pending", "pending", "pending"]
    assert verdicts(["draft", "standalone"], []) == ["pending", "pending", "success", "success", "pending"]
    per_gate = gates.withColumn("branch_id", S.col("gate_id") + 1).withColumn("target", S.array(S.lit("draft")))
    assert [r["verdict"] for r in G.branch_gate(branches, per_gate).orderBy("gate_id").collect()] == [
        "pending", "failure", "success", "pending", "pending",
    ]
    with pytest.raises(ValueError, match="both"):
        G.branch_gate(branches, gates, "closed")
    with pytest.raises(ValueError):
        G.branch_gate(branches, gates, "nope")


GATES = [
    (1, None, "raw/", ".csv", None, 2),
    (2, None, "raw/", None, None, 3),
    (3, None, None, ".txt", None, 1),
    (4, None, None, None, "__internal_run__", 1),
    (5, "raw/a.csv", None, None, None, 1),
    (6, None, "raw/a-very-long-prefix/", None, None, 1),
    (7, None, None, None, None, 4),
    (8, None, "raw/", ".csv", "model", 1),
    (9, None, "äö", None, None, 1),
]


@pytest.mark.parametrize("limit", [2, 100])
def test_gate_table_agrees_with_single_gates(spark, limit):
    records = [
        artifact(1, "raw/a.csv"), artifact(2, "raw/b.csv"), artifact(3, "raw/c.csv", aux=UPLOADING), artifact(4, "x/d.txt", None),
        artifact(5, "raw/log.txt", "__internal_run__"), artifact(6, "raw/m.csv", "model", branch_id=FEATURE), artifact(7, "äöü.csv"),
        artifact(8, "r"),
    ]
    cat = make_catalog(spark, [], artifact=records)
    gates = spark.createDataFrame(GATES, "gate_id int, key string, key_prefix string, suffix string, kind string, min_count int")
    got = {r["gate_id"]: (r["n_ready"], r["verdict"]) for r in G.evaluate_gates(cat.load("artifact"), gates, limit=limit).collect()}
    assert len(got) == len(GATES)
    for gate_id, key, prefix, suffix, kind, count in GATES:
        ready = G.matching_records(cat, "artifact", G.artifact_filter(key=key, key_prefix=prefix, suffix=suffix, kind=kind), limit=limit)
        n = ready.count()
        want = "invalid" if count > limit else "success" if n >= count else "pending"
        assert got[gate_id] == (n, want), gate_id


def test_impossible_gates_are_reported(spark):
    records = table(spark, [artifact(i, f"raw/{i}.csv") for i in range(30)], ARTIFACT)
    gates = spark.createDataFrame([(1, "raw/", 25), (2, "raw/", 20), (3, "raw/", 0), (4, "raw/", None), (5, "raw/", -1)], "gate_id int, key_prefix string, min_count int")
    verdicts = {r["gate_id"]: r["verdict"] for r in G.evaluate_gates(records, gates, limit=20).collect()}
    assert verdicts == {1: "invalid", 2: "success", 3: "invalid", 4: "invalid", 5: "invalid"}
    assert {r["gate_id"]: r["verdict"] for r in G.evaluate_gates(records, gates).collect()}[1] == "success"


def test_gate_table_options(spark):
    records = table(spark, [artifact(1, "raw/a.csv", branch_id=FEATURE), artifact(2, "raw/b.csv", aux=UPLOADING)], ARTIFACT)
    gates = spark.createDataFrame([(1, "raw/", 2)], "gate_id int, key_prefix string, min_count int")

    def verdict(**options):
        return G.evaluate_gates(records, gates, **options).first()["verdict"]

    assert verdict() == "pending"
    assert verdict(branch=None, wait_for_upload=False) == "success"
    assert verdict(branch=None) == "pending"


def test_gate_opened_at(spark):
    events = spark.createDataFrame([(5, "a"), (1, "a"), (3, "a"), (2, "b")], "id long, k string")
    assert [tuple(r) for r in G.gate_opened_at(events, ["k"], 2).collect()] == [("a", 3)]
    assert sorted(map(tuple, G.gate_opened_at(events, ["k"], 1).collect())) == [("a", 1), ("b", 2)]


def test_table_of_gates_with_every_criterion(spark):
    """Against plain Python; no criterion, also an exact key, is matched by a nested loop."""
    files = [artifact(i, ["in/", "out/", "in/sub/"][i % 3] + f"f{i % 11}" + [".csv", ".txt"][i % 2], [None, "model", "dataset", "__internal_run__"][i % 4],
                      UPLOADING if i % 5 == 0 else None, [1, FEATURE][i % 7 == 0]) for i in range(400)]
    cases = [
        (n, key, prefix, suffix, kind, branch_id, 1 + 40 * (n % 5))
        for n, (key, prefix, suffix, kind, branch_id) in enumerate(
            (k, p, s, c, b) for k in (None, "in/f3.csv") for p in (None, "", "in/", "in/f") for s in (None, [".csv"], [".csv", ".txt"])
            for c in (None, ["model"], ["__internal_run__", "dataset"]) for b in (None, FEATURE)
        )
    ]
    gates = spark.createDataFrame(cases, "gate_id int, key string, key_prefix string, suffix array<string>, kind array<string>, branch_id long, min_count int")
    result = G.evaluate_gates(make_catalog(spark, artifact=files).load("artifact"), gates)
    got = {r["gate_id"]: (r["n_ready"], r["verdict"]) for r in result.collect()}
    for n, key, prefix, suffix, kind, branch_id, least in cases:
        ready = sum(
            f["branch_id"] == (branch_id or 1) and (key is None or f["key"] == key) and f["key"].startswith(prefix or "")
            and (suffix is None or f["suffix"] in suffix) and (f["kind"] in kind if kind else f["kind"] != "__internal_run__") and not f["_aux"]
            for f in files
        )
        assert got[n] == (ready, "success" if ready >= least else "pending"), cases[n]
    plan = result._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
