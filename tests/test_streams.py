"""A stream over a log that arrives in files gives the batch operator's rows."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as S

from changelake.operators import events as E
from changelake.operators.gates import gate_opened_at
from changelake.sources import fixtures
from changelake.sources.catalog import Catalog
from changelake.sources.readers import read_log_stream, scratch_dir
from changelake.streaming import streams

SF_DIR = "/root/testdata/sf0.001"
ALL = ["created", "updated", "deleted"]


@pytest.fixture(scope="module")
def log_files(spark, tmp_path_factory):
    """The test log in six files in the order of its ids."""
    root = tmp_path_factory.mktemp("log")
    log = fixtures.view(spark, SF_DIR, "write_log")
    size = log.count() // 6 + 1
    for part in range(6):
        rows = log.where(S.col("id").between(part * size + 1, (part + 1) * size))
        rows.coalesce(1).write.mode("append").parquet(str(root))
    return str(root)


@pytest.fixture(scope="module")
def cat(spark, log_files):
    whole = fixtures.catalog(spark, SF_DIR)
    return Catalog([whole.registry(name) for name in whole.names()], lambda: spark.read.parquet(log_files))


BATCH = {
    "record": (E.record_events, {"registry": "artifact", "events": ALL}),
    "artifact": (E.artifact_events, {"events": ALL}),
    "status": (E.status_events, {}),
    "block": (E.block_events, {}),
    "custom": (E.custom_events, {"derive": lambda rows: rows.where("id % 7 = 0")}),
}


def _rows(df):
    return sorted(r[0] for r in df.select(S.to_json(S.struct("*"))).collect())


@pytest.mark.parametrize("kind", sorted(BATCH))
def test_stream_equals_batch(spark, log_files, cat, tmp_path, kind):
    operator, options = BATCH[kind]
    if kind == "custom":
        options = {**options, "candidates": S.col("event_type") == "INSERT"}
    out = str(tmp_path / "out")
    stream = read_log_stream(spark, log_files, max_files=1)
    query = streams.stream_events(kind, stream, cat, out, str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    assert len(query.recentProgress) >= 6
    expected = operator(cat, **options)
    assert expected.count() > 0
    assert _rows(spark.read.parquet(f"{out}/batch=*").select(*expected.columns)) == _rows(expected)


@pytest.mark.parametrize("every", [1, 2, 50])
def test_completions_are_remembered_across_batches(spark, log_files, cat, tmp_path, every, monkeypatch):
    """Uploads that ended behind a micro-batch count, also behind the stream's start."""
    def small(catalog, table_name, path):
        return plain(catalog, table_name, path, every)

    plain = streams._Completions
    monkeypatch.setattr(streams, "_Completions", small)
    start = 300
    stream = read_log_stream(spark, log_files, max_files=1, after_id=start)
    out = str(tmp_path / "out")
    streams.stream_events("artifact", stream, cat, out, str(tmp_path / "cp"), events=ALL).awaitTermination()
    got = spark.read.parquet(f"{out}/batch=*")
    expected = E.artifact_events(cat, events=ALL, log=cat.log().where(S.col("id") > start))
    assert _rows(got.select(*expected.columns)) == _rows(expected)
    whole = E.artifact_events(cat, events=ALL).where(S.col("id") > start)
    assert _rows(got.select(*expected.columns)) == _rows(whole)


def test_a_failed_batch_is_delivered_after_a_restart(spark, log_files, cat, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    written = streams.parquet_sink(out)

    def failing(events, batch_id):
        written(events, batch_id)
        if batch_id == 2:
            raise RuntimeError("lost after writing, before the commit")

    def start(sink):
        stream = read_log_stream(spark, log_files, max_files=1)
        return streams.stream_events("block", stream, cat, sink, checkpoint)

    with pytest.raises(Exception, match="lost after writing"):
        start(failing).awaitTermination()
    start(written).awaitTermination()
    expected = E.block_events(cat)
    assert _rows(spark.read.parquet(f"{out}/batch=*").select(*expected.columns)) == _rows(expected)


def _collect(spark, stream, tmp_path):
    out = str(tmp_path / "rows")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    writer.start(out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@pytest.mark.parametrize("n", [1, 3])
def test_stream_gate_fires_once(spark, log_files, cat, tmp_path, n):
    keys = ["sqlrecord_id", "table_name"]
    opened = _collect(spark, streams.stream_gate(read_log_stream(spark, log_files, max_files=1), keys, n), tmp_path)
    expected = gate_opened_at(cat.log(), keys, n)
    assert sorted(map(tuple, opened.collect())) == sorted(map(tuple, expected.collect()))
    assert expected.count() > 0
    with pytest.raises(ValueError):
        streams.stream_gate(cat.log(), keys, 0)


@pytest.mark.parametrize("n", [1, 40, 900])
def test_a_hot_gate_is_cut_down_where_it_is_read(spark, tmp_path, n):
    rows = [(i, "hot" if i % 10 else None if i % 30 else f"g{i % 7}", 1) for i in range(3000)]
    log = spark.createDataFrame(rows, "id long, gate string, part int")
    for low in (0, 700, 710, 2000):  # four micro-batches
        high = {0: 700, 700: 710, 710: 2000, 2000: 3000}[low]
        log.where(f"id >= {low} AND id < {high}").repartition(3).write.mode("append").parquet(str(tmp_path / f"log/{low}"))
    folders = sorted((tmp_path / "log").iterdir(), key=lambda f: int(f.name))
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "log/*"))
    keys = ["gate", "part"]
    opened = _collect(spark, streams.stream_gate(stream, keys, n), tmp_path)
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted(map(tuple, opened.collect()), key=key) == sorted(map(tuple, gate_opened_at(log, keys, n).collect()), key=key)
    batches = log.select("gate", "part", "id").toArrow().to_batches(max_chunksize=1000)
    partial = [list(streams._least_ids(n, keys)(iter([b]))) for b in batches]
    assert len(folders) == 4 and len(batches) >= 3
    for batch, found in zip(batches, partial, strict=True):
        out = [r for part in found for r in part.to_pylist()]
        assert len(out) == len({r["gate"] for r in batch.to_pylist()}) and sum(r["total"] for r in out) == len(batch)
        assert all(r["ids"] == sorted(r["ids"])[:n] and len(r["ids"]) == min(n, r["total"]) for r in out)


def test_stream_dedupe(spark, log_files, cat, tmp_path):
    log = read_log_stream(spark, log_files, max_files=2)
    once = streams.dedupe_stream(log.unionByName(read_log_stream(spark, log_files, max_files=2)), "30 days")
    got = _collect(spark, once.select("id"), tmp_path)
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in cat.log().collect())


def test_unknown_kind_and_scratch_folder(spark, cat, tmp_path):
    with pytest.raises(ValueError, match="unknown kind"):
        streams.batch_operator("nope", cat)
    local = scratch_dir(spark, "x")
    assert local != scratch_dir(spark, "x")
    def session(master, shared=None):
        own = {} if shared is None else {"spark.checkpoint.dir": shared}
        return SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master, getConf=lambda: own))

    cluster = session("spark://host:7077", f"{tmp_path}/")
    assert scratch_dir(cluster, "x").startswith(f"{tmp_path}/x-")
    assert scratch_dir(cluster, "x") != scratch_dir(cluster, "x")
    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(session(master), "x")
