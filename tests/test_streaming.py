"""Completeness of a stream's jobs over two runs of one query on one checkpoint."""

import json

import pytest

from quern.streaming import completeness as c

SCHEMA = "job string, chunk int, expected int, ok boolean, time timestamp"


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, c.ROCKSDB)
    yield
    spark.conf.set(key, before)


def test_a_resumed_query_goes_on(spark, tmp_path, rocksdb):
    source, out, state = (tmp_path / n for n in ("in", "out", "state"))
    source.mkdir()

    def put(name, rows):
        (source / name).write_text("".join(json.dumps(dict(zip(("job", "chunk", "expected", "ok", "time"), r))) + "\n" for r in rows))

    def run():
        stream = spark.readStream.schema(SCHEMA).json(f"file://{source}")
        query = c.completeness(stream, attempts=2, patience_seconds=600).writeStream.format("json").option("path", f"file://{out}").option("checkpointLocation", f"file://{state}").trigger(availableNow=True).start()
        query.awaitTermination()
        return {(r.job, r.event, r.chunk, r.chunks, r.attempts) for r in spark.read.schema(c.OUT).json(f"file://{out}").collect()}

    at = "2024-01-01T00:{:02}:00".format
    put("1.json", [("a", 0, 3, True, at(0)), ("a", 1, 3, False, at(1)), ("b", 0, 2, True, at(0)), ("d", None, 2, None, at(0)), ("d", 0, None, True, at(2)), (None, 0, 1, True, at(0)), ("e", 0, 1, True, None)])
    first = run()
    assert first == {("a", "retry", 1, 1, 1)}
    # The query starts again: what it knew is in the checkpoint, and only the new file is read.
    put("2.json", [("a", 1, 3, True, at(3)), ("a", 2, 3, True, at(3)), ("a", 0, 3, True, at(3)), ("d", 1, 2, None, at(4)), ("f", 0, 9, True, at(40))])
    second = run()
    assert second - first == {("a", "complete", None, 3, None), ("a", "repeated", 0, 3, 1), ("d", "retry", 1, 1, 1), ("b", "overdue", None, 1, None), ("d", "overdue", None, 1, None)}
    put("3.json", [("b", 1, 2, True, at(41)), ("d", 1, 2, False, at(41)), ("a", 1, 3, False, at(41))])
    third = run()
    assert third - second == {("b", "late", 1, 2, 1), ("b", "complete", None, 2, None), ("d", "given up", 1, 1, 2), ("a", "repeated", 1, 3, 2)}
