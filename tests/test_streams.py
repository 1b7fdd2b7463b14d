"""The queue as a source, and states with timers, over restarts."""

import json
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lineloom.operators import jobs
from lineloom.streaming import queue, timers

STEPS = ("Detecting", "Parsing", "Merging Output", "Saving to Database", "Reporting", "Completed")


@pytest.fixture
def store(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", timers.STORE)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass") if old is None else spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


def _events(batch):
    """Of jobs 0 to 19 the steps that come in a batch; job k stops after k % 7 of them."""
    return [(f"job{k}", f"{k}-{i}", i, STEPS[i]) for k in range(20) for i in range(2 * batch, 2 * batch + 2) if i < min(6, k % 7)]


def _frame(spark, rows):
    body = F.to_json(F.struct("event_id", "i", "status"))
    return spark.createDataFrame(rows, "key string, event_id string, i int, status string").select("key", "i", body.alias("body"))


def _read(spark, folder):
    got = spark.readStream.format("jobqueue").option("path", folder).option("ranges", "3").load()
    b = F.from_json("body", "event_id string, i int, status string")
    return got.select(F.col("key").alias("job_id"), "batch", "place", b.alias("b")).select("job_id", "batch", "place", "b.event_id", "b.i", F.timestamp_seconds(F.col("b.i")).alias("timestamp"), F.lit("X").alias("event_type"), F.to_json(F.struct(F.col("b.status").alias("status"))).alias("data"))


def _run(df, out, checkpoint):
    def save(rows, epoch):
        rows.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    q = df.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    assert q.awaitTermination(90)


def test_queue_keeps_order_and_loses_nothing_over_restarts(spark, tmp_path):
    queue.register(spark)
    folder, out, check = str(tmp_path / "q"), str(tmp_path / "out"), str(tmp_path / "check")
    for batch in range(3):
        assert queue.publish(_frame(spark, _events(batch)), folder, ["i"]) == batch + 1
        _run(_read(spark, folder), out, check)
    got = spark.read.parquet(out).collect()
    want = [e for batch in range(3) for e in _events(batch)]
    assert sorted(r.event_id for r in got) == sorted(e[1] for e in want)
    order = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.epoch, r.batch, r.place)):
        order[r.job_id].append(r.i)
    assert all(v == sorted(v) for v in order.values())
    # what isn't known yet isn't read; a folder without batches is empty
    (tmp_path / "q" / "parts" / "unfinished").mkdir()
    (tmp_path / "q" / "parts" / "unfinished" / "3").write_text(json.dumps(["job3", "{}"]) + "\n")
    assert spark.read.format("jobqueue").option("path", folder).load().count() == len(want)
    assert spark.read.format("jobqueue").option("path", str(tmp_path / "none")).load().count() == 0
    # a trigger's end is committed when the next one begins, at the latest on the next start
    _run(_read(spark, folder), out, check)
    gone = queue.prune(folder, ["default"])
    assert set(gone) <= {1, 2} and queue.publish(_frame(spark, _events(0)), folder, ["i"]) == 4
    assert queue.prune(folder, ["default", "other"]) == []


def test_states_with_timers_over_restarts(spark, tmp_path, store):
    queue.register(spark)
    folder, out, check = str(tmp_path / "q"), str(tmp_path / "out"), str(tmp_path / "check")
    for batch in range(3):
        again = _events(batch - 1) if batch else []  # delivered twice
        queue.publish(_frame(spark, _events(batch) + again), folder, ["i"])
        _run(timers.clocked(_read(spark, folder), idle=1000), out, check)
    time.sleep(1.2)
    queue.publish(_frame(spark, [("other", "o-0", 0, "Detecting")]), folder, ["i"])
    _run(timers.clocked(_read(spark, folder), idle=1000), out, check)
    rows = spark.read.parquet(out).collect()
    last = {}
    for r in sorted(rows, key=lambda r: r.epoch):
        if not r.stuck:
            last[r.job_id] = (r.status, r.applied, r.ignored)
    events = spark.createDataFrame([(k, e, i, s) for batch in range(3) for k, e, i, s in _events(batch)], "job_id string, event_id string, timestamp int, status string")
    want = {r.job_id: (r.status, r.applied, r.ignored) for r in jobs.fold(events).collect()}
    assert {k: v for k, v in last.items() if k != "other"} == want
    stuck = {r.job_id: r.status for r in rows if r.stuck}
    assert {k for k in stuck if k != "other"} == {k for k, v in want.items() if v[0] != "Completed"} and all(stuck[k] == want[k][0] for k in stuck if k != "other")
