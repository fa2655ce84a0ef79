"""Statements on commands, the registry, ages and skip reasons."""

import math

from pyspark.sql import functions as F

from starloom.operators import state


def test_commands_and_registry(spark):
    commands = spark.createDataFrame([], "id long, run_id string, kind string, args_json string, created_at string, processed_at string")
    new = spark.createDataFrame([("r", "pause", None), ("r", "stop", '{"a":1}')], "run_id string, kind string, args_json string")
    one = state.enqueue_commands(commands, new, ["kind"], "t1")
    assert sorted(map(tuple, one.collect())) == [(1, "r", "pause", "{}", "t1", None), (2, "r", "stop", '{"a":1}', "t1", None)]
    done = state.mark_processed(one, spark.createDataFrame([(2,), (2,), (9,)], "id long"), "t2")
    assert {r.id: r.processed_at for r in done.collect()} == {1: None, 2: "t2"}
    daemon = spark.createDataFrame([], "id int, pid int, host string, started_at string, last_heartbeat string")
    again = state.set_daemon(state.set_daemon(daemon, 5, "a", "t1"), 6, "b", "t2")
    assert [tuple(r) for r in again.collect()] == [(1, 6, "b", "t2", "t2")]


def test_ages(spark):
    rows = [("2024-01-01T00:00:00+00:00",), ("2024-01-01T01:00:00",), ("2024-01-01T02:00:00+02:00",), ("soon",), ("",), (None,), ("12",)]
    df = spark.createDataFrame(rows, "at string").select("at", state.age_seconds(F.col("at"), F.lit("2024-01-01 02:00:00").cast("timestamp")).alias("age"))
    assert [r.age for r in df.collect()] == [7200.0, 3600.0, 7200.0, math.inf, math.inf, math.inf, math.inf]


def test_superseded_stages(spark):
    key = "run_id string, target_label string, stage string"
    rows = [("r", "t", "a", "pending"), ("r", "t", "b", "success"), ("r", "t", "c", "pending"), ("r", "u", "a", "pending"), ("r", "off", "a", "external"), ("r", "off", "b", "success"), ("q", "t", "a", "pending"), ("q", "t", "b", "success")]
    runs = spark.createDataFrame([(*r, None, None) for r in rows], f"{key}, status string, finished_at string, exit_code int")
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "before string, after string")
    targets = spark.createDataFrame([("r", "t", 1), ("r", "u", None), ("r", "off", 0), ("q", "t", 1)], "run_id string, target_label string, enabled int")
    artifacts = spark.createDataFrame([("r", "t", "a", "external_check", "x", "old"), ("r", "t", "a", "log", "y", "old"), ("q", "t", "a", "skip_reason", "z", "old")], f"{key}, artifact_type string, path string, verified_at string")
    after, kept = state.skip_superseded(runs, artifacts, edges, targets, "r", ["c"], ["a", "b"], "now")
    changed = {tuple(r)[:4]: (r.finished_at, r.exit_code) for r in after.collect() if r.finished_at}
    assert changed == {("r", "t", "a", "skipped"): ("now", 0)} and after.count() == len(rows)
    assert sorted(tuple(r)[:5] for r in kept.collect()) == [("q", "t", "a", "skip_reason", "z"), ("r", "t", "a", "log", "y"), ("r", "t", "a", "skip_reason", "superseded")]
    twice = state.skip_superseded(after, kept, edges, targets, "r", ["c"], ["a", "b"], "later")[0]
    assert {r.finished_at for r in twice.collect()} == {"now", None}
    needed = {(r.run_id, r.target_label, r.stage) for r in state.with_verify_needed(runs, edges, ["c"], ["a", "b"]).where("verify_needed").collect()}
    assert needed == {("r", "u", "a")}
