"""Incremental runs: skip, change, failure, replay, and what they publish."""

import json

import pytest
from helpers import ONE_LINE, WITH_FUNCTION, sources
from pyspark.sql import functions as F

from codeweft.functions.contracts import key_holds, violations
from codeweft.plans import reconcile as rec
from codeweft.schemas import PAYLOADS, TOPIC_EDGES, TOPIC_ERRORS, TOPIC_METADATA, TOPIC_NODES
from codeweft.sinks.eventlog import EventLog
from codeweft.sinks.tables import VersionedTables

NOW = "2024-06-01T00:00:00Z"


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """Five runs over two files: base, change, forced, back, broken, again."""
    root = str(tmp_path_factory.mktemp("runs"))
    state = VersionedTables(spark, f"{root}/state", rec.STATE_LAYOUT)
    log = EventLog(spark, f"{root}/log")
    steady = "def g(y):\n    return y\n"
    plan = [
        ("base", ONE_LINE, False), ("change", WITH_FUNCTION, False), ("forced", WITH_FUNCTION, True),
        ("back", ONE_LINE, False), ("broken", "def broken(:\n    pass\n", False), ("again", "def broken(:\n    pass\n", False),
    ]
    results = {}
    for name, text, force in plan:
        files = sources(spark, {"app.py": text, "steady.py": steady})
        rows = rec.run_batch(spark, files, state, log, name, NOW, f"run-{name}", force).collect()
        results[name] = {r.path: r for r in rows}
    return results, log, state


def test_status_and_counts(runs):
    results, _, _ = runs
    app = {name: results[name]["app.py"] for name in results}
    assert [app[n].status for n in app] == ["processed", "processed", "processed", "processed", "error", "skipped"]
    assert [results[n]["steady.py"].status for n in results] == ["processed", "skipped", "processed"] + ["skipped"] * 3
    assert (app["base"].nodes, app["base"].edges) == (7, 6)
    assert (app["change"].nodes, app["change"].edges) == (29, 36)
    # The published sizes of the change and of the way back.
    assert (app["change"].deleted_nodes, app["change"].deleted_edges) == (0, 1)
    assert (app["forced"].deleted_nodes, app["forced"].deleted_edges) == (0, 0)
    assert (app["back"].deleted_nodes, app["back"].deleted_edges) == (22, 31)
    assert (app["broken"].deleted_nodes, app["broken"].deleted_edges) == (7, 6)
    assert "broken" not in app["broken"].error and "app.py" in app["broken"].error


def test_every_event_keeps_the_contract(runs):
    _, log, _ = runs
    events = log.committed().cache()
    for topic, payload in PAYLOADS.items():
        part = events.where(F.col("topic") == topic)
        assert part.count() > 0, topic
        bad = part.where((F.size(violations(F.col("value"), payload)) > 0) | ~key_holds(F.col("topic"), F.col("key"), F.col("value")))
        assert bad.count() == 0, topic


def test_publish_order(runs):
    _, log, _ = runs
    broken = log.committed().where("batch_number = 4").orderBy("seq").collect()
    topics = [r.topic for r in broken]
    assert topics == [TOPIC_EDGES] * 6 + [TOPIC_NODES] * 7 + [TOPIC_ERRORS, TOPIC_METADATA]
    assert [r.key for r in broken[:6]] == sorted(r.key for r in broken[:6])
    assert set(json.loads(broken[0].value)["edge"]) == {"id"}
    document = json.loads(broken[-1].value)["metadata"]
    assert document["parse_status"] == "error" and document["node_counts"] == {} and document["line_count"] == 2


def test_forced_replay_repeats_the_ids(runs):
    _, log, _ = runs
    def ids(number):
        rows = log.committed().where(f"batch_number = {number}").select("topic", F.get_json_object("value", "$.event_id").alias("e"), F.get_json_object("value", "$.op").alias("op"))
        return {tuple(r) for r in rows.where("op = 'upsert'").collect()}

    assert ids(1) <= ids(2)


def test_skipped_runs_publish_nothing_and_state_follows(runs):
    _, log, state = runs
    assert log.committed().where("batch_number = 5").count() == 0
    file_state, elements = state.read("file_state", "elements")
    assert file_state.count() == 2
    held = {r.file_id for r in elements.select("file_id").distinct().collect()}
    assert len(held) == 1  # the broken file has no elements left


def test_retry_of_a_batch_is_ignored(runs, spark):
    _, log, state = runs
    before, version = log.committed().count(), state.version()
    log.publish(log.committed(), "base")
    state.commit({"file_state": state.read("file_state")[0]}, "base")
    assert (log.committed().count(), state.version()) == (before, version)


def test_a_run_that_died_before_its_state_is_finished_as_it_was(spark, tmp_path, monkeypatch):
    """The file changes before the batch runs again: the log and the state agree."""
    state = VersionedTables(spark, f"{tmp_path}/state", rec.STATE_LAYOUT)
    log = EventLog(spark, f"{tmp_path}/log")

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(VersionedTables, "link", die)
        with pytest.raises(RuntimeError):
            rec.run_batch(spark, sources(spark, {"app.py": ONE_LINE}), state, log, "one", NOW, "run")
    changed = sources(spark, {"app.py": WITH_FUNCTION})
    rec.run_batch(spark, changed, state, log, "one", NOW, "run")
    hashes = {json.loads(r.value)["content_hash"] for r in log.committed().collect()}
    assert {r.content_hash for r in state.read("file_state")[0].collect()} == hashes
    assert rec.run_batch(spark, changed, state, log, "two", NOW, "run").first().status == "processed"


def test_batches_may_have_any_name_and_are_ordered(spark, tmp_path):
    log = EventLog(spark, f"{tmp_path}/log")
    names = ["plain", "a=b", "50%25"]
    for name in names:
        log.publish(spark.createDataFrame([("t", "k", name, 50)], "topic string, key string, value string, seq bigint"), name)
    assert [r.value for r in log.committed().orderBy("place").collect()] == names
