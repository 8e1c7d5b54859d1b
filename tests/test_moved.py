"""What moves between tasks, and that it says the same."""

import json

import pytest
from helpers import sources
from pyspark.sql import functions as F

from codeweft.functions.contracts import violations, with_kept
from codeweft.functions.ids import pack, unpack
from codeweft.plans import reconcile as rec
from codeweft.queries import REGISTRY
from codeweft.schemas import ELEMENTS, FILE_STATE


@pytest.fixture
def orders(spark, tmp_path):
    """Orders and their lines; one order twice, one urgent."""
    rows = [(1, "2-HIGH", "O"), (2, "1-URGENT", "O"), (3, "5-LOW", "P"), (3, "5-LOW", "P")]
    spark.createDataFrame(rows, "o_orderkey bigint, o_orderpriority string, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(o, n) for o in (1, 2, 3) for n in range(1, 7)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_packed_text_comes_back(spark):
    texts = ["", "a", "0", "ab", "AB", "00ff", "é", "\x01", "zz", "ab" * 32, "AB" * 32, None, "0a\x1f"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    held = pack(rows, "t")
    assert [r.t for r in unpack(held, "t").collect()] == texts
    assert held.distinct().count() == len(texts)
    assert held.agg(F.max(F.length("t"))).first()[0] == 65 and len(held.where(F.length("t") == 33).collect()) == 1


@pytest.mark.parametrize("name", ["reconcile", "publish_order"])
def test_events_move_once_and_without_their_text(spark, orders, name):
    found = REGISTRY[name](spark, orders)
    steps = found._jdf.queryExecution().optimizedPlan().toString()
    assert steps.count("RepartitionByExpression") + steps.count("Join ") == 1
    assert "json" not in steps[steps.index("RepartitionByExpression"):].lower()
    seqs = {}
    for r in found.collect():
        seqs.setdefault(r.file_id, []).append(r.seq)
    assert {f: len(s) for f, s in seqs.items()} == {"1": 1 + 5 + 1, "2": 4 + 1 + 1, "3": len(seqs["3"])}
    assert all(sorted(s) == list(range(len(s))) for s in seqs.values())


def test_sealed_events_say_what_envelopes_say(spark):
    common = "'f' AS file_id, 'r' AS repo_id, 'c' AS content_hash, 't' AS event_time, CAST(NULL AS STRING) AS run_id, 'node' AS element_type"
    for op, kind in (("delete", "node"), ("upsert", "edge")):
        rows = spark.sql(f"SELECT 'k\"1' AS element_id, {common}").withColumn("element_type", F.lit(kind))
        own = rec.graph_event_id(F.lit(kind), F.lit(op), "element_id", "content_hash")
        want = rec.envelope(rows, kind, op, F.col("element_id"), own, F.struct(F.col("element_id").alias("id"))).collect()
        got = rec.sealed(rec.bare_events(rows, F.lit(kind), op, F.col("element_id")))
        assert got.select("file_id", "topic", "key", "phase", "value").collect() == [
            r for r in spark.createDataFrame(want).select("file_id", "topic", "key", "phase", "value").collect()
        ]
    body, mine = F.struct(F.lit("m").alias("_id"), F.lit(None).cast("int").alias("n")), F.lit("e")
    want = rec.envelope(rows, "metadata", "upsert", F.col("file_id"), mine, body).first()
    got = rec.sealed(rec.bare_events(rows, F.lit("metadata"), "upsert", F.col("file_id"), body, mine)).first()
    assert (got.topic, got.key, got.phase, got.value) == (want.topic, want.key, want.phase, want.value)


def test_events_of_parsed_files_stay_in_their_buckets(spark):
    was = sources(spark, {"a.py": "def f(x):\n    return x + y\n", "b.py": "z = 1\n"})
    now = sources(spark, {"a.py": "def f(x):\n    return x\n", "b.py": "z = (\n", "c.py": "print(1)\n"})
    none = spark.createDataFrame([], FILE_STATE), spark.createDataFrame([], ELEMENTS)
    first = rec.reconcile(was, *none, "t", "one")
    second = rec.reconcile(now, first.file_state, first.elements, "t", "two")
    steps = second.events._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in steps and "RoundRobin" not in steps
    by_file = {}
    for r in second.events.collect():
        by_file.setdefault(r.file_id, []).append((r.seq, r.phase, r.key))
    assert len(by_file) == 3
    for rows in by_file.values():
        assert [s for s, _, _ in sorted(rows)] == list(range(len(rows)))
        assert [(p, k) for _, p, k in sorted(rows)] == sorted((p, k) for _, p, k in rows)


def test_whether_a_rule_is_broken_needs_no_list_of_names(spark):
    h = "ab" * 32
    good = dict(schema_version="1.0", event_time="2024-06-01T00:00:00Z", repo_id="r", file_id=h, run_id="x", content_hash=h, event_id=h, op="upsert")
    events = [{**good, "node": {"id": h}}, {**good, "node": {"id": "x"}}, {**good, "node": {}}, {**good, "node": None}, {**good, "node": "t"}, good]
    events += [{**good, "node": {"id": h}, "more": 1}] + [{**good, "node": {"id": h}, k: v} for k in good for v in (None, "", "no")]
    events += [{k: v for k, v in events[0].items() if k != out} for out in good]
    values = [json.dumps(e) for e in events] + ["", "{", "[]", "null", "1", None, '{"node":{"id":1}}']
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    both = with_kept(rows, "node", "kept").withColumn("names", violations(F.col("value"), "node"))
    got = both.collect()
    assert [r.kept for r in got] == [r.names == [] for r in got] and 0 < sum(r.kept for r in got) < len(got) / 2
    assert "lambda" not in with_kept(rows, "node", "kept")._jdf.queryExecution().optimizedPlan().toString()
