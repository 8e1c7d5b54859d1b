"""Ids, text, time and JSON functions, and the event contract."""

import json
from hashlib import sha256

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codeweft.functions import contracts, ids, jsonx, text, times
from codeweft.schemas import TOPIC_METADATA
from codeweft.sources.progress import evidence_gate, gate_input, read_snapshots

# Published sample ids: they fix separator, part order and encoding.
INVALID_FILE = "588c74ea0f8771aa5a93280dd7211bd83afc52bf9e65d495c6cc6549d74705d4"
SAMPLE_FILE = "c6ae6f5556f2b93b05a9f09c6c2907e8b49239a4167a4f0a4e766b7b9ce4ace2"
SAMPLE_DIGEST = "d9981103fcb1b057d82d44e24781f1e0547d9dca5212450da54eac55089a777a"
INVALID_DIGEST = "599a559122e3d4740cd8d47ecc76045c0c2310653235cfc102190b8f96f2182f"
MODULE = "b6569b0fda5380bcc1f06d903ea04c6654a7795938904c1a0fce0061449165d3"
IMPORT = "7f05fd0b21478c9a2be67c7504270e8ed535def48ccf860a4754c9e805ee8e0e"
EDGE = "d97f48514682f65bbab6c7370668f14c95ae9823da85cbc9219fbc8b93ddccd2"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_published_ids(spark):
    lit = F.lit
    cases = [
        (ids.file_id(lit("fixture/invalid"), lit("broken.py")), INVALID_FILE),
        (ids.node_id(lit(SAMPLE_FILE), lit("$"), lit("Module")), MODULE),
        (ids.node_id(lit(SAMPLE_FILE), lit("$.body[0]"), lit("Import")), IMPORT),
        (ids.edge_id(lit("AST"), lit(MODULE), lit(IMPORT), lit("body[0]")), EDGE),
        (
            ids.graph_event_id(lit("node"), lit("upsert"), lit(MODULE), lit(SAMPLE_DIGEST)),
            "4be15b56cb6f9965675695cc2e9d302080b3ab6a19a4220ea5ba5b62c5db9e08",
        ),
        (
            ids.graph_event_id(lit("edge"), lit("upsert"), lit(EDGE), lit(SAMPLE_DIGEST)),
            "0557614d2fa1b692e02c5702e214d226467ee3cd28b84e22127ef7b51b74262d",
        ),
        (
            ids.metadata_event_id(lit(SAMPLE_FILE), lit(SAMPLE_DIGEST), lit("ok")),
            "d098699248fd6c7aa3f866ba65db97bd9de07887fe69a3332d5628c7c49e2840",
        ),
        (
            ids.error_id(lit(INVALID_FILE), lit(INVALID_DIGEST), lit("SyntaxError"), lit(1), lit(12)),
            "92652beab5b1746ace861f951d9fb677ac613307ed66109de753d7d792d9cf8b",
        ),
        (text.content_digest(lit(b"def broken(:\n    return 1\n\n")), INVALID_DIGEST),
    ]
    row = spark.range(1).select(*[c.alias(str(i)) for i, (c, _) in enumerate(cases)]).first()
    assert list(row) == [want for _, want in cases]


def test_empty_and_null_parts_keep_their_place(spark):
    got = one(spark, ids.stable_hash(F.lit("a"), F.lit(None), F.lit(""), F.lit("b")))
    assert got == sha256("a\x1f\x1f\x1fb".encode()).hexdigest()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029é", max_size=12), min_size=1, max_size=30))
def test_line_count_is_splitlines(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", text.line_count(F.col("t")).alias("n")).collect()
    assert all(r.n == len(r.t.splitlines()) for r in rows)


def test_decoding(spark):
    df = spark.createDataFrame([(b"caf\xc3\xa9",), (b"caf\xe9 x",), (b"",)], "c binary")
    rows = df.select(text.is_utf8(F.col("c")).alias("ok"), text.decode_lossy(F.col("c")).alias("t")).collect()
    assert [tuple(r) for r in rows] == [(True, "café"), (False, "caf\ufffd x"), (True, "")]


@pytest.mark.parametrize(
    ("url", "folder", "want"),
    [
        ("https://github.com/owner/name.git", "/src/x", "owner/name"),
        ("git@github.com:owner/name.git", "/src/x", "owner/name"),
        ("https://github.com\\owner\\name", "/src/x", "owner/name"),
        ("https://elsewhere.example/owner/name.git", "/src/x/", "x"),
        ("https://github.com/", "/src/x", "x"),
        ("", "C:\\src\\x", "x"),
        (None, "/src/x", "x"),
    ],
)
def test_repo_id(spark, url, folder, want):
    assert one(spark, text.repo_id_from_url(F.lit(url).cast("string"), F.lit(folder))) == want


def test_relative_path(spark):
    assert one(spark, text.relative_path(F.lit("file:/a/b/c/d.py"), "/a/b")) == "c/d.py"
    assert one(spark, text.relative_path(F.lit("/a/b/c/d.py"), "file:///a/b/")) == "c/d.py"


def test_keyed_record(spark):
    key, value = text.keyed_record(F.lit("k\tv\tw"))
    assert (one(spark, key), one(spark, value)) == ("k", "v\tw")
    assert one(spark, text.after_last_colon(F.lit("topic:0:41"))) == "41"


def test_stamps(spark):
    ts = F.expr("timestamp'2024-01-02 03:04:05.000600'")
    assert one(spark, times.utc_stamp(ts)) == "2024-01-02T03:04:05.000600Z"
    assert one(spark, times.utc_stamp(F.expr("timestamp'2024-01-02 03:04:05'"))) == "2024-01-02T03:04:05Z"
    for stamp, ok in (("2024-01-02T03:04:05Z", True), ("2024-13-02T03:04:05Z", False), ("2024-01-02T03:04:05", False)):
        assert one(spark, times.is_utc_stamp(F.lit(stamp))) is ok


def test_progress_offset_as_object_and_as_text(spark):
    plain = '{"%s":{"0":16}}' % TOPIC_METADATA
    quoted = '"' + plain.replace('"', '\\"') + '"'
    for offset in (plain, quoted):
        assert one(spark, jsonx.progress_offset(F.lit(offset), TOPIC_METADATA)) == 16
    assert one(spark, jsonx.progress_offset(F.lit('{"other":{"0":1}}'), TOPIC_METADATA)) is None


def test_canonical_json_keeps_nulls_and_sorts(spark):
    got = one(spark, jsonx.canonical_json({"b": F.lit("é"), "a": F.lit(None).cast("string")}))
    assert got == '{"a":null,"b":"é"}'


def test_contract_lists_every_broken_rule(spark):
    event = {
        "schema_version": '"1.0"', "event_time": '"2024-01-01T00:00:00Z"', "repo_id": '"r"', "file_id": f'"{"a" * 64}"',
        "run_id": '"x"', "content_hash": f'"{"b" * 64}"', "event_id": f'"{"c" * 64}"', "op": '"upsert"',
        "node": '{"id":"%s","more":1}' % ("d" * 64),
    }

    def broken(**changed):
        merged = {k: v for k, v in {**event, **changed}.items() if v is not None}
        value = "{" + ",".join(f'"{k}":{v}' for k, v in merged.items()) + "}"
        return one(spark, contracts.violations(F.lit(value), "node"))

    assert broken() == []
    assert broken(op='"merge"') == ["op"]
    assert broken(extra="1") == ["extra field"]
    assert broken(node='{"id":"short"}') == ["node.id"]
    assert broken(node="{}") == ["missing node.id", "node.id"]
    assert broken(run_id=None) == ["missing run_id", "run_id"]
    assert broken(event_time='"yesterday"', file_id='"A"') == ["event_time", "file_id"]
    assert one(spark, contracts.violations(F.lit("{"), "node")) == ["not an object"]


def test_snapshot_minimums(spark):
    assert one(spark, contracts.integer_minimum(F.lit("3"), 1)) is True
    assert one(spark, contracts.minimum_properties(F.lit('{"a":1}'), 2)) is False


def test_all_true_needs_a_row(spark):
    df = spark.createDataFrame([("a", True), ("a", True), ("b", False), ("b", None)], "k string, f boolean")
    got = {r.k: r.v for r in df.groupBy("k").agg(contracts.all_true(F.col("f")).alias("v")).collect()}
    assert got == {"a": True, "b": False}
    assert df.where("k = 'c'").agg(contracts.all_true(F.col("f")).alias("v")).first().v is False


def test_snapshot_rules(spark, tmp_path):
    def stage_of(**change):
        whole = {"name": "n", "captured_at": "t", "source_hash": "a" * 64, "source_lines": 1, "parser": {}, "neo4j": {},
                 "mongo": {}, "kafka_metadata_end_offset": 0, "spark_checkpoint_offset": 0} | change
        return {k: v for k, v in whole.items() if v != "gone"}

    def snapshot(**change):
        whole = {
            "schema_version": "3.0", "captured_at": "2024-06-01T00:00:00Z", "neo4j_dlq_end_offset": 0,
            **{p: dict.fromkeys(names, 1) for p, names in contracts.SNAPSHOT_PARTS.items()},
            "stages": dict.fromkeys(contracts.SNAPSHOT_PARTS["stages"], stage_of()),
            "assertions": {f"c{k}": True for k in range(21)},
        } | change
        return {k: v for k, v in whole.items() if v != "gone"}

    stages = dict.fromkeys(contracts.SNAPSHOT_PARTS["stages"], stage_of())
    cases = {
        "good": (snapshot(), []),
        "array": ([1], ["not an object"]),
        "version": (snapshot(schema_version=3.0), ["schema_version"]),
        "time": (snapshot(captured_at="noon"), ["captured_at"]),
        "gone": (snapshot(replay_file="gone"), ["missing replay_file"]),
        "null": (snapshot(replay_file=None), ["replay_file"]),
        "inner": (snapshot(replay_file={"path": "", "git_diff": None}), ["missing replay_file.file_id"]),
        "below": (snapshot(neo4j_dlq_end_offset=-1), ["neo4j_dlq_end_offset"]),
        "whole": (snapshot(neo4j_dlq_end_offset=2.0), []),
        "part": (snapshot(neo4j_dlq_end_offset=0.5), ["neo4j_dlq_end_offset"]),
        "text": (snapshot(neo4j_dlq_end_offset="1"), ["neo4j_dlq_end_offset"]),
        "few": (snapshot(assertions={"a": True}), ["assertions: too few"]),
        "odd": (snapshot(assertions={f"c{k}": k or None for k in range(21)}), ["assertions: not true or false"]),
        "stage": (snapshot(stages=stages | {"extra": 1}), ["stages.extra"]),
        "fields": (
            snapshot(stages=stages | {"baseline": stage_of(source_hash="A" * 64, source_lines=0, mongo=[], name="gone")}),
            ["missing stages.baseline.name", "stages.baseline.mongo", "stages.baseline.source_hash", "stages.baseline.source_lines"],
        ),
    }
    for name, (document, _) in cases.items():
        folder = tmp_path / f"name={name}"
        folder.mkdir()
        (folder / "snapshot.json").write_text(json.dumps(document, indent=2))
    rows = read_snapshots(spark, str(tmp_path)).select("name", contracts.snapshot_violations(F.col("snapshot")).alias("v"))
    got = {r["name"]: r.v for r in rows.collect()}
    assert got == {name: want for name, (_, want) in cases.items()}
    gated = {r["name"]: r for r in evidence_gate(gate_input(read_snapshots(spark, str(tmp_path)))).collect()}
    assert gated["good"].accepted and gated["good"].checks == 21
    assert not gated["version"].accepted and not gated["version"].current
    assert not gated["array"].accepted and not gated["odd"].accepted
