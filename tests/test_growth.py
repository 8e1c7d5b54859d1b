"""What a step leaves on disk, moves and holds, where that grows with the input."""

import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from codeweft.operators.cfg import flow_paths
from codeweft.operators.counts import graph_rollup
from codeweft.operators.extract import flatten
from codeweft.plans.analyze import parse
from codeweft.plans.replay import replay_assertions
from codeweft.queries import REGISTRY
from codeweft.queries.state import line_elements, replay_stages
from codeweft.session import in_place, passing, plan_buckets, shared_root, stage
from codeweft.sinks.buckets import BucketedTable
from codeweft.sinks.files import children, exists


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    """Orders, lines and parts, a line twice and one without a part."""
    orders = [(1, "2-HIGH", "F"), (2, "1-URGENT", "O"), (3, "5-LOW", "P")]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderpriority string, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 1, 7, 9, "A", "F"), (1, 1, 7, 9, "A", "F"), (1, 2, 8, 9, "N", "O"), (2, 1, 8, 9, "R", "F"), (3, 5, None, 9, "N", "F")]
    layout = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, layout).write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = [(7, "Brand#2", "a", 5), (8, "Brand#1", "b", 30)]
    spark.createDataFrame(parts, "p_partkey bigint, p_brand string, p_name string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(9, "s", 4)], "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    return str(tmp_path)


def test_staged_tables_of_a_step_go_with_it(spark):
    staged = f"{shared_root(spark)}/codeweft"
    before = set(children(spark, staged))
    with passing(spark):
        assert stage(spark.range(3), "own").count() == 3
        assert len(set(children(spark, staged)) - before) == 1
    assert set(children(spark, staged)) == before


def test_a_batch_leaves_its_table_only(spark, tmp_path):
    """The staged rows of the batch are gone, and what died between taking a bucket away
    and moving the new one in is finished, moved ones staying."""
    staged = f"{shared_root(spark)}/codeweft"
    rows = spark.range(40).select(F.col("id").cast("string").alias("key"))
    kept = BucketedTable(spark, f"{tmp_path}/t", rows.schema, "key", 4)
    before = set(children(spark, staged))
    put, moves = BucketedTable._put, []

    def die(path, to, *_):
        raise RuntimeError("lost")

    import codeweft.sinks.buckets as module

    move = module.move
    module.move = lambda s, path, to: moves.append(to) or (die(path, to) if len(moves) == 2 else move(s, path, to))
    try:
        with pytest.raises(RuntimeError):
            kept.update(rows, lambda held, new: new, "a")
        kept.update(rows, lambda held, new: new, "a")
    finally:
        module.move = move
    assert put and len(moves) == 5 and kept.read().count() == 40
    assert set(children(spark, staged)) == before and not children(spark, f"{tmp_path}/t/_pending")
    assert exists(spark, f"{tmp_path}/t/bucket_of_4=0")


def test_files_are_parsed_by_all_cores(spark, tables):
    found = REGISTRY["file_nodes"](spark, tables)
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_rollup_moves_ids_once(spark):
    rows = [("g", "A", "1"), ("g", "B", "1"), ("h", "A", "2"), ("h", "A", "2"), ("i", "A", "1"), (None, None, "3"), (None, None, None), ("k", "A", "4"), ("k", "B", "5")]
    rolled = graph_rollup(spark.createDataFrame(rows, "repo string, kind string, id string"), "repo")
    assert not [line for line in plan(rolled).splitlines() if "Expand" in line and " id#" in line]
    got = sorted((str(r.repo), str(r.kind), r.total, r.ids_unique) for r in rolled.collect())
    none = [("None", "None", 2, False), ("None", "None", 2, False), ("None", "None", 9, False)]
    assert got == sorted([
        *none, ("g", "A", 1, True), ("g", "B", 1, True), ("g", "None", 2, False), ("h", "A", 2, False), ("h", "None", 2, False),
        ("i", "A", 1, True), ("i", "None", 1, True), ("k", "A", 1, True), ("k", "B", 1, True), ("k", "None", 2, True),
    ])


def test_snapshot_sends_no_table_to_the_driver(spark, tables):
    found = REGISTRY["graph_snapshot"](spark, tables)
    joins = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in joins and "SortMergeJoin" in joins
    row = found.first()
    assert (row.edges, row.unique_edges, row.file_edges, row.edge_kinds) == (4, 3, 2, "AST=2,CFG=1,DFG=1")


def test_parser_holds_one_text_at_a_time(spark):
    text = b"this is no code " * 4000
    batch = pa.RecordBatch.from_pydict({"file_id": ["f"] * 400, "path": ["p"] * 400, "content": [text] * 400})
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in flatten(iter([batch]), False))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 400 and peak < 10 << 20  # the texts are 26 MB


def test_checks_need_no_distinct_count(spark, tables):
    stages, runs = replay_stages(spark, tables)
    checks = replay_assertions(stages, runs, ["file_id"])
    assert "distinct" not in plan(checks)
    got = {r.file_id: r.unchanged_files_were_not_rewritten for r in checks.collect()}
    assert got == {"1": True, "2": True, "3": False}


def test_lines_are_made_distinct_by_their_numbers(spark, tables):
    rows = line_elements(spark, tables)
    assert rows.count() == 4
    (grouped,) = [line for line in plan(rows).splitlines() if "Aggregate" in line]
    keys = grouped.split("]")[0]
    assert "l_orderkey" in keys and "l_linenumber" in keys and "element_id" not in keys


def test_control_flow_moves_no_rows(spark):
    text = b"while a:\n    if b:\n        break\n    try:\n        c()\n    finally:\n        d()\nelse:\n    e()\n"
    files = spark.createDataFrame([("f", "f.py", bytearray(text))], "file_id string, path string, content binary")
    raw = parse(files)
    with in_place(spark):
        flow = flow_paths(raw)
        steps = flow._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in steps and plan(flow).count("Join ") <= 2
    got = {(r.source_path, r.discriminator): r.target_path for r in flow.collect()}
    assert got["$.body[0].body[0].body[0]", "break"] == "$.__exit__"
    assert got["$.body[0].body[1].body[0]", "next"] == "$.body[0].body[1].finalbody[0]"
    assert got["$.body[0].body[1].finalbody[0]", "next"] == "$.body[0]"


def test_buckets_follow_the_sources(spark, tmp_path):
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(400)), lambda i: F.sha2((F.col("id") * 401 + i).cast("string"), 256)))
    spark.range(2000).select(text.alias("content")).write.parquet(f"{tmp_path}/sources")
    assert plan_buckets(spark.read.parquet(f"{tmp_path}/sources")) > 2 * spark.sparkContext.defaultParallelism
