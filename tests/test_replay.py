"""The 21 replay checks: all hold on a sound record, each can fail."""

import pytest
from pyspark.sql import functions as F

from codeweft.plans.replay import replay_assertions
from codeweft.schemas import TOPIC_EDGES, TOPIC_ERRORS, TOPIC_METADATA, TOPIC_NODES

GRAPH = "nodes int, unique_nodes int, edges int, unique_edges int, file_nodes int, file_edges int, edge_kinds string"
STAGES = (
    f"id string, stage int, path string, source_hash string, parsed_nodes int, parsed_edges int, deleted_nodes int, "
    f"deleted_edges int, {GRAPH}, documents int, distinct_files int, document_hash string, document_offset int, "
    "other_digest string, end_offset int, checkpoint_offset int"
)
RUNS = (
    "id string, expected_path string, expected_files int, checkpoint_before int, checkpoint_after int, "
    "document_offset_after int, other_digest_after string, first_start_offset int, "
    "samples array<struct<topic:string,key:string,schema_version:string,event_time:string>>, dead_letter_end int"
)


def record(spark):
    stages = []
    for at in range(4):
        n, e, h = (7, 6, "a") if at == 0 else (29, 36, "b")
        stages.append(
            ("r", at, "v.py", h, n, e, 0, 1 if at == 1 else 0, 100 + n, 100 + n, 150 + e, 150 + e, n, e, "AST=1", 61, 61, h,
             10 + 2 * at, "same", 12 + 2 * at, 12 + 2 * at)
        )
    samples = [(t, "k", "1.0", "2024-01-01T00:00:00Z") for t in (TOPIC_NODES, TOPIC_EDGES, TOPIC_METADATA, TOPIC_ERRORS)]
    run = [("r", "v.py", 61, 16, 16, 14, "same", 16, samples, 0)]
    return spark.createDataFrame(stages, STAGES), spark.createDataFrame(run, RUNS)


def failed(stages, runs):
    row = replay_assertions(stages, runs, ["id"]).drop("id").first().asDict()
    assert len(row) == 21
    return {name for name, ok in row.items() if not ok}


def test_sound_record(spark):
    assert failed(*record(spark)) == set()


@pytest.mark.parametrize(
    ("stage", "column", "value", "want"),
    [
        (2, "deleted_edges", 1, {"forced_replay_has_no_stale_elements"}),
        (3, "other_digest", "new", {"unchanged_files_were_not_rewritten"}),
        (1, "unique_edges", 1, {"neo4j_ids_are_unique", "unchanged_replay_keeps_graph_counts", "restart_replay_keeps_graph_counts"}),
        (2, "document_offset", 12, {"mongo_offsets_advance", "mongo_unchanged_while_restart_was_idle"}),
        (0, "end_offset", 13, {"spark_consumed_each_stage"}),
    ],
)
def test_one_wrong_stage(spark, stage, column, value, want):
    stages, runs = record(spark)
    changed = F.when(F.col("stage") == stage, F.lit(value)).otherwise(F.col(column))
    assert failed(stages.withColumn(column, changed), runs) == want


@pytest.mark.parametrize(
    ("column", "value", "want"),
    [
        ("dead_letter_end", 1, {"neo4j_dlq_is_empty"}),
        ("first_start_offset", 15, {"first_post_restart_batch_starts_at_checkpoint"}),
        ("expected_files", 60, {"mongo_has_one_document_per_file"}),
        ("checkpoint_after", 17, {"checkpoint_preserved_while_restart_was_idle"}),
    ],
)
def test_one_wrong_run(spark, column, value, want):
    stages, runs = record(spark)
    assert failed(stages, runs.withColumn(column, F.lit(value))) == want


def test_missing_sample(spark):
    stages, runs = record(spark)
    assert failed(stages, runs.withColumn("samples", F.slice("samples", 1, 3))) == {"kafka_samples_cover_required_topics"}
