"""Checks over the stages of a replay, all of them in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeweft.functions.contracts import all_true
from codeweft.schemas import SCHEMA_VERSION, TOPIC_EDGES, TOPIC_ERRORS, TOPIC_METADATA, TOPIC_NODES

# The stages of a replay, in order.
STAGES = ("baseline", "modified", "forced_unchanged", "restart_replay")
SAMPLE_TOPICS = (TOPIC_NODES, TOPIC_EDGES, TOPIC_METADATA, TOPIC_ERRORS)
_GRAPH = ("nodes", "unique_nodes", "edges", "unique_edges", "file_nodes", "file_edges", "edge_kinds")


def with_previous(stages: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Add the value of the stage before; a key has one row per stage."""
    return stages.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy("stage")))


def replay_assertions(stages: DataFrame, runs: DataFrame, keys: list[str]) -> DataFrame:
    """One row of 21 named checks per key.

    ``stages`` has one row per key and stage: ``stage`` (0 to 3), ``path``,
    ``source_hash``, ``parsed_nodes``, ``parsed_edges``, ``deleted_nodes``,
    ``deleted_edges``, the graph columns, ``documents``, ``distinct_files``,
    ``document_hash``, ``document_offset``, ``other_digest``, ``end_offset``,
    ``checkpoint_offset``. ``runs`` has one row per key: ``expected_path``,
    ``expected_files``, ``checkpoint_before``, ``checkpoint_after``,
    ``document_offset_after``, ``other_digest_after``, ``first_start_offset``,
    ``samples`` (array of topic, key, schema_version, event_time) and
    ``dead_letter_end``.
    """
    c = F.col

    def at(name: str, value: str | Column) -> Column:
        held = c(value) if isinstance(value, str) else value
        return F.max(F.when(c("stage") == STAGES.index(name), held))

    graph = F.to_json(F.struct(*[c(g) for g in _GRAPH]))
    joined = with_previous(stages, keys, "document_offset", "offset_before").join(runs, keys)
    samples = F.first("samples")
    required = F.array(*[F.lit(t) for t in SAMPLE_TOPICS])
    sizes = F.struct("file_nodes", "file_edges")
    deletes = c("deleted_nodes") + c("deleted_edges")
    base, mod, same, again = STAGES
    checks = {
        "only_requested_file_processed": all_true(c("path") == c("expected_path")),
        "source_hash_changed": at(base, "source_hash") != at(mod, "source_hash"),
        "mongo_hash_matches_source": all_true(c("document_hash") == c("source_hash")),
        "neo4j_counts_match_parser": all_true(
            (c("file_nodes") == c("parsed_nodes")) & (c("file_edges") == c("parsed_edges"))
        ),
        "modified_graph_changed": at(base, sizes) != at(mod, sizes),
        "modified_emitted_stale_deletes": at(mod, deletes) > 0,
        "forced_replay_has_no_stale_elements": at(same, deletes) == 0,
        "unchanged_replay_keeps_graph_counts": at(same, graph) == at(mod, graph),
        "restart_replay_keeps_graph_counts": at(again, graph) == at(mod, graph),
        "neo4j_ids_are_unique": all_true(
            (c("nodes") == c("unique_nodes")) & (c("edges") == c("unique_edges"))
        ),
        "mongo_has_one_document_per_file": all_true(
            (c("documents") == c("distinct_files")) & (c("distinct_files") == c("expected_files"))
        ),
        # One value, told by its extremes: a distinct count would sort all rows anew.
        "unchanged_files_were_not_rewritten": F.min("other_digest") == F.max("other_digest"),
        "mongo_offsets_advance": all_true((c("stage") == 0) | (c("offset_before") < c("document_offset"))),
        "spark_consumed_each_stage": all_true(c("checkpoint_offset") == c("end_offset")),
        "checkpoint_resumed_after_restart": F.max("checkpoint_before") < at(again, "checkpoint_offset"),
        "checkpoint_preserved_while_restart_was_idle": F.max("checkpoint_after") == F.max("checkpoint_before"),
        "mongo_unchanged_while_restart_was_idle": (
            F.max("document_offset_after") == at(same, "document_offset")
        ) & (F.max("other_digest_after") == at(same, "other_digest")),
        "first_post_restart_batch_starts_at_checkpoint": F.max("first_start_offset") == F.max("checkpoint_before"),
        "kafka_samples_cover_required_topics": F.size(
            F.array_except(required, F.transform(samples, lambda s: s["topic"]))
        ) == 0,
        "kafka_samples_have_keys_version_and_event_time": F.forall(
            samples,
            lambda s: (F.length(s["key"]) > 0)
            & (s["schema_version"] == SCHEMA_VERSION)
            & F.endswith(s["event_time"], F.lit("Z")),
        ),
        "neo4j_dlq_is_empty": F.max("dead_letter_end") == 0,
    }
    return joined.groupBy(*keys).agg(
        *[F.coalesce(check, F.lit(False)).alias(name) for name, check in checks.items()]
    )
