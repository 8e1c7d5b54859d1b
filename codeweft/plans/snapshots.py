"""Snapshots of the graph and document tables, and when they have converged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeweft.operators.counts import counts_by_kind, graph_totals
from codeweft.operators.digest import table_digest

OTHER_COLUMNS = ["_id", "content_hash", "kafka_offset"]


def graph_snapshot(nodes: DataFrame, edges: DataFrame, file: Column) -> DataFrame:
    """Totals, distinct ids, one file's counts and the edge kinds in one row."""
    entry = F.concat(F.col("kind"), F.lit("="), F.col("count").cast("string"))
    kinds = counts_by_kind(edges).agg(
        F.array_join(F.sort_array(F.collect_list(entry)), ",").alias("edge_kinds")
    )
    return graph_totals(nodes, edges, file).crossJoin(kinds)


def document_counts(documents: DataFrame, key: str = "_id") -> DataFrame:
    """Rows and distinct keys per repository."""
    return documents.groupBy("repo_id").agg(
        F.count("*").alias("documents"), F.count_distinct(key).alias("distinct_files")
    )


def other_documents(documents: DataFrame, own: Column) -> DataFrame:
    """The watched columns of every document but one."""
    return documents.where(F.col("_id") != own).select(*OTHER_COLUMNS)


def document_snapshot(documents: DataFrame, own: Column) -> DataFrame:
    """Counts, the one document's hash and offset, and a digest of the rest."""
    is_own = F.col("_id") == own
    head = documents.agg(
        F.count("*").alias("documents"),
        F.count_distinct("_id").alias("distinct_files"),
        F.max(F.when(is_own, F.col("content_hash"))).alias("content_hash"),
        F.max(F.when(is_own, F.col("kafka_offset"))).alias("kafka_offset"),
    )
    rest = table_digest(other_documents(documents, own), OTHER_COLUMNS).select(
        F.col("row_count").alias("other_documents"), F.col("digest").alias("other_documents_digest")
    )
    return head.crossJoin(rest)


def converged(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """Whether both tables show a file's new state and the stream is past it.

    ``expected(key, nodes, edges, content_hash, previous_offset)`` against
    ``observed(key, file_nodes, file_edges, document_hash, document_offset,
    checkpoint_offset)``; what was not observed has not converged.
    """
    ready = (
        (F.col("file_nodes") == F.col("nodes"))
        & (F.col("file_edges") == F.col("edges"))
        & (F.col("document_hash") == F.col("content_hash"))
        & (F.coalesce("document_offset", F.lit(-1)) > F.col("previous_offset"))
        & (F.col("checkpoint_offset") > F.coalesce("document_offset", F.lit(-1)))
    )
    return expected.join(observed, key, "left").withColumn("ready", F.coalesce(ready, F.lit(False)))


def baseline_lines(total: Column, before: Column, after: Column) -> Column:
    """Lines of the tree before a change to one of its files."""
    return total - (after - before)
