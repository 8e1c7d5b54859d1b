"""Progress rows, checkpoint offsets and verification snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeweft.functions.contracts import all_true
from codeweft.functions.jsonx import progress_offset
from codeweft.schemas import SNAPSHOT_VERSION

PROGRESS = (
    "captured_at string, type string, query_id string, run_id string, name string, exception string, "
    "progress struct<id:string, runId:string, name:string, timestamp:string, batchId:bigint, "
    "numInputRows:bigint, sources:array<struct<startOffset:string, endOffset:string>>>"
)


def progress_events(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the progress log; blank lines are left out. Offsets stay JSON text."""
    return spark.read.schema(PROGRESS).json(path).where(F.col("type").isNotNull())


def input_progress(events: DataFrame, run_id: str, after: str = "") -> DataFrame:
    """Progress rows of one run that took in rows, captured after a time."""
    return events.where(
        (F.col("type") == "query_progress")
        & (F.col("progress.runId") == run_id)
        & (F.col("progress.numInputRows") > 0)
        & (F.col("captured_at") > after)
    )


def first_batch(events: DataFrame) -> DataFrame:
    """The first batch with input of every run, with its offsets as text."""
    rows = events.where((F.col("type") == "query_progress") & (F.col("progress.numInputRows") > 0))
    head = F.min_by("progress", "progress.batchId").alias("p")
    return rows.groupBy(F.col("progress.runId").alias("run_id")).agg(head).select(
        "run_id",
        F.col("p.timestamp").alias("timestamp"),
        F.col("p.batchId").alias("batch_id"),
        F.col("p.numInputRows").alias("num_input_rows"),
        F.col("p.sources")[0]["startOffset"].alias("start_offset"),
        F.col("p.sources")[0]["endOffset"].alias("end_offset"),
    )


def topic_offset(offset: Column, topic: str) -> Column:
    return progress_offset(offset, topic)


def checkpoint_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Last planned offset of a checkpoint: the newest file's last line."""
    files = spark.read.option("wholetext", True).text(f"{checkpoint}/offsets")
    named = files.select(
        F.regexp_extract("_metadata.file_name", r"^(\d+)$", 1).alias("name"),
        F.element_at(F.split(F.rtrim("value"), "\n"), -1).alias("offset"),
    ).where("name != ''")
    batch = F.col("name").cast("bigint")
    return named.agg(F.max(batch).alias("batch_id"), F.max_by("offset", batch).alias("offset"))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot documents, one per file, as ``snapshot`` (VARIANT), next to the columns
    that the folders name. The reader parses each document once; what is no JSON
    becomes null."""
    reader = spark.read.option("singleVariantColumn", "snapshot").option("multiLine", True)
    return reader.json(path)


def gate_input(snapshots: DataFrame) -> DataFrame:
    """What :func:`evidence_gate` takes, out of documents with a ``name``. A version that
    is no text is none."""
    version = F.try_variant_get("snapshot", "$.schema_version", "variant")
    return snapshots.select(
        "name",
        F.when(F.schema_of_variant(version) == "STRING", version.try_cast("string")).alias("schema_version"),
        F.try_variant_get("snapshot", "$.assertions", "map<string,boolean>").alias("assertions"),
    )


def evidence_gate(snapshots: DataFrame) -> DataFrame:
    """Per snapshot: the right version, and at least one check, all of them true.

    ``snapshots(name, schema_version, assertions map<string,boolean>)``.
    """
    checks = snapshots.select(
        "name", (F.col("schema_version") == SNAPSHOT_VERSION).alias("current"), F.explode_outer("assertions").alias("check", "passed")
    )
    return checks.groupBy("name").agg(
        F.bool_and("current").alias("current"),
        F.count("check").alias("checks"),
        F.count_if(F.col("check").isNotNull() & ~F.coalesce("passed", F.lit(False))).alias("failed"),
        all_true(F.col("passed")).alias("passed"),
    ).withColumn("accepted", F.coalesce(F.col("current"), F.lit(False)) & F.col("passed"))
