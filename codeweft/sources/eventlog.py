"""Reading the change-event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeweft.operators.keyed import first_per_key
from codeweft.schemas import METADATA, METADATA_EVENT
from codeweft.sinks.eventlog import kafka_options


def log_stream(spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None) -> DataFrame:
    """A growing table as a stream; ``max_files`` bounds what a batch takes in."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A stream takes a folder or a pattern; one file is named by a pattern.
    return reader.parquet(path if _is_folder(spark, path) else path + "*")


def _is_folder(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(place).isDirectory()


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The topic on a broker. Needs the Kafka source on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic)).load()


# What a document calls the log's own columns.
LOG_COLUMNS = {
    "kafka_topic": "topic",
    "kafka_partition": "partition",
    "kafka_offset": "offset",
    "kafka_timestamp": "timestamp",
}
KEY = "_id"


def read_documents(log: DataFrame) -> DataFrame:
    """Log rows with ``document``: the metadata they hold and where they came from."""
    body = F.from_json(F.col("value").cast("string"), METADATA_EVENT)["metadata"]
    members = [body[name].alias(name) for name in METADATA.fieldNames()]
    origin = [F.col(old).alias(new) for new, old in LOG_COLUMNS.items()]
    return log.withColumn("document", F.struct(*members, *origin))


def documents_of(read: DataFrame) -> DataFrame:
    """The documents of :func:`read_documents`, a column per member."""
    flat = read.select("document.*")
    return flat.withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("string"))


def mark_unkeyed(read: DataFrame) -> DataFrame:
    """Add ``reasons`` to :func:`read_documents`: a document has to have a key, which
    malformed JSON has not."""
    keyed = F.col(f"document.{KEY}").isNotNull()
    return read.withColumn("reasons", F.when(keyed, F.array().cast("array<string>")).otherwise(F.array(F.lit("no document key"))))


def split_keyed(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose document has a key, and the log rows of those that have none,
    with the reason."""
    marked = mark_unkeyed(read)
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0).drop("document")


def route(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Upserts and deletes."""
    return events.where("op = 'upsert'"), events.where("op = 'delete'")


def sample_per_topic(log: DataFrame, order: str = "offset") -> DataFrame:
    """The first record with a key of every topic."""
    return first_per_key(log.where(F.length("key") > 0), ["topic"], order)


def end_offsets(log: DataFrame) -> DataFrame:
    """Per topic the sum of its partitions' end offsets.

    Transaction markers take offsets too, so this is no row count.
    """
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end"))
    return ends.groupBy("topic").agg(F.sum("end").alias("end_offset"))


def retain(log: DataFrame, days: int, ts: str = "timestamp") -> DataFrame:
    """Rows of the last ``days`` days before the newest row."""
    newest = log.agg(F.max(ts).alias("_newest"))  # one row
    kept = F.col(ts) >= F.col("_newest") - F.expr(f"INTERVAL {int(days)} DAYS")
    return log.crossJoin(F.broadcast(newest)).where(kept).drop("_newest")
