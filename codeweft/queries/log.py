"""The event log: envelopes, contracts, keys, samples and offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeweft.functions.contracts import key_holds, time_holds, version_holds, violations
from codeweft.functions.ids import graph_event_id, metadata_event_id, stable_hash
from codeweft.functions.times import utc_stamp
from codeweft.operators.keyed import first_per_key, latest_per_key
from codeweft.operators.merge import compact
from codeweft.plans.reconcile import envelope
from codeweft.plans.replay import with_previous
from codeweft.queries.base import load, query, sql_hash, sql_json
from codeweft.schemas import TOPIC_METADATA, TOPIC_NODES
from codeweft.session import scratch, stage
from codeweft.sinks.eventlog import EventLog, judge, keep_in_session, read_jsonl, split_dead_letters, write_jsonl
from codeweft.sources.eventlog import (
    documents_of,
    end_offsets,
    read_documents,
    retain,
    route,
    sample_per_topic,
    split_keyed,
)


def base_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log rows: key, topic, partition, offset, timestamp, value."""
    return load(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        F.col("ts").alias("timestamp"),
        F.col("props").alias("value"),
    )


def common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the common envelope fields: the user is the file."""
    return load(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "user_id",
        "ts",
        F.lit("shop").alias("repo_id"),
        stable_hash(F.lit("shop"), "user_id").alias("file_id"),
        stable_hash("props").alias("content_hash"),
        utc_stamp(F.col("ts")).alias("event_time"),
        F.concat(F.lit("run-"), F.col("event_type")).alias("run_id"),
    )


SQL_COMMON = f"""
    SELECT event_id, event_type, user_id, ts, 'shop' AS repo_id, {sql_hash("'shop'", "user_id")} AS file_id,
           {sql_hash("props")} AS content_hash,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
             ELSE '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') END || 'Z' AS event_time,
           'run-' || event_type AS run_id
    FROM events
"""


def node_events(rows: DataFrame) -> DataFrame:
    """Node events of the log: an ``error`` event deletes, others upsert."""
    op = F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("upsert"))
    upserts, deletes = route(rows.withColumn("op", op))
    only_id = F.struct(F.col("file_id").alias("id"))
    whole = F.struct(F.col("file_id").alias("id"), F.lit("AST").alias("kind"), F.col("event_type").alias("name"))

    def of(df: DataFrame, op: str, body: Column) -> DataFrame:
        event = graph_event_id(F.lit("node"), F.lit(op), "file_id", "content_hash")
        return envelope(df, "node", op, F.col("file_id"), event, body)

    return of(upserts, "upsert", whole).unionByName(of(deletes, "delete", only_id))


def _sql_event(payload: str, op: str, event_id: str, body: str) -> str:
    return sql_json(
        schema_version="'1.0'", event_time="event_time", repo_id="repo_id", file_id="file_id", run_id="run_id",
        content_hash="content_hash", event_id=event_id, op=f"'{op}'", **{payload: body},
    )


_UPSERT_ID = sql_hash("'node'", "'upsert'", "file_id", "content_hash")
_DELETE_ID = sql_hash("'node'", "'delete'", "file_id", "content_hash")
_UPSERT = _sql_event("node", "upsert", _UPSERT_ID, "{'id': file_id, 'kind': 'AST', 'name': event_type}")
_DELETE = _sql_event("node", "delete", _DELETE_ID, "{'id': file_id}")
SQL_NODE_EVENTS = f"""
    SELECT event_id, file_id AS key, '{TOPIC_NODES}' AS topic,
           CASE WHEN event_type = 'error' THEN {_DELETE} ELSE {_UPSERT} END AS value
    FROM ({SQL_COMMON})
"""


@query(f"SELECT topic, key, value, CASE WHEN value LIKE '%\"op\":\"delete\"%' THEN 1 ELSE 3 END AS phase FROM ({SQL_NODE_EVENTS})")
def build_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a node event in its envelope."""
    return node_events(common(spark, sf_dir)).select("topic", "key", "value", "phase")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op FROM events")
def route_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes and upserts, each through its own branch."""
    op = F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op")
    upserts, deletes = route(load(spark, sf_dir, "events").select("event_id", op))
    return upserts.unionByName(deletes)


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_events(common(spark, sf_dir))


def damaged_events(rows: DataFrame) -> DataFrame:
    """Node events of which each event type but one is broken in its own way."""
    event = graph_event_id(F.lit("node"), F.lit("upsert"), "file_id", "content_hash")
    made = envelope(
        rows.withColumnRenamed("event_id", "number"), "node", "upsert", F.col("file_id"),
        event, F.struct(F.col("file_id").alias("id")), ["number", "event_type"],
    )
    kind, value = F.col("event_type"), F.col("value")
    broken = (
        F.when(kind == "click", F.replace(value, F.lit('"op":"upsert"'), F.lit('"op":"merge"')))
        .when(kind == "view", F.replace(value, F.lit('"schema_version":"1.0"'), F.lit('"schema_version":"2.0","extra":1')))
        .when(kind == "signup", F.substring(value, 2, 1 << 30))
        .when(kind == "purchase", F.replace(value, F.lit('"repo_id":"shop"'), F.lit('"repo_id":""')))
        .otherwise(value)
    )
    return made.select(
        F.col("number").alias("event_id"),
        kind,
        F.when(kind == "purchase", F.lit("")).otherwise(F.col("key")).alias("key"),
        broken.alias("value"),
    )


REASONS = """CASE event_type WHEN 'click' THEN 'op' WHEN 'view' THEN 'extra field,schema_version'
              WHEN 'signup' THEN 'not an object' WHEN 'purchase' THEN 'repo_id' ELSE '' END"""


@query(f"SELECT event_id, {REASONS} AS reasons FROM events")
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken contract rules of every record."""
    reasons = F.array_join(violations(F.col("value"), "node"), ",")
    return damaged(spark, sf_dir).select("event_id", reasons.alias("reasons"))


@query(
    """
    SELECT event_id, event_type NOT IN ('purchase', 'signup') AS key_ok,
           event_type NOT IN ('view', 'signup') AS version_ok, event_type <> 'signup' AS time_ok FROM events
    """
)
def key_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, version and time checks of every record."""
    value = F.col("value")
    return damaged(spark, sf_dir).select(
        "event_id",
        key_holds(F.lit(TOPIC_NODES), F.col("key"), value).alias("key_ok"),
        version_holds(value).alias("version_ok"),
        time_holds(value).alias("time_ok"),
    )


@query(
    f"""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'good' ELSE 'dead' END AS route,
           CASE WHEN event_type = 'error' THEN '' WHEN event_type IN ('purchase', 'signup') THEN
             array_to_string(list_sort(['key', {REASONS}]), ',') ELSE {REASONS} END AS reasons
    FROM events
    """
)
def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records split into accepted ones and dead letters with reasons."""
    good, dead = split_dead_letters(stage(judge(damaged(spark, sf_dir), TOPIC_NODES), "judged"))
    return good.select("event_id", F.lit("good").alias("route"), F.lit("").alias("reasons")).unionByName(
        dead.select("event_id", F.lit("dead").alias("route"), F.array_join("reasons", ",").alias("reasons"))
    )


def metadata_records(rows: DataFrame) -> DataFrame:
    """Metadata records, one per event; a ``signup`` record is malformed."""
    doc = F.struct(
        F.col("file_id").alias("_id"), "repo_id", F.col("event_type").alias("path"), "content_hash",
        F.col("event_id").cast("int").alias("size_bytes"), F.lit("ok").alias("parse_status"),
        F.create_map(F.lit("AST"), (F.col("event_id") % 7).cast("int")).alias("node_counts"),
        F.col("event_time").alias("processed_at"), F.col("run_id"), F.lit("1.0").alias("schema_version"),
    )
    status = metadata_event_id("file_id", "content_hash", F.lit("ok"))
    value = F.to_json(
        F.struct(
            F.lit("1.0").alias("schema_version"), "event_time", "repo_id", "file_id", "run_id", "content_hash",
            status.alias("event_id"), F.lit("upsert").alias("op"), doc.alias("metadata"),
        )
    )
    return rows.select(
        F.col("file_id").alias("key"),
        F.when(F.col("event_type") == "signup", F.concat(F.lit("{"), value)).otherwise(value).alias("value"),
        F.lit(TOPIC_METADATA).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


_DOC_COLUMNS = ["_id", "path", "content_hash", "size_bytes", "parse_status", "processed_at", "run_id", "kafka_offset", "kafka_partition"]
SQL_DOCS = f"""
    SELECT file_id AS _id, event_type AS path, content_hash, CAST(event_id AS INTEGER) AS size_bytes,
           'ok' AS parse_status, event_time AS processed_at, run_id, event_id AS kafka_offset,
           CAST(user_id % 4 AS INTEGER) AS kafka_partition, event_id % 7 AS ast_nodes
    FROM ({SQL_COMMON}) WHERE event_type <> 'signup'
"""
_NULLED = ", ".join(
    f"CASE WHEN event_type <> 'signup' THEN {e} END AS {n}"
    for n, e in {"_id": "file_id", "path": "event_type", "content_hash": "content_hash", "run_id": "run_id"}.items()
)


@query(
    f"""SELECT {_NULLED}, event_id AS kafka_offset, '{TOPIC_METADATA}' AS kafka_topic,
        regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '\\.?0+$', '') AS kafka_timestamp FROM ({SQL_COMMON})"""
)
def flatten_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata records as columns; malformed ones have no key yet."""
    flat = documents_of(read_documents(metadata_records(common(spark, sf_dir))))
    return flat.select("_id", "path", "content_hash", "run_id", "kafka_offset", "kafka_topic", "kafka_timestamp")


@query(f"SELECT * FROM ({SQL_DOCS})")
def drop_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata documents that have a key."""
    keyed, _ = split_keyed(read_documents(metadata_records(common(spark, sf_dir))))
    flat = documents_of(keyed)
    return flat.select(*_DOC_COLUMNS, F.col("node_counts")["AST"].cast("bigint").alias("ast_nodes"))


@query(
    """
    SELECT topic, arg_min(key, "offset") AS key, min("offset") AS "offset", arg_min(value, "offset") AS value
    FROM (SELECT event_type AS topic, event_id AS "offset", CAST(user_id AS VARCHAR) AS key, props AS value FROM events)
    GROUP BY 1
    """,
    name="sample_per_topic",
)
def sample_of_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first keyed record of every topic."""
    return sample_per_topic(base_log(spark, sf_dir).select("topic", "key", "offset", "value"))


@query(
    """
    SELECT topic, sum(last) AS end_offset FROM (
      SELECT event_type AS topic, user_id % 4 AS p, max(event_id) + 1 AS last FROM events GROUP BY 1, 2) GROUP BY 1
    """
)
def end_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End offsets of every topic over its partitions."""
    return end_offsets(base_log(spark, sf_dir))


@query(
    """
    SELECT CAST(user_id AS VARCHAR) AS key, max(event_id) AS "offset", arg_max(event_type, event_id) AS topic,
           arg_max(props, event_id) AS value FROM events GROUP BY 1
    """
)
def compact_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log compaction: the newest record of every key."""
    return compact(base_log(spark, sf_dir).select("key", "offset", "topic", "value"), ["key"], "offset")


@query(
    """
    SELECT user_id, event_type, min(event_id) AS event_id, arg_min(props, event_id) AS props
    FROM events GROUP BY 1, 2
    """,
    name="first_per_key",
)
def first_per_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of every user and type: the first definition wins."""
    events = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "props")
    return first_per_key(events, ["user_id", "event_type"], "event_id")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed deduplication: the last write of every key wins."""
    return latest_per_key(load(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("SELECT event_id, event_type FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def retain_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the last seven days before the newest one."""
    return retain(load(spark, sf_dir, "events").select("event_id", "event_type", "ts"), 7, "ts").drop("ts")


@query(
    """
    WITH m AS (SELECT event_type, date_trunc('day', ts) AS d, max(event_id) AS off FROM events GROUP BY 1, 2),
         p AS (SELECT event_type, d, off, row_number() OVER (PARTITION BY event_type ORDER BY d) - 1 AS stage,
                      lag(off) OVER (PARTITION BY event_type ORDER BY d) AS before FROM m)
    SELECT event_type, count(*) AS stages, bool_and(before IS NULL OR before < off) AS advances FROM p GROUP BY 1
    """
)
def offsets_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each topic's daily end offset grows from day to day."""
    days = load(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("stage")).agg(
        F.max("event_id").alias("last_offset")
    )
    seen = with_previous(days, ["event_type"], "last_offset", "before")
    grows = F.col("before").isNull() | (F.col("before") < F.col("last_offset"))
    return seen.groupBy("event_type").agg(F.count("*").alias("stages"), F.every(grows).alias("advances"))


@query(f"SELECT key, topic, value FROM ({SQL_NODE_EVENTS})")
def jsonl_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON lines per topic and read back."""
    path = scratch(spark, "jsonl")
    write_jsonl(node_events(common(spark, sf_dir)), path)
    return read_jsonl(spark, path).select("key", "topic", "value")


@query(f"SELECT key, topic, value, CASE WHEN value LIKE '%\"op\":\"delete\"%' THEN 0 ELSE 1 END AS batch_number FROM ({SQL_NODE_EVENTS})")
def committed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two committed batches are read, a third that was only written is not."""
    records = node_events(common(spark, sf_dir)).withColumn("seq", F.col("phase"))
    log = EventLog(spark, scratch(spark, "log"))
    upserts, deletes = records.where("phase = 3"), records.where("phase = 1")
    log.publish(deletes, "deletes")
    log.write(records)
    log.publish(upserts, "upserts")
    log.publish(upserts, "upserts")
    return log.committed().select("key", "topic", "value", "batch_number")


@query(f"SELECT topic, count(*) AS records, count(DISTINCT key) AS keys FROM ({SQL_NODE_EVENTS}) GROUP BY 1")
def memory_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records held for the session under a name and asked with SQL."""
    keep_in_session(node_events(common(spark, sf_dir)).select("topic", "key"), "held_records")
    return spark.sql("SELECT topic, count(*) AS records, count(DISTINCT key) AS keys FROM held_records GROUP BY topic")
