"""Scalar functions on documents, pages and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeweft.functions import ids, jsonx, text, times
from codeweft.queries.base import load, query, sql_hash, sql_json
from codeweft.schemas import TOPIC_METADATA



@query(
    f"""
    WITH f AS (SELECT source AS repo_id, lang || '/' || doc_id || '.py' AS path,
                      sha256(text) AS digest, doc_id FROM documents),
         i AS (SELECT *, {sql_hash("repo_id", "path")} AS file_id FROM f)
    SELECT doc_id, file_id, digest,
           {sql_hash("file_id", "'$'", "'Module'")} AS node_id,
           {sql_hash("'AST'", "file_id", "digest", "'body[0]'")} AS edge_id,
           {sql_hash("'node'", "'upsert'", "file_id", "digest")} AS node_event_id,
           {sql_hash("'metadata'", "file_id", "digest", "'ok'")} AS metadata_event_id,
           {sql_hash("file_id", "digest", "'SyntaxError'", "1", "doc_id")} AS error_id
    FROM i
    """
)
def scalar_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id formula, over whole documents."""
    path = F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".py"))
    docs = load(spark, sf_dir, "documents").select(
        "doc_id",
        ids.file_id("source", path).alias("file_id"),
        text.content_digest(F.col("text").cast("binary")).alias("digest"),
    )
    return docs.select(
        "doc_id",
        "file_id",
        "digest",
        ids.node_id("file_id", F.lit("$"), F.lit("Module")).alias("node_id"),
        ids.edge_id(F.lit("AST"), "file_id", "digest", F.lit("body[0]")).alias("edge_id"),
        ids.graph_event_id(F.lit("node"), F.lit("upsert"), "file_id", "digest").alias("node_event_id"),
        ids.metadata_event_id("file_id", "digest", F.lit("ok")).alias("metadata_event_id"),
        ids.error_id("file_id", "digest", F.lit("SyntaxError"), F.lit(1), "doc_id").alias("error_id"),
    )




def sql_line_count(column: str) -> str:
    """Every line break becomes LF; then breaks are counted."""
    plain = f"replace({column}, chr(13) || chr(10), chr(10))"
    for code in (13, 11, 12, 28, 29, 30, 133, 8232, 8233):
        plain = f"replace({plain}, chr({code}), chr(10))"
    breaks = f"(length({plain}) - length(replace({plain}, chr(10), '')))"
    tail = f"CASE WHEN {plain} = '' OR {plain} LIKE '%' || chr(10) THEN 0 ELSE 1 END"
    return f"CAST({breaks} + {tail} AS INTEGER)"


@query(
    f"""
    SELECT doc_id, {sql_line_count("text")} AS line_count, strlen(text) AS size_bytes,
           TRUE AS valid_utf8, substr(text, 1, 200) AS head, substr(text, 1, 2000) = text AS short,
           length(sha256(text)) = 64 AS digest_is_hex,
           split_part('k' || doc_id || chr(9) || source || chr(9) || lang, chr(9), 1) AS record_key,
           source || chr(9) || lang AS record_value,
           source AS after_colon
    FROM documents
    """
)
def scalar_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text functions over whole documents."""
    content = F.col("text").cast("binary")
    line = F.concat(F.lit("k"), F.col("doc_id").cast("string"), F.lit("\t"), "source", F.lit("\t"), "lang")
    key, value = text.keyed_record(line)
    return load(spark, sf_dir, "documents").select(
        "doc_id",
        text.line_count(text.decode_lossy(content)).alias("line_count"),
        F.length(content).cast("bigint").alias("size_bytes"),
        text.is_utf8(content).alias("valid_utf8"),
        F.substring("text", 1, 200).alias("head"),
        (F.substring("text", 1, 2000) == F.col("text")).alias("short"),
        text.is_hex64(text.content_digest(content)).alias("digest_is_hex"),
        key.alias("record_key"),
        value.alias("record_value"),
        text.after_last_colon(F.concat("lang", F.lit(":0:"), "source")).alias("after_colon"),
    )


@query(
    """
    WITH s AS (SELECT event_id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS base,
                      microsecond(ts) % 1000000 AS us FROM events),
         t AS (SELECT event_id, ts, CASE WHEN us = 0 THEN base || 'Z'
                      ELSE base || '.' || lpad(CAST(us AS VARCHAR), 6, '0') || 'Z' END AS stamp FROM s)
    SELECT event_id, stamp, TRUE AS valid, TRUE AS same_time, FALSE AS broken_valid,
           ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY AS retained
    FROM t
    """
)
def scalar_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTC stamps: written, checked and read back."""
    events = load(spark, sf_dir, "events").select("event_id", "ts")
    newest = events.agg(F.max("ts").alias("newest"))
    stamped = events.crossJoin(F.broadcast(newest)).withColumn("stamp", times.utc_stamp(F.col("ts")))
    return stamped.select(
        "event_id",
        "stamp",
        times.is_utc_stamp(F.col("stamp")).alias("valid"),
        (times.parse_stamp(F.col("stamp")) == F.col("ts")).alias("same_time"),
        times.is_utc_stamp(F.rtrim(F.replace("stamp", F.lit("Z"), F.lit("X")))).alias("broken_valid"),
        times.retained(F.col("ts"), F.col("newest"), 7).alias("retained"),
    )


@query(
    f"""
    WITH j AS (SELECT event_id, {sql_json(id="event_id", kind="event_type", none="NULL", user="user_id")} AS body,
                      CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT event_id, body, sha256(body) AS digest, k, event_id + 1 AS from_object, event_id + 1 AS from_text,
           CAST(NULL AS BIGINT) AS other_topic FROM j
    """
)
def scalar_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical JSON, its hash, map access and progress offsets."""
    fields = {
        "user": F.col("user_id"),
        "kind": F.col("event_type"),
        "id": F.col("event_id"),
        "none": F.lit(None).cast("string"),
    }
    offset = F.to_json(F.create_map(F.lit(TOPIC_METADATA), F.create_map(F.lit("0"), F.col("event_id") + 1)))
    quoted = F.substring(F.to_json(F.array(offset)), 2, 1 << 30)
    quoted = F.substr(quoted, F.lit(1), F.length(quoted) - 1)
    props = F.from_json("props", "map<string,bigint>")
    return load(spark, sf_dir, "events").select(
        "event_id",
        jsonx.canonical_json(fields).alias("body"),
        jsonx.json_hash(fields).alias("digest"),
        props["k"].alias("k"),
        jsonx.progress_offset(offset, TOPIC_METADATA).alias("from_object"),
        jsonx.progress_offset(quoted, TOPIC_METADATA).alias("from_text"),
        jsonx.progress_offset(offset, "other").alias("other_topic"),
    )


# Forms of a remote address: two hosted ones, one elsewhere, none at all.
_HOSTED = "github.com"


@query(
    f"""
    WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
                      rtrim(regexp_extract(url, '^[a-z]+://[^/?#]+/?([^?#]*)', 1), '/') AS path FROM pages)
    SELECT page_id,
           CASE WHEN starts_with(host, 'm.') OR starts_with(host, 'blog.') THEN host || '/' || path
                ELSE regexp_extract('/' || path, '([^/]*)$', 1) END AS repo_id
    FROM p
    """
)
def repo_id_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository ids for page addresses: hosted by prefix, else by folder."""
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1)
    path = F.rtrim(F.regexp_extract("url", r"^[a-z]+://[^/?#]+/?([^?#]*)", 1), F.lit("/"))
    slug = F.concat("host", F.lit("/"), "path")
    url = (
        F.when(F.startswith("host", F.lit("m.")), F.concat(F.lit(f"git@{_HOSTED}:"), slug, F.lit(".git")))
        .when(F.startswith("host", F.lit("blog.")), F.concat(F.lit(f"https://{_HOSTED}\\"), slug))
        .otherwise(F.concat(F.lit("https://elsewhere.example/"), slug))
    )
    pages = load(spark, sf_dir, "pages").select("page_id", host.alias("host"), path.alias("path"))
    return pages.select("page_id", text.repo_id_from_url(url, F.concat(F.lit("/srv/"), "path")).alias("repo_id"))
