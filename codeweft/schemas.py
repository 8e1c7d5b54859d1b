"""Table layouts and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "map<string,int>": T.MapType(T.StringType(), T.IntegerType()),
    "array<string>": T.ArrayType(T.StringType()),
}


def _layout(ddl: str) -> T.StructType:
    # Built here because parsing DDL needs a running session.
    fields = (field.split(" ") for field in ddl.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# They are part of the event format and of the ids.
SCHEMA_VERSION = "1.0"
SNAPSHOT_VERSION = "3.0"
TOPIC_NODES = "cpg.nodes.v1"
TOPIC_EDGES = "cpg.edges.v1"
TOPIC_METADATA = "cpg.source-metadata.v1"
TOPIC_ERRORS = "cpg.parser-errors.v1"
TOPIC_DEAD_LETTERS = "cpg.neo4j-dlq.v1"
COMPACTED_TOPICS = (TOPIC_NODES, TOPIC_EDGES, TOPIC_METADATA)
RETAINED_TOPICS = (TOPIC_ERRORS, TOPIC_DEAD_LETTERS)
RETENTION_DAYS = 7
EDGE_KINDS = ("AST", "CFG", "DFG", "CALL")
PLACEHOLDER = "PLACEHOLDER"
PAYLOADS = {
    TOPIC_NODES: "node",
    TOPIC_EDGES: "edge",
    TOPIC_METADATA: "metadata",
    TOPIC_ERRORS: "error",
}

SOURCE_FILE = _layout(
    "repo_id string, path string, file_id string, content binary"
)

NODE = _layout(
    "id string, kind string, ast_type string, file_id string, structural_path string, "
    "line int, column int, end_line int, end_column int, name string, value string"
)

EDGE = _layout(
    "id string, kind string, source_id string, target_id string, file_id string, "
    "discriminator string, variable string, resolved boolean"
)

METADATA = _layout(
    "_id string, repo_id string, repo_url string, path string, content_hash string, "
    "size_bytes int, line_count int, commit_sha string, parse_status string, "
    "node_counts map<string,int>, edge_counts map<string,int>, warnings array<string>, "
    "error_message string, processed_at string, run_id string, schema_version string"
)

ERROR = _layout(
    "id string, stage string, exception_type string, message string, line int, "
    "column int, recoverable boolean, traceback string"
)

ENVELOPE = _layout(
    "schema_version string, event_time string, repo_id string, file_id string, "
    "run_id string, content_hash string, event_id string, op string"
)
ENVELOPE_FIELDS = tuple(ENVELOPE.fieldNames())

RECORD = _layout("topic string, key string, value string")

FILE_STATE = _layout("file_id string, content_hash string, updated_at string")
ELEMENTS = _layout("file_id string, element_type string, element_id string")


def event(payload: str, layout: T.StructType) -> T.StructType:
    """Envelope plus one payload struct."""
    return T.StructType([*ENVELOPE.fields, T.StructField(payload, layout)])


METADATA_EVENT = event("metadata", METADATA)
NODE_EVENT = event("node", NODE)
EDGE_EVENT = event("edge", EDGE)
ERROR_EVENT = event("error", ERROR)
