"""State, reconciliation and replay over orders and their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeweft.functions.contracts import SNAPSHOT_PARTS, all_true, snapshot_violations
from codeweft.functions.ids import stable_hash
from codeweft.operators.counts import same_rows
from codeweft.operators.digest import table_digest
from codeweft.operators.graph import union_all
from codeweft.operators.merge import replace_rows
from codeweft.plans import reconcile as rec
from codeweft.plans.replay import STAGES, replay_assertions
from codeweft.plans.snapshots import (
    OTHER_COLUMNS,
    baseline_lines,
    converged,
    document_snapshot,
    other_documents,
)
from codeweft.queries.base import load, query, sql_hash, sql_json
from codeweft.schemas import ELEMENTS, FILE_STATE, SCHEMA_VERSION, SNAPSHOT_VERSION, TOPIC_EDGES, TOPIC_ERRORS, TOPIC_METADATA, TOPIC_NODES
from codeweft.session import scratch, stage
from codeweft.sinks.tables import VersionedTables
from codeweft.sources.progress import evidence_gate, gate_input, read_snapshots

NOW = "2024-06-01T00:00:00Z"


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files. Urgent ones are files that no longer parse."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("file_id"),
        F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string"), F.lit(".py")).alias("path"),
        F.col("o_orderpriority").alias("repo_id"),
        stable_hash("o_orderkey", "o_orderstatus").alias("content_hash"),
        (F.col("o_orderpriority") == "1-URGENT").alias("failed"),
        F.col("o_orderstatus").alias("status_mark"),
    )


def order_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored state: finished orders as they are, open ones with an older
    hash, pending ones not at all."""
    files = order_files(spark, sf_dir)
    old = stable_hash("file_id", F.lit("old"))
    return files.where("status_mark != 'P'").select(
        "file_id",
        F.when(F.col("status_mark") == "F", F.col("content_hash")).otherwise(old).alias("content_hash"),
        F.lit("2024-01-01T00:00:00Z").alias("updated_at"),
    )


def line_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as elements: odd lines are nodes, even ones edges. Ids follow from
    order and number, so these two alone are made distinct and moved for it."""
    odd = F.col("l_linenumber") % 2 == 1
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct().select(
        F.col("l_orderkey").cast("string").alias("file_id"),
        F.when(odd, "node").otherwise("edge").alias("element_type"),
        stable_hash("l_orderkey", "l_linenumber").alias("element_id"),
        F.col("l_linenumber").alias("line"),
    )


def previous_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_elements(spark, sf_dir).where("line <= 4").drop("line")


def current_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_elements(spark, sf_dir).where("line >= 2").drop("line")


_FILES = f"""
    files AS (SELECT CAST(o_orderkey AS VARCHAR) AS file_id, 'orders/' || o_orderkey || '.py' AS path,
                     o_orderpriority AS repo_id, {sql_hash("o_orderkey", "o_orderstatus")} AS content_hash,
                     o_orderpriority = '1-URGENT' AS failed, o_orderstatus AS status_mark FROM orders),
    state AS (SELECT file_id, CASE WHEN status_mark = 'F' THEN content_hash ELSE {sql_hash("file_id", "'old'")} END AS content_hash,
                     '2024-01-01T00:00:00Z' AS updated_at FROM files WHERE status_mark <> 'P'),
    lines AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS file_id,
                     CASE WHEN l_linenumber % 2 = 1 THEN 'node' ELSE 'edge' END AS element_type,
                     {sql_hash("l_orderkey", "l_linenumber")} AS element_id, l_linenumber AS line FROM lineitem),
    prev AS (SELECT file_id, element_type, element_id FROM lines WHERE line <= 4),
    cur AS (SELECT file_id, element_type, element_id FROM lines WHERE line >= 2),
    marked AS (SELECT f.*, s.content_hash AS stored_hash, s.content_hash IS DISTINCT FROM f.content_hash AS changed
               FROM files f LEFT JOIN state s USING (file_id)),
    good AS (SELECT c.* FROM cur c JOIN marked m USING (file_id) WHERE m.changed AND NOT m.failed),
    stale AS (SELECT p.* FROM prev p JOIN marked m USING (file_id)
              LEFT JOIN good c ON c.file_id = p.file_id AND c.element_type = p.element_type AND c.element_id = p.element_id
              WHERE m.changed AND c.file_id IS NULL)
"""


@query(f"WITH {_FILES} SELECT file_id, content_hash, updated_at FROM state")
def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State written as a versioned table and looked up for all files."""
    tables = VersionedTables(spark, scratch(spark, "state"), {"file_state": FILE_STATE})
    tables.commit({"file_state": order_state(spark, sf_dir)}, "first")
    (state,) = tables.read("file_state")
    return state.join(order_files(spark, sf_dir).select("file_id"), "file_id", "left_semi")


@query(f"WITH {_FILES} SELECT file_id, content_hash, stored_hash FROM marked")
def state_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file next to the hash that was stored for it."""
    joined = rec.with_state(order_files(spark, sf_dir), order_state(spark, sf_dir))
    return joined.select("file_id", "content_hash", "stored_hash")


@query(f"WITH {_FILES} SELECT file_id, changed, TRUE AS forced FROM marked")
def skip_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which files need work, by hash and under force."""
    files, state = order_files(spark, sf_dir), order_state(spark, sf_dir)
    plain = rec.mark_changed(files, state).select("file_id", "changed")
    forced = rec.mark_changed(files, state, force=True).select("file_id", F.col("changed").alias("forced"))
    return plain.join(forced, "file_id")


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.mark_changed(order_files(spark, sf_dir), order_state(spark, sf_dir))


def _changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Marked files, their current elements and their stale ones. Files and current
    elements are stored, as all that follows reads them again."""
    marked = stage(_marked(spark, sf_dir), "marked")
    changed = marked.where("changed")
    current = stage(rec.elements_of(current_elements(spark, sf_dir), changed.where("not failed")), "current")
    return marked, current, rec.stale_elements(previous_elements(spark, sf_dir), current, changed)


@query(f"WITH {_FILES} SELECT * FROM stale", name="stale_elements")
def stale_of_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements that changed files no longer have."""
    return _changes(spark, sf_dir)[2]


@query(f"WITH {_FILES} SELECT p.* FROM prev p JOIN marked m USING (file_id) WHERE m.changed AND m.failed")
def failed_file_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All previous elements of files that failed."""
    failed = _marked(spark, sf_dir).where("changed AND failed")
    return rec.elements_of(previous_elements(spark, sf_dir), failed)


@query(
    f"""
    WITH {_FILES}, kept AS (SELECT p.* FROM prev p WHERE NOT EXISTS (SELECT 1 FROM marked m WHERE m.changed AND m.file_id = p.file_id))
    SELECT 'element' AS part, file_id, element_type, element_id FROM (SELECT * FROM kept UNION ALL SELECT * FROM good)
    UNION ALL
    SELECT 'file', file_id, content_hash, CASE WHEN changed THEN '{NOW}' ELSE '2024-01-01T00:00:00Z' END FROM marked
    """
)
def state_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State after the batch, committed and read back."""
    marked, current, _ = _changes(spark, sf_dir)
    changed = marked.where("changed")
    tables = VersionedTables(spark, scratch(spark, "state"), {"file_state": FILE_STATE, "elements": ELEMENTS})
    tables.commit({"file_state": order_state(spark, sf_dir), "elements": previous_elements(spark, sf_dir)}, 0)
    file_state, elements = tables.read("file_state", "elements")
    tables.commit(
        {
            "file_state": rec.next_file_state(file_state, changed, F.lit(NOW)),
            "elements": rec.next_elements(elements, current, changed),
        },
        1,
    )
    file_state, elements = tables.read("file_state", "elements")
    return elements.select(F.lit("element").alias("part"), "*").unionByName(
        file_state.select(
            F.lit("file").alias("part"), "file_id", F.col("content_hash").alias("element_type"), F.col("updated_at").alias("element_id")
        )
    )


def _events(spark: SparkSession, sf_dir: str, failed_only: bool = False) -> DataFrame:
    """Events of the batch: deletes, errors, upserts and metadata."""
    if failed_only:  # such files have lost all their elements
        changed = stage(_marked(spark, sf_dir).where("changed AND failed"), "failed")
        stale, current = rec.elements_of(previous_elements(spark, sf_dir), changed), None
    else:
        marked, current, stale = _changes(spark, sf_dir)
        changed = marked.where("changed")
    common = changed.select(
        "file_id", "repo_id", "content_hash", F.lit(NOW).alias("event_time"), F.lit("run-1").alias("run_id")
    )
    upserts = [] if current is None else [rec.id_events(current, "upsert", common)]
    errors = changed.where("failed").select(
        "file_id", F.lit("SyntaxError").alias("exception_type"), F.lit("invalid syntax").alias("message"),
        F.lit(1).alias("line"), F.lit(2).alias("column"), F.lit("SyntaxError: invalid syntax").alias("traceback"),
    )
    status = F.when(F.col("failed"), F.lit("error")).otherwise(F.lit("ok"))
    docs = changed.select("*", status.alias("_status"), F.lit(NOW).alias("event_time"), F.lit("run-1").alias("run_id"))
    metadata = rec.bare_events(
        docs, F.lit("metadata"), "upsert", F.col("file_id"),
        F.struct(
            F.col("file_id").alias("_id"), F.col("content_hash"), F.col("_status").alias("parse_status"), F.col("path"),
            F.lit(NOW).alias("processed_at"), F.lit(SCHEMA_VERSION).alias("schema_version"),
        ),
        rec.metadata_event_id("file_id", "content_hash", "_status"),
    )
    events = union_all(rec.delete_events(stale, common), rec.error_events(errors, common), *upserts, metadata)
    return rec.sealed(rec.publish_order(stage(events, "events")), "seq")


def _sql_value(payload: str, op: str, event_id: str, body: str) -> str:
    return sql_json(
        schema_version="'1.0'", event_time=f"'{NOW}'", repo_id="repo_id", file_id="file_id", run_id="'run-1'",
        content_hash="content_hash", event_id=event_id, op=f"'{op}'", **{payload: body},
    )


def _sql_element(kind: str, op: str) -> str:
    return _sql_value(kind, op, sql_hash(f"'{kind}'", f"'{op}'", "element_id", "content_hash"), "{'id': element_id}")


_ERROR_ID = sql_hash("file_id", "content_hash", "'SyntaxError'", "1", "2")
_ERROR = _sql_value(
    "error", "error", _ERROR_ID,
    "{'column': 2, 'exception_type': 'SyntaxError', 'id': " + _ERROR_ID + ", 'line': 1, 'message': 'invalid syntax', "
    "'recoverable': TRUE, 'stage': 'parse', 'traceback': 'SyntaxError: invalid syntax'}",
)
_STATUS = "CASE WHEN failed THEN 'error' ELSE 'ok' END"
_METADATA = _sql_value(
    "metadata", "upsert", sql_hash("'metadata'", "file_id", "content_hash", _STATUS),
    "{'_id': file_id, 'content_hash': content_hash, 'parse_status': " + _STATUS
    + f", 'path': path, 'processed_at': '{NOW}', 'schema_version': '1.0'}}",
)
_EVENTS = f"""
    {_FILES},
    ev AS (
      SELECT file_id, '{TOPIC_EDGES}' AS topic, element_id AS key, 0 AS phase, {_sql_element("edge", "delete")} AS value
        FROM stale JOIN marked USING (file_id) WHERE element_type = 'edge'
      UNION ALL SELECT file_id, '{TOPIC_NODES}', element_id, 1, {_sql_element("node", "delete")}
        FROM stale JOIN marked USING (file_id) WHERE element_type = 'node'
      UNION ALL SELECT file_id, '{TOPIC_ERRORS}', {_ERROR_ID}, 2, {_ERROR} FROM marked WHERE changed AND failed
      UNION ALL SELECT file_id, '{TOPIC_NODES}', element_id, 3, {_sql_element("node", "upsert")}
        FROM good JOIN marked USING (file_id) WHERE element_type = 'node'
      UNION ALL SELECT file_id, '{TOPIC_EDGES}', element_id, 4, {_sql_element("edge", "upsert")}
        FROM good JOIN marked USING (file_id) WHERE element_type = 'edge'
      UNION ALL SELECT file_id, '{TOPIC_METADATA}', file_id, 5, {_METADATA} FROM marked WHERE changed),
    ordered AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY phase, key) - 1 AS seq FROM ev)
"""


@query(f"WITH {_EVENTS} SELECT file_id, topic, key, phase, seq FROM ordered", name="publish_order")
def ordered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every event within its file."""
    return _events(spark, sf_dir).select("file_id", "topic", "key", "phase", "seq")


@query(f"WITH {_EVENTS} SELECT file_id, topic, key, seq, value FROM ordered", name="reconcile")
def reconcile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of one batch over all files."""
    return _events(spark, sf_dir).select("file_id", "topic", "key", "seq", "value")


@query(
    f"WITH {_EVENTS} SELECT o.file_id, topic, key, seq, value FROM ordered o JOIN marked m USING (file_id) WHERE m.failed",
    name="reconcile_errors",
)
def reconcile_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of the files that failed: deletes, error, metadata."""
    return _events(spark, sf_dir, failed_only=True).select("file_id", "topic", "key", "seq", "value")


_RESULTS = f"""
    {_FILES},
    n AS (SELECT file_id, count(*) FILTER (element_type = 'node') AS nodes, count(*) FILTER (element_type = 'edge') AS edges FROM good GROUP BY 1),
    d AS (SELECT file_id, count(*) FILTER (element_type = 'node') AS deleted_nodes,
                 count(*) FILTER (element_type = 'edge') AS deleted_edges FROM stale GROUP BY 1),
    results AS (SELECT path, file_id, content_hash,
           CASE WHEN NOT changed THEN 'skipped' WHEN failed THEN 'error' ELSE 'processed' END AS status,
           coalesce(nodes, 0) AS nodes, coalesce(edges, 0) AS edges, coalesce(deleted_nodes, 0) AS deleted_nodes,
           coalesce(deleted_edges, 0) AS deleted_edges, 0 AS warnings,
           CASE WHEN changed AND failed THEN 'invalid syntax' ELSE '' END AS error, repo_id
    FROM marked LEFT JOIN n USING (file_id) LEFT JOIN d USING (file_id))
"""


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, current, stale = _changes(spark, sf_dir)
    errors = marked.where("changed AND failed").select("file_id", F.lit("invalid syntax").alias("full_message"))
    none = marked.select("file_id").where(F.lit(False))
    return rec.file_results(marked, current, stale, none, errors)


@query(f"WITH {_RESULTS} SELECT * EXCLUDE (repo_id) FROM results", name="file_results")
def order_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One result row per file."""
    return _results(spark, sf_dir)


@query(
    f"""
    WITH {_RESULTS} SELECT count(*) FILTER (status = 'processed') AS processed, count(*) FILTER (status = 'skipped') AS skipped,
           count(*) FILTER (status = 'error') AS errors,
           CAST(CASE WHEN count(*) FILTER (status = 'error') > 0 THEN 1 ELSE 0 END AS INTEGER) AS exit_code FROM results
    """,
    name="run_summary",
)
def order_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by status, and whether the run failed."""
    return rec.run_summary(_results(spark, sf_dir))


@query(
    f"""
    WITH {_FILES} SELECT (SELECT count(*) FROM good) AS elements, 0 AS only_left, 0 AS only_right, TRUE AS same
    """
)
def replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forced second run over the new state changes nothing in it."""
    marked, current, _ = _changes(spark, sf_dir)
    changed = marked.where("changed")
    columns = ELEMENTS.fieldNames()
    once = stage(rec.next_elements(previous_elements(spark, sf_dir), current, changed).select(*columns), "once")
    state = rec.next_file_state(order_state(spark, sf_dir), changed, F.lit(NOW))
    forced = rec.mark_changed(changed.drop("changed"), state, force=True).where("changed")
    twice = rec.next_elements(once, current, forced)
    compared = same_rows(once, twice, columns)
    return current.agg(F.count("*").alias("elements")).crossJoin(compared)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per order, in the watched columns."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("_id"),
        F.col("o_orderpriority").alias("repo_id"),
        stable_hash("o_orderkey", "o_orderstatus").alias("content_hash"),
        F.col("o_custkey").alias("kafka_offset"),
    )


_DOCS = f"""docs AS (SELECT CAST(o_orderkey AS VARCHAR) AS _id, {sql_hash("o_orderkey", "o_orderstatus")} AS content_hash,
                o_custkey AS kafka_offset FROM orders)"""
_ROW_HASH = f"sha256({sql_json(_id='_id', content_hash='content_hash', kafka_offset='kafka_offset')})"


def sql_digest(source: str, row_hash: str, group: str = "") -> str:
    """SQL text of the table digest: row hashes added up in four parts."""
    parts = [f"sum(CAST('0x' || substr(h, {1 + 15 * i}, 15) AS BIGINT))" for i in range(4)]
    text = " || ':' || ".join(["CAST(count(*) AS VARCHAR)", *[f"CAST(CAST({p} AS HUGEINT) AS VARCHAR)" for p in parts]])
    by = f"GROUP BY {group}" if group else ""
    head = f"{group}, " if group else ""
    return f"SELECT {head}count(*) AS row_count, sha256({text}) AS digest FROM (SELECT *, {row_hash} AS h FROM {source}) {by}"


@query(f"WITH {_DOCS} {sql_digest('docs', _ROW_HASH)}", name="table_digest")
def documents_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of all documents."""
    return table_digest(_documents(spark, sf_dir), OTHER_COLUMNS)


@query(f"WITH {_DOCS} SELECT * FROM docs WHERE _id <> '0'")
def other_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watched columns of every document but one."""
    return other_documents(_documents(spark, sf_dir), F.lit("0"))


@query(
    f"""
    WITH {_DOCS}, d AS ({sql_digest("(SELECT * FROM docs WHERE _id <> '0')", _ROW_HASH)})
    SELECT (SELECT count(*) FROM docs) AS documents, (SELECT count(DISTINCT _id) FROM docs) AS distinct_files,
           (SELECT content_hash FROM docs WHERE _id = '0') AS content_hash,
           (SELECT kafka_offset FROM docs WHERE _id = '0') AS kafka_offset,
           d.row_count AS other_documents, d.digest AS other_documents_digest FROM d
    """
)
def doc_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document and a digest of the others."""
    return document_snapshot(_documents(spark, sf_dir), F.lit("0"))


@query(
    f"""
    WITH {_FILES}, docs AS (SELECT file_id AS k, content_hash FROM state UNION ALL
                            SELECT file_id, content_hash FROM files WHERE status_mark = 'P')
    SELECT k AS _id, content_hash FROM (
      SELECT d.k, CASE WHEN m.status_mark = 'O' THEN m.content_hash ELSE d.content_hash END AS content_hash
      FROM docs d JOIN marked m ON m.file_id = d.k)
    """
)
def replace_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after changed and new ones replaced the old."""
    marked = _changes(spark, sf_dir)[0]
    old = order_state(spark, sf_dir).select(F.col("file_id").alias("_id"), "content_hash")
    fresh = marked.where("changed").select(F.col("file_id").alias("_id"), "content_hash")
    return replace_rows(old, fresh, ["_id"])


_PER_FILE = """
    SELECT file_id, count(*) FILTER (element_type = 'node') AS nodes, count(*) FILTER (element_type = 'edge') AS edges
"""


@query(
    f"""
    WITH {_FILES}, e AS ({_PER_FILE} FROM cur GROUP BY 1), o AS ({_PER_FILE} FROM prev GROUP BY 1)
    SELECT f.file_id, coalesce(
        coalesce(o.nodes, 0) = coalesce(e.nodes, 0) AND coalesce(o.edges, 0) = coalesce(e.edges, 0)
        AND s.content_hash = f.content_hash AND CAST(f.file_id AS BIGINT) > 0, FALSE) AS ready
    FROM files f LEFT JOIN e USING (file_id) LEFT JOIN o USING (file_id) LEFT JOIN state s USING (file_id)
    """,
    name="converged",
)
def converged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which files show their new state everywhere."""
    files = order_files(spark, sf_dir)

    def counts(df: DataFrame, node: str, edge: str) -> DataFrame:
        held = df.groupBy("file_id").agg(
            F.count_if(F.col("element_type") == "node").alias(node), F.count_if(F.col("element_type") == "edge").alias(edge)
        )
        return files.select("file_id").join(held, "file_id", "left").fillna(0, [node, edge])

    key = F.col("file_id").cast("bigint")
    expected = files.join(counts(current_elements(spark, sf_dir), "nodes", "edges"), "file_id").select(
        "file_id", "nodes", "edges", "content_hash", F.lit(0).alias("previous_offset")
    )
    observed = counts(previous_elements(spark, sf_dir), "file_nodes", "file_edges").join(
        order_state(spark, sf_dir).select(
            "file_id", F.col("content_hash").alias("document_hash"), key.alias("document_offset"),
            (key + 1).alias("checkpoint_offset"),
        ),
        "file_id",
        "left",
    )
    return converged(expected, observed, "file_id").select("file_id", "ready")


@query(
    f"""
    WITH {_FILES}, c AS (SELECT file_id, count(*) FILTER (line <= 4) AS before, count(*) FILTER (line >= 2) AS after,
                                count(*) AS total FROM lines GROUP BY 1)
    SELECT file_id, total - (after - before) AS baseline FROM c
    """
)
def line_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before a change, from the total and both counts."""
    counts = line_elements(spark, sf_dir).groupBy("file_id").agg(
        F.count_if(F.col("line") <= 4).alias("before"), F.count_if(F.col("line") >= 2).alias("after"), F.count("*").alias("total")
    )
    return counts.select("file_id", baseline_lines(F.col("total"), F.col("before"), F.col("after")).alias("baseline"))


def replay_stages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Four stages per order, and the restart row of each order.

    The baseline has the lines up to four, the later stages those from two
    on. Offsets are two apart. What is broken differs by order status: pending
    orders have a changed digest, open ones have a dead letter.
    """
    lines = line_elements(spark, sf_dir)
    kind = F.col("element_type")

    def count(which, *conditions):
        hit = F.col("line").isNotNull()
        for condition in conditions:
            hit &= condition
        return F.count_if(hit & (kind == which) if which else hit)

    was, now = F.col("line") <= 4, F.col("line") >= 2
    counts = lines.groupBy("file_id").agg(
        count("node", was).alias("n0"), count("edge", was).alias("e0"),
        count("node", now).alias("n1"), count("edge", now).alias("e1"),
        count("node", was, ~now).alias("dn"), count("edge", was, ~now).alias("de"),
    )
    files = order_files(spark, sf_dir).join(counts, "file_id")
    first = F.col("stage") == 0
    nodes, edges = F.when(first, F.col("n0")).otherwise(F.col("n1")), F.when(first, F.col("e0")).otherwise(F.col("e1"))
    second = F.col("stage") == 1
    offset = F.lit(10) + 2 * F.col("stage")
    rewritten = (F.col("status_mark") == "P") & (F.col("stage") == 3)
    staged = files.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("stage"))
    stages = staged.select(
        "file_id", "stage", "path",
        F.when(first, F.lit("old")).otherwise(F.col("content_hash")).alias("source_hash"),
        nodes.alias("parsed_nodes"), edges.alias("parsed_edges"),
        F.when(second, F.col("dn")).otherwise(F.lit(0)).alias("deleted_nodes"),
        F.when(second, F.col("de")).otherwise(F.lit(0)).alias("deleted_edges"),
        nodes.alias("nodes"), nodes.alias("unique_nodes"), edges.alias("edges"), edges.alias("unique_edges"),
        nodes.alias("file_nodes"), edges.alias("file_edges"), F.lit("AST").alias("edge_kinds"),
        F.lit(1).alias("documents"), F.lit(1).alias("distinct_files"),
        F.when(first, F.lit("old")).otherwise(F.col("content_hash")).alias("document_hash"),
        offset.alias("document_offset"), F.when(rewritten, F.lit("other")).otherwise(F.lit("same")).alias("other_digest"),
        (offset + 2).alias("end_offset"), (offset + 2).alias("checkpoint_offset"),
    )
    topics = F.array(*[F.lit(t) for t in (TOPIC_NODES, TOPIC_EDGES, TOPIC_METADATA, TOPIC_ERRORS)])
    sample = F.transform(
        topics,
        lambda t: F.struct(
            t.alias("topic"), F.lit("k").alias("key"), F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(NOW).alias("event_time")
        ),
    )
    runs = files.select(
        "file_id", F.col("path").alias("expected_path"), F.lit(1).alias("expected_files"),
        F.lit(16).alias("checkpoint_before"), F.lit(16).alias("checkpoint_after"), F.lit(14).alias("document_offset_after"),
        F.lit("same").alias("other_digest_after"), F.lit(16).alias("first_start_offset"), sample.alias("samples"),
        F.when(F.col("status_mark") == "O", F.lit(1)).otherwise(F.lit(0)).alias("dead_letter_end"),
    )
    return stages, runs


_ALWAYS = [
    "only_requested_file_processed", "source_hash_changed", "mongo_hash_matches_source", "neo4j_counts_match_parser",
    "forced_replay_has_no_stale_elements", "unchanged_replay_keeps_graph_counts", "restart_replay_keeps_graph_counts",
    "neo4j_ids_are_unique", "mongo_has_one_document_per_file", "mongo_offsets_advance", "spark_consumed_each_stage",
    "checkpoint_resumed_after_restart", "checkpoint_preserved_while_restart_was_idle",
    "mongo_unchanged_while_restart_was_idle", "first_post_restart_batch_starts_at_checkpoint",
    "kafka_samples_cover_required_topics", "kafka_samples_have_keys_version_and_event_time",
]
_CHECKS_SQL = f"""
    {_FILES},
    c AS (SELECT file_id,
            count(*) FILTER (line <= 4 AND element_type = 'node') AS n0, count(*) FILTER (line <= 4 AND element_type = 'edge') AS e0,
            count(*) FILTER (line >= 2 AND element_type = 'node') AS n1, count(*) FILTER (line >= 2 AND element_type = 'edge') AS e1,
            count(*) FILTER (line < 2) AS gone FROM lines GROUP BY 1),
    checks AS (SELECT file_id, {", ".join(f"TRUE AS {n}" for n in _ALWAYS)},
           (n0 <> n1 OR e0 <> e1) AS modified_graph_changed, gone > 0 AS modified_emitted_stale_deletes,
           status_mark <> 'P' AS unchanged_files_were_not_rewritten, status_mark <> 'O' AS neo4j_dlq_is_empty
    FROM files JOIN c USING (file_id))
"""


@query(f"WITH {_CHECKS_SQL} SELECT * FROM checks", name="replay_assertions")
def order_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 21 replay checks for every order."""
    stages, runs = replay_stages(spark, sf_dir)
    return replay_assertions(stages, runs, ["file_id"])


@query(
    f"""
    WITH {_CHECKS_SQL}, g AS (SELECT file_id AS name, (CAST(modified_graph_changed AS INTEGER) + CAST(modified_emitted_stale_deletes AS INTEGER)
           + CAST(unchanged_files_were_not_rewritten AS INTEGER) + CAST(neo4j_dlq_is_empty AS INTEGER)) AS held FROM checks)
    SELECT name, TRUE AS current, 21 AS checks, 4 - held AS failed, held = 4 AS passed, held = 4 AS accepted FROM g
    """,
    name="evidence_gate",
)
def order_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check rows written as snapshots, read back and gated."""
    stages, runs = replay_stages(spark, sf_dir)
    checks = replay_assertions(stages, runs, ["file_id"])
    names = [c for c in checks.columns if c != "file_id"]
    entries = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*names))
    path = scratch(spark, "snapshots")
    checks.select(
        F.col("file_id").alias("name"), F.lit(SNAPSHOT_VERSION).alias("schema_version"), entries.alias("assertions")
    ).write.json(path)
    layout = "name string, schema_version string, assertions map<string,boolean>"
    return evidence_gate(spark.read.schema(layout).json(path))


@query(
    f"WITH {_CHECKS_SQL} SELECT status_mark, bool_and(neo4j_dlq_is_empty) AS all_true, count(*) AS files FROM checks JOIN files USING (file_id) GROUP BY 1"
)
def all_true_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a check holds for all files of a status."""
    stages, runs = replay_stages(spark, sf_dir)
    checks = replay_assertions(stages, runs, ["file_id"]).join(order_files(spark, sf_dir), "file_id")
    return checks.groupBy("status_mark").agg(all_true(F.col("neo4j_dlq_is_empty")).alias("all_true"), F.count("*").alias("files"))


def snapshot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot for every priority and status, over the checks of all its orders.

    Urgent ones miss a part, high ones have a stage with a wrong hash and no lines,
    those of unknown priority count below zero, low ones are of an older version and
    lack a check.
    """
    stages, runs = replay_stages(spark, sf_dir)
    checks = replay_assertions(stages, runs, ["file_id"])
    names = [c for c in checks.columns if c != "file_id"]
    marked = checks.join(order_files(spark, sf_dir).select("file_id", "repo_id", "status_mark"), "file_id")
    priority = F.col("repo_id")
    grouped = marked.groupBy("repo_id", "status_mark").agg(
        *[all_true(F.col(n)).alias(n) for n in names], F.count("*").alias("files")
    )
    entries = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*names))
    fewer = F.map_filter(entries, lambda k, _: k != names[0])
    blank = F.create_map(F.lit("state"), F.lit("RUNNING"))
    high = priority == "2-HIGH"
    stage_of = {
        name: F.struct(
            F.lit(name).alias("name"), F.lit(NOW).alias("captured_at"),
            F.when(high, F.lit("none")).otherwise(stable_hash(F.lit(name), "repo_id")).alias("source_hash"),
            F.when(high, F.lit(0)).otherwise(F.col("files")).alias("source_lines"),
            blank.alias("parser"), blank.alias("neo4j"), blank.alias("mongo"),
            F.col("files").alias("kafka_metadata_end_offset"), F.col("files").alias("spark_checkpoint_offset"),
        ).alias(name)
        for name in SNAPSHOT_PARTS["stages"]
    }

    def part(name: str, **given: Column) -> Column:
        return F.struct(*[given.get(n, F.col("files")).alias(n) for n in SNAPSHOT_PARTS[name]])

    document = F.struct(
        F.when(priority == "5-LOW", F.lit("2.0")).otherwise(F.lit(SNAPSHOT_VERSION)).alias("schema_version"),
        F.lit(NOW).alias("captured_at"),
        part("repository", repo_id=priority).alias("repository"),
        F.when(priority != "1-URGENT", part("replay_file", path=priority)).alias("replay_file"),
        blank.alias("connector_status"),
        blank.alias("parser_error_fixture"),
        part("kafka_samples").alias("kafka_samples"),
        F.struct(*stage_of.values()).alias("stages"),
        part("spark_restart").alias("spark_restart"),
        F.when(priority == "4-NOT SPECIFIED", F.lit(-1)).otherwise(F.lit(0)).alias("neo4j_dlq_end_offset"),
        F.when(priority == "5-LOW", fewer).otherwise(entries).alias("assertions"),
    )
    name = F.concat_ws("_", F.substring("repo_id", 1, 1), "status_mark")
    return grouped.select(name.alias("name"), F.to_json(document, {"pretty": "true"}).alias("value"))


_BROKEN = ",".join(f"stages.{n}.{f}" for n in sorted(SNAPSHOT_PARTS["stages"]) for f in ("source_hash", "source_lines"))


@query(
    f"""
    WITH {_CHECKS_SQL}, g AS (
      SELECT left(repo_id, 1) AS p, left(repo_id, 1) || '_' || status_mark AS name, count(*) AS n,
             min(CAST(modified_graph_changed AS INTEGER)) + min(CAST(modified_emitted_stale_deletes AS INTEGER))
             + min(CAST(unchanged_files_were_not_rewritten AS INTEGER)) + min(CAST(neo4j_dlq_is_empty AS INTEGER)) AS held
      FROM checks JOIN files USING (file_id) GROUP BY 1, 2)
    SELECT name, CASE p WHEN '1' THEN 'missing replay_file' WHEN '2' THEN '{_BROKEN}' WHEN '4' THEN 'neo4j_dlq_end_offset'
                        WHEN '5' THEN 'assertions: too few,schema_version' ELSE '' END AS broken,
           CASE p WHEN '5' THEN 20 ELSE 21 END AS checks, 4 - held AS failed, held = 4 AND p <> '5' AS accepted
    FROM g
    """
)
def snapshot_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots written as documents, read back, held against their contract and gated."""
    path = scratch(spark, "documents")
    snapshot_documents(spark, sf_dir).write.partitionBy("name").text(path)
    documents = read_snapshots(spark, path)
    broken = documents.select("name", F.array_join(snapshot_violations(F.col("snapshot")), ",").alias("broken"))
    gated = evidence_gate(gate_input(documents)).select("name", "checks", "failed", "accepted")
    return broken.join(gated, "name")
