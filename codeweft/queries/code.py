"""Code graphs of sources that the part table gives, and reaching definitions
over conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeweft.functions.sql import register
from codeweft.operators import calls as call_ops
from codeweft.operators import graph as gr
from codeweft.operators.cfg import cfg_edges as control_edges
from codeweft.operators.cfg import flow_paths
from codeweft.operators.counts import graph_totals
from codeweft.operators.dfg import data_flow
from codeweft.operators.discovery import discovery_report as report
from codeweft.operators.discovery import split_files
from codeweft.operators.extract import failures
from codeweft.operators.metadata import documents, file_facts
from codeweft.operators.ordered import WIDTH
from codeweft.operators.reach import reaching
from codeweft.operators.warn import warnings as found_warnings
from codeweft.plans import reconcile as rec
from codeweft.plans.analyze import analyze, parse
from codeweft.plans.follow import follow
from codeweft.queries.base import load, query, sql_hash
from codeweft.queries.templates import CALLS, DATA, FLOW, NODES, TEMPLATES
from codeweft.schemas import METADATA
from codeweft.session import in_place, scratch, stage
from codeweft.sinks.buckets import BucketedTable
from codeweft.sinks.eventlog import EventLog
from codeweft.sinks.graph import GraphTables
from codeweft.sinks.tables import VersionedTables
from codeweft.sources.files import as_files, scan_tree, spread, write_tree
from codeweft.streaming.jobs import Verdicts

RUN_TIME, RUN_ID = "2024-06-01T00:00:00Z", "run-1"


def part_files(spark: SparkSession, sf_dir: str, step: Column | None = None) -> DataFrame:
    """One generated source file per part; the size picks the template."""
    key = F.lpad(F.col("p_partkey").cast("string"), 12, "0")
    number = (F.col("p_size") + 1_000_000).cast("string")
    size = F.col("p_size") if step is None else F.col("p_size") + step
    template = F.get(F.array(*[F.lit(t) for t in TEMPLATES]), size % len(TEMPLATES))
    text = F.replace(F.replace(template, F.lit("{K}"), key), F.lit("{N}"), number)
    made = load(spark, sf_dir, "part").select(
        "p_brand", F.concat(F.lit("parts/"), key, F.lit(".py")).alias("path"), text.cast("binary").alias("content")
    )
    return as_files(made, F.col("p_brand"))


def _values(rows: list[tuple]) -> str:
    def literal(v) -> str:
        return str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def _text(template: str) -> str:
    return " || chr(10) || ".join("'" + line + "'" for line in template.split("\n"))


_TEMPLATE = "CASE p_size % 5 " + " ".join(f"WHEN {i} THEN {_text(t)}" for i, t in enumerate(TEMPLATES)) + " END"


def _fill(expression: str) -> str:
    return f"replace(replace({expression}, '{{K}}', key), '{{N}}', num)"


_CODE = f"""
    parts AS (SELECT p_brand AS repo_id, lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS key, CAST(1000000 + p_size AS VARCHAR) AS num,
                     p_size % 5 AS t, p_size, {_TEMPLATE} AS template FROM part),
    files AS (SELECT *, 'parts/' || key || '.py' AS path, {_fill("template")} AS text,
                     {sql_hash("repo_id", "'parts/' || key || '.py'")} AS file_id FROM parts),
    vn(t, path, ast_type, line, "column", end_line, end_column, name, value) AS (VALUES {_values(NODES)}),
    vf(t, source, target, discriminator) AS (VALUES {_values(FLOW)}),
    vd(t, source, target, variable, resolved) AS (VALUES {_values(DATA)}),
    vc(t, source, target, callee, resolved) AS (VALUES {_values(CALLS)}),
    vs AS (SELECT t, path FROM vn WHERE ast_type IN ('Module', 'FunctionDef')),
    tn AS (SELECT t, 'AST' AS kind, path, ast_type, line, "column", end_line, end_column, name, value FROM vn
           UNION ALL SELECT t, 'SYNTHETIC', path || '.__entry__', 'ScopeEntry', 0, 0, 0, 0, 'ENTRY', '' FROM vs
           UNION ALL SELECT t, 'SYNTHETIC', path || '.__exit__', 'ScopeExit', 0, 0, 0, 0, 'EXIT', '' FROM vs
           UNION SELECT t, 'EXTERNAL', source, 'ExternalSymbol', 0, 0, 0, 0, variable, '' FROM vd WHERE NOT resolved
           UNION SELECT t, 'EXTERNAL', '$.__external__.' || target, 'ExternalSymbol', 0, 0, 0, 0, callee, '' FROM vc WHERE NOT resolved),
    ta AS (SELECT t, 'AST' AS kind, regexp_replace(path, '\\.[^.]*$', '') AS source, path AS target,
                  regexp_extract(path, '[^.]*$') AS discriminator, '' AS variable, TRUE AS resolved FROM vn WHERE path <> '$'
           UNION ALL SELECT t, 'CFG', source, target, discriminator, '', TRUE FROM vf
           UNION ALL SELECT t, 'DFG', source, target, variable, variable, resolved FROM vd
           UNION ALL SELECT t, 'CALL', source, CASE WHEN resolved THEN target ELSE '$.__external__.' || target END, callee, '', resolved FROM vc),
    te AS (SELECT ta.*, s.ast_type AS source_type, d.ast_type AS target_type FROM ta
           JOIN tn s ON s.t = ta.t AND s.path = ta.source JOIN tn d ON d.t = ta.t AND d.path = ta.target),
    nodes AS (SELECT {sql_hash("file_id", _fill("n.path"), "ast_type")} AS id, kind, ast_type, file_id, {_fill("n.path")} AS structural_path,
                     line, "column", end_line, end_column, {_fill("name")} AS name, {_fill("value")} AS value
              FROM files f JOIN tn n USING (t)),
    ends AS (SELECT e.*, f.file_id, f.key, f.num, {sql_hash("file_id", _fill("source"), "source_type")} AS source_id,
                    {sql_hash("file_id", _fill("target"), "target_type")} AS target_id FROM files f JOIN te e USING (t)),
    edges AS (SELECT {sql_hash("kind", "source_id", "target_id", _fill("discriminator"))} AS id, kind, source_id, target_id, file_id,
                     {_fill("discriminator")} AS discriminator, {_fill("variable")} AS variable, resolved FROM ends)
"""
_NODE_ROWS = 'SELECT id, kind, ast_type, file_id, structural_path, line, "column", end_line, end_column, name, value FROM nodes'
_EDGE_ROWS = "SELECT id, kind, source_id, target_id, file_id, discriminator, variable, resolved FROM edges"


def _syntax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(part_files(spark, sf_dir))


@query(f"WITH {_CODE} SELECT 'parts' AS repo_id, path, sha256(text) AS content_hash, strlen(text) AS size_bytes FROM files")
def scan_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written to a tree, one per part, and scanned back."""
    root = scratch(spark, "tree").removeprefix("file:")
    write_tree(part_files(spark, sf_dir), root)
    facts = file_facts(scan_tree(spark, root, "parts"))
    return facts.select("repo_id", "path", "content_hash", F.col("size_bytes").cast("bigint").alias("size_bytes"))


@query(f"WITH {_CODE} {_NODE_ROWS} WHERE kind = 'AST'", name="ast_nodes")
def syntax_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every syntax node of every part file."""
    return gr.ast_nodes(_syntax(spark, sf_dir))


@query(f"WITH {_CODE} {_NODE_ROWS} WHERE kind = 'AST'", name="file_nodes")
def nodes_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The syntax nodes again, by the table function in a lateral join."""
    register(spark)
    spread(part_files(spark, sf_dir)).createOrReplaceTempView("files")
    return spark.sql(
        """
        SELECT node_id(f.file_id, n.path, n.ast_type) AS id, 'AST' AS kind, n.ast_type, f.file_id, n.path AS structural_path,
               n.line, n.column, n.end_line, n.end_column, substring(n.label, 1, 200) AS name, n.value
        FROM files f, LATERAL file_nodes(f.content, f.path) n WHERE n.exception_type IS NULL
        """
    )


@query(f"WITH {_CODE} {_EDGE_ROWS} WHERE kind = 'AST'", name="ast_edges")
def syntax_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent-to-child edges."""
    return gr.ast_edges(_syntax(spark, sf_dir))


@query(f"WITH {_CODE} SELECT file_id, structural_path AS path, ast_type FROM nodes WHERE ast_type IN ('Module', 'FunctionDef')", name="scopes")
def file_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scopes of every file."""
    return gr.scopes(_syntax(spark, sf_dir)).select("file_id", "path", "ast_type")


@query(f"WITH {_CODE} {_NODE_ROWS} WHERE kind = 'SYNTHETIC'", name="scope_bounds")
def entry_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry and exit nodes of every scope."""
    return gr.scope_bounds(_syntax(spark, sf_dir))


@query(f"WITH {_CODE} {_EDGE_ROWS} WHERE kind = 'CFG'")
def cfg_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control-flow edges."""
    raw = _syntax(spark, sf_dir)
    with in_place(spark):
        return control_edges(stage(flow_paths(raw), "flow", "file_id"))


@query(f"WITH {_CODE} {_EDGE_ROWS} WHERE kind = 'DFG'")
def dfg_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-flow edges."""
    raw = _syntax(spark, sf_dir)
    with in_place(spark):
        return data_flow(raw, stage(flow_paths(raw), "flow", "file_id")).edges


@query(f"WITH {_CODE} {_EDGE_ROWS} WHERE kind = 'CALL'", name="call_edges")
def resolved_call_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call edges, resolved and not."""
    return call_ops.call_edges(call_ops.resolved_calls(_syntax(spark, sf_dir)))


@query(f"WITH {_CODE} {_NODE_ROWS} WHERE kind = 'EXTERNAL'", name="external_nodes")
def unresolved_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A node for every name that nothing in the file defines."""
    raw = _syntax(spark, sf_dir)
    calls = call_ops.missing_callees(call_ops.resolved_calls(raw))
    with in_place(spark):
        missing = data_flow(raw, stage(flow_paths(raw), "flow", "file_id")).missing
    return gr.external_nodes(missing.unionByName(calls))


@query(f"WITH {_CODE} {_NODE_ROWS}")
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the whole analysis."""
    return analyze(part_files(spark, sf_dir)).nodes


@query(f"WITH {_CODE} {_EDGE_ROWS}")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All edges of the whole analysis."""
    return analyze(part_files(spark, sf_dir)).edges


@query(
    f"""
    WITH {_CODE} SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges,
      (SELECT count(DISTINCT id) FROM nodes) AS unique_nodes, (SELECT count(DISTINCT id) FROM edges) AS unique_edges,
      (SELECT count(*) FROM nodes WHERE file_id = (SELECT min(file_id) FROM files WHERE t <> 4)) AS file_nodes,
      (SELECT count(*) FROM edges WHERE file_id = (SELECT min(file_id) FROM files WHERE t <> 4)) AS file_edges
    """
)
def graph_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, distinct ids and one file's counts of the whole analysis; the file is the
    one with the smallest id."""
    graph = analyze(part_files(spark, sf_dir))
    (first,) = graph.nodes.agg(F.min("file_id")).first()
    return graph_totals(graph.nodes, graph.edges, F.lit(first))


@query(
    f"""
    WITH {_CODE} SELECT file_id, t = 0 OR t = 1 AS has_branch, t = 1 OR t = 3 AS has_loop, t = 2 OR t = 3 AS has_call
    FROM files
    """,
    name="feature_flags",
)
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each file branches, loops or calls."""
    return gr.feature_flags(_syntax(spark, sf_dir), "file_id")


@query(f"WITH {_CODE} SELECT file_id, 'exception flow is conservative at line 2' AS text FROM files WHERE t = 2", name="warnings")
def analysis_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings of every file."""
    return found_warnings(_syntax(spark, sf_dir)).select("file_id", "text")


@query(
    f"""
    WITH {_CODE} SELECT {sql_hash("file_id", "sha256(text)", "'SyntaxError'", "1", "20")} AS id, file_id, 'parse' AS stage,
      'SyntaxError' AS exception_type, 'invalid syntax (' || key || '.py, line 1)' AS message, 1 AS line, 20 AS "column", TRUE AS recoverable
    FROM files WHERE t = 4
    """
)
def parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One error row for every file that does not parse."""
    files = part_files(spark, sf_dir)
    facts = file_facts(files).select("file_id", "content_hash")
    return rec.error_rows(failures(parse(files)), facts).select(
        "id", "file_id", "stage", "exception_type", "message", "line", "column", "recoverable"
    )


@query(
    f"""
    WITH {_CODE}, lines AS (SELECT *, length(text) - length(replace(text, chr(10), '')) AS n FROM files)
    SELECT repo_id, count(*) AS raw_python_files, count(*) AS processed_python_files, 0 AS excluded_python_files, sum(n) AS total_lines,
           count(*) FILTER (t <> 4) AS parseable_files, bool_or(t IN (0, 1)) AS has_branch, bool_or(t IN (1, 3)) AS has_loop,
           bool_or(t IN (2, 3)) AS has_call, round(count(*) FILTER (t <> 4) / count(*), 4) AS parse_success_rate
    FROM lines GROUP BY 1
    """,
    name="discovery_report",
)
def discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The discovery report of every brand's files."""
    files = stage(part_files(spark, sf_dir), "files")
    return report(files, parse(split_files(files)[0], lossy=True))


def _map_text(column: str) -> Column:
    entries = F.transform(
        F.array_sort(F.map_entries(column)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    return F.array_join(entries, ",")


_COUNTS = """SELECT file_id, string_agg(kind || '=' || n, ',' ORDER BY kind) AS counts
             FROM (SELECT file_id, kind, count(*) AS n FROM {} GROUP BY ALL) GROUP BY 1"""


@query(
    f"""
    WITH {_CODE}, nc AS ({_COUNTS.format("nodes")}), ec AS ({_COUNTS.format("edges")})
    SELECT file_id AS _id, repo_id, path, sha256(text) AS content_hash, strlen(text) AS size_bytes,
           length(text) - length(replace(text, chr(10), '')) AS line_count, CASE WHEN t = 4 THEN 'error' ELSE 'ok' END AS parse_status,
           coalesce(nc.counts, '') AS node_counts, coalesce(ec.counts, '') AS edge_counts,
           CASE WHEN t = 2 THEN 'exception flow is conservative at line 2' ELSE '' END AS warnings,
           CASE WHEN t = 4 THEN 'invalid syntax (' || key || '.py, line 1)' ELSE '' END AS error_message,
           '{RUN_TIME}' AS processed_at, '{RUN_ID}' AS run_id, '1.0' AS schema_version
    FROM files LEFT JOIN nc USING (file_id) LEFT JOIN ec USING (file_id)
    """
)
def source_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole metadata document of every file."""
    files = part_files(spark, sf_dir)
    graph = analyze(files)
    docs = documents(
        file_facts(files), graph.nodes, graph.edges, graph.warnings, graph.errors, F.lit(RUN_TIME), F.lit(RUN_ID)
    )
    return docs.select(
        "_id", "repo_id", "path", "content_hash", F.col("size_bytes").cast("bigint").alias("size_bytes"),
        F.col("line_count").cast("bigint").alias("line_count"), "parse_status", _map_text("node_counts").alias("node_counts"),
        _map_text("edge_counts").alias("edge_counts"), F.array_join("warnings", ";").alias("warnings"), "error_message",
        "processed_at", "run_id", "schema_version",
    )


@query(
    f"""
    WITH {_CODE}, o AS (SELECT file_id, path, p_size, t AS t0, CASE WHEN p_size > 25 THEN (p_size + 1) % 5 ELSE t END AS t1,
                               key, num FROM files),
      el AS (SELECT t, 'node' AS what, path || '|' || ast_type AS e FROM tn
             UNION ALL SELECT t, 'edge', kind || '|' || source || '|' || source_type || '|' || target || '|' || target_type || '|' || discriminator FROM te),
      pairs AS (SELECT DISTINCT t0, t1 FROM o),
      c AS (SELECT t, count(*) FILTER (what = 'node') AS nodes, count(*) FILTER (what = 'edge') AS edges FROM el GROUP BY 1),
      d AS (SELECT t0, t1, count(*) FILTER (what = 'node') AS deleted_nodes, count(*) FILTER (what = 'edge') AS deleted_edges
            FROM pairs JOIN el ON el.t = t0 WHERE NOT EXISTS (SELECT 1 FROM el x WHERE x.t = t1 AND x.what = el.what AND x.e = el.e) GROUP BY 1, 2)
    SELECT path, CASE WHEN t0 = t1 THEN 'skipped' WHEN t1 = 4 THEN 'error' ELSE 'processed' END AS status,
           CASE WHEN t0 = t1 OR t1 = 4 THEN 0 ELSE c.nodes END AS nodes, CASE WHEN t0 = t1 OR t1 = 4 THEN 0 ELSE c.edges END AS edges,
           CASE WHEN t0 = t1 THEN 0 ELSE coalesce(d.deleted_nodes, 0) END AS deleted_nodes,
           CASE WHEN t0 = t1 THEN 0 ELSE coalesce(d.deleted_edges, 0) END AS deleted_edges,
           CASE WHEN t0 <> t1 AND t1 = 2 THEN 1 ELSE 0 END AS warnings,
           CASE WHEN t0 <> t1 AND t1 = 4 THEN 'invalid syntax (' || key || '.py, line 1)' ELSE '' END AS error
    FROM o LEFT JOIN c ON c.t = t1 LEFT JOIN d USING (t0, t1)
    """
)
def incremental_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the files of all parts: the large parts changed between."""
    root = scratch(spark, "incremental")
    state = VersionedTables(spark, f"{root}/state", rec.STATE_LAYOUT)
    log = EventLog(spark, f"{root}/log")
    step = F.when(F.col("p_size") > 25, 1).otherwise(0)
    rec.run_batch(spark, part_files(spark, sf_dir), state, log, "first", RUN_TIME, RUN_ID)
    results = rec.run_batch(spark, part_files(spark, sf_dir, step), state, log, "second", RUN_TIME, "run-2")
    return results.drop("file_id", "content_hash")


# The code of the second version: large parts move on by one template.
_CODE_TWO = _CODE.replace("p_size % 5", "(p_size + CASE WHEN p_size > 25 THEN 1 ELSE 0 END) % 5")


@query(
    f"""
    WITH {_CODE_TWO} SELECT 'node' AS part, id, kind FROM nodes UNION ALL SELECT 'edge', id, kind FROM edges
    UNION ALL SELECT 'document', file_id, CASE WHEN t = 4 THEN 'error' ELSE 'ok' END FROM files
    """
)
def log_to_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: files of two versions through runs and the log to graph tables
    and documents; then the whole log is applied once more, which changes nothing. What
    is left is the graph of version two."""
    root = scratch(spark, "chain")
    state, log = VersionedTables(spark, f"{root}/state", rec.STATE_LAYOUT), EventLog(spark, f"{root}/log")
    graph = GraphTables(spark, f"{root}/graph", buckets=16)
    documents, verdicts = BucketedTable(spark, f"{root}/documents", METADATA, "_id", 16), Verdicts(spark, f"{root}/verdicts")
    step = F.when(F.col("p_size") > 25, 1).otherwise(0)
    at = -1
    for name, files in (("first", part_files(spark, sf_dir)), ("second", part_files(spark, sf_dir, step))):
        rec.run_batch(spark, files, state, log, name, RUN_TIME, name)
        at = follow(log, graph, documents, verdicts, at)
    follow(log, graph, documents, verdicts)
    rows = graph.nodes().select(F.lit("node").alias("part"), "id", "kind")
    rows = rows.unionByName(graph.edges().select(F.lit("edge").alias("part"), "id", "kind"))
    return rows.unionByName(documents.read().select(F.lit("document").alias("part"), F.col("_id").alias("id"), F.col("parse_status").alias("kind")))


@query(
    """
    WITH e AS (SELECT conv_id, turn, role, CASE role WHEN 'assistant' THEN 'user' ELSE 'assistant' END AS variable FROM conversations)
    SELECT conv_id, turn, variable, coalesce(
        (SELECT max(d.turn) FROM conversations d WHERE d.conv_id = e.conv_id AND d.role = e.variable AND d.turn < e.turn),
        (SELECT max(d.turn) FROM conversations d WHERE d.conv_id = e.conv_id AND d.role = e.variable)) AS definition
    FROM e
    """
)
def reaching_defs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reaching definitions over conversations that loop.

    A turn defines its role and uses the other one; after the last turn the
    conversation starts over.
    """
    turns = load(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("order"), "role", F.lit(0).alias("block"))
    other = F.when(F.col("role") == "assistant", "user").otherwise("assistant")
    keys = ["conv_id", "block", "order"]
    events = turns.select(
        *keys, F.col("role").alias("variable"), F.col("order").cast("string").alias("site"), F.lit(False).alias("is_use")
    ).unionByName(
        turns.select(*keys, other.alias("variable"), F.lit(None).cast("string").alias("site"), F.lit(True).alias("is_use"))
    )
    edges = turns.select("conv_id", "block", F.col("block").alias("next")).distinct()
    found = reaching(spark, events, edges, ["conv_id"], width=WIDTH)
    return found.select("conv_id", F.col("order").alias("turn"), "variable", F.col("site").cast("bigint").alias("definition"))
