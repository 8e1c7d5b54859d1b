"""Source files to graph tables, all files in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from codeweft.operators import calls as call_ops
from codeweft.operators.cfg import cfg_edges, flow_paths
from codeweft.operators.dfg import data_flow
from codeweft.operators.extract import extract, failures
from codeweft.operators.graph import ast_edges, ast_nodes, external_nodes, scope_bounds, union_all
from codeweft.operators.warn import warnings
from codeweft.session import in_place, plan_buckets, stage


@dataclass(frozen=True)
class CodeGraph:
    """Tables of one analysis run; ``raw`` is stored, the rest reads from it."""

    raw: DataFrame
    nodes: DataFrame
    edges: DataFrame
    warnings: DataFrame
    errors: DataFrame


def parse(files: DataFrame, lossy: bool = False, buckets: int | None = None) -> DataFrame:
    """Run the parser once and store its rows for the graph passes.

    The sources are shuffled by file, not the many more rows they give: those
    come out in place, and the passes over them need no shuffle of their own.
    ``buckets`` is what :func:`plan_buckets` gave for them, if it was asked before.
    """
    sources = files.select("file_id", "path", "content")
    placed = sources.repartition(buckets or plan_buckets(sources), "file_id")
    return stage(extract(placed, lossy), "syntax", "file_id", laid_out=True)


def analyze(files: DataFrame, buckets: int | None = None) -> CodeGraph:
    """Nodes, edges, warnings and parse errors of ``files(file_id, path, content)``."""
    raw = parse(files, buckets=buckets)
    with in_place(files.sparkSession):
        flow = stage(flow_paths(raw), "flow", "file_id")
        data = data_flow(raw, flow)
        calls = stage(call_ops.resolved_calls(raw), "calls", "file_id")
    missing = data.missing.unionByName(call_ops.missing_callees(calls))
    nodes = union_all(ast_nodes(raw), scope_bounds(raw), external_nodes(missing))
    edges = union_all(ast_edges(raw), cfg_edges(flow), data.edges, call_ops.call_edges(calls))
    return CodeGraph(raw, nodes, edges, warnings(raw), failures(raw))
