"""Syntax graph rows, scopes and scope boundaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeweft.functions.ids import edge_id, node_id
from codeweft.operators.extract import ENTRY, EXIT, LOOP_TYPES, SCOPE_TYPES, syntax
from codeweft.schemas import EDGE, NODE

def node_rows(df: DataFrame, kind: str, ast_type: Column, path: Column, **given: Column) -> DataFrame:
    """Rows in the node layout; what is not given is ``""`` or 0."""
    column = {
        "id": node_id("file_id", path, ast_type),
        "kind": F.lit(kind),
        "ast_type": ast_type,
        "file_id": F.col("file_id"),
        "structural_path": path,
        **given,
    }
    blank = {"string": F.lit(""), "int": F.lit(0)}
    return df.select(
        *[
            column.get(f.name, blank[f.dataType.simpleString()]).cast(f.dataType).alias(f.name)
            for f in NODE.fields
        ]
    )


def edge_rows(
    df: DataFrame,
    kind: str,
    source: Column,
    target: Column,
    discriminator: Column,
    variable: Column | None = None,
    resolved: Column | None = None,
) -> DataFrame:
    """Rows in the edge layout."""
    column = {
        "id": edge_id(F.lit(kind), source, target, discriminator),
        "kind": F.lit(kind),
        "source_id": source,
        "target_id": target,
        "file_id": F.col("file_id"),
        "discriminator": discriminator,
        "variable": F.lit("") if variable is None else variable,
        "resolved": F.lit(True) if resolved is None else resolved,
    }
    return df.select(*[column[f.name].alias(f.name) for f in EDGE.fields])


def ast_nodes(raw: DataFrame) -> DataFrame:
    return node_rows(
        syntax(raw),
        "AST",
        F.col("ast_type"),
        F.col("path"),
        line=F.col("line"),
        column=F.col("column"),
        end_line=F.col("end_line"),
        end_column=F.col("end_column"),
        name=F.substring("label", 1, 200),
        value=F.col("value"),
    )


def ast_edges(raw: DataFrame) -> DataFrame:
    """Parent to child. The parent's id follows from the child's own row."""
    child = syntax(raw).where(F.col("parent_path") != "")
    step = F.when(F.col("position") < 0, F.col("field")).otherwise(
        F.concat("field", F.lit("["), F.col("position").cast("string"), F.lit("]"))
    )
    return edge_rows(
        child,
        "AST",
        node_id("file_id", "parent_path", "parent_type"),
        node_id("file_id", "path", "ast_type"),
        step,
    )


def scopes(raw: DataFrame) -> DataFrame:
    return syntax(raw).where(F.col("ast_type").isin(*SCOPE_TYPES))


def entry_id(scope_path: Column) -> Column:
    return node_id("file_id", F.concat(scope_path, F.lit(ENTRY)), F.lit("ScopeEntry"))


def exit_id(scope_path: Column) -> Column:
    return node_id("file_id", F.concat(scope_path, F.lit(EXIT)), F.lit("ScopeExit"))


def scope_bounds(raw: DataFrame) -> DataFrame:
    """The entry and exit node of every scope."""
    bounds = F.array(
        F.struct(F.lit(ENTRY).alias("suffix"), F.lit("ScopeEntry").alias("type"), F.lit("ENTRY").alias("name")),
        F.struct(F.lit(EXIT).alias("suffix"), F.lit("ScopeExit").alias("type"), F.lit("EXIT").alias("name")),
    )
    both = scopes(raw).select("file_id", "path", F.explode(bounds).alias("b"))
    return node_rows(
        both, "SYNTHETIC", F.col("b.type"), F.concat("path", "b.suffix"), name=F.col("b.name")
    )


def external_nodes(missing: DataFrame) -> DataFrame:
    """Nodes for unresolved names: ``missing(file_id, scope_path, role, name)``."""
    path = F.concat("scope_path", F.lit(".__external__."), "role", F.lit(":"), "name")
    wanted = missing.select("file_id", "scope_path", "role", "name").distinct()
    return node_rows(wanted, "EXTERNAL", F.lit("ExternalSymbol"), path, name=F.col("name"))


def external_id(scope_path: Column, role: str, name: Column) -> Column:
    path = F.concat(scope_path, F.lit(f".__external__.{role}:"), name)
    return node_id("file_id", path, F.lit("ExternalSymbol"))


def feature_flags(raw: DataFrame, *keys: str) -> DataFrame:
    """Whether a branch, a loop and a call occur, per ``keys``."""
    kind = F.col("ast_type")

    def has(*types: str) -> Column:
        return F.coalesce(F.bool_or(kind.isin(*types)), F.lit(False))

    return raw.groupBy(*keys).agg(
        has("If", "Match").alias("has_branch"),
        has(*LOOP_TYPES).alias("has_loop"),
        has("Call").alias("has_call"),
    )


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
