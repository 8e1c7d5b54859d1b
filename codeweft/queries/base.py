"""Query registry and helpers for the checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codeweft.session import tune

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, or under ``name``."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        REGISTRY[name or fn.__name__] = run
        if sql is not None:
            SQL[name or fn.__name__] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sql_hash(*parts: str) -> str:
    """SQL text of the stable hash of some SQL expressions."""
    cast = [f"coalesce(cast({p} AS VARCHAR), '')" for p in parts]
    return f"sha256({' || chr(31) || '.join(cast)})"


def sql_json(**fields: str) -> str:
    """SQL text of a JSON object with its keys in name order."""
    inner = ", ".join(f"'{k}': {fields[k]}" for k in sorted(fields))
    return f"CAST(to_json({{{inner}}}) AS VARCHAR)"
