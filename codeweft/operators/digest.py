"""Digests of whole tables.

Every row is hashed and the hashes are added up in four parts, so the digest
does not depend on row order, combines on the map side and never gathers a
group in one place. It changes when a row is added, lost, doubled or altered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeweft.functions.jsonx import json_hash

_PARTS = 4
_HEX = 15  # 60 bits, the most that a signed 64-bit integer holds in full digits


def row_parts(row_hash: Column) -> list[Column]:
    return [
        F.conv(F.substring(row_hash, 1 + i * _HEX, _HEX), 16, 10).cast("decimal(20,0)").cast("decimal(38,0)")
        for i in range(_PARTS)
    ]


def table_digest(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """``keys``, the row count and the digest of the named columns."""
    hashed = json_hash({c: F.col(c) for c in columns})
    summed = df.select(*(keys or []), hashed.alias("_h")).select(
        *(keys or []), *[p.alias(f"_p{i}") for i, p in enumerate(row_parts(F.col("_h")))]
    )
    totals = summed.groupBy(*(keys or [])).agg(
        F.count("*").alias("row_count"),
        *[F.coalesce(F.sum(f"_p{i}"), F.lit(0).cast("decimal(38,0)")).alias(f"_s{i}") for i in range(_PARTS)],
    )
    text = F.concat_ws(":", F.col("row_count").cast("string"), *[F.col(f"_s{i}").cast("string") for i in range(_PARTS)])
    return totals.select(*(keys or []), "row_count", F.sha2(text, 256).alias("digest"))
