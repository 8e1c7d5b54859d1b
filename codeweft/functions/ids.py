"""Stable ids: SHA-256 over parts joined with the unit separator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the separator is part of every id.
UNIT_SEPARATOR = "\x1f"


def _part(value: Column | str) -> Column:
    # concat_ws leaves nulls out, which would change the id.
    column = value if isinstance(value, Column) else F.col(value)
    return F.coalesce(column.cast("string"), F.lit(""))


def stable_hash(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws(UNIT_SEPARATOR, *[_part(p) for p in parts]), 256)


def packed(text: Column | str) -> Column:
    """Text as bytes, half as many where it is lower-case hexadecimal, as hashes are.
    Texts are equal if and only if these are; they have another order."""
    column = text if isinstance(text, Column) else F.col(text)
    raw = F.unhex(column)
    return F.when(F.lower(F.hex(raw)) == column, F.concat(F.lit(b"\x01"), raw)).when(
        column.isNotNull(), F.concat(F.lit(b"\x00"), column.cast("binary"))
    )


def unpacked(held: Column | str) -> Column:
    """The text of :func:`packed`."""
    column = held if isinstance(held, Column) else F.col(held)
    rest = F.substring(column, 2, 1 << 30)
    return F.when(F.substring(column, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def pack(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the named columns :func:`packed`, for rows that are about to move."""
    return df.select(*[packed(c).alias(c) if c in names else F.col(c) for c in df.columns])


def unpack(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[unpacked(c).alias(c) if c in names else F.col(c) for c in df.columns])


def file_id(repo_id: Column | str, path: Column | str) -> Column:
    return stable_hash(repo_id, path)


def node_id(file: Column | str, structural_path: Column | str, ast_type: Column | str) -> Column:
    return stable_hash(file, structural_path, ast_type)


def edge_id(
    kind: Column | str, source: Column | str, target: Column | str, discriminator: Column | str
) -> Column:
    return stable_hash(kind, source, target, discriminator)


def graph_event_id(
    element: Column | str, op: Column | str, element_id: Column | str, digest: Column | str
) -> Column:
    return stable_hash(element, op, element_id, digest)


def metadata_event_id(file: Column | str, digest: Column | str, status: Column | str) -> Column:
    return stable_hash(F.lit("metadata"), file, digest, status)


def error_id(
    file: Column | str,
    digest: Column | str,
    exception_type: Column | str,
    line: Column | str,
    column: Column | str,
) -> Column:
    return stable_hash(file, digest, exception_type, line, column)
