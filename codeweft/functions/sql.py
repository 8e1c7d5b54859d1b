"""What the library adds to SQL: a table function and the id functions.

After :func:`register`, files in any table give their syntax nodes in a query::

    SELECT f.file_id, n.path, node_id(f.file_id, n.path, n.ast_type) AS id
    FROM files f, LATERAL file_nodes(f.content, f.path) n
    WHERE n.exception_type IS NULL
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from codeweft.operators.extract import RAW_FIELDS, analyse

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns of ``file_nodes``: those of the extraction but the file's id.
NODE_COLUMNS = ", ".join(f"`{name}` {kind}" for name, kind in RAW_FIELDS if name != "file_id")

# Ids, from their parts in this order; an absent part counts as empty.
_IDS = {
    "file_id": ("repo_id", "path"),
    "node_id": ("file_id", "path", "ast_type"),
    "edge_id": ("kind", "source_id", "target_id", "discriminator"),
}


class FileNodes:
    """One row per syntax node of one file; of a file that does not parse, one row
    with ``exception_type``, ``message``, ``line`` and ``column``. A null content gives
    no rows. Each call sees one file, so the function needs no shuffle."""

    def eval(self, content: bytes | None, path: str | None = None) -> Iterator[tuple]:
        if content is not None:
            for row in analyse("", path or "", bytes(content), False):
                yield row[1:]


def register(spark: SparkSession) -> None:
    """Make ``file_nodes(content[, path])`` and the functions
    ``file_id``, ``node_id`` and ``edge_id`` known to this session's SQL."""
    spark.udtf.register("file_nodes", F.udtf(FileNodes, returnType=NODE_COLUMNS))
    for name, parts in _IDS.items():
        inputs = ", ".join(f"{p} STRING" for p in parts)
        joined = ", ".join(f"coalesce({name}.{p}, '')" for p in parts)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({inputs}) RETURNS STRING RETURN sha2(concat_ws(chr(31), {joined}), 256)"
        )
