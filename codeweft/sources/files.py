"""Source trees on a mounted or remote file system.

Spark's own file sources leave out names that start with ``_`` or ``.``, and
with them every ``__init__.py``. Folders are therefore listed, and files read,
by tasks; a tree that is already a table needs none of this.
"""

from __future__ import annotations

import os
import posixpath
import sys
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeweft.functions.ids import file_id
from codeweft.functions.text import relative_path
from codeweft.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FLUSH_BYTES = 32 << 20
_FILES_PER_TASK = 2000


def _batch(ddl: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in ddl)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, ddl.values(), strict=True)], names=list(ddl)
    )


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    layout = {"path": pa.string(), "is_dir": pa.bool_()}
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            system, inside = pafs.FileSystem.from_uri(folder)
            prefix = folder[: len(folder) - len(inside)] if folder.endswith(inside) else ""
            rows = []
            for info in system.get_file_info(pafs.FileSelector(inside)):
                is_dir = info.type == pafs.FileType.Directory
                linked = isinstance(system, pafs.LocalFileSystem) and os.path.islink(info.path)
                if is_dir and not linked or info.type == pafs.FileType.File:
                    rows.append((prefix + info.path, is_dir))
            yield _batch(layout, rows)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    layout = {"full_path": pa.string(), "content": pa.binary()}
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, inside = pafs.FileSystem.from_uri(path)
            with system.open_input_stream(inside) as handle:
                held.append((path, handle.read()))
            size += len(held[-1][1])
            if size >= _FLUSH_BYTES:
                yield _batch(layout, held)
                held, size = [], 0
    yield _batch(layout, held)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    layout = {"path": pa.string()}
    for batch in batches:
        done = []
        for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            system, inside = pafs.FileSystem.from_uri(path)
            system.create_dir(posixpath.dirname(inside), recursive=True)
            with system.open_output_stream(inside) as handle:
                handle.write(content)
            done.append((path,))
        yield _batch(layout, done)


def list_files(spark: SparkSession, root: str, suffix: str = ".py") -> DataFrame:
    """``full_path`` of every file below ``root`` with the suffix.

    One round per folder level; each folder is listed by some task.
    """
    rounds = []
    frontier = spark.createDataFrame([(root.rstrip("/"),)], "path string")
    while True:
        listed = stage(frontier.mapInArrow(_list, "path string, is_dir boolean"), "listing")
        rounds.append(listed.where(~F.col("is_dir")))
        folders = listed.where("is_dir").select("path")
        if folders.isEmpty():
            break
        frontier = folders.repartition("path")
    found = reduce(DataFrame.unionByName, rounds)
    return found.where(F.col("path").endswith(suffix)).select(F.col("path").alias("full_path"))


def scan_tree(spark: SparkSession, root: str, repo_id: str) -> DataFrame:
    """``(repo_id, path, file_id, content)`` of every ``*.py`` file below ``root``."""
    paths = list_files(spark, root)
    # A path is short and its file may be long: go by the number of files, so
    # that one big folder is read by many tasks.
    tasks = max(spark.sparkContext.defaultParallelism, paths.count() // _FILES_PER_TASK + 1)
    read = paths.repartition(tasks, "full_path").mapInArrow(_read, "full_path string, content binary")
    return as_files(read.withColumn("path", relative_path(F.col("full_path"), root)), F.lit(repo_id))


def as_files(df: DataFrame, repo_id) -> DataFrame:
    """Bring a table with ``path`` and ``content`` into the source-file layout."""
    return df.select(
        repo_id.alias("repo_id"),
        "path",
        file_id(repo_id, "path").alias("file_id"),
        F.col("content").cast("binary").alias("content"),
    )


def spread(files: DataFrame) -> DataFrame:
    """Give a table that lies in few partitions one task per core.

    Parsing costs far more than reading, so a small table with one split must
    not be parsed by one task. A table with enough splits is left as it is:
    its content then never moves.
    """
    cores = files.sparkSession.sparkContext.defaultParallelism
    if files.rdd.getNumPartitions() >= cores:
        return files
    return files.repartition(cores, "file_id")


def write_tree(files: DataFrame, root: str) -> int:
    """Write one file per row below ``root``; returns how many.

    Writing a file again gives the same file, so a lost task may be repeated.
    """
    target = files.select(
        F.concat(F.lit(root.rstrip("/") + "/"), "path").alias("path"), F.col("content").cast("binary")
    )
    return target.mapInArrow(_write, "path string").count()


def single_file(files: DataFrame, path: str) -> DataFrame:
    """The one file at ``path``. Exclusion rules do not apply to it.

    Raises ``ValueError`` for a path outside the tree, or without a Python file.
    """
    plain = posixpath.normpath(path.replace("\\", "/"))
    if plain.startswith(("../", "/")) or plain == "..":
        raise ValueError("the file must lie inside the repository")
    found = files.where(F.col("path") == plain)
    if not plain.endswith(".py") or found.isEmpty():
        raise ValueError(f"no such Python file: {path}")
    return found
