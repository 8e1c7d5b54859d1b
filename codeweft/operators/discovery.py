"""Which files are analysed, and what a repository holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeweft.functions.text import decode_lossy, line_count
from codeweft.operators.graph import feature_flags

# Folder and file names that are left out.
EXCLUDED_FOLDERS = (
    ".git", ".venv", "venv", ".tox", "build", "dist", "site-packages", "__pycache__", "tests", "generated",
)
EXCLUDED_NAMES = ("setup.py",)
EXCLUDED_PREFIXES = ("test_",)
EXCLUDED_SUFFIXES = ("_test.py", "_pb2.py", "_pb2_grpc.py")


def should_exclude(path: Column) -> Column:
    parts = F.split(F.lower(path), "/")
    folders = F.slice(parts, 1, F.size(parts) - 1)
    name = F.element_at(parts, -1)
    hit = F.arrays_overlap(folders, F.array(*[F.lit(f) for f in EXCLUDED_FOLDERS]))
    hit |= name.isin(*EXCLUDED_NAMES)
    for prefix in EXCLUDED_PREFIXES:
        hit |= F.startswith(name, F.lit(prefix))
    for suffix in EXCLUDED_SUFFIXES:
        hit |= F.endswith(name, F.lit(suffix))
    return hit


def split_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Included and excluded files; each file is in exactly one of them."""
    excluded = should_exclude(F.col("path"))
    return files.where(~excluded), files.where(excluded)


def discovery_report(files: DataFrame, raw: DataFrame) -> DataFrame:
    """One row per repository: file counts, lines, parse rate and features.

    ``files(repo_id, path, file_id, content)`` are all files; ``raw`` holds the
    syntax rows of the included ones, read with bad bytes replaced. The file
    lists are rows of :func:`split_files`, as a repository may hold any number.
    """
    included = ~should_exclude(F.col("path"))
    sized = files.select(
        "repo_id",
        "file_id",
        included.alias("included"),
        F.when(included, line_count(decode_lossy(F.col("content")))).alias("lines"),
    )
    failed = F.coalesce(F.bool_or(F.col("exception_type").isNotNull()), F.lit(False))
    per_file = feature_flags(raw, "file_id").join(
        raw.groupBy("file_id").agg((~failed).alias("parsed")), "file_id"
    )
    flag = {c: F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("has_branch", "has_loop", "has_call")}
    counted = sized.join(per_file, "file_id", "left").groupBy("repo_id").agg(
        F.count("*").alias("raw_python_files"),
        F.count_if("included").alias("processed_python_files"),
        F.count_if(~F.col("included")).alias("excluded_python_files"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("total_lines"),
        F.count_if(F.col("included") & F.col("parsed")).alias("parseable_files"),
        *flag.values(),
    )
    kept = F.col("processed_python_files")
    rate = F.when(kept > 0, F.bround(F.col("parseable_files") / kept, 4)).otherwise(F.lit(0.0))
    return counted.withColumn("parse_success_rate", rate)
