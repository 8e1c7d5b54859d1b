"""Scans, exclusion rules and per-file documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeweft.functions.contracts import rule_failures
from codeweft.operators.discovery import discovery_report, should_exclude, split_files
from codeweft.operators.extract import extract, failures
from codeweft.operators.metadata import file_facts
from codeweft.plans.analyze import parse
from codeweft.plans.snapshots import document_counts
from codeweft.queries.base import load, query, sql_hash
from codeweft.queries.scalars import sql_line_count
from codeweft.session import stage
from codeweft.sources.files import as_files, single_file, spread

# Endings put onto page paths so that every exclusion rule has rows.
ENDINGS = (
    ".py", "/main.py", "/setup.py", "/test_a.py", "/a_test.py", "/x_pb2.py", "/x_pb2_grpc.py",
    "/tests/a.py", "/Build/a.py", "/generated/a.py", "/.git/a.py", "/latest/a.py", "/my_tests.py",
)


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as source files: repository, ``lang/doc_id.py``, text."""
    docs = load(spark, sf_dir, "documents").select(
        "source",
        F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".py")).alias("path"),
        F.col("text").cast("binary").alias("content"),
    )
    return as_files(docs, F.col("source"))


SQL_DOCUMENTS = (
    "SELECT source AS repo_id, lang || '/' || doc_id || '.py' AS path, text, "
    f"{sql_hash('source', chr(39).join(['lang || ', '/', ' || doc_id || ', '.py', '']))} AS file_id FROM documents"
)


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.rtrim(F.regexp_extract("url", r"^[a-z]+://[^/?#]+/?([^?#]*)", 1), F.lit("/"))
    endings = F.array(*[F.lit(e) for e in ENDINGS])
    ending = F.get(endings, (F.col("page_id") % len(ENDINGS)).cast("int"))
    return load(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("repo_id"), F.concat(base, ending).alias("path")
    )


_SQL_PAGES = f"""
    SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS repo_id,
           rtrim(regexp_extract(url, '^[a-z]+://[^/?#]+/?([^?#]*)', 1), '/')
             || [{", ".join(f"'{e}'" for e in ENDINGS)}][page_id % {len(ENDINGS)} + 1] AS path
    FROM pages
"""
_SQL_EXCLUDED = r"""
    regexp_matches(lower(path), '(^|/)(\.git|\.venv|venv|\.tox|build|dist|site-packages|__pycache__|tests|generated)/')
    OR regexp_matches(lower(path), '(^|/)(setup\.py|test_[^/]*)$')
    OR regexp_matches(lower(path), '(_test|_pb2|_pb2_grpc)\.py$')
"""


@query(f"WITH p AS ({_SQL_PAGES}) SELECT page_id, path, ({_SQL_EXCLUDED}) AS excluded FROM p")
def exclude_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exclusion rule on every path."""
    return page_paths(spark, sf_dir).select("page_id", "path", should_exclude(F.col("path")).alias("excluded"))


@query(
    f"""
    WITH p AS ({_SQL_PAGES}), e AS (SELECT *, ({_SQL_EXCLUDED}) AS excluded FROM p)
    SELECT path, page_id, CASE WHEN excluded THEN 'excluded' ELSE 'included' END AS part FROM e
    """
)
def partition_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Included and excluded paths, each sorted."""
    included, excluded = split_files(page_paths(spark, sf_dir).select("path", "page_id"))
    both = included.withColumn("part", F.lit("included")).unionByName(excluded.withColumn("part", F.lit("excluded")))
    return both.orderBy("part", "path", "page_id")


def _wanted(spark: SparkSession, sf_dir: str) -> str:
    """The path of the longest document, as the file that is asked for."""
    docs = load(spark, sf_dir, "documents")
    best = docs.agg(F.max_by(F.struct("lang", "doc_id"), F.struct("n_chars", "doc_id")).alias("d")).first().d
    return f"./{best.lang}/../{best.lang}/{best.doc_id}.py"


@query(
    f"""
    WITH f AS ({SQL_DOCUMENTS}),
         w AS (SELECT lang || '/' || doc_id || '.py' AS path FROM documents ORDER BY n_chars DESC, doc_id DESC LIMIT 1)
    SELECT repo_id, path, file_id, sha256(text) AS content_hash, strlen(text) AS size_bytes
    FROM f JOIN w USING (path)
    """
)
def scan_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file by its path, which need not be in plain form."""
    found = single_file(document_files(spark, sf_dir), _wanted(spark, sf_dir))
    return found.select(
        "repo_id", "path", "file_id", F.sha2("content", 256).alias("content_hash"),
        F.length("content").cast("bigint").alias("size_bytes"),
    )


@query(
    f"""
    WITH f AS ({SQL_DOCUMENTS})
    SELECT file_id AS _id, repo_id, path, sha256(text) AS content_hash, strlen(text) AS size_bytes,
           {sql_line_count("text")} AS line_count FROM f
    """
)
def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest, size and lines of every document."""
    facts = file_facts(document_files(spark, sf_dir))
    return facts.select(
        F.col("file_id").alias("_id"), "repo_id", "path", "content_hash",
        F.col("size_bytes").cast("bigint").alias("size_bytes"), "line_count",
    )


@query()
def document_parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the parser says about documents that are no Python code."""
    raw = extract(spread(document_files(spark, sf_dir)))
    return failures(raw).select("file_id", "exception_type", "message", "line", "column", "traceback")


@query()
def document_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The discovery report of every document source."""
    files = stage(document_files(spark, sf_dir), "files")
    included, _ = split_files(files)
    return discovery_report(files, parse(included, lossy=True))


@query("SELECT source AS repo_id, count(*) AS documents, count(DISTINCT doc_id) AS distinct_files FROM documents GROUP BY 1")
def doc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and distinct keys per source."""
    docs = load(spark, sf_dir, "documents").select(F.col("source").alias("repo_id"), F.col("doc_id").alias("_id"))
    return document_counts(docs)


def _rules(text: Column) -> dict[str, Column]:
    return {
        "ends with a full stop": F.endswith(F.rtrim(text), F.lit(".")),
        "has a blank line": F.contains(text, F.lit("\n\n")),
        "has a line break": F.contains(text, F.lit("\n")),
        "has no address": ~F.contains(text, F.lit("@")),
        "has no digits": ~text.rlike("[0-9]"),
        "has no link": ~F.contains(text, F.lit("http")),
    }


@query(
    """
    SELECT doc_id, concat_ws('; ',
        CASE WHEN NOT rtrim(text, ' ') LIKE '%.' THEN 'ends with a full stop' END,
        CASE WHEN NOT contains(text, chr(10) || chr(10)) THEN 'has a blank line' END,
        CASE WHEN NOT contains(text, chr(10)) THEN 'has a line break' END,
        CASE WHEN contains(text, '@') THEN 'has no address' END,
        CASE WHEN regexp_matches(text, '[0-9]') THEN 'has no digits' END,
        CASE WHEN contains(text, 'http') THEN 'has no link' END) AS failures
    FROM documents
    """
)
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which text rules each whole document fails."""
    failed = rule_failures(F.col("text"), _rules(F.col("text")))
    return load(spark, sf_dir, "documents").select("doc_id", F.array_join(failed, "; ").alias("failures"))


@query(
    """
    SELECT doc_id, source, lang FROM documents ORDER BY n_chars DESC, doc_id LIMIT 5
    """
)
def limit_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows in an order, as a report shows them."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return docs.orderBy(F.desc("n_chars"), "doc_id").limit(5).drop("n_chars")
