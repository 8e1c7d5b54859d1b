"""Queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from codeweft.llm.common import prepare
from codeweft.llm.divergence import DIVERGENCE_SQL, divergence
from codeweft.llm.filter_audit import FILTER_AUDIT_SQL, filter_audit
from codeweft.llm.mix import MIX_SQL, mix
from codeweft.llm.near_vectors import near_vectors
from codeweft.llm.ngram_join import similar_groups
from codeweft.llm.pack import pack, tokenizer_path
from codeweft.llm.quality import quality
from codeweft.llm.quotes import link_quotes
from codeweft.llm.secrets import scan
from codeweft.llm.string_kernel import languages
from codeweft.llm.surrogates import replace_entities
from codeweft.llm.toxicity import toxicity
from codeweft.llm.warc import round_trip

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that checks it."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        REGISTRY[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query()
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return scan(load(spark, sf_dir, "documents"))


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by rules and by its likeness to trusted ones."""
    return quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the held-out fold are not used."""
    return toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query(MIX_SQL)
def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document, by the target of its source."""
    return mix(load(spark, sf_dir, "documents"))


@query()
def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack(load(spark, sf_dir, "documents"), tokenizer_path())


@query()
def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors with a cosine of 0.93 or more."""
    return near_vectors(load(spark, sf_dir, "embeddings"))


@query()
def op8_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages without quotations, with what they reply to."""
    return link_quotes(load(spark, sf_dir, "conversations"))


@query()
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back by the salvage reader."""
    return round_trip(load(spark, sf_dir, "pages"))


@query()
def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced; the key is a caller's secret."""
    return replace_entities(load(spark, sf_dir, "documents"), key="demonstration key")


@query()
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 4-word shingles overlap by 85 per cent."""
    return similar_groups(load(spark, sf_dir, "documents"))


@query()
def op11_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by string kernels."""
    return languages(load(spark, sf_dir, "documents"))


@query(DIVERGENCE_SQL)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are apart, and by which terms."""
    return divergence(load(spark, sf_dir, "documents"))


@query(FILTER_AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order, by language."""
    return filter_audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline: toxicity, near duplicates, secrets, mix, packing."""
    return corpus_pipeline.run(spark, sf_dir)
