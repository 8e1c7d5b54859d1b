"""A corpus from raw documents to packed sequences, in five stages.

Each stage gets what the one before it wrote, and all but the last return the
columns of documents. ``ORACLE_SQL`` is None: tokenizer ids, compressed lengths and
inferred automata are beyond SQL. The stages are tested against plain versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codeweft.llm.common import keep, prepare
from codeweft.llm.mix import repeated
from codeweft.llm.ngram_join import first_of_each
from codeweft.llm.pack import pack, tokenizer_path
from codeweft.llm.secrets import without_secrets
from codeweft.llm.toxicity import without_toxic

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    return without_toxic(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles overlap by 80 per cent."""
    prepare(spark)
    return first_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    prepare(spark)
    return without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prepare(spark)
    return repeated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, each with its sequence and place there."""
    prepare(spark)
    return pack(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_copies),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
