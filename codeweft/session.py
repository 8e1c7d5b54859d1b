"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys: let AQE split an oversized join partition even where that
    # costs the plan another exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Streams keep state on disk, not on the heap; keyed state needs this store.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Stored tables are mostly hashes in hexadecimal, which only an entropy coder packs.
    "spark.sql.parquet.compression.codec": "zstd",
    # Bucketed tables are written without a sort.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator here relies on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "codeweft", master: str | None = None, **conf: str) -> SparkSession:
    """A tuned session; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. A folder of this machine
    is used only where that is unset and the session is local.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="codeweft-")
    context.setCheckpointDir(root)
    return context.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/codeweft/{name}-{uuid.uuid4().hex}"


_PASSING = threading.local()


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables staged within this, by this thread, go once it ends, so that disk holds
    those of one step and not of all steps. What outlives it must not read them."""
    from codeweft.sinks.files import remove

    outer, own = getattr(_PASSING, "paths", None), []
    _PASSING.paths = own
    try:
        yield
    finally:
        _PASSING.paths = outer
        for path in own:
            remove(spark, path)


_CO_LOCATED = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def in_place(spark: SparkSession) -> Iterator[None]:
    """Within this, tables bucketed by file join on any keys that hold the file
    without a shuffle. For graph passes only, where a key is one parsed file:
    elsewhere a hot file would stay in one partition."""
    before = spark.conf.get(_CO_LOCATED)
    spark.conf.set(_CO_LOCATED, "false")
    try:
        yield
    finally:
        spark.conf.set(_CO_LOCATED, before)


_BUCKETS = "spark.codeweft.buckets"
_BUCKET_BYTES = 1 << 20  # a bucket's passes hold some hundred times as much
_UNKNOWN_SIZE = 1 << 60
_MAX_BUCKETS = 10_000  # a stage has a task and a file for each


def plan_buckets(df: DataFrame, size: int | None = None) -> int:
    """Choose how many buckets the tables of one analysis get, by the size of
    the tables it reads, and keep that for :func:`stage`.

    Sizes of joins are rough guesses, so the leaves of the plan are added up; a
    leaf of unknown size counts nothing. Where the bytes of the sources are known,
    ``size`` gives them.
    """
    spark = df.sparkSession
    if size is None:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
        size = sum(s for s in sizes if s < _UNKNOWN_SIZE)
    count = max(spark.sparkContext.defaultParallelism, min(size // _BUCKET_BYTES, _MAX_BUCKETS))
    spark.conf.set(_BUCKETS, str(count))
    return count


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get(_BUCKETS, spark.conf.get("spark.sql.shuffle.partitions")))


def by_file(df: DataFrame) -> DataFrame:
    """``df`` laid out as the tables that :func:`stage` buckets by file, for rows behind
    a union: what follows on keys that hold the file moves them no more."""
    return df.repartition(_buckets(df.sparkSession), "file_id")


def stage(df: DataFrame, name: str, by: str | None = None, laid_out: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives lost executors, and keeps
    column pruning and filter pushdown for the readers. With ``by`` the table
    is bucketed on that column: later joins, windows and aggregates on keys that
    hold it need no shuffle. The shuffle here falls away, too, where ``df`` is
    known to be laid out that way, or is said to be by ``laid_out``.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    held = getattr(_PASSING, "paths", None)
    if held is not None:
        held.append(path)
    if by is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    count = _buckets(spark)
    table = f"codeweft_{name}_{uuid.uuid4().hex}"
    rows = df if laid_out else df.repartition(count, by)
    rows.write.bucketBy(count, by).option("path", path).saveAsTable(table)
    stored = spark.table(table)
    # Only a catalog entry tells readers about buckets. The frame has it now, so
    # the entry goes; the files stay, as their path was given.
    spark.sql(f"DROP TABLE {table}")
    return stored
