"""Incremental reconciliation of source files, as one batch over all of them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeweft.functions.ids import error_id, graph_event_id, metadata_event_id, pack, unpack
from codeweft.operators.graph import union_all
from codeweft.operators.merge import replace_rows
from codeweft.operators.metadata import documents, file_facts
from codeweft.operators.ordered import WIDTH, ordinal_at_once, ordinal_by_size
from codeweft.plans.analyze import analyze
from codeweft.schemas import (
    EDGE,
    ELEMENTS,
    ENVELOPE_FIELDS,
    ERROR,
    FILE_STATE,
    METADATA,
    NODE,
    SCHEMA_VERSION,
    TOPIC_EDGES,
    TOPIC_ERRORS,
    TOPIC_METADATA,
    TOPIC_NODES,
)
from codeweft.session import by_file, in_place, passing, plan_buckets, stage
from codeweft.sinks.eventlog import EventLog
from codeweft.sinks.tables import VersionedTables

STATE_LAYOUT = {"file_state": FILE_STATE, "elements": ELEMENTS}
ELEMENT_KEYS = ["file_id", "element_type", "element_id"]
_SHARED = ("repo_id", "content_hash", "event_time", "run_id")  # by all events of a file
_ALL = {"ignoreNullFields": "false"}

# The order in which one file's events are published.
PHASES = {
    ("edge", "delete"): 0,
    ("node", "delete"): 1,
    ("error", "error"): 2,
    ("node", "upsert"): 3,
    ("edge", "upsert"): 4,
    ("metadata", "upsert"): 5,
}
_TOPIC_OF = {"node": TOPIC_NODES, "edge": TOPIC_EDGES, "metadata": TOPIC_METADATA, "error": TOPIC_ERRORS}


def with_state(files: DataFrame, file_state: DataFrame) -> DataFrame:
    """Files with the hash that was stored for them, null for new ones."""
    stored = file_state.select("file_id", F.col("content_hash").alias("stored_hash"))
    return files.join(stored, "file_id", "left")


def mark_changed(files: DataFrame, file_state: DataFrame, force: bool = False) -> DataFrame:
    """Add ``changed``: false where the stored hash equals the content's."""
    same = F.col("stored_hash").eqNullSafe(F.col("content_hash")) & ~F.lit(force)
    return with_state(files, file_state).withColumn("changed", ~same).drop("stored_hash")


def stale_elements(previous: DataFrame, current: DataFrame, changed: DataFrame) -> DataFrame:
    """Elements that changed files had before and do not have now.

    The join key holds the element id, so a file with very many elements is
    spread over all partitions.
    """
    now = pack(current.select(*ELEMENT_KEYS), "element_id")
    return unpack(pack(elements_of(previous, changed), "element_id").join(now, ELEMENT_KEYS, "left_anti"), "element_id")


def elements_of(elements: DataFrame, files: DataFrame) -> DataFrame:
    """All elements of the given files. AQE splits the elements of a hot file."""
    return unpack(pack(elements, "element_id").join(files.select("file_id").distinct(), "file_id", "left_semi"), "element_id")


def next_file_state(file_state: DataFrame, changed: DataFrame, updated_at: Column) -> DataFrame:
    fresh = changed.select("file_id", "content_hash", updated_at.alias("updated_at"))
    return replace_rows(file_state, fresh, ["file_id"])


def next_elements(elements: DataFrame, current: DataFrame, changed: DataFrame) -> DataFrame:
    """Drop all elements of changed files, then add what they have now."""
    kept = elements.join(changed.select("file_id"), "file_id", "left_anti")
    return kept.unionByName(elements_of(current, changed))


def publish_order(*parts: DataFrame) -> DataFrame:
    """Add ``seq``, the place of each event within its file.

    ``parts(file_id, phase, key)``: deletes of edges, then of nodes, the
    error, upserts of nodes, then of edges, the metadata; ids in order within
    each. A file with very many events is numbered in ranges of its keys. The
    events are read more than once, so they are to be stored or easily made.

    Events may come in several parts, phases of one before those of the next. Each is
    numbered by itself, behind the rows that the parts before it have of the file: parts
    that lie by file then move no event, as they would behind a union. Files of several
    parts all have an id.
    """
    leading = F.concat(F.col("phase").cast("string"), F.substring("key", 1, 3))

    keys, order = ["file_id"], ["phase", "key"]
    if len(parts) == 1:
        hashes = [c for c in ("key", "content_hash", "event_id") if c in parts[0].columns]
        return ordinal_by_size(parts[0], keys, order, "seq", leading, hashes=hashes)
    sizes = [p.groupBy("file_id").agg(F.count("*").alias("_n")).withColumn("_part", F.lit(i)) for i, p in enumerate(parts)]
    sizes = stage(union_all(*sizes), "sizes", "file_id")
    before = [F.sum(F.when(F.col("_part") < i, F.col("_n")).otherwise(0)).alias(f"_before{i}") for i in range(len(parts))]
    starts = sizes.groupBy(F.col("file_id").alias("_file")).agg(*before)
    hot = not sizes.where(F.col("_n") > WIDTH).isEmpty()

    def placed(i: int, part: DataFrame) -> DataFrame:
        start = starts.select("_file", F.col(f"_before{i}").alias("_before")).hint("shuffle_hash")
        rows = ordinal_by_size(part, keys, order, "seq", leading) if hot else ordinal_at_once(part, keys, order, "seq")
        rows = rows.join(start, F.col("file_id") == F.col("_file"))
        return rows.withColumn("seq", F.col("seq") + F.col("_before")).drop("_file", "_before")

    return union_all(*[placed(i, p) for i, p in enumerate(parts)])


def envelope(
    df: DataFrame, payload: str, op: str, key: Column, event_id: Column, body: Column, carry: Sequence[str] = ()
) -> DataFrame:
    """Events as ``file_id, topic, key, phase, value`` plus the carried columns.

    The value's keys are in name order and nothing is left out.
    """
    return df.select("file_id", *[c.alias(n) for n, c in _event(payload, op, key, event_id, body).items()], *carry)


def _event(payload: str, op: str, key: Column, event_id: Column, body: Column) -> dict[str, Column]:
    given = {"schema_version": F.lit(SCHEMA_VERSION), "event_id": event_id, "op": F.lit(op), payload: body}
    fields = [given.get(n, F.col(n)).alias(n) for n in sorted((*ENVELOPE_FIELDS, payload))]
    return {
        "topic": F.lit(_TOPIC_OF[payload]),
        "key": key,
        "phase": F.lit(PHASES[payload, op]),
        "value": F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}),
    }


def _body(layout, prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{n}").alias(n) for n in sorted(layout.fieldNames())])


def bare_events(
    df: DataFrame, kind: Column, op: str, key: Column, body: Column | None = None, event_id: Column | None = None
) -> DataFrame:
    """Events before they are put in order: ``file_id, key, phase``, what all events of a
    file share, ``body`` (the payload as JSON; null if it is the id alone) and
    ``event_id`` (null for nodes and edges, whose own follows from the rest).

    They are narrow, so this is what moves; :func:`sealed` then gives their text.
    """
    phase = F.coalesce(*[F.when(kind == k, F.lit(at)) for (k, o), at in PHASES.items() if o == op])
    none = F.lit(None).cast("string")
    text = none if body is None else F.to_json(body, _ALL)
    return df.select(
        "file_id", key.alias("key"), phase.alias("phase"), text.alias("body"),
        (none if event_id is None else event_id).alias("event_id"), *_SHARED,
    )


def sealed(events: DataFrame, *carry: str) -> DataFrame:
    """``file_id, topic, key, phase, value`` of :func:`bare_events` plus the carried
    columns: the value that :func:`envelope` gives."""
    def value(payload: str, op: str) -> Column:
        own = graph_event_id(F.lit(payload), F.lit(op), "key", "content_hash")
        given = {"schema_version": F.lit(SCHEMA_VERSION), "op": F.lit(op), "event_id": F.coalesce("event_id", own)}
        names = sorted((*ENVELOPE_FIELDS, payload))
        at = names.index(payload)  # never first or last
        before, after = (
            F.to_json(F.struct(*[given.get(n, F.col(n)).alias(n) for n in part]), _ALL) for part in (names[:at], names[at + 1 :])
        )
        body = F.coalesce("body", F.to_json(F.struct(F.col("key").alias("id")), _ALL))
        return F.concat(before.substr(F.lit(1), F.length(before) - 1), F.lit(f',"{payload}":'), body, F.lit(","), after.substr(F.lit(2), F.length(after)))

    def by_phase(given) -> Column:
        return F.coalesce(*[F.when(F.col("phase") == at, given(*what)) for what, at in PHASES.items()])

    topic = by_phase(lambda payload, op: F.lit(_TOPIC_OF[payload]))
    return events.select("file_id", topic.alias("topic"), "key", "phase", by_phase(value).alias("value"), *carry)


def id_events(elements: DataFrame, op: str, common: DataFrame) -> DataFrame:
    """Events of elements of both kinds, in one pass; their payload is the id alone."""
    kind = F.when(F.col("element_type") == "edge", "edge").otherwise("node")
    return bare_events(elements.join(common, "file_id"), kind, op, F.col("element_id"))


def delete_events(stale: DataFrame, common: DataFrame) -> DataFrame:
    """Delete events of ``stale`` elements."""
    return id_events(stale, "delete", common)


def upsert_events(rows: DataFrame, kind: str, common: DataFrame) -> DataFrame:
    layout = {"node": NODE, "edge": EDGE}[kind]
    nested = rows.select("file_id", F.struct(*layout.fieldNames()).alias("_e")).join(common, "file_id")
    return bare_events(nested, F.lit(kind), "upsert", F.col("_e.id"), _body(layout, "_e."))


def metadata_events(docs: DataFrame, common: DataFrame) -> DataFrame:
    nested = docs.select(F.col("_id").alias("file_id"), F.struct(*METADATA.fieldNames()).alias("_d")).join(common, "file_id")
    return bare_events(
        nested, F.lit("metadata"), "upsert", F.col("file_id"), _body(METADATA, "_d."),
        metadata_event_id("file_id", "content_hash", "_d.parse_status"),
    )


def error_rows(errors: DataFrame, common: DataFrame) -> DataFrame:
    """Parse errors in the error layout, next to the common fields."""
    joined = errors.join(common, "file_id")
    return joined.select(
        *common.columns,
        error_id("file_id", "content_hash", "exception_type", "line", "column").alias("id"),
        F.lit("parse").alias("stage"),
        "exception_type",
        "message",
        "line",
        "column",
        F.lit(True).alias("recoverable"),
        "traceback",
    )


def error_events(errors: DataFrame, common: DataFrame) -> DataFrame:
    rows = error_rows(errors, common).withColumn("_e", F.struct(*ERROR.fieldNames()))
    return bare_events(rows, F.lit("error"), "error", F.col("_e.id"), _body(ERROR, "_e."), F.col("_e.id"))


def file_results(files: DataFrame, current: DataFrame, stale: DataFrame, warnings: DataFrame, errors: DataFrame) -> DataFrame:
    """One row per file: status, element counts, deletes, warnings, error.

    ``files(file_id, path, content_hash, changed)``.
    """
    def counted(df: DataFrame, node: str, edge: str) -> DataFrame:
        return df.groupBy("file_id").agg(
            F.count_if(F.col("element_type") == "node").alias(node),
            F.count_if(F.col("element_type") == "edge").alias(edge),
        )

    zero = ("nodes", "edges", "deleted_nodes", "deleted_edges", "warnings")
    joined = (
        files.join(counted(current, "nodes", "edges"), "file_id", "left")
        .join(counted(stale, "deleted_nodes", "deleted_edges"), "file_id", "left")
        .join(warnings.groupBy("file_id").agg(F.count("*").alias("warnings")), "file_id", "left")
        .join(errors.select("file_id", F.col("full_message").alias("error")), "file_id", "left")
    )
    status = (
        F.when(~F.col("changed"), F.lit("skipped"))
        .when(F.col("error").isNotNull(), F.lit("error"))
        .otherwise(F.lit("processed"))
    )
    return joined.select(
        "path", "file_id", "content_hash", status.alias("status"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in zero],
        F.coalesce("error", F.lit("")).alias("error"),
    )


def run_summary(results: DataFrame, *keys: str) -> DataFrame:
    """Counts by status; ``exit_code`` is 1 if any file failed."""
    def status(name: str) -> Column:
        return F.count_if(F.col("status") == name)

    return results.groupBy(*keys).agg(
        status("processed").alias("processed"), status("skipped").alias("skipped"), status("error").alias("errors")
    ).withColumn("exit_code", F.when(F.col("errors") > 0, 1).otherwise(0))


@dataclass(frozen=True)
class Batch:
    """What one run over the files leaves behind."""

    events: DataFrame
    results: DataFrame
    file_state: DataFrame
    elements: DataFrame


def reconcile(
    files: DataFrame,
    file_state: DataFrame,
    elements: DataFrame,
    event_time: str,
    run_id: str,
    force: bool = False,
    repo_url: Column | None = None,
    commit_sha: Column | None = None,
) -> Batch:
    """Events, results and next state for ``files`` in the source-file layout.

    Unchanged files are taken out before the parser sees them; where all are
    to be parsed, their content does not take part in a join. A file that is no
    longer in the tree is not visited, so its elements stay.
    """
    now, run = F.lit(event_time), F.lit(run_id)
    facts = stage(mark_changed(file_facts(files), file_state, force), "facts")
    size = facts.where("changed").agg(F.sum(F.col("size_bytes").cast("bigint"))).first()[0]
    buckets = plan_buckets(files, size or 0)
    facts = stage(facts, "facts", "file_id")
    changed = facts.where("changed")
    everything = force or file_state.isEmpty()
    pending = files if everything else files.join(changed.select("file_id"), "file_id", "left_semi")
    graph = analyze(pending.select("file_id", "path", "content"), buckets)
    with in_place(files.sparkSession):
        nodes, edges = stage(graph.nodes, "nodes", "file_id"), stage(graph.edges, "edges", "file_id")
        warned = stage(graph.warnings, "warnings", "file_id")
    errors = graph.errors

    def ids(df: DataFrame, kind: str) -> DataFrame:
        return df.select("file_id", F.lit(kind).alias("element_type"), F.col("id").alias("element_id"))

    held = stage(elements, "held", "file_id")
    is_edge = F.coalesce(F.col("element_type") == "edge", F.lit(False))
    with in_place(files.sparkSession):  # by kind: behind a union, current elements would move
        stale = [(held.where(~is_edge), ids(nodes, "node")), (held.where(is_edge), ids(edges, "edge"))]
        stale = stage(union_all(*[stale_elements(was, now_there, changed) for was, now_there in stale]), "stale", "file_id")
        docs = stage(documents(changed, nodes, edges, warned, errors, now, run, repo_url, commit_sha), "docs", "_id")
    current = ids(nodes, "node").unionByName(ids(edges, "edge"))
    # A row per file, met in its bucket by the many rows of the file's elements.
    common = changed.select(
        "file_id", "repo_id", "content_hash", now.alias("event_time"), run.alias("run_id")
    ).hint("shuffle_hash")
    events = publish_order(
        delete_events(stale, common),
        error_events(errors, common),
        upsert_events(nodes, "node", common),
        upsert_events(edges, "edge", common),
        metadata_events(docs, common),
    )
    return Batch(
        sealed(events, "seq"),
        file_results(facts, current, stale, warned, errors),
        next_file_state(file_state, changed, now),
        next_elements(held, current, changed),
    )


def run_batch(
    spark: SparkSession,
    files: DataFrame,
    state: VersionedTables,
    log: EventLog,
    batch: str,
    event_time: str,
    run_id: str,
    force: bool = False,
) -> DataFrame:
    """Reconcile, publish, then move the state on; returns the file results.

    Events, next state and results are written first, and one row names them. What
    is published and committed is what that row names, also when the batch runs
    again after a failure: then the sources are not looked at anew, so log and
    state never tell different stories.
    """
    planned = f"{state.path}/planned"
    row = _planned(spark, planned, batch)
    if row is None:
        file_state, elements = state.read("file_state", "elements")
        results = f"{state.path}/results/{uuid.uuid4().hex}"
        with passing(spark):
            done = reconcile(files, file_state, elements, event_time, run_id, force)
            done.results.write.parquet(results)
            folders = state.write({"file_state": done.file_state, "elements": done.elements})
            plan = [(str(batch), log.write(done.events), folders, results)]
        spark.createDataFrame(plan, _PLAN).coalesce(1).write.mode("append").json(planned)
        row = _planned(spark, planned, batch)
    log.commit(batch, row.events)
    state.link(row.folders, batch)
    return spark.read.parquet(row.results)


_PLAN = "batch string, events string, folders map<string,string>, results string"


def _planned(spark: SparkSession, path: str, batch: str):
    """The row of a batch that was written before, None if there is none."""
    try:
        rows = spark.read.schema(_PLAN).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows.where(F.col("batch") == str(batch)).first()
