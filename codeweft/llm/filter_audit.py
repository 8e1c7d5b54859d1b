"""How filters interact: what each removes, alone and behind others, in every order.

An inverted index holds, for each part of the corpus, range of row ids and filter,
the sorted ids of the rows that fail it, and such lists for the good and the toxic
rows as well. All counts are sizes of unions and differences of these lists, taken
range by range by galloping k-way merges and summed over the ranges. A range is at
most ``RANGE`` consecutive rows of one input partition, so no list grows with the
corpus, however large a part or a group of copies is.

Filters, by what fails them (null text: empty; words are ``[^\\x20\\x09-\\x0D]+``):
A under 100 words; B 100 * distinct words < 80 * words; C 100 * ``[A-Z]`` > 10 * code
points; D any of ``#$%&*|``; E a row of smaller id holds the same text.

Odd rows: a null ``lang`` is the part ''. Rows count one by one, also where an id
repeats. A null id is neither smaller nor larger than others, so such rows neither
fail E nor make others fail, and have no labels. Repeated labels: one that says so is
enough. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeweft.llm.common import keep, table

FILTERS = "ABCDE"
RANGE = 16  # bits of a row id that tell the rows of one range apart
_GOOD, _TOXIC = "good", "toxic"
_STRIDE = 4096
_HOT = 500  # at most so many texts are looked up by broadcast
_PARTS = 1000
_PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"


# --- lists ----------------------------------------------------------------------


def gallop(ids: np.ndarray, key: int, low: int) -> int:
    """The first place from ``low`` on whose id is at least ``key``: steps that double
    until they pass it, then a binary search in the last step."""
    high, step = low, 1
    while high < len(ids) and ids[high] < key:
        low, high, step = high + 1, high + step, step * 2
    return low + int(np.searchsorted(ids[low : min(high, len(ids))], key))


def _windows(lists: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Cut sorted lists at common ids; each list gallops to where the cut falls."""
    at = [0] * len(lists)
    while any(a < len(ids) for a, ids in zip(at, lists, strict=True)):
        ends = [ids[a + _STRIDE] for a, ids in zip(at, lists, strict=True) if a + _STRIDE < len(ids)]
        if ends:
            to = [gallop(ids, min(ends), a) for a, ids in zip(at, lists, strict=True)]
        else:
            to = [len(ids) for ids in lists]
        yield [ids[a:b] for ids, a, b in zip(lists, at, to, strict=True)]
        at = to


def union(lists: list[np.ndarray]) -> np.ndarray:
    """The ids in any of some sorted lists."""
    lists = [ids for ids in lists if len(ids)]
    if len(lists) < 2:
        return lists[0] if lists else np.zeros(0, np.int64)
    return np.concatenate([np.unique(np.concatenate(cut)) for cut in _windows(lists)])


def difference(ids: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The ids of a sorted list that are not in another one."""
    if not len(ids) or not len(other):
        return ids
    out = []
    for own, against in _windows([ids, other]):
        if len(own) and len(against):
            at = np.minimum(np.searchsorted(against, own), len(against) - 1)
            own = own[against[at] != own]
        out.append(own)
    return np.concatenate(out)


def _before(letter: str) -> list[str]:
    others = FILTERS.replace(letter, "")
    return ["".join(c) for n in range(len(FILTERS)) for c in combinations(others, n)]


CASES = [(letter, before) for letter in FILTERS for before in _before(letter)]


def counts(lists: dict[str, np.ndarray]) -> np.ndarray:
    """For each of ``CASES``, a filter and those before it: how many rows are gone
    before, fail the filter, are removed by it, and how many of these are good, toxic."""
    none = np.zeros(0, np.int64)
    own = {letter: lists.get(letter, none) for letter in FILTERS}
    gone = {"": none}
    for n in range(1, len(FILTERS)):
        for names in combinations(FILTERS, n):
            gone["".join(names)] = union([gone["".join(names[:-1])], own[names[-1]]])
    out = np.zeros((len(CASES), 5), np.int64)
    for k, (letter, before) in enumerate(CASES):
        removed = difference(own[letter], gone[before])
        marked = [len(removed) - len(difference(removed, lists.get(name, none))) for name in (_GOOD, _TOXIC)]
        out[k] = (len(gone[before]), len(own[letter]), len(removed), *marked)
    return out


# --- rows -----------------------------------------------------------------------


def faults(raw: bytes, points: int) -> tuple[bool, bool, bool, bool]:
    """Filters A to D on one text in UTF-8, read in pieces cut between words."""
    words, distinct, start = 0, set(), 0
    while start < len(raw):
        cut = _SPACE.search(raw, start + _PIECE)
        end = cut.start() if cut else len(raw)
        piece = raw[start:end].split()  # at \x20 and \x09-\x0D, as raw is bytes
        words += len(piece)
        distinct.update(piece)
        start = end
    upper = len(raw) - len(raw.translate(None, _UPPER))
    return words < 100, 100 * len(distinct) < 80 * words, 100 * upper > 10 * points, len(raw.translate(None, _SYMBOLS)) < len(raw)


_ROW = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), *((k, pa.bool_()) for k in "abcd")]
)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = pc.utf8_length(batch["text"]).to_pylist()
        texts = batch["text"].cast(pa.binary()).to_pylist()
        found = [faults(raw, n) for raw, n in zip(texts, points, strict=True)]
        digests = [hashlib.blake2b(raw, digest_size=16).digest() for raw in texts]
        flags = dict(zip("abcd", zip(*found, strict=True), strict=True)) if found else dict.fromkeys("abcd", ())
        yield table(_ROW, doc_id=batch["doc_id"], part=batch["part"], digest=digests, **flags)


def judged(docs: DataFrame) -> DataFrame:
    """``row, doc_id, part, digest, a, b, c, d`` of every document, as a written
    table: the row ids stay as they are, and are consecutive within a partition."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    kind = "doc_id bigint, part string, digest binary, a boolean, b boolean, c boolean, d boolean"
    return keep(texts.mapInArrow(_judge, kind).withColumn("row", F.monotonically_increasing_id()), "judged")


def _copies(rows: DataFrame) -> DataFrame:
    """``part, row`` of the rows whose text a row of smaller id holds.

    Texts are counted before anything is joined. Those of more than one in ``_HOT``
    rows, at most ``_HOT``, are looked up by broadcast, so a large group of copies
    never meets in one task; the others are joined by their digest.
    """
    groups = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")
    )
    groups = keep(groups.where("first < last").select("digest", "first", "n"), "copied")
    often = F.col("n") * _HOT > F.lit(rows.count())
    hot = groups.where(often).select("digest", F.col("first").alias("hot"))
    marked = rows.select("part", "row", "doc_id", "digest").join(F.broadcast(hot), "digest", "left")
    rest = marked.where("hot IS NULL").join(groups.where(~often), "digest").where("first < doc_id")
    return marked.where("hot < doc_id").select("part", "row").union(rest.select("part", "row"))


def postings(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The index (``part, range, name, ids``) as a written table, where ``name`` is a
    filter's letter, 'good' or 'toxic', and ``part, total``, the rows of each part."""
    rows = judged(docs)
    failed = F.filter(F.array(*(F.when(F.col(k), F.lit(k.upper())) for k in "abcd")), lambda x: x.isNotNull())
    lists = rows.select("part", "row", F.explode(failed).alias("name"))
    lists = lists.union(_copies(rows).withColumn("name", F.lit("E")))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, F.lit(_GOOD))).alias("good"), F.max(F.when(F.col("toxic") == 1, F.lit(_TOXIC))).alias("toxic")
    )
    marked = rows.select("part", "row", "doc_id").join(marks.where("good IS NOT NULL OR toxic IS NOT NULL"), "doc_id")
    names = F.filter(F.array("good", "toxic"), lambda x: x.isNotNull())
    lists = lists.union(marked.select("part", "row", F.explode(names)))
    index = lists.groupBy("part", F.shiftright("row", RANGE).alias("range"), "name").agg(F.sort_array(F.collect_list("row")).alias("ids"))
    return keep(index, "postings"), rows.groupBy("part").agg(F.count("*").alias("total"))


_SUMS = "part string, case int, gone bigint, failing bigint, removed bigint, good bigint, toxic bigint"
_SUM = pa.schema([("part", pa.string()), ("case", pa.int32()), *((n, pa.int64()) for n in ("gone", "failing", "removed", "good", "toxic"))])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of every range, added up by part."""
    sums: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for part, total in sums.items():
            columns = dict(zip(_SUM.names[2:], total.T, strict=True))
            yield table(_SUM, part=[part] * len(CASES), case=range(len(CASES)), **columns)
        sums.clear()

    for batch in batches:
        for part, lists in zip(batch["part"].to_pylist(), batch["lists"], strict=True):
            found = {entry["name"].as_py(): entry["ids"].values.to_numpy() for entry in lists}
            sums[part] = sums.get(part, 0) + counts(found)
        if len(sums) > _PARTS:
            yield from flush()
    yield from flush()


def interactions(index: DataFrame) -> DataFrame:
    """Sums over all ranges for every part and each of ``CASES``."""
    ranges = index.groupBy("part", "range").agg(F.collect_list(F.struct("name", "ids")).alias("lists"))
    merged = ranges.select("part", "lists").mapInArrow(_merge, _SUMS)
    return merged.groupBy("part", "case").agg(*(F.sum(n).alias(n) for n in _SUM.names[2:]))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For every part, all orders of the filters and each step: ``kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    spark = docs.sparkSession
    index, totals = postings(docs, labels)
    sums = keep(interactions(index), "interactions")
    place = {case: k for k, case in enumerate(CASES)}
    steps = [
        ("".join(order), k + 1, place[order[k], "".join(sorted(order[:k]))], place[order[k], FILTERS.replace(order[k], "")])
        for order in permutations(FILTERS)
        for k in range(len(FILTERS))
    ]
    plan = spark.createDataFrame([(k, *step) for k, step in enumerate(steps)], "k int, filter_order string, step int, case int, alone int")
    grid = totals.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1)))).join(F.broadcast(plan), "k")
    alone = sums.select("part", F.col("case").alias("alone"), F.col("removed").alias("unique_fails"))
    grid = grid.join(sums, ["part", "case"], "left").join(alone, ["part", "alone"], "left")
    grid = grid.na.fill(0, ["gone", "failing", "removed", "good", "toxic", "unique_fails"])
    same_filter = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return grid.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.col("gone") - F.col("removed")).alias("kept"),
        "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails",
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("removed").over(same_filter).alias("shapley"),
    )


FILTER_AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(words) < 100 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN first_id < doc_id THEN 'E' ELSE '' END) AS failed
  FROM texts LEFT JOIN marks USING (doc_id)
), cells AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, failed
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), judged AS (
  SELECT s.filter_order, s.step, s.own, c.part, c.failed, c.n, c.good, c.toxic,
    contains(c.failed, s.own) AS fails, translate(c.failed, s.before, '') <> c.failed AS gone
  FROM steps s, cells c
), counted AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
