"""Similarity join on word n-grams, by prefix filtering with rare n-grams first.

Texts with equal shingle sets are one class from the start. Shingles are ordered
by how many documents hold them, rarest first, as counted over all documents in a
sketch of fixed size; any order common to all is exact, a good one is fast. Two
sets that are similar enough share a shingle among the first few of each, so
classes are joined on those alone.

Among the classes of a prefix shingle, those that come first in ``LEADERS`` orders
common to all lead. Each class is first compared with the leaders that it meets most
often, ``MEET`` at most. Near copies mostly meet the same ones, so links found
there connect groups of thousands with a few comparisons each. Then pairs that share a prefix shingle and still are in different components
are tried: all of them pass the length, positional and suffix filters where they
meet, and only what is left is verified, once, at the first shingle they share. The
suffix filter bounds the shingles that only one of two sets has by the bits in which
their sketches differ, so it is exact. No link between components is lost. The output is components: links inside one are not
listed, and most of them not verified.

Hot groups: copies collapse in partial aggregates; leaders are minima, which
combine on the map side; joins are equi joins whose large side AQE splits; a shingle
with more than ``BLOCK`` classes is cut into blocks, and pairs of blocks are tasks of
their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeweft.llm.common import (
    SALTS,
    U,
    bit_chunks,
    components,
    fold,
    in_cells,
    keep,
    mix,
    pack,
    seen_once,
    shingle_sets,
    table,
)

SKETCH = 20
_CHUNKS = 16
LEADERS = 4
MEET = 12
BLOCK = 1024
_FLUSH = 1 << 21


def class_of(s: np.ndarray) -> int:
    """The 64-bit name of a set of shingles."""
    total = mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U, keepdims=True)
    return int(mix(total + np.array([len(s)], U) * U(0x9E3779B97F4A7C15)).view(np.int64)[0])


def prefix_length(n: int, num: int, den: int) -> int:
    """How many of n ordered shingles must be looked at: n - ceil(n * num / den) + 1."""
    return n + num * n // -den + 1


def _suffix_sketch(s: np.ndarray) -> bytes:
    """One bit for each of as many cells as shingles, or more: whether an odd number of
    shingles falls into it. Where two such differ, one set has a shingle the other lacks."""
    width = 512
    while width < len(s):
        width *= 2
    odd = np.bincount((s & U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _folded(sketch: bytes, width: int) -> np.ndarray:
    """The sketch of the same set in ``width`` words of 64 bits."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, U).reshape(-1, width), axis=0)


def _overlap_bound(na: int, nb: int, a: bytes, b: bytes) -> int:
    """The most shingles that two sets of these sizes and sketches can share."""
    width = min(len(a), len(b)) // 8
    return (na + nb - int(np.bitwise_count(_folded(a, width) ^ _folded(b, width)).sum())) // 2


_SETS = pa.schema(
    [("doc_id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("chunk", pa.int32()), ("salt", pa.int32()), ("part", pa.binary())]
)
_PREFIX = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary()), ("sketch", pa.binary())])
_POSTING = pa.schema([("token", pa.int64()), ("cls", pa.int64()), ("place", pa.int64())])
_STORED = pa.schema([("cls", pa.int64()), ("members", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _chunk_rows(schema: pa.Schema, parts: list[bytes]) -> pa.RecordBatch:
    m = len(parts)
    blank = {f.name: [None] * m for f in schema}
    salt = TaskContext.get().partitionId() % SALTS
    return table(schema, **blank | {"chunk": list(range(m)), "salt": [salt] * m, "part": parts})


def _measure(n: int):
    """Rows of documents, and the task's document counts by hashed shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH, np.int64)
        for batch in batches:
            sets = shingle_sets(batch["text"], n)
            m = len(sets)
            if m:
                cells = np.concatenate(sets) >> U(64 - SKETCH)
                counts += np.bincount(cells.astype(np.int64), minlength=1 << SKETCH)
            yield table(
                _SETS,
                doc_id=batch["doc_id"],
                h=batch["h"],
                n=[len(s) for s in sets],
                cls=[class_of(s) if len(s) else None for s in sets],
                chunk=[None] * m,
                salt=[None] * m,
                part=[None] * m,
            )
        parts = counts.reshape(_CHUNKS, -1)
        yield _chunk_rows(_SETS, [pack(p) for p in parts])

    return run


def _prefixes(n: int, num: int, den: int, counts):
    """The prefix of each set, rarest first, and its suffix sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts.value
        for batch in batches:
            cls, sizes, tokens, sketches = [], [], [], []
            for s in shingle_sets(batch["text"], n):
                if not len(s):
                    continue
                # Stable, and s is sorted: equal counts go by hash.
                order = np.argsort(known[(s >> U(64 - SKETCH)).astype(np.int64)], kind="stable")
                cls.append(class_of(s))
                sizes.append(len(s))
                tokens.append(s[order[: prefix_length(len(s), num, den)]].tobytes())
                sketches.append(_suffix_sketch(s))
            yield table(_PREFIX, cls=cls, n=sizes, tokens=tokens, sketch=sketches)

    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A narrow row for each prefix shingle; its place is size and position in one."""
    for batch in batches:
        values = [np.frombuffer(t.as_buffer(), np.int64) for t in batch["tokens"]]
        lengths = np.array([len(v) for v in values], np.int64)
        if not lengths.sum():
            continue
        tokens = np.concatenate(values)
        row = np.repeat(np.arange(len(values)), lengths)
        pos = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        yield table(_POSTING, token=tokens, cls=np.asarray(batch["cls"])[row], place=(np.asarray(batch["n"])[row] << 32) | pos)


def _row_cells(ids: pa.Array, cls: np.ndarray) -> np.ndarray:
    return mix(mix(np.asarray(ids.fill_null(0)).astype(np.int64).view(U)) ^ cls.astype(np.int64).view(U))


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the rows (doc_id, cls) that are wanted."""
    got, size = [], 0
    for batch in batches:
        got.append(_row_cells(batch["doc_id"], np.asarray(batch["cls"])))
        size += len(got[-1])
        if size > _FLUSH:
            yield _chunk_rows(_MARKS, bit_chunks(np.concatenate(got)))
            got, size = [], 0
    yield _chunk_rows(_MARKS, bit_chunks(np.concatenate([*got, np.zeros(0, U)])))


_MARKS = pa.schema([("chunk", pa.int32()), ("salt", pa.int32()), ("part", pa.binary())])


def _stored(n: int, wanted):
    """The whole sets of the documents whose cells are marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch["text"], n)
            cls = np.array([class_of(s) if len(s) else 0 for s in sets], np.int64)
            full = np.array([len(s) > 0 for s in sets], bool)
            here = np.flatnonzero(full & in_cells(wanted.value, _row_cells(batch["doc_id"], cls))) if len(sets) else []
            yield table(_STORED, cls=cls[here] if len(sets) else [], members=[sets[k].tobytes() for k in here])

    return run


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _needed(na, nb, num: int, den: int):
    """The least overlap of similar sets: num / (num + den) of both sizes, rounded up."""
    return -(-num * (na + nb) // (num + den))


_DEALT = ("token", "x", "y", "block", "cls", "place", "root")
_LIGHT = pa.schema(
    [(k, pa.int32() if k in ("x", "y", "block") else pa.int64()) for k in _DEALT] + [("a", pa.int64()), ("b", pa.int64())]
)
_NEAR = 8
_FEW_PAIRS = 4


def _fit(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs of rows of one group pass the length and the positional filter,
    are in different components, and belong to this pair of blocks."""
    n, pos, root, block = rows["place"] >> 32, rows["place"] & 0xFFFFFFFF, rows["root"], rows["block"]
    a, b = n[i], n[j]
    most = np.minimum(pos[i], pos[j]) + np.minimum(a - pos[i], b - pos[j])
    good = (root[i] != root[j]) & (den * np.minimum(a, b) >= num * np.maximum(a, b)) & (most >= _needed(a, b, num, den))
    return good & ((rows["x"][i] == rows["y"][i]) | (block[i] != block[j]))


def _first_look(rows: dict[str, np.ndarray], bounds: np.ndarray, num: int, den: int) -> pa.RecordBatch:
    """Pairs of groups that have few; of others the rows, to be tried with sketches."""
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    size = np.diff(bounds)[group]
    left, right = [], []
    for apart in range(1, _NEAR):  # small groups, all at once
        i = np.flatnonzero((group[apart:] == group[:-apart]) & (size[apart:] <= _NEAR)) if len(group) > apart else np.zeros(0, np.int64)
        good = _fit(rows, i, i + apart, num, den)
        left.append(i[good])
        right.append(i[good] + apart)
    later = []
    for k in np.flatnonzero(np.diff(bounds) > _NEAR).tolist():
        i, j = np.triu_indices(int(bounds[k + 1] - bounds[k]), 1)
        i, j = i + bounds[k], j + bounds[k]
        good = _fit(rows, i, j, num, den)
        if good.sum() <= _FEW_PAIRS * (bounds[k + 1] - bounds[k]):
            left.append(i[good])
            right.append(j[good])
        else:
            later.append(np.arange(bounds[k], bounds[k + 1]))
    i, j = np.concatenate([*left, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*right, np.zeros(0, np.int64)]).astype(np.int64)
    again = np.concatenate([*later, np.zeros(0, np.int64)]).astype(np.int64)
    one, other = rows["cls"][i], rows["cls"][j]
    none = [None] * len(i)
    pairs = table(_LIGHT, **dict.fromkeys(_DEALT, none), a=np.minimum(one, other), b=np.maximum(one, other))
    blank = [None] * len(again)
    kept = table(_LIGHT, **{k: rows[k][again] for k in _DEALT}, a=blank, b=blank)
    return pa.Table.from_batches([pairs, kept]).combine_chunks().to_batches()[0] if len(i) + len(again) else pairs


def _try_group(rows: dict[str, np.ndarray | list], num: int, den: int) -> Iterator[tuple[int, int]]:
    """Pairs of one group that pass all filters, and share no earlier shingle.

    Members go by size, so that those of fitting length follow each other."""
    cls, root, block = (rows[k] for k in ("cls", "root", "block"))
    n, pos = rows["place"] >> 32, rows["place"] & 0xFFFFFFFF
    token, across = int(rows["token"][0]), rows["x"][0] != rows["y"][0]
    order = np.lexsort((cls, n))
    cls, n, pos, root, block = cls[order], n[order], pos[order], root[order], block[order]
    sketches, held = [rows["sketch"][k] for k in order], [rows["open"][k] for k in order]
    last = np.searchsorted(n, den * n // num, side="right")
    by_width: dict[int, tuple[int, np.ndarray]] = {}

    def sketches_from(i: int) -> tuple[int, np.ndarray]:
        """Sketches as wide as that of row i, of the rows from the first such one on."""
        width = len(sketches[i]) // 8
        if width not in by_width:
            by_width[width] = i, np.stack([_folded(s, width) for s in sketches[i:]])
        return by_width[width]

    earlier: dict[int, np.ndarray] = {}
    for i in range(len(n) - 1):
        j = np.arange(i + 1, last[i])
        if not len(j):
            continue
        good = (root[j] != root[i]) & (cls[j] != cls[i])
        if across:
            good &= block[j] != block[i]
        most = np.minimum(pos[i], pos[j]) + 1 + np.minimum(n[i] - pos[i], n[j] - pos[j]) - 1
        need = _needed(n[i], n[j], num, den)
        j, need = j[good & (most >= need)], need[good & (most >= need)]
        if not len(j):
            continue
        base, wide = sketches_from(i)
        apart = np.bitwise_count(wide[j - base] ^ wide[i - base]).sum(1, dtype=np.int64)
        j = j[n[i] + n[j] - apart >= 2 * need]
        for k in j.tolist():
            for m in (i, k):
                if m not in earlier:
                    own = np.frombuffer(held[m], np.int64)
                    earlier[m] = own[own < token]
            if not len(np.intersect1d(earlier[i], earlier[k], assume_unique=True)):
                a, b = int(cls[i]), int(cls[k])
                yield (a, b) if a < b else (b, a)


def _try_all(rows: dict[str, np.ndarray | list], bounds: np.ndarray, num: int, den: int) -> pa.RecordBatch:
    found: list[tuple[int, int]] = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            found.extend(_try_group({k: v[a:b] for k, v in rows.items()}, num, den))
    return table(_PAIR, a=[p[0] for p in found], b=[p[1] for p in found])


def _grouped(work, num: int, den: int):
    """Do ``work`` over rows sorted by group; a group may go on in the next batch."""

    def columns(rows: pa.Table) -> dict[str, np.ndarray | list]:
        return {k: rows[k].to_pylist() if k in ("sketch", "open") else rows[k].to_numpy() for k in rows.column_names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            got = pa.Table.from_batches([batch])
            rest = got if rest is None else pa.concat_tables([rest, got])
            if len(rest) < 2:
                continue
            keys = [rest[k].to_numpy() for k in ("token", "x", "y")]
            ends = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
            if len(ends):
                yield work(columns(rest.slice(0, int(ends[-1]))), np.concatenate([[0], ends]), num, den)
                rest = rest.slice(int(ends[-1]))
        if rest is not None and len(rest):
            yield work(columns(rest), np.array([0, len(rest)]), num, den)

    return run


def _suffix_filter(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            need = _needed(np.asarray(batch["na"]), np.asarray(batch["nb"]), num, den)
            facts = zip(*(batch[k].to_pylist() for k in ("na", "nb", "sa", "sb")), strict=True)
            here = pa.array([_overlap_bound(*x) >= k for x, k in zip(facts, need.tolist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(here), batch["b"].filter(here)], schema=_PAIR)

    return run


def _verified(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here = []
            for x, y in zip(batch["ma"], batch["mb"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                here.append(den * common >= num * (len(x) + len(y) - common))
            here = pa.array(here, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(here), batch["b"].filter(here)], schema=_PAIR)

    return run


def similar_groups(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (doc_id, text).

    Documents link when ``den * common >= num * union`` over their distinct n-word
    shingles. Null and empty texts have no shingles and link with nothing. Every row
    counts by its own text, also where rows repeat an id; equal texts are in one
    component, whose id is the smallest one in it. A null id takes part like any
    other and is never the smallest one, so its component is null only where no
    row in it has an id. No rows: no rows. Other columns are not read.
    """
    return _groups(docs, n, num, den).select("doc_id", "n_shingles", "component_id")


def _groups(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """:func:`similar_groups` with ``h``, the hash of the row's text, and ``root``, which
    names its group; null without shingles."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = keep(texts.withColumn("h", F.xxhash64("text")).mapInArrow(_measure(n), _ddl(_SETS)), "sets")
    counts = share(fold(measured.where("chunk IS NOT NULL"), np.add, "i8", 1 << SKETCH))
    rows = measured.where("chunk IS NULL").select("doc_id", "h", "n", "cls")

    held = keep(texts.mapInArrow(_prefixes(n, num, den, counts), _ddl(_PREFIX)), "prefixes")
    postings = held.select("cls", "n", "tokens").mapInArrow(_postings, _ddl(_POSTING))
    # Most shingles occur once. That is found by their counts alone, which are narrow.
    twice = postings.groupBy("token").count().where("count > 1").select("token")
    postings = keep(postings.join(twice, "token", "left_semi").distinct(), "postings")

    def turn(column: Column, k: int) -> Column:
        return column.bitwiseXOR(F.lit(k * 0x5DEECE66D1234567 % (1 << 63)))

    firsts = [f"l{k}" for k in range(LEADERS)]
    lead = postings.groupBy("token").agg(
        *(F.min(turn(F.col("cls"), k)).alias(f) for k, f in enumerate(firsts)), F.max("cls").alias("most")
    )
    shared = keep(postings.join(lead.where("l0 <> most").drop("most"), "token"), "shared")
    star = shared.select("cls", F.explode(F.array_distinct(F.array(*(turn(F.col(f), k) for k, f in enumerate(firsts))))).alias("other"))
    star = star.where("cls <> other").groupBy("cls", "other").agg(F.count("*").alias("times"))
    most = Window.partitionBy("cls").orderBy(F.desc("times"), "other")
    star = star.withColumn("place", F.row_number().over(most)).where(F.col("place") <= MEET)
    star = star.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b"))
    tried = keep(_filtered(star.distinct(), held, num, den), "tried")
    first_ids = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    first_ids = keep(first_ids, "classes")
    links = keep(_verify(tried, texts, first_ids, n, num, den), "links")

    roots = components(links)
    named = shared.select("token", "cls", "place").join(
        roots.withColumnRenamed("node", "cls"), "cls", "left"
    ).withColumn("root", F.coalesce("root", "cls"))
    many = named.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("size"))
    many = many.where("r0 <> r1").select("token", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    left = keep(named.join(many, "token"), "left")
    block = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    dealt = left.withColumn("block", block).withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.select("token", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"), "block", "cls", "place", "root")
    dealt = dealt.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y")
    light = keep(dealt.mapInArrow(_grouped(_first_look, num, den), _ddl(_LIGHT)), "light")
    few = _filtered(light.where("a IS NOT NULL").select("a", "b").distinct(), held, num, den)
    # Groups with many pairs. A class's shingles in such groups: no more than its prefix.
    many = light.where("a IS NULL").select(*_DEALT)
    own = many.groupBy("cls").agg(F.collect_set("token").alias("open"))
    own = own.join(held.select("cls", "sketch").dropDuplicates(["cls"]), "cls").mapInArrow(_packed, _ddl(_OWN))
    many = many.join(own, "cls").select(*_DEALT, "sketch", "open")
    many = many.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y")
    rest = few.union(many.mapInArrow(_grouped(_try_all, num, den), _ddl(_PAIR))).distinct()
    rest = rest.join(tried, ["a", "b"], "left_anti")
    rest = keep(rest, "rest")
    if not rest.isEmpty():
        links = links.union(keep(_verify(rest, texts, first_ids, n, num, den), "links"))
        roots = components(links)

    joined = first_ids.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    named = joined.where("copies > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_class = named.select("cls", "root").join(least, "root").select("cls", "root", "component_id")
    return rows.join(by_class, "cls", "left").select(
        "doc_id", "h", F.coalesce("root", "cls").alias("root"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


_FEW = 100_000


def first_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` without the rows whose text has a similar one with a smaller id.

    One row of each group of similar texts stays: that with the smallest id, and of
    several with that id the smallest by text. Rows that repeat an id are judged each by
    its own text, so unlike ones stay or go apart. Rows without an id, without a text or
    with an empty one all stay. The rows that go are broadcast only where they are few.
    """
    groups = _groups(docs, n, num, den).where("doc_id IS NOT NULL AND root IS NOT NULL")
    groups = keep(groups.select("doc_id", "h", "root", "component_id"), "groups")
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    gone = keep(gone, "gone")
    if len(gone.select(F.lit(1)).take(_FEW + 1)) <= _FEW:
        gone = F.broadcast(gone)
    held = docs.withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    out = held.join(gone, (F.col("doc_id") == F.col("_id")) & (F.col("_hash") == F.col("_h")), "left_anti")
    first = groups.where("doc_id = component_id")
    again = first.groupBy("doc_id", "root").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id", "root")
    again = keep(first.join(again, ["doc_id", "root"]).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), F.col("root").alias("_root")).distinct(), "again")
    if not again.isEmpty():
        same = (F.col("doc_id") == F.col("_id")) & (F.col("_hash") == F.col("_h"))
        one = out.join(again, same).groupBy("_id", "_root").agg(F.min_by(F.struct(*docs.columns), "text").alias("row"))
        out = out.join(again, same, "left_anti").select(*docs.columns).union(one.select("row.*"))
    return out.select(*docs.columns)


_OWN = pa.schema([("cls", pa.int64()), ("open", pa.binary()), ("sketch", pa.binary())])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [np.array(x, np.int64).tobytes() for x in batch["open"].to_pylist()]
        yield table(_OWN, cls=batch["cls"], open=lists, sketch=batch["sketch"])


def _filtered(pairs: DataFrame, held: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of classes that the length and the suffix filter let through."""
    facts = held.select("cls", "n", "sketch").dropDuplicates(["cls"])
    wide = pairs.join(facts.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
    wide = wide.join(facts.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
    wide = wide.where(den * F.least("na", "nb") >= num * F.greatest("na", "nb"))
    return wide.mapInArrow(_suffix_filter(num, den), _ddl(_PAIR))


def _verify(pairs: DataFrame, texts: DataFrame, first_ids: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs whose whole sets are similar enough. Sets are made anew from the
    texts of the classes in question only."""
    spark = pairs.sparkSession
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    marks = first_ids.join(wanted, "cls", "left_semi").select("doc_id", "cls").mapInArrow(_marks, _ddl(_MARKS))
    marks = spark.sparkContext.broadcast(seen_once(marks))
    sets = keep(texts.mapInArrow(_stored(n, marks), _ddl(_STORED)), "members").dropDuplicates(["cls"])
    wide = pairs.join(sets.select(F.col("cls").alias("b"), F.col("members").alias("mb")), "b")
    wide = wide.join(sets.select(F.col("cls").alias("a"), F.col("members").alias("ma")), "a")
    return wide.select("a", "b", "ma", "mb").mapInArrow(_verified(num, den), _ddl(_PAIR))
