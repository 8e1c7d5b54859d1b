"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by rounds of random signs and fast Hadamard transforms; its hash
is the axis nearest to it, with sign. ``HASHES`` such axes name a bucket. A vector
also goes to the buckets it only just missed (``PROBES`` in all for each table).
Vectors of one bucket are compared by cosine in double precision; a pair counts in
the smallest bucket that both share, so it counts once, without a table of pairs.

More vectors need more axes for small buckets, and more axes, dimensions or a lower
threshold need more tables for the same recall. The axes follow from the largest label.
How often one table parts two vectors whose cosine is just the threshold is measured on
drawn pairs, and as many tables are taken as let ``MISS`` of such pairs be parted by
all. Closer pairs are missed less often.

Equal vectors are one class from the start, so groups of copies cost nothing. A
bucket with more than ``BLOCK`` classes is cut, and pairs of its blocks are compared
by tasks of their own. Tasks give link counts, and a spanning forest of what is
linked for the components.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeweft.llm.common import U, components, keep, mix, table

PROBES = 6
MISS = 0.0005
MOST_AXES = 6
_DRAWN = 500
_TRIED = 4
BLOCK = 1024
_NEAR_AXES = 4
_ROUNDS = 3


def hadamard(a: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of rows whose length is a power of two."""
    n, h = a.shape[1], 1
    while h < n:
        b = a.reshape(len(a), -1, 2, h)
        a = np.stack([b[:, :, 0] + b[:, :, 1], b[:, :, 0] - b[:, :, 1]], 2).reshape(len(a), n)
        h *= 2
    return a / math.sqrt(n)


def _rotated(a: np.ndarray, seed: int) -> np.ndarray:
    signs = np.random.default_rng(seed)
    for _ in range(_ROUNDS):
        a = hadamard(a * signs.choice([-1.0, 1.0], size=a.shape[1]))
    return a


def buckets(vectors: np.ndarray, labels: np.ndarray, hashes: int, tables: int) -> np.ndarray:
    """The buckets of unit vectors of one length, a row each, as 64-bit names."""
    size = max(2, 1 << (vectors.shape[1] - 1).bit_length())
    padded = np.zeros((len(vectors), size))
    padded[:, : vectors.shape[1]] = vectors
    near = min(_NEAR_AXES, size)
    choices = list(itertools.product(range(near), repeat=hashes))
    probes = min(PROBES, len(choices))
    out = []
    for t in range(tables):
        axes, losses = [], []
        for k in range(hashes):
            turned = _rotated(padded, 1000 * t + k)
            strength = np.abs(turned)
            order = np.argsort(-strength, axis=1, kind="stable")[:, :near]
            reach = np.take_along_axis(strength, order, 1)
            axes.append(order * 2 + (np.take_along_axis(turned, order, 1) < 0))
            losses.append((reach[:, :1] - reach) ** 2)
        loss = np.stack([sum(x[:, i] for x, i in zip(losses, c, strict=True)) for c in choices], 1)
        best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        name = mix(labels.astype(np.int64).view(U) * U(2654435761) + np.array([vectors.shape[1] * 1024 + t], U))
        codes = np.zeros((len(vectors), len(choices)), U)
        for j, c in enumerate(choices):
            h = name
            for x, i in zip(axes, c, strict=True):
                h = mix(h ^ (x[:, i].astype(U) + U(1)) * U(0x9E3779B97F4A7C15))
            codes[:, j] = h
        out.append(np.take_along_axis(codes, best, 1))
    return np.concatenate(out, 1)


def tables_needed(hashes: int, size: int, least: float) -> int:
    """How many tables part at most ``MISS`` of the pairs of ``size`` dimensions whose
    cosine is ``least``. ValueError if hashing hardly tells such pairs from any others."""
    if size < 2 or least >= 1:
        return 1
    draw = np.random.default_rng(size)
    one, other = draw.normal(size=(2, _DRAWN, size))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (other * one).sum(1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    near = least * one + math.sqrt(1 - least * least) * other
    label = np.zeros(_DRAWN, np.int64)
    a, b = (buckets(x, label, hashes, _TRIED).reshape(_DRAWN, _TRIED, -1) for x in (one, near))
    parted = ~(a[:, :, :, None] == b[:, :, None, :]).any((2, 3))
    # One more than counted, so that a table that parted none is not taken for perfect.
    share = (parted.sum() + 1) / (parted.size + 1)
    if share > 0.99:
        raise ValueError(f"cosines of {least} are too low for hashing in {size} dimensions")
    return math.ceil(math.log(MISS) / math.log(share))


def _usable(vector: list | None) -> np.ndarray | None:
    """The unit vector in double precision, or None."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.array(vector, np.float64)
    most = np.abs(v).max()
    if not np.isfinite(most) or most == 0:
        return None
    v = v / most
    return v / np.sqrt((v * v).sum())


_CLEAN = pa.schema(
    [("vec_id", pa.int64()), ("label", pa.int64()), ("size", pa.int64()), ("cls", pa.int64()), ("unit", pa.binary())]
)
_CLEAN_DDL = "vec_id bigint, label bigint, size bigint, cls bigint, unit binary"


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors; the class names equal ones with equal labels. Rows that take
    no part have no class."""
    for batch in batches:
        labels = batch["label"].to_pylist()
        units = [None if label is None else _usable(v) for label, v in zip(labels, batch["embedding"].to_pylist(), strict=True)]
        names: list[int | None] = [None] * len(units)
        by_size: dict[int, list[int]] = {}
        for k, u in enumerate(units):
            if u is not None:
                by_size.setdefault(len(u), []).append(k)
        for size, rows in by_size.items():
            bits = mix((np.stack([units[k] for k in rows]) + 0.0).view(U) + np.arange(size, dtype=U) * U(0x9E3779B97F4A7C15))
            own = np.array([labels[k] for k in rows], np.int64).view(U)
            total = mix(mix(bits).sum(1, dtype=U) ^ mix(own + U(size << 32)))
            for k, name in zip(rows, total.view(np.int64).tolist(), strict=True):
                names[k] = name
        yield table(
            _CLEAN,
            vec_id=batch["vec_id"],
            label=labels,
            size=[None if u is None else len(u) for u in units],
            cls=names,
            unit=[None if u is None else u.tobytes() for u in units],
        )


_HASHED = pa.schema([("cls", pa.int64()), ("label", pa.int64()), ("copies", pa.int64()), ("unit", pa.binary()), ("names", pa.list_(pa.int64()))])
_HASHED_DDL = "cls bigint, label bigint, copies bigint, unit binary, names array<bigint>"


def _hash(hashes: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch["size"])
            for size in np.unique(sizes).tolist():
                rows = batch.filter(pa.array(sizes == size))
                units = np.stack([np.frombuffer(u.as_buffer(), np.float64) for u in rows["unit"]])
                names = buckets(units, np.asarray(rows["label"]), hashes, tables).view(np.int64)
                yield table(
                    _HASHED, cls=rows["cls"], label=rows["label"], copies=rows["copies"], unit=rows["unit"],
                    names=[sorted(set(x)) for x in names.tolist()],
                )

    return run


_FACTS = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _compare(group: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Link counts of a group's classes, and pairs that span what is linked."""
    cls, copies, labels = (group[k].to_numpy() for k in ("cls", "copies", "label"))
    block, name = group["block"].to_numpy(), group["bucket"][0].as_py()
    raw = group["unit"].to_pylist()
    size = len(raw[0])
    units = np.stack([np.frombuffer(u if len(u) == size else bytes(size), np.float64) for u in raw])
    linked = (units @ units.T >= least) & (labels[:, None] == labels) & (cls[:, None] != cls)
    if group["x"][0].as_py() != group["y"][0].as_py():
        linked &= block[:, None] != block
    if linked.any():
        lists = [np.array(x, np.int64) for x in group["names"].to_pylist()]
        earlier = [x[x < name] for x in lists]
        values, counts = np.unique(np.concatenate(earlier), return_counts=True)
        values = values[counts > 1]
        for start in range(0, len(values), 2048):
            some = values[start : start + 2048]
            holds = np.stack([np.isin(some, x, assume_unique=True) for x in earlier]).astype(np.float32)
            linked &= holds @ holds.T == 0
    links = linked @ copies
    pairs: list[tuple[int, int]] = []
    waiting = linked.any(1)
    while waiting.any():
        start = int(np.argmax(waiting))
        reached = np.zeros(len(cls), bool)
        reached[start] = True
        edge = reached
        while edge.any():
            edge = linked[edge].any(0) & ~reached
            reached |= edge
        waiting &= ~reached
        pairs += [(int(cls[start]), int(c)) for c in cls[reached] if c != cls[start]]
    return cls, links, copies, pairs


def _compare_all(least: float):
    def one(group: pa.Table) -> pa.RecordBatch | None:
        if len(group) < 2:
            return None
        cls, links, _, pairs = _compare(group, least)
        some = np.flatnonzero(links)
        m, k = len(some), len(pairs)
        return table(
            _FACTS,
            cls=[*cls[some].tolist(), *[None] * k],
            links=[*links[some].tolist(), *[None] * k],
            a=[*[None] * m, *(p[0] for p in pairs)],
            b=[*[None] * m, *(p[1] for p in pairs)],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            got = pa.Table.from_batches([batch])
            rest = got if rest is None else pa.concat_tables([rest, got])
            keys = [rest[k].to_numpy() for k in ("bucket", "x", "y")]
            ends = (np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1).tolist()
            for a, b in zip([0, *ends[:-1]], ends, strict=True) if ends else []:
                if (out := one(rest.slice(a, b - a))) is not None:
                    yield out
            rest = rest.slice(ends[-1]) if ends else rest
        if rest is not None and (out := one(rest)) is not None:
            yield out

    return run


def near_vectors(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (vec_id,
    label, embedding).

    Vectors link where labels and lengths are equal and the cosine is at least
    ``least``. Null labels and vectors, empty ones, zeros, null or non-finite parts
    link with nothing. Repeated rows are vectors of their own: they count as links
    of each other, and share id, component and ``kept``. A null id is never the
    smallest one. No rows: no rows. Other columns are not read.
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    clean = keep(rows.mapInArrow(_clean, _CLEAN_DDL), "vectors")
    used = clean.where("cls IS NOT NULL")
    classes = keep(used.groupBy("cls").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies")), "classes")
    one = used.join(classes, "cls").where(F.col("vec_id").eqNullSafe(F.col("first_id"))).dropDuplicates(["cls"])
    one = keep(one.select("cls", "label", "size", "copies", "unit"), "units")
    largest = one.groupBy("label", "size").agg(F.count("*").alias("n")).agg(F.max("n"), F.max("size")).first()
    n, size = largest[0] or 1, largest[1] or 2
    axes = 2 * max(2, 1 << (size - 1).bit_length())
    hashes = min(MOST_AXES, max(1, math.ceil(math.log(n * PROBES) / math.log(axes))))
    hashed = keep(one.mapInArrow(_hash(hashes, tables_needed(hashes, size, least)), _HASHED_DDL), "hashed")

    places = hashed.select("cls", F.explode("names").alias("bucket"))
    full = places.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    full = full.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = places.join(full, "bucket").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.select("bucket", "cls", "block", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"))
    dealt = dealt.join(hashed, "cls").repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
    facts = keep(dealt.mapInArrow(_compare_all(least), "cls bigint, links bigint, a bigint, b bigint"), "facts")

    links = facts.where("cls IS NOT NULL").groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(facts.where("cls IS NULL").select("a", "b"))
    named = classes.join(links, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.where("copies > 1 OR links > 0").withColumn("root", F.coalesce("root", "cls"))
    lowest = named.groupBy("root").agg(F.min("first_id").alias("lowest"))
    named = named.join(lowest, "root").select(
        "cls", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("lowest").alias("component_id")
    )
    out = clean.select("vec_id", "cls").join(named, "cls", "left")
    out = out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
