"""What the text operators share: word hashes, fixed-size sketches, staged tables.

Words are ``[^\\x20\\x09-\\x0D]+`` throughout. Hashes of words and shingles are 64
bits wide: two of m different values meet with probability below m*m / 2**65.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeweft.session import scratch, tune

U = np.uint64
SALTS = 64
_PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches bounded by bytes as well."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all others."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(_BASE))
for _upper in range(65, 91):
    _BYTE[_upper] = _BYTE[_upper + 32]
_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, _INVERSE)):
            step = np.full(max(n + 1, _PIECE + 4096), base, U)
            step[0] = 1
            _powers[k] = np.cumprod(step)
    return _powers[0][: n + 1], _powers[1][: n + 1]


def _hash_piece(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of some bytes, and where each word starts; words end at ``cuts``."""
    letter = ~_SPACE[raw]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    cuts = cuts[cuts < len(raw)]
    first[cuts] = letter[cuts]
    starts = np.flatnonzero(first)
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    before = cuts[cuts > 0] - 1
    last[before] = letter[before]
    ends = np.flatnonzero(last) + 1
    up, down = powers(len(raw))
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix(value + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93)), starts


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch, A-Z lower-cased, one text after the other,
    and the bounds of each text in them. Null is empty. Works through bounded
    pieces, cut between words."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, U), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin, end = int(at[0]), int(at[-1])
    hashes, places = [], []
    while begin < end:
        stop = min(begin + _PIECE, end)
        if stop < end:  # back to a space or the start of a text, else on to the next one
            back = raw[begin:stop]
            spaces = np.flatnonzero(_SPACE[back[-8192:]])
            k = int(np.searchsorted(at, stop, side="right")) - 1
            if len(spaces):
                stop = stop - min(8192, stop - begin) + int(spaces[-1]) + 1
            elif at[k] > begin:
                stop = int(at[k])
            else:
                while stop < end and not _SPACE[raw[stop]] and stop not in (int(at[k + 1]),):
                    stop += 1
        lo, hi = np.searchsorted(at, [begin, stop])
        h, s = _hash_piece(raw[begin:stop], at[lo:hi] - begin)
        hashes.append(h)
        places.append(s + begin)
        begin = stop
    if not hashes:
        return np.zeros(0, U), np.zeros(len(at), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), at)


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-word shingles of each text, as 64-bit hashes. A text
    of fewer words has its whole sequence as one; one without words has none."""
    words, bounds = word_hashes(texts)
    factors = [mix(np.array([k + 77], U))[0] | U(1) for k in range(n + 1)]
    runs = np.zeros(max(0, len(words) - n + 1), U)
    for k in range(n if len(runs) else 0):
        runs += words[k : len(words) - n + 1 + k] * factors[k]
    runs = mix(runs)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(runs[a : b - n + 1])
            keep_first = np.ones(len(s), bool)
            keep_first[1:] = s[1:] != s[:-1]
            out.append(s[keep_first])
        elif b > a:
            short = (words[a:b] * np.array(factors[: b - a], U)).sum(dtype=U, keepdims=True)
            out.append(mix(short + np.array([b - a], U) * factors[n]))
        else:
            out.append(np.zeros(0, U))
    return out


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


# --- sums of fixed size -------------------------------------------------------

CHUNK = "chunk int, salt int, part binary"


def pack(part: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(part.tobytes())


def _unpack(part: pa.BinaryScalar | bytes, dtype: str) -> np.ndarray:
    raw = part if isinstance(part, (bytes, bytearray)) else part.as_buffer()
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype)


def _folded(combine: Callable[[np.ndarray, np.ndarray], np.ndarray], dtype: str):
    schema = pa.schema([("chunk", pa.int32()), ("salt", pa.int32()), ("part", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, part in zip(batch["chunk"].to_pylist(), batch["part"], strict=True):
                part = _unpack(part, dtype)
                total[chunk] = combine(total[chunk], part) if chunk in total else part.copy()
        for chunk, part in total.items():
            yield table(schema, chunk=[chunk], salt=[0], part=[pack(part)])

    return run


def fold(parts: DataFrame, combine, dtype: str, size: int) -> np.ndarray:
    """Combine the sketches of all tasks, chunk by chunk, in two steps, so that no
    task streams through more than a part of them. What reaches the driver is one
    sketch of ``size`` numbers, whatever the input; without input it is zero."""
    run = _folded(combine, dtype)
    first = parts.select("chunk", "salt", "part").repartition("chunk", "salt").mapInArrow(run, CHUNK)
    rows = first.repartition("chunk").mapInArrow(run, CHUNK).collect()
    if not rows:
        return np.zeros(size, dtype)
    return np.concatenate([_unpack(r["part"], dtype) for r in sorted(rows, key=lambda r: r["chunk"])])


BITS = 26
_ROWS = 64


def seen_once(parts: DataFrame) -> np.ndarray:
    """Bits of the cells that values fell into; see :func:`bit_chunks`."""
    return fold(parts, np.bitwise_or, "u1", 1 << BITS >> 3)


def bit_chunks(values: np.ndarray) -> list[bytes]:
    """Which of 2**26 cells values fall into, in 64 chunks."""
    cells = np.unique((values >> U(64 - BITS)).astype(np.int64))
    plane = np.zeros(1 << BITS >> 3, np.uint8)
    np.bitwise_or.at(plane, cells >> 3, (1 << (cells & 7)).astype(np.uint8))
    return [pack(part) for part in plane.reshape(_ROWS, -1)]


def in_cells(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    cells = (values >> U(64 - BITS)).astype(np.int64)
    return (bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1


# --- connected components -----------------------------------------------------


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every end of ``links`` (a, b: long): the smallest node
    that links reach. Large-star and small-star steps over joins and partial
    aggregates; each round is a written table, so nothing is held by a task."""
    edges = keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")
        )
        edges = keep(small.select("e.*").where("u <> v").distinct(), name)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    low = edges.groupBy("u").agg(F.min("v").alias("root"))
    return keep(low.select(F.col("u").alias("node"), "root").union(low.select("root", "root").distinct()), name)
