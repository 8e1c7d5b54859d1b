"""Pack token pieces into sequences: match large items, best-fit small ones.

There are only as many different lengths as a sequence has tokens, so the packing
is planned on the histogram of lengths: runs that say which sequences take how many
items of a length, at which offset. Pieces find their run by their rank among the
pieces of their length. The plan's size depends on the capacity alone.

Items above a third of the capacity fit in at most twice. From the largest down, each
is matched with the largest that still fits beside it. The rest, from the largest
down, go where the gap left is smallest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeweft.llm.common import U, keep, mix, powers, table

CAPACITY = 1024
END = 2
_CACHE = 2_000_000
_PIECE = 1 << 20
_tokenizers: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts, exactly as the tokenizer gives them for the whole text.

    A pre-tokenizer of this family never reaches over a single space between two
    visible characters, so texts are cut before such spaces, and each part is
    encoded once. Parts are known by a 64-bit hash of their bytes; what is
    remembered is bounded. Cuts are made only beside characters that are surely
    visible; elsewhere parts are longer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        vocabulary = self.model.get_vocab()
        # One character of a token's name stands for one byte.
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.width[list(vocabulary.values())] = [len(name) for name in vocabulary]
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, U)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, and the bounds of each in them; parts start with a space,
        or are encoded one by one."""
        out, sizes = [], []
        for start in range(0, len(parts), 2000):
            some = parts[start : start + 2000]
            got = self.model.encode_batch_fast([b"".join(some).decode()], add_special_tokens=False)[0].ids
            ids = np.array(got, np.uint32)
            ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(p) for p in some]), side="left") + 1
            out.append(ids)
            sizes.append(np.diff(ends, prepend=0))
        return np.concatenate(out), np.concatenate(sizes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a batch, one text after the other, and the bounds of texts."""
        texts = texts.fill_null("").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        at = at - at[0]
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        starts = _part_starts(raw, at)
        hashes = _part_hashes(raw, starts)
        names, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(names) > _CACHE:
            self._forget()
        place = np.searchsorted(self.known, names)
        new = np.ones(len(names), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != names[inside]
        if new.any():
            ends = np.append(starts[1:], len(raw))
            view = memoryview(raw)
            begins = starts[first[new]]
            plain = raw[begins] != 0x20  # the first part of a text
            parts = [bytes(view[a:b]) for a, b in zip(begins.tolist(), ends[first[new]].tolist(), strict=True)]
            size = np.zeros(len(parts), np.int64)
            pieces: list[np.ndarray] = [None] * len(parts)
            spaced = np.flatnonzero(~plain)
            if len(spaced):
                ids, sizes = self._learn([parts[k] for k in spaced])
                size[spaced] = sizes
                for k, got in zip(spaced.tolist(), np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                    pieces[k] = got
            for k in np.flatnonzero(plain).tolist():
                pieces[k] = np.array(self.model.encode(parts[k].decode(), add_special_tokens=False).ids, np.uint32)
                size[k] = len(pieces[k])
            begin = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate([self.ids, *pieces])
            self.known = np.insert(self.known, place[new], names[new])
            self.at = np.insert(self.at, place[new], begin)
            self.size = np.insert(self.size, place[new], size)
            place = np.searchsorted(self.known, names)
        size, begin = self.size[place][inverse], self.at[place][inverse]
        ends = np.cumsum(size)
        total = int(ends[-1])
        ids = self.ids[np.repeat(begin - (ends - size), size) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.searchsorted(starts, at)]
        return ids, bounds


def _part_starts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where parts start: texts, and spaces between characters that are visible:
    of ASCII, or of two or three bytes in blocks that hold no white space."""
    spaces = np.flatnonzero(raw == 0x20)
    spaces = spaces[(spaces > 2) & (spaces < len(raw) - 1)]
    before, after = raw[spaces - 1], raw[spaces + 1]
    good = (before > 0x20) & (before < 0x7F)
    good |= (before >= 0x80) & _TWO[raw[spaces - 2]]
    good |= (before >= 0x80) & _THREE[raw[spaces - 3]] & (raw[spaces - 2] >= 0x80) & (raw[spaces - 2] < 0xC0)
    good &= ((after > 0x20) & (after < 0x7F)) | _TWO[after] | _THREE[after]
    bounds = at[:-1][at[:-1] < at[1:]]
    # A text's first and last character have no neighbour on one side.
    edge = np.isin(spaces, at) | np.isin(spaces + 1, at)
    return np.union1d(spaces[good & ~edge], bounds)


_TWO, _THREE = np.zeros(256, bool), np.zeros(256, bool)
_TWO[0xC3:0xE0] = True
_THREE[[0xE0, *range(0xE4, 0xEE)]] = True
_RAW = mix(np.arange(1001, 1257, dtype=U) * U(0x9E3779B97F4A7C15))


def _part_hashes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from each start to the next."""
    ends = np.append(starts[1:], len(raw))
    out = np.zeros(len(starts), U)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + _PIECE, side="right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        up, down = powers(b - a)
        sums = np.zeros(b - a + 1, U)
        np.cumsum(_RAW[raw[a:b]] * up[: b - a], out=sums[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        out[lo:hi] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))
        lo = hi
    return out


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary files are; they are on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> Encoder:
    if path not in _tokenizers:
        _tokenizers[path] = Encoder(path)
    return _tokenizers[path]


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
        ("task", pa.int32()),
        ("nth", pa.int64()),
    ]
)
_PIECES_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, task int, nth bigint"


def _pieces(path: str, capacity: int, with_ids: bool):
    """Pieces of documents; ``nth`` counts the pieces of a length within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, counts, tok = TaskContext.get().partitionId(), [0] * (capacity + 1), encoder(path)
        end = np.array([END], np.uint32)
        for batch in batches:
            columns: dict[str, list] = {f.name: [] for f in _PIECES}
            ids, bounds = tok.encode(batch["text"])
            for doc_id, a, b in zip(batch["doc_id"].to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = np.concatenate([ids[a:b], end]).astype("<u4", copy=False)
                total, start = len(own), 0
                for piece, stop in enumerate(range(total % capacity or capacity, total + 1, capacity)):
                    part = own[start:stop].tobytes()
                    row = (doc_id, piece, start, stop - start, zlib.crc32(part), part if with_ids else None, task, counts[stop - start])
                    for name, value in zip(columns, row, strict=True):
                        columns[name].append(value)
                    counts[stop - start] += 1
                    start = stop
            yield table(_PIECES, **columns)

    return run


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, items, first sequence, items per sequence, offset).

    Item number i of a run goes to sequence ``first + i // per``, at ``offset +
    (i % per) * length``.
    """
    left = {s: c for s, c in histogram.items() if c}
    rank = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, how many)
    fresh = 0

    def place(size: int, items: int, first: int, per: int, gap: int) -> None:
        runs.append((size, rank[size], items, first, per, capacity - gap))
        rank[size] += items
        left[size] -= items

    large = [s for s in sorted(left, reverse=True) if 3 * s > capacity]
    for size in large:
        while left[size]:
            mate = next((t for t in large if t <= capacity - size and left[t] and (t != size or left[t] > 1)), None)
            if mate is None:
                many = left[size]
                place(size, many, fresh, 1, capacity)
                rest = capacity - size
            elif mate == size:
                many = left[size] // 2
                place(size, 2 * many, fresh, 2, capacity)
                rest = capacity - 2 * size
            else:
                many = min(left[size], left[mate])
                place(size, many, fresh, 1, capacity)
                place(mate, many, fresh, 1, capacity - size)
                rest = capacity - size - mate
            gaps.setdefault(rest, []).append((fresh, many))
            fresh += many
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            gap = min((g for g in gaps if g >= size), default=None)
            if gap is None:
                many = -(-left[size] // (capacity // size))
                gap, gaps[capacity] = capacity, [(fresh, many)]
                fresh += many
            first, many = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
            per = gap // size
            full = min(many, left[size] // per)
            if full:
                place(size, full * per, first, per, gap)
                gaps.setdefault(gap - per * size, []).append((first, full))
            if full < many:
                rest = left[size] if left[size] < per else 0
                if rest:
                    place(size, rest, first + full, rest, gap)
                    gaps.setdefault(gap - rest * size, []).append((first + full, 1))
                unused = many - full - (rest > 0)
                if unused:
                    gaps.setdefault(gap, []).append((first + full + (rest > 0), unused))
    return runs


_PLACED = pa.schema([*((_f.name, _f.type) for _f in _PIECES if _f.name not in ("task", "nth")), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _placed(runs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, start, _, first, per, offset = np.array(sorted(runs.value), np.int64).reshape(-1, 6).T
        keys = (size << 44) | start
        for batch in batches:
            length, rank = np.asarray(batch["length"]), np.asarray(batch["rank"])
            k = np.searchsorted(keys, (length << 44) | rank, side="right") - 1
            i = rank - start[k]
            own = [batch[name] for name in _PLACED.names[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(first[k] + i // per[k]), pa.array(offset[k] + i % per[k] * length)], schema=_PLACED
            )

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``, and the ids themselves on request.

    Null and empty texts are the end mark alone. Repeated rows are packed each on
    its own. A null id stays null. No rows: no rows. Other columns are not read.
    Ranks are fixed when the pieces are written, so the plan holds however often
    tasks run again. ``rank`` may use 44 bits.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = keep(texts.mapInArrow(_pieces(tokenizer, capacity, with_ids), _PIECES_DDL), "pieces")
    counts = keep(pieces.groupBy("task", "length").agg(F.count("*").alias("items")), "counts")
    totals = {r["length"]: r["items"] for r in counts.groupBy("length").agg(F.sum("items").alias("items")).collect()}
    runs = docs.sparkSession.sparkContext.broadcast(plan(totals, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("items").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["task", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    names = _PLACED.names[:-2]
    ddl = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, sequence_id bigint, offset bigint"
    out = ranked.select(*names, "rank").mapInArrow(_placed(runs), ddl)
    return out if with_ids else out.drop("ids")
