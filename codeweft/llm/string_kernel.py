"""Language identification with string kernels.

Texts are cut into windows of ``WINDOW`` characters. The kernel of two windows is how
many n-grams of 1 to ``LONGEST`` characters both hold, each counted once, over the
geometric mean of how many either holds (a blended-spectrum presence kernel). N-grams
are of lower-case letters, with one mark for any run of other characters, and are
hashed to ``FEATURES`` values.

Nystroem: some windows of the training sample are landmarks. The kernel against them,
times the inverse root of the landmarks' own kernel matrix, maps a window to a vector,
and ridge regression of +1 and -1 on these vectors gives one function a language.
Scoring multiplies matrices for many windows at once: presence by landmarks gives the
kernel, the kernel by coefficients the outputs. A text's output is the mean over all
its windows, weighted by their letters.

The fit sees a bounded sample: of each language ``SAMPLE`` different texts, those with
the smallest hash, and of each text ``SPREAD`` windows, evenly spread; ``LANDMARKS`` of
all windows are landmarks. Windows are cut in tasks, so no whole text reaches the
driver. Texts of the held-out fold and without a language are never looked at.

Odd rows: texts that are null or have no letter are ``und`` with score 0, and so is
all where nothing can be learnt. Rows are scored one by one, repeated ids too; a row
with a null id is held out. Of other columns none is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeweft.llm.common import keep, table

WINDOW = 1024
LONGEST = 4
FEATURES = 1 << 14
SAMPLE = 300
SPREAD = 4
LANDMARKS = 192
RIDGE = 1e-3
FOLDS, OUT = 4, 2
UNKNOWN = "und"
_PIECE = WINDOW << 10
_ROWS = 256
_PARTS = 64
_M = np.uint32(0x9E3779B1)


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(k).isalpha() for k in range(0x110000)), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def marked(text: str) -> np.ndarray:
    """Code points of the letters in lower case, any run of others being one 0; there
    is one at both ends."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    first = letter.copy()
    first[1:] |= letter[:-1]
    first[0] = True
    return np.where(letter, points, np.uint32(0))[first]


def grams(points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each length n, the features of all n-grams, by where they start."""
    h = np.zeros(len(points), np.uint32)
    for n in range(1, LONGEST + 1):
        if len(points) < n:
            return
        h = (h[: len(points) - n + 1] + points[n - 1 :] + np.uint32(n)) * _M
        h ^= h >> np.uint32(15)
        yield n, (h * np.uint32(0x85EBCA77)) >> np.uint32(32 - FEATURES.bit_length() + 1)


def presence(windows: list[np.ndarray]) -> np.ndarray:
    """A row of zeros and ones per window."""
    out = np.zeros((len(windows), FEATURES), np.float32)
    points = np.concatenate(windows)
    owner = np.repeat(np.arange(len(windows)), [len(w) for w in windows])
    for n, feature in grams(points):
        same = owner[: len(feature)] == owner[n - 1 :]
        if n == 1:
            same &= points > 0
        out[owner[: len(feature)][same], feature[same]] = 1
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    """Presence rows of length 1, so that products are kernels."""
    return rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))


def cut(text: str) -> Iterator[np.ndarray]:
    """All windows of a text that have letters."""
    for start in range(0, len(text), _PIECE):
        piece = text[start : start + _PIECE]
        for k in range(0, len(piece), WINDOW):
            points = marked(piece[k : k + WINDOW])
            if points.any():
                yield points


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    landmarks: bytes  # bits of presence
    coefficients: np.ndarray  # landmarks x languages
    offset: np.ndarray

    def matrix(self) -> np.ndarray:
        """Features by landmarks, of length 1 each."""
        bits = np.frombuffer(self.landmarks, np.uint8).reshape(-1, FEATURES // 8)
        return np.ascontiguousarray(unit(np.unpackbits(bits, axis=1).astype(np.float32)).T)


def kernel(windows: list[np.ndarray], landmarks: np.ndarray) -> np.ndarray:
    """Windows by landmarks, in blocks of bounded size."""
    blocks = [unit(presence(windows[k : k + _ROWS])) @ landmarks for k in range(0, len(windows), _ROWS)]
    return np.concatenate(blocks).astype(np.float64)


def train(sample: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Fit on (language, window) pairs; None if there is no window with letters."""
    rows = [(name, points) for name, text in sample if (points := marked(text)).any()]
    names = tuple(sorted({name for name, _ in rows}, key=str.encode))
    if not names:
        return None
    by_name = {name: [w for own, w in rows if own == name] for name in names}
    share = max(1, landmarks // len(names))
    chosen = [w for name in names for w in by_name[name][:: max(1, -(-len(by_name[name]) // share))]]
    bits = np.concatenate([np.packbits(presence(chosen[k : k + _ROWS]).astype(bool), axis=1) for k in range(0, len(chosen), _ROWS)])
    blank = Model(names, bits.tobytes(), np.zeros((len(chosen), len(names))), np.zeros(len(names)))
    matrix = blank.matrix()
    values, vectors = np.linalg.eigh(kernel(chosen, matrix))
    use = values > 1e-6 * values[-1]
    root = vectors[:, use] / np.sqrt(values[use])
    mapped = np.concatenate([kernel(by_name[name], matrix) for name in names]) @ root
    own = np.repeat(np.arange(len(names)), [len(by_name[name]) for name in names])
    weight = 1.0 / (len(names) * np.bincount(own))[own]  # all languages count alike
    wanted = np.where(own[:, None] == np.arange(len(names)), 1.0, -1.0)
    middle, mean = weight @ mapped, weight @ wanted
    x, y = mapped - middle, wanted - mean
    beta = np.linalg.solve((x * weight[:, None]).T @ x + ridge * np.eye(x.shape[1]), (x * weight[:, None]).T @ y)
    return Model(names, bits.tobytes(), root @ beta, mean - middle @ beta)


class Scorer:
    """Languages of texts, many windows at a time."""

    def __init__(self, model: Model | None):
        self.model = model
        self.landmarks = model.matrix() if model else None

    def outputs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The weighted sums of outputs of each text, and the sums of weights."""
        model = self.model
        sums, weights = np.zeros((len(texts), len(model.names))), np.zeros(len(texts))
        block: list[tuple[int, np.ndarray]] = []

        def add() -> None:
            owner = np.array([k for k, _ in block])
            letters = np.array([np.count_nonzero(w) for _, w in block], float)
            found = kernel([w for _, w in block], self.landmarks) @ model.coefficients + model.offset
            np.add.at(sums, owner, found * letters[:, None])
            np.add.at(weights, owner, letters)
            block.clear()

        for k, text in enumerate(texts):
            for window in cut(text or ""):
                block.append((k, window))
                if len(block) == _ROWS:
                    add()
        if block:
            add()
        return sums, weights

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if self.model is None:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        sums, weights = self.outputs(texts)
        means = sums / np.maximum(weights, 1)[:, None]
        best = means.argmax(axis=1)
        scores = np.clip((means[np.arange(len(texts)), best] + 1) / 2, 0, 1)
        known = weights > 0
        return [self.model.names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, scores, 0.0).tolist()


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Documents that are not learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS, F.lit(OUT)) == OUT


_WINDOWS = pa.schema([("lang", pa.string()), ("digest", pa.int64()), ("windows", pa.list_(pa.string()))])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch["text"].to_pylist():
            step = max(1, -(-max(1, -(-len(text) // WINDOW)) // SPREAD)) * WINDOW
            out.append([text[k : k + WINDOW] for k in range(0, len(text), step)])
        yield table(_WINDOWS, lang=batch["lang"], digest=batch["digest"], windows=out)


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    """Windows to learn from, with their languages. Texts are made distinct before
    they are chosen, so copies count once."""
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    known = known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.withColumn("digest", F.xxhash64("text"))
    chosen = known.select("lang", "digest").distinct().withColumn("part", F.pmod("digest", F.lit(_PARTS)))
    for by in (["lang", "part"], ["lang"]):  # a language's texts never meet in one task, only the first of each part
        order = Window.partitionBy(*by).orderBy("digest")
        chosen = chosen.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= SAMPLE)
    chosen = keep(chosen.select("lang", "digest"), "language_sample")
    rows = known.join(F.broadcast(chosen), ["lang", "digest"]).mapInArrow(_spread, "lang string, digest bigint, windows array<string>")
    rows = rows.groupBy("lang", "digest").agg(F.min("windows").alias("windows"))
    return sorted((r["lang"], w) for r in rows.toLocalIterator() for w in r["windows"])


_PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            names, scores = scorer.predict(batch["text"].to_pylist())
            yield table(_PREDICTED, doc_id=batch["doc_id"], lang_pred=names, score=scores)

    return run


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``."""
    model = train(sample(docs))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = texts.mapInArrow(_predict(model), "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
