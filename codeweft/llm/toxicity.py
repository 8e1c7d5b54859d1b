"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of toxic text, one on windows
of ordinary text. Each window of a document is compressed with both; the bytes that
the toxic one saves are its advantage. How often each advantage occurs in toxic and
in ordinary documents gives the weight of a window, and thresholds on a document's
sum of weights are calibrated on the labelled documents.

A window is one word in lower case, whose first letters are marked by upper case, so
that its beginning does not match the inside of another word. It stands between a
lead-in that both dictionaries end with and a tail, because zstandard stores very
short input as it is and starts no match in the last bytes.

What the toxic dictionary is trained on: labelled toxic text also is mostly ordinary.
Its windows are kept where a beginning of the word is far more frequent there than in
ordinary text, counted over distinct surroundings, so that copies count once. Trained
on all its windows, as the README says with figures, it told nothing apart.

Labelled documents in the held-out fold are never looked at. The fit takes at most
``SAMPLE`` documents of each class, those with the smallest hash of the id, once each
whatever the rows. Weights and threshold are calibrated on documents that the
dictionaries were not trained on: the sample is dealt into ``PARTS``, and the counts of
a part come from dictionaries of the others. Texts stay in the tasks, where words and
their surroundings are counted over whole texts; the driver gets at most ``WINDOWS``
words of each class to train on, of at most ``LONGEST`` characters, and eight counts
for each document to calibrate on.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeweft.llm.common import keep, table

SAMPLE = 3000
PARTS = 3
WINDOWS = 80_000
LONGEST = 64
DICTIONARY = 16_384
LEVEL = 1
FOLDS = 5
_WORD = re.compile(r"[^\W\d_]+")
_MARKED = 4
_LONGEST_START = 12
_STANDS_OUT = 8.0  # standard deviations
_LEAD = bytes(range(1, 9)) * 2
_TAIL = b" ~~~~~~~"
_LOW, _HIGH = 1, 8
_CACHE = 1_000_000
_SEEN = 5
_ROWS = 20_000


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]  # by advantage, from _LOW (and less) to _HIGH (and more)
    middle: float
    slope: float


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _window(word: str) -> bytes:
    return b" " + (word[:_MARKED].upper() + word[_MARKED:]).encode()


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    own = zstandard.ZstdCompressionDict(content + _LEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL,
        source_size=64,
        dict_size=DICTIONARY,
        min_match=4,
        write_checksum=0,
        write_content_size=0,
        write_dict_id=0,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    own.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=own, compression_params=settings)


class Distance:
    """The advantage of the toxic dictionary for words, each computed once."""

    def __init__(self, model: Model):
        self.toxic, self.ordinary = _compressor(model.toxic), _compressor(model.ordinary)
        self.inside = {model.toxic[k : k + 4] for k in range(len(model.toxic) - 3)}
        self.known: dict[str, int] = {}

    def of(self, word: str) -> int:
        """From _LOW to _HIGH. Without four bytes in common the toxic dictionary
        has nothing to match, so it has no advantage."""
        got = self.known.get(word)
        if got is None:
            window = _window(word)
            got = _LOW
            if any(window[k : k + 4] in self.inside for k in range(len(window) - 3)):
                whole = _LEAD + window + _TAIL
                saved = len(self.ordinary.compress(whole)) - len(self.toxic.compress(whole))
                got = max(_LOW, min(_HIGH, saved))
            if len(self.known) > _CACHE:
                self.known.clear()
            self.known[word] = got
        return got

    def counts(self, text: str) -> list[int]:
        """Windows of a text by their advantage."""
        out = [0] * (_HIGH - _LOW + 1)
        for word, times in Counter(_words(text)).items():
            out[self.of(word) - _LOW] += times
        return out


def _train(words: list[str]) -> bytes:
    """A dictionary's content; too little text is taken as it is."""
    samples = [b"".join(map(_window, words[k : k + 4])) for k in range(0, len(words), 4)]
    try:
        content = zstandard.train_dictionary(DICTIONARY, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        content = b"".join(samples)
    return content[-DICTIONARY:]


def _total(weights: tuple[float, ...], counts: list[int]) -> float:
    return sum(w * c for w, c in zip(weights, counts, strict=True))


NOTHING = Model(b"", b"", (0.0,) * (_HIGH - _LOW + 1), 40.0, 1.0)  # scores 0 throughout


def dictionaries(toxic: list[str], ordinary: list[str]) -> Model:
    """Two dictionaries of given words, without weights."""
    return Model(_train(toxic), _train(ordinary), (), 0.0, 1.0)


def calibrated(blank: Model, rows: list[tuple[list[int], int]]) -> Model:
    """Weights of advantages, threshold and slope from the counts of documents. An
    advantage seen fewer than ``_SEEN`` times has the weight of the one below it."""
    sums = {label: [sum(c) + 1 for c in zip(*(c for c, own in rows if own == label), strict=True)] for label in (0, 1)}
    weights: tuple[float, ...] = ()
    for t, o in zip(sums[1], sums[0], strict=True):
        own = math.log(t / sum(sums[1])) - math.log(o / sum(sums[0]))
        weights += (weights[-1] if weights and t + o - 2 < _SEEN else own,)
    middle, slope = _calibrate([(_total(weights, counts), label) for counts, label in rows])
    return Model(blank.toxic, blank.ordinary, weights, middle, slope)


def _calibrate(rows: list[tuple[float, int]]) -> tuple[float, float]:
    """The threshold with the fewest errors on the labelled documents, in the middle
    of the best gap, and the slope at which scores fit the labels best."""
    rows = sorted(rows)
    wrong = sum(1 - label for _, label in rows)  # all above the threshold
    best, middle = wrong, rows[0][0] - 1.0
    for k, (value, label) in enumerate(rows):
        wrong += 1 if label else -1
        after = rows[k + 1][0] if k + 1 < len(rows) else value + 2.0
        if wrong < best and after > value:
            best, middle = wrong, (value + after) / 2

    def loss(slope: float) -> float:
        out = 0.0
        for value, label in rows:
            x = max(-30.0, min(30.0, slope * (value - middle)))
            out += math.log1p(math.exp(-x if label else x))
        return out

    return middle, min((0.1, 0.2, 0.35, 0.5, 0.75, 1.0, 1.5, 2.0), key=loss)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Documents whose labels are not learnt from; a null id is among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS, F.lit(0)) == 0


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, toxic, part, text`` of at most ``SAMPLE`` documents of each class out
    of the held-out fold, as a written table, a row per id: of several texts the least.
    A document with several labels is toxic if one says so; null labels are ignored."""
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out())
    known = known.withColumn("turn", F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)))
    picked = [known.where(F.col("toxic") == k).orderBy("turn", "doc_id").limit(SAMPLE) for k in (0, 1)]
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)), F.lit(PARTS))
    ids = picked[0].union(picked[1]).select("doc_id", "toxic", part.alias("part"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    rows = rows.join(F.broadcast(ids), "doc_id")  # 2 * SAMPLE rows at most
    return keep(rows.groupBy("doc_id", "toxic", "part").agg(F.min("text").alias("text")), "toxicity_sample")


_SPOT = pa.schema([("toxic", pa.int32()), *((n, pa.string()) for n in ("before", "word", "after"))])


def _spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word of every text with its two neighbours."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return table(_SPOT, **dict(zip(_SPOT.names, zip(*rows, strict=True), strict=True)))

    held: list[tuple] = []
    for batch in batches:
        for toxic, text in zip(batch["toxic"].to_pylist(), batch["text"].to_pylist(), strict=True):
            before = word = ""
            for match in chain(_WORD.finditer(text.lower()), (None,)):
                after = match[0][:LONGEST] if match else ""
                if word:
                    held.append((toxic, before, word, after))
                before, word = word, after
                if len(held) >= _ROWS:
                    yield out(held)
                    held = []
    if held:
        yield out(held)


def _telling(spots: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``word``: words of which a beginning stands out among toxic surroundings."""
    words = spots.groupBy("word").agg(F.sum("toxic").alias("own"), F.count("*").alias("both"))
    words = words.where(F.length("word") >= _MARKED)
    lengths = F.sequence(F.lit(_MARKED), F.least(F.length("word"), F.lit(_LONGEST_START)))
    begun = words.select("word", "own", "both", F.explode(F.transform(lengths, lambda k: F.substring("word", F.lit(1), k))).alias("start"))
    starts = begun.groupBy("start").agg(F.sum("own").alias("own"), F.sum("both").alias("both"))
    share = sizes[1] / (sizes[0] + sizes[1])
    far = F.col("own") - F.col("both") * share > _STANDS_OUT * F.sqrt(F.col("both") * share * (1 - share))
    return begun.select("word", "start").join(starts.where(far & (F.col("own") >= 5)).select("start"), "start").select("word").distinct()


def training_words(texts: DataFrame) -> tuple[list[str], list[str]] | None:
    """The words of toxic and of ordinary windows to train on, of a sample; None
    without words of both classes. Each distinct surrounding of a word counts once."""
    spots = keep(texts.select("toxic", "text").mapInArrow(_spots, "toxic int, before string, word string, after string").distinct(), "spots")
    sizes = {r.toxic: r.n for r in spots.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    telling = keep(_telling(spots, sizes), "telling")
    sides = []
    for toxic, how in ((1, "left_semi"), (0, "left_anti")):
        own = spots.where(F.col("toxic") == toxic).join(telling, "word", how)
        turn = F.xxhash64("before", "word", "after")
        rows = own.select("word", turn.alias("turn"), "before", "after").orderBy("turn", "word", "before", "after").limit(WINDOWS)
        sides.append([r.word for r in rows.select("word").collect()])
    return sides[0], sides[1]


_COUNTED = pa.schema([("toxic", pa.int32()), ("counts", pa.list_(pa.int64()))])


def _counter(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model)
        for batch in batches:
            yield table(_COUNTED, toxic=batch["toxic"], counts=[distance.counts(t) for t in batch["text"].to_pylist()])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train and calibrate on the sample. Where a part leaves no words of both classes
    to train on, as in very small tables, its documents are counted with dictionaries of
    the whole sample; with a class missing there is nothing to tell apart, and every
    score is 0."""
    texts = sample(docs, labels)
    words = training_words(texts)
    if words is None:
        return NOTHING
    whole = dictionaries(*words)
    counted = []
    for part in range(PARTS):
        others = training_words(texts.where(F.col("part") != part))
        blank = dictionaries(*others) if others else whole
        rows = texts.where(F.col("part") == part).select("toxic", "text")
        rows = rows.mapInArrow(_counter(blank), "toxic int, counts array<bigint>").collect()
        counted += [(list(r.counts), r.toxic) for r in rows]
    return calibrated(whole, sorted(counted))


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score_texts(model: Model, texts: list[str | None], distance: Distance) -> list[float]:
    out = []
    for text in texts:
        x = model.slope * (_total(model.weights, distance.counts(text or "")) - model.middle)
        out.append(1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, x)))))
    return out


def _scorer(model: Model, schema: pa.Schema, keep_rows: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model)
        for batch in batches:
            scores = score_texts(model, batch["text"].to_pylist(), distance)
            if keep_rows:
                yield batch.filter(pa.array([s < 0.5 for s in scores], pa.bool_()))
            else:
                yield table(schema, doc_id=batch["doc_id"], score=scores)

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    The score is between 0 and 1, from the text alone. Null and empty texts have no
    windows and get the score of that. Repeated rows get equal scores. Other columns
    are not read. Without labels of both classes every score is near 0.
    """
    model = fit(docs, labels)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = texts.mapInArrow(_scorer(model, _SCORED, False), "doc_id bigint, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, as they are."""
    model = fit(docs, labels)
    return docs.mapInArrow(_scorer(model, _SCORED, True), docs.schema)
