"""Quality rules: countable faults, and how much a text looks like trusted ones.

Words, word pairs and word endings are hashed into ``BUCKETS``. Two multinomials are
counted, over the n-grams of trusted documents and over those of all documents. A
document's score is the mean log-likelihood ratio of its n-grams, so length does
not count. It is kept at or above a threshold that follows from the scores of the
trusted documents, found from counts of rounded scores; nothing is random.

All of it is built-in functions. A step whose result is used twice is bound to a name
by a lambda over an array of one, so that it is evaluated once.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeweft.llm.common import keep

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
BUCKETS = 1 << 14
SPARED = 0.995
_WINDOW = 8
_SMOOTH = 1.0
_ROUND = 4
_FEW = 1_000_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def _pairs(h: Column, apart: int) -> Column:
    """Hashes of an array's items combined with those ``apart`` places on."""
    return F.when(
        F.size(h) > apart,
        F.transform(F.slice(h, 1, F.size(h) - apart), lambda x, i: F.xxhash64(x, F.get(h, i + apart))),
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """How many words lie in windows whose hash occurs again."""

    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    repeated = let(
        placed,
        lambda p: F.array_sort(
            F.transform(
                F.filter(
                    p,
                    lambda x, i: F.coalesce(F.get(p, i - 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False)),
                ),
                lambda x: x["at"],
            )
        ),
    )
    return F.aggregate(
        repeated,
        F.struct(F.lit(0).alias("words"), F.lit(0).alias("end")),
        lambda acc, at: F.struct(
            (acc["words"] + at + _WINDOW - F.greatest(acc["end"], at)).alias("words"), (at + _WINDOW).alias("end")
        ),
    )["words"].cast("bigint")


def _repeat_words(words: Column) -> Column:
    """Words in windows of eight that occur twice or more in the text."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    windows = let(let(let(hashed, lambda h: _pairs(h, 1)), lambda h: _pairs(h, 2)), lambda h: _pairs(h, 4))
    return let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(_covered(w)),
    )


def _grams(words: Column) -> Column:
    """Buckets of words, pairs of words and word endings."""

    def bucket(h: Column) -> Column:
        return F.pmod(h, F.lit(BUCKETS)).cast("int")

    own = F.transform(words, lambda w: F.xxhash64(w))
    ends = F.transform(words, lambda w: bucket(F.xxhash64(F.right(w, F.lit(3)), F.lit(1))))
    return F.concat(let(own, lambda h: F.transform(F.concat(h, _pairs(h, 1)), bucket)), ends)


def _words(text: str = "text") -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))


def log_ratios(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """The log-likelihood ratio of each bucket, counted over all documents; all zero
    where nothing is trusted. What is collected has a row for each bucket."""
    marked = _with_trust(docs.select("doc_id", "text"), trusted)
    grams = marked.select("trusted", F.explode(_grams(_words())).alias("bucket"))
    rows = grams.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("trusted").alias("t")).collect()
    n = {r["bucket"]: r["n"] for r in rows}
    t = {r["bucket"]: r["t"] for r in rows}
    all_n, all_t = sum(n.values()) + _SMOOTH * BUCKETS, sum(t.values()) + _SMOOTH * BUCKETS
    if not any(t.values()):
        return [0.0] * BUCKETS
    return [
        math.log((t.get(b, 0) + _SMOOTH) / all_t) - math.log((n.get(b, 0) + _SMOOTH) / all_n) for b in range(BUCKETS)
    ]


def _with_trust(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """``rows`` with ``trusted``; the ids are broadcast only where they are few."""
    ids = trusted.select(F.col("doc_id").alias("trusted_id"), F.lit(True).alias("trusted"))
    if len(ids.select(F.lit(1)).take(_FEW + 1)) <= _FEW:
        ids = F.broadcast(ids)
    out = rows.join(ids, rows["doc_id"] == ids["trusted_id"], "left").drop("trusted_id")
    return out.withColumn("trusted", F.coalesce("trusted", F.lit(False)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents whose label says that they are good; one such label is enough."""
    return labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()


def measures(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """Counts and score of every row."""
    weights = F.from_json(F.lit("[" + ",".join(map(repr, ratios)) + "]"), "array<double>")
    score = let(
        _grams(F.col("words")),
        lambda g: F.aggregate(g, F.lit(0.0), lambda acc, b: acc + F.get(weights, b)) / F.size(g),
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))
    return docs.select("doc_id", "text", _words().alias("words")).select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("bigint"), lambda acc, w: acc + F.length(w)).alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        F.when(F.size("words") > 0, score).alias("score"),
    )


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, score`` for every row of ``docs``.

    Null and empty texts have no words, fail the base rules and have a null score.
    Repeated rows are judged alike, and count each. Without trusted documents all
    scores are 0 and the base rules decide. Other columns are not read.
    """
    trusted = trusted_ids(labels)
    ratios = log_ratios(docs, trusted)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = keep(measures(docs, ratios).withColumn("base_failed", failed), "measures")
    good = _with_trust(rows.where("NOT base_failed"), trusted).where("trusted")
    floor = threshold(good)
    kept = ~F.col("base_failed") & (F.round("score", _ROUND) >= floor)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "score"
    )


def threshold(good: DataFrame) -> float:
    """As far below the score that ``SPARED`` of ``good`` reach as that is below their
    median. Rounded scores lie within a few nats, so there are at most some 100,000
    different ones."""
    bins = good.groupBy(F.round("score", _ROUND).alias("score")).agg(F.count("*").alias("n")).collect()
    total, below = sum(r["n"] for r in bins), 0
    low = median = None
    for r in sorted(bins, key=lambda r: r["score"]):
        below += r["n"]
        if low is None and below > (1 - SPARED) * total:
            low = r["score"]
        if median is None and 2 * below >= total:
            median = r["score"]
    return -math.inf if low is None else 2 * low - median
