"""How sources of a language differ: by pairs of sources, and by telling terms.

Each group, a source of a language, has a smoothed share ``p`` of every kept term of
the language; a term it lacks has its zero baseline, the same for all of them. Two
groups are as far apart as their shares are, summed over all kept terms.

Pairs are summed by row accumulation: a term-major index lists which groups hold a
term. Each group scatters its own terms through the index into a dense accumulator
with a cell for each peer, so no pair of postings becomes a row. That sees only terms
which both hold. The rest is what zero baselines give: a group's terms against the
peer's baseline, from running sums over its sorted shares, and a constant for terms
that neither holds. With ``z`` for baselines and sums over

    terms of g:  |p_g - z_h|          terms of h:  |z_g - p_h|
    of both:     |p_g - p_h| - |p_g - z_h| - |z_g - p_h| + |z_g - z_h|
    all terms:   |z_g - z_h|, less those of g and those of h

the total is exact in integers.

A task holds a block of terms and two tiles of at most ``TILE`` groups. Blocks have
about as many postings as a tile has pairs, so that what tasks emit is never more
than they read, and all postings of a language or a group never meet in one task.

Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased; a language keeps
those in at least ``LEAST`` of its documents.

Odd rows: null text, lang and source are ''. Documents are rows, also where ids
repeat; ids are not read. Groups without terms, or languages without kept terms, keep
their rows, the latter with distance 0. A task holds the distinct terms of one text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeweft.llm.common import keep, table

LEAST = 30
SCALE = 1_000_000_000
ADDED = 5
TOP = 50
TILE = 1024
_BLOCK = 1 << 15
_ENTRIES = 200_000
_PIECE = 1 << 20
_ROWS = 50_000
#: ASCII that is no letter becomes a space, A-Z become a-z, all other bytes stay.
_LETTERS = bytes(b if b > 127 or chr(b).isalpha() and chr(b).islower() else b + 32 if chr(b).isalpha() else 32 for b in range(256))


# --- counts ---------------------------------------------------------------------


def _terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, piece by piece."""
    start = 0
    while start < len(raw):
        clean = raw[start : start + _PIECE].translate(_LETTERS)
        if start + _PIECE < len(raw):
            cut = clean.rfind(b" ")
            while cut < 0:  # one term is longer than a piece
                more = raw[start + len(clean) : start + len(clean) + _PIECE]
                if not more:
                    break
                clean += more.translate(_LETTERS)
                cut = clean.find(b" ")
            clean = clean if cut < 0 else clean[: cut + 1]
        yield clean.split()
        start += len(clean)


_COUNT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("cnt", pa.int64()), ("docs", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents by group and term, added up within the task and
    handed on before they fill its memory. The term '' says that a group occurs."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in found.items():
            terms = [b"", *times]
            for k in range(0, len(terms), _ROWS):
                some = terms[k : k + _ROWS]
                yield table(
                    _COUNT,
                    lang=[lang] * len(some),
                    source=[source] * len(some),
                    term=pa.array(some, pa.binary()).view(pa.string()),
                    cnt=[times[t] for t in some],
                    docs=[docs[t] for t in some],
                )
        found.clear()

    held = 0
    for batch in batches:
        keys = zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True)
        for key, raw in zip(keys, batch["text"].cast(pa.binary()), strict=True):
            times, docs = found.setdefault(key, (Counter(), Counter()))
            before, own = len(times), set()
            for words in _terms(raw.as_py()):
                times.update(words)
                own.update(words)
            docs.update(own)
            held += len(times) - before + 1
            if held > _ENTRIES:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, cnt, docs`` as a written table."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    parts = docs.select(*columns).mapInArrow(_count, "lang string, source string, term string, cnt bigint, docs bigint")
    return keep(parts.groupBy("lang", "source", "term").agg(F.sum("cnt").alias("cnt"), F.sum("docs").alias("docs")), "term_counts")


def _share(cnt: str, size: str, terms: str) -> Column:
    """``1 + floor(SCALE * (cnt + ADDED) / (size + ADDED * terms))``, without overflow."""
    return F.expr(
        f"1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({cnt} + {ADDED} AS DECIMAL(20,0)))"
        f" div CAST({size} + {ADDED} * {terms} AS DECIMAL(20,0))"
    )


def group_shares(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two written tables. ``lang, source, g, held, zero, terms, tiles, blocks`` has a
    row per group, numbered within its language; ``lang, source, g, term, p, q`` the
    shares of the terms it holds, ``q`` being the language's."""
    every = term_counts(docs)
    kept = every.where("term <> ''").groupBy("lang", "term").agg(F.sum("cnt").alias("total"), F.sum("docs").alias("docs"))
    kept = keep(kept.where(F.col("docs") >= LEAST).drop("docs"), "kept_terms")
    rows = keep(every.drop("docs").join(kept, ["lang", "term"]), "kept_counts")
    languages = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("all"))
    sizes = rows.groupBy("lang", "source").agg(F.sum("cnt").alias("size"), F.count("*").alias("held"))
    groups = every.where("term = ''").select("lang", "source").join(sizes, ["lang", "source"], "left")
    groups = groups.join(languages, "lang", "left").na.fill(0, ["size", "held", "terms", "all"])
    totals = groups.groupBy("lang").agg(F.count("*").alias("groups"), F.sum("held").alias("postings"))
    tile = F.least("groups", F.lit(TILE))
    blocks = F.greatest(F.ceil(F.col("postings") / F.greatest(tile * tile, F.lit(_BLOCK))), F.lit(1))
    totals = totals.select("lang", F.ceil(F.col("groups") / TILE).cast("int").alias("tiles"), blocks.cast("int").alias("blocks"))
    numbered = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("g")
    zero = F.when(F.col("terms") > 0, _share("0", "size", "terms")).otherwise(0).alias("zero")
    groups = keep(groups.join(totals, "lang").select("lang", "source", numbered, "size", "held", zero, "terms", "all", "tiles", "blocks"), "groups")
    shares = rows.join(groups, ["lang", "source"]).select(
        "lang", "source", "g", "term", _share("cnt", "size", "terms").alias("p"), _share("total", "`all`", "terms").alias("q"), "tiles", "blocks"
    )
    return groups, keep(shares, "shares")


# --- pairs ----------------------------------------------------------------------

_PAIRS = pa.schema([("lang", pa.string()), ("g", pa.int32()), ("h", pa.int32()), ("value", pa.int64())])


def against(own: np.ndarray, points: np.ndarray) -> np.ndarray:
    """For each point, the sum of its distances from all of ``own``."""
    own = np.sort(own)
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(own)])
    at = np.searchsorted(own, points)
    return points * at - sums[at] + (sums[-1] - sums[at]) - points * (len(own) - at)


def _accumulator(tile: int):
    """Sums over one block of terms for all pairs of two tiles. A row without a term
    gives a group's baseline."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lang, a, b, _ = (k.as_py() for k in key)
        g, p = rows["g"].to_numpy().astype(np.int64), rows["p"].to_numpy()
        marker = rows["term"].is_null().to_numpy()
        peers = np.sort(g[marker])
        zero = np.zeros(len(peers), np.int64)
        zero[np.searchsorted(peers, g[marker])] = p[marker]
        code = rows["term"].filter(pa.array(~marker)).combine_chunks().dictionary_encode().indices.to_numpy()
        place, p = np.searchsorted(peers, g[~marker]), p[~marker]
        by_term = np.lexsort((place, code))
        index_place, index_p = place[by_term], p[by_term]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(code))]) if len(code) else np.zeros(1, np.int64)
        by_group = np.argsort(place, kind="stable")
        group_bounds = np.searchsorted(place[by_group], np.arange(len(peers) + 1))
        mine = [by_group[group_bounds[k] : group_bounds[k + 1]] for k in range(len(peers))]
        baseline = np.array([against(p[own], zero) for own in mine]).reshape(len(peers), len(peers))
        out_g, out_h, out_value = [], [], []
        for row in np.flatnonzero(peers // tile == a):
            held = mine[row]
            total = baseline[row] + baseline[:, row]
            starts, lengths = bounds[code[held]], bounds[code[held] + 1] - bounds[code[held]]
            cells = np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            peer, theirs, own = index_place[cells], index_p[cells], np.repeat(p[held], lengths)
            z = zero[peer]
            np.add.at(total, peer, abs(own - theirs) - abs(own - z) - abs(zero[row] - theirs) + abs(zero[row] - z))
            columns = np.flatnonzero((peers // tile == b) & (peers > peers[row]))
            out_g.append(np.full(len(columns), peers[row]))
            out_h.append(peers[columns])
            out_value.append(total[columns])
        out_g, out_h, out_value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_g, out_h, out_value))
        return pa.Table.from_batches([table(_PAIRS, lang=[lang] * len(out_g), g=out_g, h=out_h, value=out_value)])

    return run


def distances(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for all ordered pairs of sources of a language."""
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    postings = shares.select("lang", "g", "term", "p", "tiles", block)
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    markers = groups.select("lang", "g", F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"), "tiles", every_block)
    own = F.floor(F.col("g") / TILE).cast("int")
    both = postings.unionByName(markers).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    both = both.select("lang", "g", "term", "p", "block", F.least(own, "other").alias("a"), F.greatest(own, "other").alias("b"))
    sums = both.groupBy("lang", "a", "b", "block").applyInArrow(_accumulator(TILE), "lang string, g int, h int, value bigint")
    sums = sums.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    for end in ("g", "h"):
        names = [F.col(c).alias(f"{end}_{c}") for c in ("source", "held", "zero")]
        sums = sums.join(groups.select("lang", F.col("g").alias(end), *names, *(["terms"] if end == "g" else [])), ["lang", end])
    neither = (F.col("terms") - F.col("g_held") - F.col("h_held")) * F.abs(F.col("g_zero") - F.col("h_zero"))
    pairs = keep(sums.select("lang", "g_source", "h_source", (F.col("value") + neither).alias("value")), "pairs")
    names = ["lang", "source", "item", "value"]
    return pairs.toDF(*names).union(pairs.select("lang", "h_source", "g_source", "value"))


def divergence(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``: for every group, all other sources
    of its language by distance (``pair``), and the ``TOP`` terms whose share is most
    above the language's (``term``)."""
    groups, shares = group_shares(docs)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = distances(groups, shares).withColumn("rank", F.row_number().over(order))
    telling = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    telling = telling.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).union(telling.withColumn("part", F.lit("term")).select(*columns))


DIVERGENCE_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), languages AS (
  SELECT lang, count(*) AS v, CAST(sum(total) AS BIGINT) AS n FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM texts
), held AS (
  SELECT lang, source, term, count(*) AS cnt FROM words GROUP BY ALL
), grid AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(h.cnt, 0) AS cnt
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
), sized AS (
  SELECT *, CAST(sum(cnt) OVER (PARTITION BY lang, source) AS BIGINT) AS size FROM grid
), shares AS (
  SELECT s.lang, s.source, s.term, s.cnt, 1 + (1000000000 * (s.cnt + 5)) // (s.size + 5 * l.v) AS p,
    1 + (1000000000 * (s.total + 5)) // (l.n + 5 * l.v) AS q
  FROM sized s JOIN languages l ON s.lang = l.lang
), far AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE cnt > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM listed
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
