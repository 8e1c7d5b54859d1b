"""Distances of sources and telling terms against plain loops."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from codeweft.llm import divergence as dv


def plain(rows, least):
    """Rows (text, lang, source)."""
    times, docs, groups = Counter(), Counter(), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)
        for t in terms:
            times[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    out = set()
    for lang, sources in groups.items():
        kept = [t for (own, t), n in docs.items() if own == lang and n >= least]
        total = {t: sum(times[lang, s, t] for s in sources) for t in kept}

        def shares(count, kept=kept):
            size = sum(count.values())
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (size + 5 * len(kept)) for t in kept}

        own = {s: shares({t: times[lang, s, t] for t in kept}) for s in sources}
        whole = shares(total)
        for s in sources:
            far = [(sum(abs(own[s][t] - own[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(own[s][t] - whole[t], t) for t in kept if times[lang, s, t] and own[s][t] > whole[t]]
            for part, items in (("pair", far), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                ranked = ranked[:50] if part == "term" else ranked
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)}
    return out


def corpus(seed, n=160):
    rng = random.Random(seed)
    words = ["The", "the", "élan", "ÉLAN", "a", "x1y", "don't", "naïve word", "Zeta", *(f"t{chr(97 + k)}" for k in range(26))]
    rows = []
    for k in range(n):
        lang = rng.choice(["en", "en", "en", "de", None, ""])
        source = rng.choice(["a", "a", "a", "b", "é", None, "tiny" if k % 40 == 0 else "c"])
        rows.append((" ".join(rng.choices(words, k=rng.randrange(0, 40))), lang, source))
    rows += [("the " * 3000, "en", "hot")] + [("1 2 3", "en", "no terms"), (None, "en", "null text"), ("", None, None)]
    rows += [("the same a", "en", "copies")] * 40 + [("few words here", "fr", "p"), ("few others", "fr", "q")]
    return rows


def found(df):
    return {tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()}


def frame(spark, rows):
    odd = "text string, lang string, source string, doc_id bigint, term string, cnt int, g int"
    return spark.createDataFrame([(*r, None, "clash", 1, 2) for r in rows], odd)


@pytest.mark.parametrize("tile, block", [(1024, 1 << 18), (2, 8), (3, 1)])
def test_against_plain(llm, monkeypatch, tile, block):
    monkeypatch.setattr(dv, "LEAST", 4)
    monkeypatch.setattr(dv, "TILE", tile)
    monkeypatch.setattr(dv, "_BLOCK", block)
    rows = corpus(tile)
    got = dv.divergence(frame(llm, rows).repartition(3))
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    assert found(got) == plain(rows, 4) and got.count() == len(plain(rows, 4))


def test_blocks_and_tiles_are_used(llm, monkeypatch):
    """The tasks of the small setting really hold parts only."""
    monkeypatch.setattr(dv, "LEAST", 4)
    monkeypatch.setattr(dv, "TILE", 2)
    monkeypatch.setattr(dv, "_BLOCK", 8)
    groups, _ = dv.group_shares(frame(llm, corpus(2)))
    row = groups.where("lang = 'en'").selectExpr("max(tiles) AS t", "max(blocks) AS b").first()
    assert row.t > 2 and row.b > 2


def test_flush_does_not_change_counts(llm, monkeypatch):
    rows = corpus(5)
    batches = [pa.RecordBatch.from_pydict({c: [r[k] or "" for r in rows] for k, c in enumerate(("text", "lang", "source"))})]

    def total(limit):
        monkeypatch.setattr(dv, "_ENTRIES", limit)
        out = Counter()
        for batch in dv._count(iter(batches)):
            for r in batch.to_pylist():
                out[r["lang"], r["source"], r["term"], "n"] += r["cnt"]
                out[r["lang"], r["source"], r["term"], "d"] += r["docs"]
        return out

    assert total(1) == total(10**9)


def test_terms_over_pieces(monkeypatch):
    raw = ("Ab1cé " * 30 + "x" * 100 + " Z").encode()
    whole = [t for words in dv._terms(raw) for t in words]
    for piece in (1, 2, 7, 64):
        monkeypatch.setattr(dv, "_PIECE", piece)
        assert [t for words in dv._terms(raw) for t in words] == whole


def test_against_points():
    own, points = np.array([5, 1, 9, 1]), np.array([0, 1, 4, 100])
    assert dv.against(own, points).tolist() == [sum(abs(int(p) - int(o)) for o in own) for p in points]


def test_large_counts_do_not_overflow(llm):
    row = llm.sql("SELECT 90000000000000 AS n, 900000000000000 AS size, 10L AS v").select(dv._share("n", "size", "v").alias("p")).first()
    assert row.p == 1 + 1_000_000_000 * (90_000_000_000_005) // (900_000_000_000_050)


def test_empty(llm):
    assert found(dv.divergence(frame(llm, []))) == set()
