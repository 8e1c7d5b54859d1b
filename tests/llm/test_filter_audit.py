"""The filter audit against plain loops, and its list operations against sets."""

import re
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from codeweft.llm import filter_audit as fa

IDS = st.lists(st.integers(0, 400), unique=True).map(lambda x: np.array(sorted(x), np.int64))


@settings(max_examples=150, deadline=None)
@given(st.lists(IDS, max_size=5), IDS, st.sampled_from([1, 3, 4096]))
def test_lists(lists, own, stride):
    before, fa._STRIDE = fa._STRIDE, stride
    try:
        merged = fa.union(lists)
        assert merged.tolist() == sorted(set().union(*(x.tolist() for x in lists)))
        assert fa.difference(own, merged).tolist() == sorted(set(own.tolist()) - set(merged.tolist()))
    finally:
        fa._STRIDE = before


@given(IDS, st.integers(-5, 410), st.integers(0, 50))
def test_gallop(ids, key, low):
    low = min(low, len(ids))
    want = next((k for k in range(low, len(ids)) if ids[k] >= key), len(ids))
    assert fa.gallop(ids, key, low) == want


def plain(rows, labels):
    """Rows (id, text, lang), labels (id, quality, toxic)."""
    marked = []
    for i, text, lang in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words)}
        fails["C"] = 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)
        fails["D"] = any(c in "#$%&*|" for c in text)
        fails["E"] = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)
        good = any(j == i and q == 1 for j, q, _ in labels if i is not None)
        toxic = any(j == i and x == 1 for j, _, x in labels if i is not None)
        marked.append((lang or "", {k for k, v in fails.items() if v}, good, toxic))
    out = {}
    for part in {m[0] for m in marked}:
        mine = [m[1:] for m in marked if m[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                left = [m for m in mine if not m[0] & set(order[:k])]
                gone = [m for m in left if f in m[0]]
                total[f] += len(gone)
                out[part, "".join(order), k + 1] = (
                    len(left) - len(gone),
                    len(gone),
                    sum(f in m[0] for m in mine) - len(gone),
                    sum(m[0] == {f} for m in mine),
                    sum(m[1] for m in gone),
                    sum(m[2] for m in gone),
                )
        for key in out:
            if key[0] == part:
                out[key] = (*out[key], total[key[1][key[2] - 1]])
    return out


def texts():
    clean = " ".join(f"word{k}" for k in range(120))
    return [
        (1, clean, "en"),
        (2, clean, "de"),
        (3, clean, "en"),
        (3, clean, "en"),
        (4, clean + " #", "en"),
        (5, "one two", None),
        (6, "one two", ""),
        (7, None, "en"),
        (8, "", "en"),
        (None, clean, "en"),
        (None, "one two", "en"),
        (9, clean + " again" * 200 + " $", "en"),
        (10, "UPPER CASE " * 80, "en"),
        (11, "é" * 200 + " Ü A\x0bB\x1cC D", "fr"),
        (12, clean.upper(), "en"),
        (13, " \t\n ", "fr"),
        (14, "x" * 3_000_000 + " " + "y z " * 400_000, "long"),
        (-5, "UPPER CASE " * 80, "en"),
    ]


LABELS = [(1, 1, 0), (3, 1, 1), (3, 0, None), (4, 0, 1), (10, 1, 1), (9, None, 1), (12, 1, None), (None, 1, 1), (99, 1, 1)]


def found(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in df.collect()}


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, lang string, part string, row int")
    return docs, spark.createDataFrame([(*r, "y") for r in labels], "doc_id bigint, quality int, toxic int, range string")


def test_against_plain(llm, monkeypatch):
    docs, labels = frames(llm, texts(), LABELS)
    for parts in (1, 5):
        assert found(fa.filter_audit(docs.repartition(parts), labels)) == plain(texts(), LABELS)
    monkeypatch.setattr(fa, "_HOT", 1)  # no text is in more than all rows: all are joined
    assert found(fa.filter_audit(docs, labels)) == plain(texts(), LABELS)


def test_pieces_do_not_change_words(monkeypatch):
    text = ("aa bb aa\tcc\x0bdd " * 50).encode()
    whole = fa.faults(text, len(text))
    monkeypatch.setattr(fa, "_PIECE", 3)
    assert fa.faults(text, len(text)) == whole


def test_index_is_sorted_and_bounded(llm, monkeypatch):
    monkeypatch.setattr(fa, "RANGE", 2)
    docs, labels = frames(llm, texts(), LABELS)
    index, totals = fa.postings(docs.coalesce(1), labels)
    rows = index.collect()
    assert all(r.ids == sorted(set(r.ids)) and len(r.ids) <= 4 and {i >> 2 for i in r.ids} == {r.range} for r in rows)
    assert {r.part: r.total for r in totals.collect()}["en"] == 12


def test_empty(llm):
    docs, labels = frames(llm, [], [])
    assert found(fa.filter_audit(docs, labels)) == {}
    docs, _ = frames(llm, texts(), [])
    assert found(fa.filter_audit(docs, labels)) == plain(texts(), [])
