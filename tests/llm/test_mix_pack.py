"""Mixing against a plain version, and packing as an exact round trip."""

import hashlib
import random
import re
import struct
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from codeweft.llm.mix import mix, repeated
from codeweft.llm.pack import encoder, pack, plan, tokenizer_path


def plain_mix(rows):
    size = [len(re.findall("[^\x20\x09-\x0d]+", t or "")) for _, t, _ in rows]
    key = [int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16) for i, _, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total = {s: sum(n for n, (*_, t) in zip(size, rows, strict=True) if t == s) for s in names}
    goal, open_, left = {}, set(names), 1.5 * sum(total.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * total[s]}
        if not full:
            goal |= {s: level * weight[s] for s in open_}
            break
        goal |= {s: 2.0 * total[s] for s in full}
        left -= sum(2 * total[s] for s in full)
        open_ -= full
    out = []
    for s in names:
        mine = sorted((key[k], k) for k, (*_, t) in enumerate(rows) if t == s)
        whole = int(goal[s] // total[s]) if total[s] else 0
        budget, used, last = goal[s] - whole * total[s], 0, -1
        for h in sorted({h for h, _ in mine}):
            own = sum(size[k] for g, k in mine if g == h)
            if used + own <= budget or 2 * (budget - used) > own:
                used, last = used + own, h
            if used > budget or own and used + own > budget and last != h:
                break
        for h, k in mine:
            out.append((rows[k][0], s, size[k], total[s], round(goal[s], 6), size[k] * (whole + (h <= last))))
    return sorted(out, key=str)


def test_mix_against_plain(docs_of):
    rng = random.Random(3)
    rows = [(k, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(60))), rng.choice("aab")) for k in range(150)]
    rows += [(900 + k, "x " * k, None) for k in range(9)] + [(950, "y " * 5000, "é"), (951, None, "empty"), (952, "", "empty")]
    rows += [(960, "same row", "b")] * 4 + [(None, "no id here", "b")]
    got = [(r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in mix(docs_of(*rows)).collect()]
    assert sorted(got, key=str) == plain_mix(rows)
    assert all(t <= 2 * n for *_, n, _, _, t in got)


def test_mix_repeats_whole_rows(docs_of):
    docs = docs_of(*((k, "a b c d", "one" if k % 3 else "two") for k in range(60))).withColumnRenamed("lang", "key_")
    taken = {r.doc_id: r.taken // r.size for r in mix(docs).collect()}
    out = repeated(docs)
    assert out.columns == docs.columns
    counts = {}
    for r in out.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {i: n for i, n in taken.items() if n}


def test_mix_of_nothing(docs_of):
    assert mix(docs_of((1, "x")).where("false")).count() == 0
    assert [r.taken for r in mix(docs_of((1, ""), (2, None))).collect()] == [0, 0]


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 64), st.lists(st.integers(1, 64), max_size=60))
def test_plan_fills_without_gaps(capacity, sizes):
    histogram = {}
    for s in sizes:
        s = 1 + (s - 1) % capacity
        histogram[s] = histogram.get(s, 0) + 1
    bins, ranks = {}, {}
    for size, start, items, first, per, offset in plan(histogram, capacity):
        for i in range(items):
            bins.setdefault(first + i // per, []).append((offset + i % per * size, size))
            ranks.setdefault(size, []).append(start + i)
    assert {s: len(r) for s, r in ranks.items()} == histogram
    assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
    for items in bins.values():
        at = 0
        for offset, size in sorted(items):
            assert offset == at
            at += size
        assert at <= capacity


def test_few_sequences():
    rng = random.Random(0)
    histogram = {}
    for _ in range(20_000):
        s = min(1024, int(rng.paretovariate(1.1) * 40))
        histogram[s] = histogram.get(s, 0) + 1
    used = max(first + -(-items // per) for _, _, items, first, per, _ in plan(histogram))
    assert used <= 1.01 * sum(s * c for s, c in histogram.items()) / 1024 + 1


@pytest.fixture(scope="module")
def tokens():
    return encoder(tokenizer_path())


def test_ids_are_those_of_the_whole_text(tokens):
    odd = ["a  b", "a \n b", " a", "a ", "\n\na b", "a \x1cb", "a' s don't 's", "  ", "", "a\x85 b", "日本 語 12", "a​ b"]
    odd += [None, "é é à", "한국 어 말", "नम स्ते", "a \x7f b", "x <|endoftext|> y", "　 a 　b", "a  b", "word " * 900]
    ids, bounds = tokens.encode(pa.array(odd * 2))
    for k, text in enumerate(odd * 2):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == tokens.model.encode(text or "", add_special_tokens=False).ids, text


def test_pack_round_trip(docs_of, tokens):
    rows = [(1, "short"), (2, None), (3, ""), (4, "many words and " * 1500), (5, "x" * 5000), (6, "tie"), (6, "tie"), (None, "no id")]
    rows += [(10 + k, "some words " * (7 * k)) for k in range(40)]
    out = pack(docs_of(*rows), tokenizer_path()).collect()
    by_bin = {}
    for r in out:
        by_bin.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in by_bin.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 1024
    want = []
    for i, text in rows:
        ids = tokens.model.encode(text or "", add_special_tokens=False).ids + [2]
        start, stops = 0, range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)
        for piece, stop in enumerate(stops):
            want.append((i, piece, start, stop - start, zlib.crc32(struct.pack(f"<{stop - start}I", *ids[start:stop]))))
            start = stop
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in out)


def test_pack_of_nothing(docs_of):
    assert pack(docs_of((1, "x")).where("false"), tokenizer_path()).count() == 0
