"""Quality rules against a plain version, with the same hashes."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from codeweft.llm import quality as q

WORDS = [f"{a}{b}" for a in ("ten", "ra", "mo", "li", "su") for b in ("der", "win", "ka", "post")]


def text(seed, n, mark=""):
    return " ".join(w + mark for w in random.Random(seed).choices(WORDS, k=n))


ROWS = [(k, text(k, 40 + k)) for k in range(12)] + [
    (20, None), (21, ""), (22, "one"), (23, "a b c d e f g h " * 9), (24, text(3, 50, "###")), (25, text(4, 50, " |")),
    (26, "line one\n\n line one\nline one\nx\n \n"), (27, "a a a a a a a a a"), (28, "a a a a a a a a"), (29, text(1, 30) + " " + text(1, 30)),
    (2, text(2, 42)), (None, text(5, 60)), (30, "é#ü\x0bb\x1cc d"),
]


def plain_counts(t):
    words = re.findall("[^\x20\x09-\x0d]+", t or "")
    windows = defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k : k + 8])].append(k)
    covered = {j for at in windows.values() if len(at) > 1 for k in at for j in range(k, k + 8)}
    lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def long_hash(x, seed):
    return xxhash.xxh64((x & (1 << 64) - 1).to_bytes(8, "little"), seed).intdigest()


def plain_grams(t):
    words = re.findall("[^\x20\x09-\x0d]+", t or "")
    h = [xxhash.xxh64(w.encode(), 42).intdigest() for w in words]
    pairs = [long_hash(b, long_hash(a, 42)) for a, b in zip(h, h[1:], strict=False)]
    one = (1).to_bytes(4, "little")
    ends = [xxhash.xxh64(one, xxhash.xxh64(w[-3:].encode(), 42).intdigest()).intdigest() for w in words]
    return [signed(x) % q.BUCKETS for x in h + pairs + ends]


@pytest.fixture(scope="module")
def labels(llm):
    rows = [(k, 1, 0) for k in range(8)] + [(24, 0, 0), (25, 0, 0), (3, None, 0), (None, 1, 0), (7, 0, 1)]
    return llm.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_against_plain(docs_of, labels):
    rows = {(r.doc_id, r.n_words): r for r in q.quality(docs_of(*ROWS), labels).collect()}
    trusted = set(range(8))
    grams = [(i, plain_grams(t)) for i, t in ROWS]
    n, t = Counter(b for _, g in grams for b in g), Counter(b for i, g in grams if i in trusted for b in g)
    all_n, all_t = sum(n.values()) + q.BUCKETS, sum(t.values()) + q.BUCKETS
    ratio = [math.log((t[b] + 1) / all_t) - math.log((n[b] + 1) / all_n) for b in range(q.BUCKETS)]
    for (i, text_), (_, g) in zip(ROWS, grams, strict=True):
        want = plain_counts(text_)
        r = rows[i, want[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)
        if g:
            assert r.score == pytest.approx(sum(ratio[b] for b in g) / len(g))
        else:
            assert r.score is None
    assert all(rows[k, 40 + k].kept for k in range(8))
    assert not rows[24, 50].kept and not rows[25, 100].kept


def test_no_rows_and_no_labels(docs_of, labels):
    assert q.quality(docs_of((1, "x")).where("false"), labels).count() == 0
    rows = q.quality(docs_of(*ROWS), labels.where("false")).collect()
    assert {r.score for r in rows} == {0.0, None} and all(r.kept == (not r.base_failed) for r in rows)
