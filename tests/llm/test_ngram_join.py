"""The similarity join against all pairs, compared one by one."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import codeweft.llm.ngram_join as nj
from codeweft.llm.common import shingle_sets, word_hashes


def plain(rows, n, num, den):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and den * common >= num * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets[k]), least.get(find(k), i) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def near_copies(count, words, changes, seed, vocabulary=400):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(words)]
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(rng.randrange(changes + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_against_all_pairs(docs_of):
    texts = near_copies(25, 60, 3, 1) + near_copies(25, 200, 12, 2) + near_copies(10, 9, 2, 3)
    texts += ["", None, "one", "One", "one two", "a\x0bb\tc\nd e", "a b c d e", "ÀB c d e f", "àb c d e f"]
    rows = [(3 * k + 7, t) for k, t in enumerate(texts)]
    rows += [(5, texts[0]), (5, texts[0]), (None, texts[1]), (None, "alone at last indeed yes"), (1, texts[30])]
    assert got(nj.similar_groups(docs_of(*rows))) == plain(rows, 4, 85, 100)


def test_groups_with_many_open_pairs(docs_of, monkeypatch):
    """No leaders and tiny blocks: everything goes the way of the hot groups."""
    monkeypatch.setattr(nj, "MEET", 0)
    monkeypatch.setattr(nj, "BLOCK", 7)
    monkeypatch.setattr(nj, "_FEW_PAIRS", 0)
    rows = list(enumerate(near_copies(45, 80, 4, 5) + near_copies(12, 300, 10, 6)))
    assert got(nj.similar_groups(docs_of(*rows))) == plain(rows, 4, 85, 100)


def test_empty_table_and_clashing_columns(docs_of, llm):
    assert nj.similar_groups(docs_of((1, "x")).where("false")).count() == 0
    odd = docs_of((1, "a b c d e"), (2, "a b c d e")).withColumns({c: F.lit(9) for c in ("cls", "n", "token", "root")})
    assert got(nj.similar_groups(odd)) == [(1, 2, 1), (2, 2, 1)]


def test_one_document_of_each_group_stays(docs_of):
    same, other = " ".join(f"w{k}" for k in range(30)), "quite another text of some more words than five"
    docs = docs_of((4, same), (2, same), (2, same), (9, other), (None, other), (7, None), (8, ""))
    left = nj.first_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([2, 9, None, 7, 8], key=str)


def test_words_over_pieces_and_slices(monkeypatch):
    import codeweft.llm.common as common

    texts = ["aa bb", None, "", "ccc" * 50, " dd  ee ", "BB aa"]
    whole = word_hashes(pa.array(texts))
    monkeypatch.setattr(common, "_PIECE", 16)
    cut = word_hashes(pa.array(["zz", *texts]).slice(1))
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist() == [0, 2, 2, 2, 3, 5, 7]
    assert whole[0][0] == whole[0][6] and whole[0][1] == whole[0][5]


def test_short_texts_are_one_shingle():
    sizes = [len(s) for s in shingle_sets(pa.array(["a", "a b c", "a b c d", "a b c d e", "x x x x x x", None]), 4)]
    assert sizes == [1, 1, 1, 2, 1, 0]
    assert np.array_equal(*(shingle_sets(pa.array([t]), 4)[0] for t in ("A b", "a\nB")))


def test_unlike_texts_of_one_id_are_judged_apart(docs_of):
    def text(name):
        return " ".join(f"{name}{k}" for k in range(40))

    rows = [
        (3, text("x")), (3, text("a")), (5, text("x")), (6, text("x") + " end"), (7, text("u")), (7, text("x")),
        (8, None), (8, None), (8, ""), (8, " "), (9, text("v")), (9, text("v")), (9, text("v") + " end"), (None, text("x")),
    ]
    got = sorted((str(r.doc_id), r.text or "") for r in nj.first_of_each(docs_of(*rows)).collect())
    want = [(3, text("x")), (3, text("a")), (7, text("u")), (8, ""), (8, ""), (8, ""), (8, " "), (9, text("v")), (None, text("x"))]
    assert got == sorted((str(i), t) for i, t in want)


def test_suffix_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(4)
    for m in (1, 3, 300, 511, 513, 2000, 9000):
        base = rng.integers(0, 1 << 64, 2 * m, np.uint64)
        for shared in sorted({0, m // 2, m * 3 // 4, m * 9 // 10, m}):
            for extra in (0, m // 8):
                a, b = base[:m], base[m - shared : 2 * m - shared + extra]
                bound = nj._overlap_bound(len(a), len(b), nj._suffix_sketch(a), nj._suffix_sketch(b))
                assert len(np.intersect1d(a, b)) <= bound


def test_suffix_bound_turns_away_sets_that_share_three_quarters():
    rng = np.random.default_rng(4)
    for m in (300, 511, 513, 2000, 9000):
        base = rng.integers(0, 1 << 64, 2 * m, np.uint64)
        a, b = base[:m], base[m - m * 3 // 4 : 2 * m - m * 3 // 4]
        bound = nj._overlap_bound(m, m, nj._suffix_sketch(a), nj._suffix_sketch(b))
        assert bound < nj._needed(m, m, 80, 100)
