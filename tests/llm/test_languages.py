"""String kernels against sets, ridge regression against its equations, and
held-out accuracy."""

import zlib

import numpy as np
import pytest

from codeweft.llm import string_kernel as sk


def spectrum(text):
    """The features of a window, gram by gram."""
    points = sk.marked(text).tolist()
    out = set()
    for n, features in sk.grams(sk.marked(text)):
        assert len(features) == len(points) - n + 1
        by_gram = {}
        for k, f in enumerate(features.tolist()):
            assert by_gram.setdefault(tuple(points[k : k + n]), f) == f  # one value per n-gram
            if points[k : k + n] != [0]:
                out.add(f)
    return out


TEXTS = ["Hello, World 12 again", "hello world", "ÄÖ ünïcode été", "a", "aaaa bbbb", "zażółć gęślą", "x" * 50]


def test_marks():
    assert sk.marked("Ab, 12!é").tolist() == [0, ord("a"), ord("b"), 0, ord("é"), 0]
    assert not sk.marked("12 -- 3").any() and not sk.marked("").any()


def test_kernel_against_sets():
    windows = [sk.marked(t) for t in TEXTS]
    rows = sk.presence(windows)
    sets = [spectrum(t) for t in TEXTS]
    assert [set(np.flatnonzero(r).tolist()) for r in rows] == sets
    want = [[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets] for a in sets]
    assert np.allclose(sk.kernel(windows, sk.unit(rows).T), want, atol=1e-5)


def test_training_solves_the_kernel_ridge_equations():
    """With every window a landmark, Nystroem is exact: coefficients of the plain
    kernel ridge regression give the same outputs."""
    sample = [("de", "der die das und ist nicht"), ("de", "das ist ein haus und ein hund"), ("en", "the dog and the house"), ("en", "this is not the way")]
    model = sk.train(sample, landmarks=100, ridge=1e-3)
    windows = [sk.marked(t) for _, t in sample]
    got = sk.kernel(windows, model.matrix()) @ model.coefficients + model.offset
    k = sk.kernel(windows, sk.unit(sk.presence(windows)).T)
    y = np.array([[1, -1]] * 2 + [[-1, 1]] * 2, float)
    centre = np.eye(4) - 0.25
    alpha = np.linalg.solve(centre @ k @ centre / 4 + 1e-3 * np.eye(4), y - y.mean(axis=0)) / 4
    assert np.allclose(got, centre @ k @ centre @ alpha + y.mean(axis=0), atol=1e-3)
    assert model.names == ("de", "en")


def test_predictions_do_not_depend_on_batches():
    model = sk.train([("x", "abc abd abe " * 9), ("y", "zyx zyw zyv " * 9)])
    scorer = sk.Scorer(model)
    texts = ["abd abc", None, "", "12 + 7", "zyw " * 2000, "abc " * 400_000, "zyx", "é"]
    together = scorer.predict(texts)
    alone = [scorer.predict([t]) for t in texts]
    assert together[0] == [a[0][0] for a in alone] and np.allclose(together[1], [a[1][0] for a in alone])
    assert together[0][:7] == ["x", "und", "und", "und", "y", "x", "y"]
    assert together[1][1:4] == [0.0, 0.0, 0.0] and all(0 <= s <= 1 for s in together[1])


def test_nothing_to_learn(llm, docs_of):
    assert sk.train([]) is None and sk.train([("x", "12")]) is None
    rows = sk.languages(docs_of((2, "abc"), (2, "abc"), (None, None))).collect()
    assert all(r.score == 0 or r.lang_pred == "en" for r in rows) and len(rows) == 3
    assert sk.languages(docs_of().limit(0)).collect() == []


def test_held_out_fold_is_not_read(llm):
    rows = [(k, f"abc abd abe {k}", "x") for k in range(40)] + [(k, f"zyx zyw {k}", "y") for k in range(40, 80)]
    rows = [(k, t, "wrong" if zlib.crc32(str(k).encode()) % 4 == 2 else lang) for k, t, lang in rows] + [(None, "null id", "wrong"), (500, "no lang", None)]
    docs = llm.createDataFrame([(*r, "s") for r in rows], "doc_id bigint, text string, lang string, digest string")
    got = {r.doc_id: r for r in sk.languages(docs).collect()}
    assert all(r.held_out == (k is None or zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())
    assert all(got[k].lang_pred == ("x" if k < 40 else "y") for k in range(80))
    assert len(got) == len(rows)


def test_sample_is_bounded_and_distinct(llm, monkeypatch):
    monkeypatch.setattr(sk, "SAMPLE", 3)
    texts = [f"text number {'abcdefgh'[k % 5]} " * 900 for k in range(200)]
    docs = llm.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    sample = sk.sample(docs)
    assert len(sample) <= 3 * sk.SPREAD and all(len(w) <= sk.WINDOW for _, w in sample)
    assert len({w for _, w in sample}) >= 3


@pytest.fixture(scope="module")
def predicted(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return sk.languages(docs).withColumnRenamed("held_out", "out").join(docs.select("doc_id", "lang", "text"), "doc_id").collect()


def test_held_out_accuracy(predicted):
    rows = [r for r in predicted if r.out and r.lang_pred != "und"]
    assert len(rows) > 150 and sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all(sk.has_letter(r.text) == (r.lang_pred != "und") for r in predicted)
