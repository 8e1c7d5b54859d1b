"""Vector links against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import codeweft.llm.near_vectors as nv

LAYOUT = "vec_id bigint, label int, embedding array<float>"


def plain(rows, least=0.93):
    units = []
    for _, label, v in rows:
        good = label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            x, y = units[a], units[b]
            if x is not None and y is not None and len(x) == len(y) and rows[a][1] == rows[b][1] and x @ y >= least:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    low = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return sorted((str((i, links[k], low.get(find(k), i), i == low.get(find(k), i))) for k, (i, *_) in enumerate(rows)))


def got(df):
    return sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in df.collect())


def cluster(rng, count, size, spread):
    centre = rng.normal(size=size)
    return [[float(np.float32(x)) for x in centre + spread * rng.normal(size=size)] for _ in range(count)]


def sample():
    rng = np.random.default_rng(4)
    rows = []
    for count, size, spread in ((30, 64, 0.2), (40, 64, 0.25), (12, 64, 0.05), (60, 64, 9.0), (8, 5, 0.1)):
        rows += [(len(rows) + 10 + k, k % 2, v) for k, v in enumerate(cluster(rng, count, size, spread))]
    v = rows[0][2]
    rows += [(1, 0, v), (1, 0, v), (2, 0, v), (3, 0, [2 * x for x in v]), (4, 1, v), (5, None, v), (6, 0, None), (7, 0, [])]
    rows += [(8, 0, [0.0] * 64), (9, 0, [float("nan")] * 64), (200, 0, [float("inf")] + v[1:]), (201, 0, [None] + v[1:]), (202, 0, v[:63])]
    return [*rows, (None, 0, v), (300, 7, [1.0]), (301, 7, [-1.0]), (302, 7, [3.0])]


def test_against_all_pairs(llm):
    rows = sample()
    assert got(nv.near_vectors(llm.createDataFrame(rows, LAYOUT))) == plain(rows)


def test_hot_buckets_in_blocks(llm, monkeypatch):
    monkeypatch.setattr(nv, "BLOCK", 4)
    rows = sample()[:90]
    assert got(nv.near_vectors(llm.createDataFrame(rows, LAYOUT))) == plain(rows)


def test_no_rows_and_clashing_columns(llm):
    df = llm.createDataFrame(sample()[:20], LAYOUT)
    assert nv.near_vectors(df.where("false")).count() == 0
    odd = df.withColumns({c: F.lit("x") for c in ("cls", "unit", "size", "links", "names")})
    assert got(nv.near_vectors(odd)) == plain(sample()[:20])


@pytest.mark.parametrize(("size", "hashes", "least"), [(64, 1, 0.93), (64, 2, 0.93), (64, 4, 0.93), (128, 3, 0.93), (1024, 2, 0.93), (1024, 3, 0.93), (64, 2, 0.8)])
def test_recall_at_the_threshold(size, hashes, least):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y, labels = least * x + math.sqrt(1 - least**2) * z, np.zeros(len(x), np.int64)
    a, b = (nv.buckets(v, labels, hashes, nv.tables_needed(hashes, size, least)) for v in (x, y))
    assert np.mean([bool(set(p) & set(q)) for p, q in zip(a.tolist(), b.tolist(), strict=True)]) > 0.993


def test_tables_follow_threshold_and_size():
    assert nv.tables_needed(2, 64, 0.99) < nv.tables_needed(2, 64, 0.93) < nv.tables_needed(2, 64, 0.8)
    assert nv.tables_needed(3, 64, 0.93) < nv.tables_needed(3, 1024, 0.93)
    assert nv.tables_needed(3, 1, 0.93) == nv.tables_needed(3, 64, 1.0) == 1
    with pytest.raises(ValueError, match="too low"):
        nv.tables_needed(4, 64, 0.05)
