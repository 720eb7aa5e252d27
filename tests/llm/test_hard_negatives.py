"""Hard negatives against every pair in plain Python integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbena.llm import hard_negatives as H

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(data, n_pos=5, n_neg=5, low=80, high=100, scale=256, every=100):
    rows = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in data
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (ai, av, al) in enumerate(rows):
        if ai % every:
            continue
        scored = [(-sum(x * y for x, y in zip(av, v, strict=False)), i, lab) for b, (i, v, lab) in enumerate(rows) if b != a]
        scored.sort(key=lambda r: r[:2])
        for ps, pi, _ in [r for r in scored if r[2] == al][:n_pos]:
            window = [r for r in scored if r[2] != al and low * -ps <= 100 * -r[0] <= high * -ps]
            out += [(ai, pi, k + 1, r[1], -ps, -r[0]) for k, r in enumerate(window[:n_neg])]
    return sorted(out)


def got(df, anchor=None, **kw):
    out = H.hard_negatives(df, F.col("id") % 100 == 0 if anchor is None else anchor, **kw)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()))


def noisy(n, dims=12, labels=3, seed=1, spread=0.5):
    """Unit vectors around a few centres that labels share in part."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        v = [x + rng.gauss(0, spread) for x in c]
        norm = math.sqrt(sum(x * x for x in v))
        out.append((i * 10, [x / norm for x in v], rng.randrange(labels)))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_matches_every_pair(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(H, "SHARD", 16)
        monkeypatch.setattr(H, "GROUP", 4)
        monkeypatch.setattr(H, "CELL", 32)
    data = noisy(400)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    want = brute(data)
    assert len(want) > 100
    assert got(df) == want


def test_other_windows_and_counts(spark):
    data = noisy(150, dims=5, labels=2, seed=9, spread=1.0)
    df = spark.createDataFrame(data, SCHEMA)
    assert got(df, positives=3, negatives=7, low=50, high=120, scale=64) == brute(data, 3, 7, 50, 120, 64)


def test_odd_rows_ties_and_repeats(spark):
    data = noisy(60, dims=4, labels=2, seed=4)
    same = data[0][1]
    data += [(k, same, k % 2) for k in range(1001, 1040)]  # one common vector: ties by id
    data += [(0, same, 1), (0, same, 1), (100, None, 0), (200, same, None), (None, same, 0), (300, [None] + same[1:], 0),
             (400, [math.nan] + same[1:], 1), (500, [math.inf] + same[1:], 1), (600, [], 0), (700, same[:2], 1), (800, [0.0] * 4, 0),
             (900, [-x for x in same], 1), (1100, [1.0] * 9, 0)]
    df = spark.createDataFrame(data, SCHEMA).repartition(4).withColumns(
        {c: F.lit("clash") for c in ("row", "id", "v", "scores", "n", "no", "bucket", "batch", "score")})
    assert got(df) == brute(data)


def test_few_rows_and_none(spark):
    data = [(0, [1.0, 0.5], 1), (1, [0.5, 1.0], 1), (2, [0.6, 0.7], 2)]
    df = spark.createDataFrame(data, SCHEMA)
    assert got(df) == brute(data) != []
    assert got(df.where("vec_id = 0")) == [] == got(df.where("vec_id < 0")) == got(df, F.col("id") < 0)


def test_wide_components_stay_exact(spark):
    data = [(i * 50, [2.0 ** 21 + i % 5, 2.0 ** 20 + i % 3, float(i)], i % 2) for i in range(30)]
    assert got(spark.createDataFrame(data, SCHEMA)) == brute(data)


def test_index_leaves_out_covered_suffixes():
    """A high threshold lists fewer dimensions, and no pair at or above it is lost."""
    rng = np.random.default_rng(2)
    v = rng.integers(-40, 40, (300, 16)).astype(np.int64)
    x = v[:20] + rng.integers(-3, 4, (20, 16))
    shard = H.Packed({"row": np.arange(300).tobytes(), "id": np.arange(300).tobytes(), "label": np.zeros(300, "<i8").tobytes(),
                      "n": 300, "dims": 16, "type": "<i8", "v": v.tobytes(), "scores": []}, 16)
    index = H.Index(shard)
    xs = x[:, index.order]
    full = x @ v.T
    for share in (0.9, 0.5, 0.1, 0.0):
        least = share * (full.max(axis=1).astype(float))
        a, b, s = index.search(xs, H.suffix_norms(xs), least, np.ones((20, 300), dtype=bool))
        assert sorted(zip(a, b, s, strict=True)) == [(i, j, full[i, j]) for i in range(20) for j in range(300) if full[i, j] >= least[i]]
