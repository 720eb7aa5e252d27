"""Clustering against plain Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbena.llm.clustering import cluster_vectors, distinct_rows

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
SCHEMA = "vec_id long, embedding array<float>, label int"


def fine(v, dims):
    return v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)


def brute(data, k=8, rounds=10, dims=64, scale=1024):
    rows = [(i, [math.floor(scale * x) for x in v]) for i, v in data if fine(v, dims)]
    order = sorted(rows, key=lambda r: ((r[0] is None), hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cents = [r[1] for r in order[:k]]

    def assign():
        out = []
        for _, v in rows:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = assign()
        for c in range(len(cents)):
            own = [rows[i][1] for i, (x, _) in enumerate(at) if x == c]
            if own:
                cents[c] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    at = assign()
    by = {c: sum(d for x, d in at if x == c) for c in range(len(cents))}
    total = sum(by.values())
    return sorted(((rows[i][0], c, d, by[c], total, hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest())
                   for i, (c, d) in enumerate(at)), key=repr)


def got(df, **kw):
    order = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    out = cluster_vectors(df, start_order=order, **kw)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()), key=repr)


def f32(x):
    return float(np.float32(x))


@pytest.mark.parametrize("block,shard", [(4, 8192), (3, 7), (64, 50)])
def test_matches_brute_force(spark, block, shard):
    rng = random.Random(block)
    data = [(i, [f32(rng.gauss(0, 0.2)) for _ in range(10)]) for i in range(120)]
    data += [(200 + i, data[i % 3][1]) for i in range(60)]  # copies
    data += [(300, None), (301, [0.5] * 9), (302, [0.5] * 11), (303, [None] + [0.5] * 9), (304, [math.inf] + [0.5] * 9),
             (305, [math.nan] + [0.5] * 9), (306, []), (None, [0.25] * 10), (None, [0.25] * 10), (307, [0.5] * 10), (307, [-0.5] * 10),
             (308, [1e6] * 10), (309, [-1e6] * 10)]
    df = spark.createDataFrame([(i, v, 1) for i, v in data], SCHEMA).repartition(4)
    assert got(df, dims=10, block=block, shard=shard) == brute(data, dims=10)


def test_fewer_vectors_than_centroids_and_ties(spark):
    data = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.5, 0.5]), (4, [0.5, 0.5])]
    df = spark.createDataFrame([(i, v, 0) for i, v in data], SCHEMA)
    assert got(df, dims=2) == brute(data, dims=2)


def test_clashing_columns_and_empty_table(spark):
    data = [(i, [float(i % 5), float(i % 3)]) for i in range(20)]
    df = spark.createDataFrame([(i, v, 0) for i, v in data], SCHEMA).withColumns(
        {c: F.lit("clash") for c in ("v", "cluster", "distance", "ids", "blocks", "c", "o", "inertia")})
    assert got(df, dims=2, k=3) == brute(data, k=3, dims=2)
    assert got(df.where("vec_id < 0"), dims=2) == []


def test_wide_components_stay_exact(spark):
    data = [(i, [f32(v) for v in (2.0 ** 20 + i % 7, -(2.0 ** 20) - i % 3, 1.0 * i, 0.5)]) for i in range(40)]
    df = spark.createDataFrame([(i, v, 0) for i, v in data], SCHEMA)
    assert got(df, dims=4, k=4) == brute(data, k=4, dims=4)


def test_dictionary_is_lossless():
    rng = np.random.default_rng(3)
    for high in (5, 1 << 40):
        block = rng.integers(-high, high, (500, 4))
        values, codes = distinct_rows(block)
        assert (values[codes] == block).all() and len(np.unique(values, axis=0)) == len(values)
