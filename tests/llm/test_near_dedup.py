"""Near-duplicates against brute force over full shingle sets."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from llm_samples import ODD
from pyspark.sql import functions as F

from verbena.llm import near_dedup as N
from verbena.llm.near_dedup import connected, most_differing_bits, near_duplicates, odd_sketch, spanning_links


def shingles(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i: i + width]) for i in range(len(w) - width + 1)}


def brute(docs, width, percent):
    sets = [shingles(t, width) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            up[root(i)] = root(j)
    low = {}
    for i, (k, _) in enumerate(docs):
        low[root(i)] = min(low.get(root(i), k), k)
    return sorted((k, len(s), low[root(i)], low[root(i)] == k) for i, ((k, _), s) in enumerate(zip(docs, sets, strict=True)))


def copies(n=60, seed=5):
    """Chains of near copies, exact copies, short texts and clean texts."""
    rng = random.Random(seed)
    out = []
    for g in range(n):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([1, 3, 5, 40, 200]))]
        for _ in range(rng.choice([1, 2, 6])):
            out.append((len(out) * 7 % 1009, " ".join(words).title() if g % 2 else "\t".join(words)))
            if len(words) > 20:
                words = words[:]
                words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_components_match_brute_force(spark, width):
    docs = copies()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("cls", F.lit("clash"))
    got = sorted(tuple(r) for r in near_duplicates(df, width=width).collect())
    assert got == brute(docs, width, 80)


def test_documents_match_brute_force(documents, rows):
    got = sorted(tuple(r) for r in near_duplicates(documents, width=4).collect())
    assert got == brute(list(rows.items()), 4, 80)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(300):  # members differ from each other by up to twelve words, so hubs miss many of them
        w = base[:]
        for _ in range(rng.randrange(7)):
            w[rng.randrange(120)] = f"y{rng.randrange(10_000)}"
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(r) for r in near_duplicates(df, width=4).collect()) == brute(docs, 4, 80)


def test_odd_rows(odd, none):
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd).collect() if r.doc_id is not None)
    assert got == brute([x for x in ODD if x[0] is not None], 5, 80)
    assert near_duplicates(odd).count() == len(ODD)
    assert near_duplicates(none).collect() == []


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(40)]
    edges = [(str(a).encode(), str(b).encode()) for a, b in edges if a != b]
    got = {bytes(r.node): bytes(r.root) for r in connected(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    up = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert got == up


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(4)
    limit = most_differing_bits(0.8 - N.SLACK)
    worst = 0
    for _ in range(400):
        u = np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64))
        a, b = N.min_hashes(u[:810]), N.min_hashes(u[90:])  # similarity 0.8
        worst = max(worst, sum(int(x).bit_count() for x in (odd_sketch(a).view(np.uint64) ^ odd_sketch(b).view(np.uint64))))
    assert worst <= limit
    x, y = (odd_sketch(N.min_hashes(rng.integers(0, 1 << 63, 800, dtype=np.uint64))).view(np.uint64) for _ in range(2))
    assert sum(int(v).bit_count() for v in x ^ y) > limit


def test_null_ids_inside_groups(spark):
    base = [f"w{i}" for i in range(80)]
    near = base[:40] + ["other"] + base[41:]
    alone = [f"z{i}" for i in range(80)]
    docs = [(3, base), (None, base), (4, base), (5, near), (None, near), (7, near),
            (None, alone), (None, alone), (None, [*alone[:-1], "end"]), (None, ["single"])]
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in docs], "doc_id long, text string")
    got = near_duplicates(df).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id is not None) == [
        (3, 3, True), (4, 3, False), (5, 3, False), (7, 3, False)]
    nameless = sorted((r.component_id or 0, r.n_shingles, r.kept) for r in got if r.doc_id is None)
    assert nameless[0] == (0, 1, True) and sorted(x[2] for x in nameless[1:4]) == [False, False, True]
    assert nameless[4:] == [(3, 76, False)] * 2


def near_misses(n, words=60, seed=8):
    """Copies of one text, most pairs of which are a little under or over the threshold."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        w = base[:]
        for i in rng.sample(range(words), rng.choice([1, 2, 3])):
            w[i] = f"x{rng.randrange(3) if rng.random() < 0.2 else rng.randrange(10 ** 6)}"
        out.append((k, " ".join(w)))
    return out


@pytest.mark.parametrize("rows,columns", [(1024, 4096), (16, 50)])
def test_large_groups_of_near_misses(spark, monkeypatch, rows, columns):
    monkeypatch.setattr(N, "BLOCK_ROWS", rows)
    monkeypatch.setattr(N, "BLOCK_COLUMNS", columns)
    docs = near_misses(160) + [(1000 + i, t.replace("w", "v")) for i, t in near_misses(50, 30, 3)]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=4)
    assert sorted(map(tuple, got.collect())) == brute(docs, 4, 80)


def test_spanning_links():
    rng = np.random.default_rng(1)
    m = rng.random((40, 40)) < 0.04
    m |= m.T
    np.fill_diagonal(m, False)
    found = spanning_links(m)
    assert len(found) < 40 and all(m[i, j] for i, j in found)

    def parts(pairs):
        up = list(range(40))

        def root(i):
            while up[i] != i:
                i = up[i]
            return i
        for i, j in pairs:
            up[root(i)] = root(j)
        return [root(i) for i in range(40)]
    a, b = parts(found), parts(zip(*np.nonzero(m), strict=True))
    assert len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


def test_long_words_of_one_polynomial_hash(spark):
    """Two one-word texts of a kilobyte that a hash modulo 2^64 takes for one."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    docs = [(1, one), (2, one.translate(str.maketrans("ab", "ba")))]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=4)
    assert sorted(map(tuple, got.collect())) == [(1, 1, 1, True), (2, 1, 2, True)]
