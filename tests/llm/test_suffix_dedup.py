"""Repeat removal and suffix arrays against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_samples import ODD
from hypothesis import given, settings, strategies as st

from verbena.llm.suffix_arrays import _name_hashes, repeated_starts, sorted_names, suffix_array
from verbena.llm.suffix_dedup import remove_repeats


def brute(docs, length):
    raws = [(k, (t or "").encode()) for k, t in docs]
    seen = Counter(r[i: i + length] for _, r in raws for i in range(len(r) - length + 1))
    out = []
    for k, r in raws:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - length + 1):
            if seen[r[i: i + length]] > 1:
                gone[i: i + length] = True
        kept = bytes(b for b, g in zip(r, gone, strict=False) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(r) else 0
        out.append((k, len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def run(spark, docs, length, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return Counter(tuple(r) for r in remove_repeats(df, length=length, **kw).collect())


def made(seed, n=80):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(20, 90))) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = ["".join(rng.choice("abcdé \n") for _ in range(rng.randrange(0, 60))) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(shared))
        if rng.random() < 0.2:
            parts.append(rng.choice("xyz") * rng.randrange(100))
        docs.append((i, "".join(parts)))
    return docs + docs[:5] + [(1000 + i, t) for i, t in docs[:3]]


@pytest.mark.parametrize("length", [24, 40])
@pytest.mark.parametrize("group", [20_000, 2])
def test_made_texts_match_brute_force(spark, length, group):
    docs = made(length)
    assert run(spark, docs, length, group_segments=group) == brute(docs, length)


def test_periodic_texts(spark):
    docs = [(1, "a" * 300), (2, "ab" * 400), (3, "b" * 39), (4, "c" * 40), (5, "d" * 41), (6, "abc" * 20), (7, "é" * 1500)]
    assert run(spark, docs, 40) == brute(docs, 40)


def test_documents_match_brute_force(documents, rows):
    small = {k: t for k, t in rows.items()}
    got = Counter(tuple(r) for r in remove_repeats(documents).collect())
    assert got == brute(small.items(), 200)


def test_odd_rows(odd, none):
    docs = [(k, t) for k, t in ODD if k != 7]
    got = Counter(tuple(r) for r in remove_repeats(odd.where("doc_id is null or doc_id <> 7")).collect())
    assert got == brute(docs, 200)
    long = [r for r in remove_repeats(odd).collect() if r.doc_id == 7][0]
    assert (long.n_removed, long.n_spans) == (long.n_bytes, 1)
    assert remove_repeats(none).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=40).map(str.encode), max_size=6), st.integers(1, 9))
def test_repeated_starts(parts, length):
    seen = Counter(p[i: i + length] for p in parts for i in range(len(p) - length + 1))
    want = [[i for i in range(len(p) - length + 1) if seen[p[i: i + length]] > 1] for p in parts]
    assert [x.tolist() for x in repeated_starts(parts, length)] == want if parts else True


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=200), st.sampled_from([2, 3, 256]))
def test_suffix_array_is_sorted(raw, letters):
    s = np.append(np.frombuffer(raw, np.uint8).astype(np.int16) % letters + 1, 0).astype(np.int16)
    got = suffix_array(s, letters + 1, len(s), _name_hashes(s))
    assert got.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_doubling(names):
    x = np.array(names)
    assert sorted_names(x, len(x) + 1).tolist() == sorted(range(len(x)), key=lambda i: names[i:])
