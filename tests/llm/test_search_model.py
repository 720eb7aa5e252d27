"""BM25 and the suffix tree against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_samples import ODD
from pyspark.sql import functions as F

from verbena.llm import bm25
from verbena.llm import suffix_tree_lm as S
from verbena.llm.bm25 import top_k
from verbena.llm.queries import q_suffix_tree
from verbena.llm.suffix_tree_lm import fit_suffix_tree, score_texts


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]


def brute_search(docs, queries, k):
    bags = [(i, Counter(words(t)), len(words(t))) for i, t in docs]
    n, mean = len(bags), sum(x[2] for x in bags) / max(1, len(bags))
    df = Counter(w for _, b, _ in bags for w in b)
    idf = {w: math.log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    out = []
    for q, t in queries:
        ask = Counter(words(t))
        hits = []
        for i, b, size in bags:
            s = sum(c * idf[w] * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * size / mean)) for w, c in ask.items() if w in b)
            if s:
                hits.append((-round(s, 7), i))
        out += [(q, r, -s) for r, (s, _) in enumerate(sorted(hits, key=lambda x: (x[0], x[1] is not None, x[1]))[:k], 1)]
    return sorted(out, key=str)


def scores(df):
    return sorted(((r.query_id, r["rank"], round(r.score, 7)) for r in df.collect()), key=str)


@pytest.mark.parametrize("shard,block", [(bm25.SHARD_BYTES, bm25.QUERY_BYTES), (20_000, 30_000)])
def test_search_matches_brute_force(documents, rows, shard, block, monkeypatch):
    monkeypatch.setattr(bm25, "SHARD_BYTES", shard)
    monkeypatch.setattr(bm25, "QUERY_BYTES", block)
    asked = documents.where("doc_id % 20 = 0")
    got = scores(top_k(documents, asked))
    want = brute_search(list(rows.items()), [(k, t) for k, t in rows.items() if k % 20 == 0], 10)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want], atol=2e-6)


def test_short_queries_prune_blocks(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 500}" for _ in range(30))) for i in range(2000)]
    ask = [(1, "w1 w250"), (2, "w499 w499 w3"), (3, "nowhere"), (4, None)]
    df, q = (spark.createDataFrame(x, "doc_id long, text string") for x in (docs, ask))
    got = top_k(df, q, k=5)
    assert scores(got) == brute_search(docs, ask, 5)


def test_search_of_odd_rows(spark, odd, none):
    kept = [x for x in ODD if x[0] != 7]
    asked = odd.where("doc_id in (1, 2, 4, 5, 8, 9)")
    got = top_k(odd.where("doc_id is null or doc_id <> 7"), asked.where("doc_id <> 5"))
    assert scores(got) == brute_search(kept, [x for x in kept if x[0] in (1, 2, 4, 8, 9)], 10)
    assert top_k(none, asked).collect() == [] and top_k(odd, none).collect() == []
    tie = top_k(odd, odd.where("doc_id = 6")).orderBy("rank").collect()
    assert [r.doc_id for r in tie[:3]] == [5, 5, 6]


@pytest.mark.parametrize("often", [1, 4, 1 << 30])
def test_long_queries_and_their_estimates(spark, often, monkeypatch):
    """Long queries are estimated first; copies tie by id, also where more than k of them have one id or none."""
    monkeypatch.setattr(bm25, "DENSE_SHARE", often)
    monkeypatch.setattr(bm25, "PRODUCT_CELLS", 1000)
    rng = random.Random(2)
    text = [" ".join(f"w{int(rng.paretovariate(0.25)) % 3000}" for _ in range(90)) for _ in range(300)]
    docs = [(1000 - i if i % 50 else None, text[i % 300] if i < 300 else text[7]) for i in range(400)]
    ask = [(i, text[i]) for i in range(0, 300, 7)] + [(-1, "w1 w2")]
    assert any(len(set(t.split())) >= bm25.LONG_QUERY for _, t in ask)
    df, q = (spark.createDataFrame(x, "doc_id long, text string").coalesce(2) for x in (docs, ask))
    got = top_k(df, q, k=10)
    assert sorted(((r.query_id, r["rank"], r.doc_id, round(r.score, 6)) for r in got.collect()), key=str) \
        == sorted(brute_ids(docs, ask, 10), key=str)


def brute_ids(docs, queries, k):
    n, lengths = len(docs), [len(words(t)) for _, t in docs]
    bags, mean = [Counter(words(t)) for _, t in docs], sum(lengths) / len(docs)
    df = Counter(w for b in bags for w in b)
    for q, t in queries:
        found = []
        for (i, _), b, size in zip(docs, bags, lengths, strict=True):
            s = sum(c * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * size / mean))
                    for w, c in Counter(words(t)).items() if w in b)
            if s:
                found.append((-round(s, 6), i is not None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        yield from ((q, r, x[2], -x[0]) for r, x in enumerate(found[:k], 1))


def test_a_task_returns_few_of_many_copies():
    """Of equal scores only those that come first can be among the k best: copies cost no memory."""
    s, place = np.array([2.0] * 1000 + [3.0, 1.0]), np.append(np.arange(1000)[::-1], [0, 0])
    assert sorted(bm25._first_of_equals(s, place, 3).tolist()) == [997, 998, 999, 1000, 1001]


def test_index_keeps_little_at_a_time(spark, monkeypatch):
    """Words are hashed chunk by chunk, however large a shard is, and a shard goes on over batches."""
    monkeypatch.setattr(bm25, "CHUNK_BYTES", 5000)
    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('word w' || id || ' ', 20)").alias("text"))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "50")
    try:
        shards = bm25.build_index(docs).collect()
    finally:
        spark.conf.set(key, before)
    assert len(shards) == 1 and len(np.frombuffer(shards[0].lengths, "<i4")) == 400


def held(k):
    return zlib.crc32(str(k).encode()) % 7 == 2


def test_base_scores_match_brute_force(spark, rows):
    got = {r.doc_id: r for r in q_suffix_tree(spark, "/root/testdata/sf0.001").collect()}
    counts = Counter(w for k, t in rows.items() if not held(k) for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    gain = []
    for k, t in rows.items():
        tok = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tok)
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(k), len(tok), sum(counts[w] > 0 for w in tok), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        gain.append((r.score - r.base_score) / len(tok))
    assert np.mean([g for g, k in zip(gain, rows, strict=True) if held(k)]) > 0


def brute_tree(train, min_share, divergence):
    """The same model with dictionaries: P(word | history)."""
    sents = [[*words(t), None] for t in train]
    uni = Counter(w for s in sents for w in s)
    n, v = sum(uni.values()), len(uni)
    least = max(1.0, min_share * n)
    vocab = {w for w, c in uni.items() if c >= least}
    two = Counter((a, b) for s in sents for a, b in zip(s, s[1:], strict=False) if a in vocab and b in vocab)
    two = {p: c for p, c in two.items() if c >= least}
    three = Counter((a, b, c) for s in sents for a, b, c in zip(s, s[1:], s[2:], strict=False) if (a, b) in two and (b, c) in two)
    three = {p: c for p, c in three.items() if c >= least}
    states = {}

    def prob(w, context):
        if not context:
            return (uni[w] + 1) / (n + v + 1)
        if context not in states:
            return prob(w, context[1:])
        explicit, back = states[context]
        return explicit[w] if w in explicit else back * prob(w, context[1:])

    def consider(context, count, follow):
        below = {w: prob(w, context[1:]) for w in follow}
        p = {w: c / count for w, c in follow.items()}
        rest, rest_below = max(0.0, 1 - sum(p.values())), max(1e-12, 1 - sum(below.values()))
        gain = sum(c * math.log(p[w] / below[w]) for w, c in follow.items())
        gain += count * rest * math.log(rest / rest_below) if rest > 1e-12 else 0
        if gain >= divergence:
            made = {w: (c - S.DISCOUNT) / count for w, c in follow.items()}
            states[context] = made, (1 - sum(made.values())) / rest_below

    for a in vocab - {None}:
        consider((a,), uni[a], {b: c for (x, b), c in two.items() if x == a})
    for (a, b), count in two.items():
        if b is not None and (b,) in states:
            consider((a, b), count, {c: m for (x, y, c), m in three.items() if (x, y) == (a, b)})

    def score(text):
        s, total = [*words(text), None], 0.0
        for i, w in enumerate(s):
            context = tuple(s[max(0, i - 2): i])
            while context and context not in states:
                context = context[1:]
            total += math.log10(prob(w, context))
        return total

    return score, states, prob, vocab, uni


def corpus(n=300, seed=3):
    rng = random.Random(seed)
    follow = defaultdict(lambda: [f"v{rng.randrange(25)}" for _ in range(3)])
    out = []
    for i in range(n):
        s = ["v0", "v1"]
        for _ in range(rng.randrange(2, 30)):
            s.append(rng.choice(follow[tuple(s[-2:])]) if rng.random() < 0.85 else f"r{rng.randrange(900)}")
        out.append((i, " ".join(s)))
    return out


def test_tree_matches_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    options = {"min_share": 2e-3, "vocabulary_share": 1e-3, "divergence": 8.0}
    got = {r.doc_id: r.score for r in score_texts(df, F.col("doc_id") % 3 != 0, **options).collect()}
    score, states, prob, vocab, uni = brute_tree([t for k, t in docs if k % 3], 2e-3, 8.0)
    assert {len(c) for c in states} == {1, 2}
    for k, t in docs:
        assert math.isclose(got[k], score(t), rel_tol=1e-9), k
    for context in list(states)[:20]:  # distributions add up to one
        total = sum(prob(w, context) for w in uni) + prob("never seen", context)
        assert math.isclose(total, 1, abs_tol=1e-9)


def test_model_of_odd_rows(spark, odd, none):
    got = score_texts(odd, F.col("doc_id") != 9).collect()
    assert len(got) == len(ODD)
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((k, len(words(t)) + 1) for k, t in ODD)
    assert score_texts(none, F.lit(True)).collect() == []
    untrained = score_texts(odd.where("doc_id = 5"), F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.score == 0 and r.n_known == 0 for r in untrained)
    tree, unigrams = fit_suffix_tree(none)
    assert tree.train_tokens == 0 and unigrams.count() == 0


def test_rare_contexts_stay_in_a_large_corpus(spark):
    """A passage of eight copies is far below a share of 1e-5 of the tokens; its words are frequent."""
    rng = random.Random(11)
    passage = " ".join(f"c{i}" for i in range(40))
    docs = [(i, " ".join(f"c{rng.randrange(1000)}" for _ in range(1000))) for i in range(1200)]
    docs += [(2000 + i, passage) for i in range(8)] + [(3000, passage)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    got = score_texts(df, F.col("doc_id") < 3000).where("doc_id = 3000").first()
    assert got.score - got.base_score > 20


def test_tree_of_counts_matches_brute_force(spark):
    docs = corpus(150)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    train = [t for k, t in docs if k % 3]
    n = sum(len(words(t)) + 1 for t in train)
    score, states, _, _, _ = brute_tree(train, 2 / n, 8.0)
    assert {len(c) for c in states} == {1, 2}
    got = {r.doc_id: r.score for r in score_texts(df, F.col("doc_id") % 3 != 0, divergence=8.0).collect()}
    for k, t in docs:
        assert math.isclose(got[k], score(t), rel_tol=1e-9), k


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_places_and_packed_arrays(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(-(1 << 63), (1 << 63) - 1, n))
    asked = np.concatenate([keys, rng.integers(-(1 << 63), (1 << 63) - 1, 100), np.array([-(1 << 63), 0, (1 << 63) - 1])])
    at = {k: i for i, k in enumerate(keys.tolist())}
    assert S.Places(keys).find(asked).tolist() == [at.get(k, -1) for k in asked.tolist()]
    if n:
        assert (S.unsqueeze_sorted(S.squeeze_sorted(keys), len(keys), np.int64) == keys).all()
    got = dict(S.bucket_slices(keys, 7))
    assert sorted(i for places in got.values() for i in places.tolist()) == list(range(len(keys)))


def test_key_filter_misses_no_key(spark):
    keys = np.random.default_rng(2).integers(-(1 << 63), (1 << 63) - 1, 3000)
    bits = S.key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(3))
    assert S.may_have(bits, keys).all()
    assert S.may_have(bits, np.random.default_rng(3).integers(-(1 << 63), (1 << 63) - 1, 3000)).mean() < 0.01


def test_sent_keys_do_not_grow_with_the_buckets():
    """Buckets are ranges of keys: the steps between sorted keys stay as small however many buckets there are."""
    keys = np.sort(np.random.default_rng(4).integers(-(1 << 63), (1 << 63) - 1, 200_000))
    few, many = ({b: S.squeeze_sorted(keys[at]) for b, at in S.bucket_slices(keys, n)} for n in (4, 400))
    assert len(many) == 400 and sum(map(len, many.values())) < 1.05 * sum(map(len, few.values()))
    got = [S.unsqueeze_sorted(many[b], len(at), np.int64) for b, at in S.bucket_slices(keys, 400)]
    assert (np.concatenate(got) == keys).all()
    some = got[17]
    assert (S.Places(some).find(keys) >= 0).sum() == len(some) and (S.Places(some).find(some) == np.arange(len(some))).all()
    assert np.diff(S.Places(some).begin).max() < 20  # few keys share a place


@pytest.mark.parametrize("dtype", [np.int64, np.uint32, np.float64])
def test_squeezed_numbers(dtype):
    for a in ([], [0], [0, 0, 3], [1, 255, 256, 70000], [(1 << 31) + 5, 7]):
        a = np.array(a, dtype=dtype)
        assert (S.unsqueeze(S.squeeze(a), len(a), dtype) == a).all()
    a = np.array([-1, 5, -(1 << 63), (1 << 63) - 1], dtype=np.int64)
    assert (S.unsqueeze(S.squeeze(a), 4, np.int64) == a).all() and (S.unsqueeze_words(S.squeeze_words(a), 4) == a).all()
    assert len(S.squeeze(np.ones(1000, dtype=np.int64))) < 40


def test_key_filter_grows_with_its_keys(spark, monkeypatch):
    """As sharp for many keys as for few, up to the most it may take."""
    monkeypatch.setattr(S, "FILTER_WORDS", 1 << 4)
    monkeypatch.setattr(S, "MOST_FILTER_WORDS", 1 << 11)
    rng = np.random.default_rng(5)
    for n, words in ((40, 1 << 4), (4000, 1 << 10), (20_000, 1 << 11)):
        keys = rng.integers(-(1 << 63), (1 << 63) - 1, n)
        bits = S.key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(3))
        assert len(bits) == words and S.may_have(bits, keys).all()
        if words < 1 << 11:
            assert S.may_have(bits, rng.integers(-(1 << 63), (1 << 63) - 1, 5000)).mean() < 0.08


def test_search_takes_one_shard_at_a_time(spark, documents, monkeypatch):
    """A batch of the index holds one shard, however many a task has; the session's setting comes back."""
    load = bm25._load
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    counted = spark.sparkContext.accumulator(0)
    more = spark.sparkContext.accumulator(0)

    def loaded(batch, i):
        counted.add(1)
        more.add(batch.num_rows - 1)
        return load(batch, i)

    monkeypatch.setattr(bm25, "SHARD_BYTES", 4000)
    monkeypatch.setattr(bm25, "_load", loaded)
    before = spark.conf.get(key)
    bm25.small_batches(spark)
    small = spark.conf.get(key)
    top_k(documents, documents.where("doc_id % 20 = 0")).collect()
    assert spark.conf.get(key) == small
    spark.conf.set(key, before)
    assert counted.value > 10 and more.value == 0


def test_index_is_written_and_read_a_shard_at_a_time(spark, documents, monkeypatch):
    """Neither the writer nor the reader holds all the shards of a partition, and no pass leaves its terms on the executors."""
    import pyarrow.parquet as pq
    from pyspark.core.broadcast import Broadcast
    from verbena.llm import bm25
    monkeypatch.setattr(bm25, "SHARD_BYTES", 50_000)
    monkeypatch.setattr(bm25, "QUERY_BYTES", 20_000)
    monkeypatch.setitem(bm25.SHARD_FILES, "parquet.block.size", 1000)
    groups, gone, batches = [], [], []

    def noted(df, name, f=bm25.materialise, **options):
        batches.append((name, spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")))
        out = f(df, name, **options)
        if name == "index":
            for x in out.inputFiles():
                m = pq.read_metadata(x.removeprefix("file:"))
                groups.extend(m.row_group(k).num_rows for k in range(m.num_row_groups))
        return out

    monkeypatch.setattr(bm25, "materialise", noted)
    monkeypatch.setattr(Broadcast, "destroy", lambda b, *a, f=Broadcast.destroy: gone.append(1) or f(b, *a))
    bm25.top_k(documents.coalesce(1), documents.where("doc_id % 20 = 0")).count()
    assert len(groups) > 3 and set(groups) == {1}
    passes = [size for name, size in batches if name == "hits"]
    assert len(passes) == len(gone) > 1 and set(passes) == {"1"}
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) > 1
