"""Language-model scores from a probabilistic suffix tree over words.

States are contexts of up to ``depth`` words.  A context is a state if its
next-word distribution differs enough from that of its suffix (count times
Kullback-Leibler divergence, the likelihood gain in nats, reaches
``divergence``) and its suffix is a state too.  A state's distribution is
discounted, and what the discount frees goes to the suffix state's
distribution; the empty context is the add-one unigram distribution over all
training words.  A text is scored from its longest suffix state at each token.

An n-gram is part of the tree if it occurs ``min_count`` times, however large
the corpus is.  Counting goes level by level: a longer n-gram is counted only
where both its parts were found often enough.  Tasks send their counts, and
later what they ask of the tree, as sorted and compressed arrays, one for each
bucket of keys (a range of them), so that a shuffled n-gram takes a few bytes.

The score of a text is a sum over its n-grams: a state adds its backoff
wherever it occurs, and an n-gram with a probability of its own adds what that
differs by from the backed-off one.  Tasks hold the n-grams whose share of all
tokens is at least ``vocabulary_share`` (at most 1 / vocabulary_share an
order) and ask the buckets of the tree for the others; a bit filter that
grows with the tree, up to a fixed size, spares them most questions about
n-grams that the tree does not have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from .common import chunk_rows, discard, give_back, materialise, mix64, out_batch, shuffles_removed, sized, texts, word_hashes

DISCOUNT = 0.75
MIN_COUNT, VOCABULARY_SHARE, DIVERGENCE, DEPTH = 2, 1e-6, 20.0, 2
#: N-grams that a task gathers before it hands them on.
HELD_GRAMS = 1_000_000
#: Bytes of text whose n-grams are counted, or looked up, in one bucket of keys.
COUNT_BYTES, ASK_BYTES = 12 << 20, 16 << 20
#: Bits of a bit filter for each of its keys, and its 64-bit words, at least and at most (64 MB).
FILTER_BITS, FILTER_WORDS, MOST_FILTER_WORDS = 16, 1 << 20, 1 << 23
FILTER_BLOCKS = 16
#: Bytes of text that are worked on at a time, so that their arrays stay in a core's cache.
PART_BYTES = 1 << 18
_U = np.uint64
_LEFT, _RIGHT = _U(0xD1342543DE82EF95), _U(0xAF251AF3B0F025B5)
END = int(mix64(np.array([0x5BF0_3635_5A6E_19C3], dtype=np.uint64)).view(np.int64)[0])


def tokens(offsets: np.ndarray, data: memoryview, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes (as signed numbers) of rows lo..hi with one END after each row, and tokens per row."""
    h, counts = word_hashes(offsets, data, lo, hi)
    out = np.full(len(h) + len(counts), END, dtype=np.int64)
    place = np.arange(len(h)) + np.repeat(np.arange(len(counts)), counts)
    out[place] = h.view(np.int64)
    return out, counts + 1


def looked_up(table: DataFrame) -> DataFrame:
    """A table of distinct keys as the side of a join that is hashed: whole if it is small, else partition by partition."""
    small = sized(table)
    return small if small is not table else table.hint("shuffle_hash")


class Places:
    """Finds keys in sorted ones, spread evenly between the least and the largest: the leading bits of their distance
    from the least say where the few that share them begin."""

    def __init__(self, sorted_keys: np.ndarray):
        self.keys = sorted_keys
        self.least = sorted_keys[:1].view(np.uint64).sum(dtype=np.uint64)
        span = int(sorted_keys[-1]) - int(sorted_keys[0]) if len(sorted_keys) else 0
        self.shift = _U(max(0, span.bit_length() - max(1, len(sorted_keys).bit_length())))
        self.cells = (span >> int(self.shift)) + 2  # the last one for keys beyond, and empty
        self.begin = np.append(0, np.cumsum(np.bincount(self._lead(sorted_keys), minlength=self.cells))).astype(np.int32)

    def _lead(self, keys: np.ndarray) -> np.ndarray:
        return np.minimum((keys.view(np.uint64) - self.least) >> self.shift, _U(self.cells - 1)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key in the sorted ones, or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        lead = self._lead(keys)
        at, end = self.begin[lead], self.begin[lead + 1]
        live = np.flatnonzero(at < end)
        at, end, keys = at[live], end[live], keys[live]
        while len(live):
            same = self.keys[at] == keys
            out[live[same]] = at[same]
            at += 1
            on = np.flatnonzero(~same & (at < end))
            live, at, end, keys = live[on], at[on], end[on], keys[on]
        return out


def gram_key(left: np.ndarray, right: np.ndarray, order: int) -> np.ndarray:
    """Keys of n-grams from the keys of their parts without the last and without the first word."""
    return mix64(left.view(np.uint64) * _LEFT + right.view(np.uint64) * _RIGHT + _U(order)).view(np.int64)


def grams(tok: np.ndarray, lengths: np.ndarray, orders: int):
    """``order, starts, left, right, key`` of the n-grams inside the rows, for each order from 2."""
    inside = np.ones(len(tok), dtype=bool)
    inside[np.cumsum(lengths) - 1] = False  # nothing follows an END
    key, ok = tok, np.ones(len(tok), dtype=bool)
    for order in range(2, orders + 1):
        left, right = key[:-1], key[1:]
        key = gram_key(left, right, order)
        ok = ok[1:] & inside[: len(key)]
        yield order, np.flatnonzero(ok), left[ok], right[ok], key[ok]


def squeeze(a: np.ndarray) -> bytes:
    """An array of numbers, byte plane by byte plane, compressed; whole numbers without the planes that are all zero."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize)
    if a.dtype.kind in "iu" and len(a):
        most = int(np.bitwise_or.reduce(a.view(f"u{a.itemsize}")))
        planes = planes[:, : max(1, -(-most.bit_length() // 8))]
    return bytes([planes.shape[1]]) + pa.compress(planes.T.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(packed: bytes, n: int, dtype) -> np.ndarray:
    width = packed[0]
    raw = pa.decompress(memoryview(packed)[1:], n * width, codec="zstd", asbytes=True)
    out = np.zeros((n, np.dtype(dtype).itemsize), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, dtype=np.uint8).reshape(width, n).T
    return out.view(dtype).ravel()


def squeeze_sorted(a: np.ndarray) -> bytes:
    """As ``squeeze``, for rising numbers: the steps between them."""
    return squeeze(np.diff(a, prepend=a.dtype.type(0)))


def unsqueeze_sorted(packed: bytes, n: int, dtype) -> np.ndarray:
    return np.cumsum(unsqueeze(packed, n, dtype), dtype=dtype)


def squeeze_words(a: np.ndarray) -> bytes:
    """As ``squeeze``, for hashes in no order of which some come again: as they are, compressed."""
    return pa.compress(np.ascontiguousarray(a), codec="zstd", asbytes=True)


def unsqueeze_words(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, n * 8, codec="zstd", asbytes=True), dtype=np.int64)


def bucket_slices(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """``bucket, places`` of the sorted keys of each bucket.  A bucket is a range of keys, so that the steps between
    the keys that a task sends to it depend on how many it sends in all, not on how many buckets there are."""
    least = [((-(-(b << 32) // buckets) << 32) - (1 << 63)) for b in range(buckets)]
    ends = np.append(np.searchsorted(keys, np.array(least[1:], dtype=np.int64)), len(keys))
    begins = np.append(0, ends[:-1])
    for b in np.flatnonzero(ends > begins):
        yield int(b), np.arange(begins[b], ends[b])


def key_filter(keys: DataFrame) -> np.ndarray:
    """Bits of a one-column table of keys: ``FILTER_BITS`` a key, rounded up to a power of two inside the bounds."""
    schema = StructType([StructField("block", IntegerType()), StructField("bits", BinaryType())])
    need = -(-FILTER_BITS * keys.count() // 64)
    words = min(max(FILTER_WORDS, 1 << max(0, need - 1).bit_length()), MOST_FILTER_WORDS)
    size = words * 8 // FILTER_BLOCKS

    def run(batches):
        bits = np.zeros(words * 8, dtype=np.uint8)
        for batch in batches:
            place = batch.column(0).to_numpy().view(np.uint64) & _U(words * 64 - 1)
            np.bitwise_or.at(bits, place >> _U(3), np.left_shift(1, place & _U(7), dtype=np.uint64).astype(np.uint8))
        for i, block in enumerate(bits.reshape(FILTER_BLOCKS, size)):
            if block.any():
                yield out_batch(schema, [pa.array([i]), pa.array([squeeze(block)], pa.binary())])
        bits = block = None
        give_back()

    def either(table: pa.Table) -> pa.Table:
        bits = np.zeros(size, dtype=np.uint8)
        for packed in table["bits"]:
            bits |= unsqueeze(packed.as_py(), size, np.uint8)
        return pa.Table.from_batches([out_batch(schema, [table["block"][:1].combine_chunks(), pa.array([squeeze(bits)], pa.binary())])])

    got = keys.mapInArrow(run, schema).groupBy("block").applyInArrow(either, schema).toArrow()
    bits = np.zeros((FILTER_BLOCKS, size), dtype=np.uint8)
    for block, packed in zip(got["block"].to_pylist(), got["bits"].to_pylist(), strict=True):
        bits[block] = unsqueeze(packed, size, np.uint8)
    return bits.ravel().view(np.int64)


def may_have(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the table of ``bits``; no key of the table is missed."""
    u = keys.view(np.uint64)
    word = bits.view(np.uint64)[(u >> _U(6)) & _U(len(bits) - 1)]
    return (word >> (u & _U(63))) & _U(1) != 0


def _buckets(base: DataFrame, size: int) -> int:
    """Buckets for about ``size`` bytes of the texts of ``base`` each."""
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(base.sparkSession.sparkContext.defaultParallelism, -(-int(total) // size))


_LONGS = StructType([StructField(c, LongType()) for c in ("key", "left", "right", "n")])


def _counts(base: DataFrame, order: int, min_count: int, buckets: int, shorter: np.ndarray | None = None) -> DataFrame:
    """``key, left, right, n`` of the n-grams of ``order`` words that occur ``min_count`` times (words: all).

    ``shorter``: filter of the n-grams of ``order - 1`` words that do.  A word is its own ``left`` and has 0 as ``right``."""
    packed = StructType([StructField("bucket", IntegerType()), StructField("size", LongType()),
                         *[StructField(c, BinaryType()) for c in ("left", "right", "n")]])
    least = min_count if order > 1 else 1

    def summed(left, right, n):
        key = gram_key(left, right, order) if order > 1 else left
        by = np.argsort(key)
        key = key[by]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        first = by[new]
        return key[new], left[first], right[first], np.add.reduceat(n[by], new)

    def hand_on(parts):
        left, right = (np.concatenate(x) for x in zip(*parts, strict=True))
        if len(left):
            key, left, right, n = summed(left, right, np.ones(len(left), dtype=np.int64))
            for b, at in bucket_slices(key, buckets):
                if order > 1:  # words are in order already
                    at = at[np.argsort(left[at])]
                yield out_batch(packed, [pa.array([b]), pa.array([len(at)]), *[pa.array([x], pa.binary()) for x in (
                    squeeze_sorted(left[at]), squeeze_words(right[at]), squeeze(n[at]))]])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            offsets, data = texts(batch, 0)
            for lo, hi in chunk_rows(offsets, PART_BYTES):
                tok, lengths = tokens(offsets, data, lo, hi)
                left, right = tok, np.zeros_like(tok)
                for _, _, left, right, _ in grams(tok, lengths, order):
                    pass
                if order > 1:
                    both = may_have(shorter, left) & may_have(shorter, right)
                    left, right = left[both], right[both]
                held.append((left, right))
                size += len(left)
                if size > HELD_GRAMS:
                    yield from hand_on(held)
                    held, size = [], 0
        if held:
            yield from hand_on(held)
        held = None
        give_back()

    def merge(table: pa.Table) -> pa.Table:
        give_back()
        parts = [(unsqueeze_sorted(r["left"], r["size"], np.int64), unsqueeze_words(r["right"], r["size"]),
                  unsqueeze(r["n"], r["size"], np.int64)) for r in table.to_pylist()]
        columns = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        enough = columns[-1] >= least
        return pa.Table.from_batches([out_batch(_LONGS, [c[enough] for c in columns])])

    with shuffles_removed(base.sparkSession):
        return materialise(base.mapInArrow(run, packed).groupBy("bucket").applyInArrow(merge, _LONGS), f"counts-{order}")


@dataclass
class SuffixTree:
    """``weights``: ``order, key, n, value`` of all words (their count and, for states, backoff) and of the n-grams
    that add something to a score; ``words`` and ``frequent``: the frequent ones of either kind, held by every task."""

    train_tokens: int
    distinct: int
    weights: DataFrame
    words: tuple[np.ndarray, np.ndarray, np.ndarray]  # sorted hashes, counts, backoff
    frequent: tuple[np.ndarray, np.ndarray]  # sorted keys of n-grams, what they add
    depth: int

    @property
    def denominator(self) -> float:
        return float(self.train_tokens + self.distinct + 1)


def _states(rows: DataFrame, shorter: DataFrame, divergence: float) -> DataFrame:
    """``context, count, backoff`` of the contexts that are states.

    ``rows``: ``left, n, below`` (log10 P of the last word at the context's suffix); ``shorter``: counts of contexts."""
    n, ln10 = F.col("n"), float(np.log(10))
    sums = rows.groupBy("left").agg(
        F.sum("n").alias("explicit"), F.sum(n * F.log(n.cast("double"))).alias("n_log_n"),
        F.sum(n * F.col("below") * ln10).alias("n_log_below"), F.sum(F.pow(F.lit(10.0), "below")).alias("p_below"),
        F.count("*").alias("followers"))
    count, explicit = F.col("count"), F.col("explicit")
    rest, rest_below = (count - explicit) / count, F.greatest(1 - F.col("p_below"), F.lit(1e-12))
    gain = F.col("n_log_n") - explicit * F.log(count.cast("double")) - F.col("n_log_below") \
        + F.when(rest > 0, count * rest * F.log(rest / rest_below)).otherwise(0.0)
    free = (count - explicit + DISCOUNT * F.col("followers")) / count
    return sums.join(shorter.select(F.col("key").alias("left"), F.col("n").alias("count")), "left") \
        .where(gain >= divergence).select(F.col("left").alias("context"), "count", F.log10(free / rest_below).alias("backoff"))


def fit_suffix_tree(train: DataFrame, text_col: str = "text", min_share: float = 0.0,
                    vocabulary_share: float = VOCABULARY_SHARE, divergence: float = DIVERGENCE,
                    min_count: int = MIN_COUNT, depth: int = DEPTH) -> tuple[SuffixTree, DataFrame]:
    """The tree, and the table ``key, n`` of all training tokens (``key`` hashes the word).

    ``min_share`` (none by default) leaves out n-grams under that share of all tokens."""
    spark = train.sparkSession
    base = train.select(train[text_col].cast("string").alias("text"))
    buckets = _buckets(base, COUNT_BYTES)
    unigrams = _counts(base, 1, min_count, buckets)
    total = unigrams.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"), F.count("*").alias("v")).first()
    n_tokens, distinct = int(total["t"]), int(total["v"])
    denominator, least = float(n_tokens + distinct + 1), F.lit(max(float(min_count), min_share * n_tokens))

    def level_tables():
        shorter = unigrams.where(F.col("n") >= least)
        below = unigrams.select(F.col("key").alias("right"), F.log10((F.col("n") + 1) / F.lit(denominator)).alias("below"))
        for order in range(2, depth + 2):
            enough = _counts(base, order, min_count, buckets, key_filter(shorter.select("key"))).where(F.col("n") >= least)
            rows = materialise(enough.join(looked_up(below), "right").select("key", "left", "n", "below"), f"follow-{order}")
            states = materialise(_states(rows, shorter, divergence), f"states-{order}")
            log = F.log10((F.col("n") - DISCOUNT) / F.col("count"))
            level = materialise(rows.join(looked_up(states), F.col("left") == F.col("context")).select(
                "key", "n", log.alias("log"), (log - F.col("below") - F.col("backoff")).alias("value")), f"level-{order}")
            used.append(states)
            yield states.select(F.lit(order - 1).alias("order"), F.col("context").alias("key"), F.col("count").alias("n"),
                                F.col("backoff").alias("value"))
            yield level.select(F.lit(order).alias("order"), "key", "n", "value")
            below = level.select(F.col("key").alias("right"), F.col("log").alias("below"))
            used.append(level)
            for table in (rows, *([shorter] if order > 2 else [])):
                discard(table)
            shorter = enough
        if depth:
            used.append(shorter)

    used: list[DataFrame] = []  # tables that the weights replace
    with shuffles_removed(spark):
        added = reduce(DataFrame.unionAll, level_tables()).groupBy("order", "key") \
            .agg(F.max("n").alias("n"), F.sum("value").alias("value"))
        words = unigrams.select("key", "n").join(added.where("order = 1").select("key", "value"), "key", "left") \
            .select(F.lit(1).alias("order"), "key", "n", F.coalesce("value", F.lit(0.0)).alias("value"))
        weights = materialise(words.unionAll(added.where("order > 1").select("order", "key", "n", "value")), "weights")
        for table in used:
            discard(table)
        often = F.col("n") >= F.lit(max(1.0, vocabulary_share * n_tokens))
        tables = []
        for kind, columns in (("order = 1", ["key", "n", "value"]), ("order > 1", ["key", "value"])):
            got = weights.where(F.expr(kind) & often).select(*columns).toArrow()
            by = np.argsort(got["key"].to_numpy())
            tables.append(tuple(c.to_numpy()[by] for c in got.columns))
    return SuffixTree(n_tokens, distinct, weights, *tables, depth), unigrams.select("key", "n")


def _packed_tree(weights: DataFrame, buckets: int) -> DataFrame:
    """``bucket, size, keys, counts, values``: the tree's table as arrays (counts of words only)."""
    schema = StructType([StructField("bucket", IntegerType()), StructField("size", LongType()),
                         *[StructField(c, BinaryType()) for c in ("keys", "counts", "values")]])

    def hand_on(parts):
        order, key, n, value = (np.concatenate(x) for x in zip(*parts, strict=True))
        n = np.where(order == 1, n, 0)
        by = np.argsort(key)
        key, n, value = key[by], n[by], value[by]
        for b, at in bucket_slices(key, buckets):
            yield out_batch(schema, [pa.array([b]), pa.array([len(at)]), *[pa.array([x], pa.binary()) for x in (
                squeeze_sorted(key[at]), squeeze(n[at]), squeeze(value[at]))]])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy() for i in range(4)))
            size += batch.num_rows
            if size > HELD_GRAMS:
                yield from hand_on(held)
                held, size = [], 0
        if size:
            yield from hand_on(held)

    return weights.select("order", "key", "n", "value").mapInArrow(run, schema)


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                extra: dict[str, Column] | None = None, **fit) -> DataFrame:
    """``doc_id, [extra,] n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    The model learns from the rows where ``train`` holds (null: does not).
    Null and empty texts are scored as the end token alone.  Rows are scored
    one by one, also those that repeat an id or have none.
    """
    extra = extra or {}
    tree, unigrams = fit_suffix_tree(docs.where(train), text_col, **fit)
    discard(unigrams)  # the weights have them
    base = docs.select(docs[id_col].alias("doc_id"), *[c.alias(n) for n, c in extra.items()],
                       F.monotonically_increasing_id().alias("row"), docs[text_col].cast("string").alias("text"))
    at, kept = len(base.columns) - 1, len(base.columns) - 2
    fixed = [StructField(c, base.schema[c].dataType) for c in base.columns[:kept]]
    own = [StructField("place", LongType()), StructField("n_tokens", LongType()), StructField("n_known", LongType()),
           StructField("base_score", DoubleType()), StructField("score", DoubleType())]
    asked_schema = StructType([StructField("bucket", IntegerType()), StructField("held", LongType()), *fixed, *own,
                               StructField("size", LongType()), StructField("keys", BinaryType()), StructField("places", BinaryType())])
    answer_schema = StructType([StructField("held", LongType()), *fixed, *own, StructField("size", LongType()),
                                *[StructField(c, BinaryType()) for c in ("places", "known", "base", "tree")]])
    out_schema = StructType([*fixed, own[1], own[2], StructField("train_tokens", LongType()), own[3], own[4]])
    with shuffles_removed(docs.sparkSession):
        bits = key_filter(tree.weights.select("key"))
        buckets = _buckets(base, ASK_BYTES)
    words, word_log, word_value = Places(tree.words[0]), np.log10((tree.words[1] + 1) / tree.denominator), tree.words[2]
    frequent, value = Places(tree.frequent[0]), tree.frequent[1]
    orders, unseen, train_tokens = tree.depth + 1, float(np.log10(1 / tree.denominator)), tree.train_tokens

    def hand_on(first, columns, n, known, sums, asked):
        """The rows that a task holds, and for each bucket the keys they ask for, with the places of the rows."""
        rows = len(n)
        bare = [pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary())]
        yield out_batch(asked_schema, [np.full(rows, first % buckets), np.full(rows, first), *columns, np.arange(rows),
                                       n, known, sums[0], sums[1], *bare])
        keys, places = (np.concatenate(x) for x in zip(*asked, strict=True))
        by = np.argsort(keys)
        keys, places = keys[by], places[by]
        for b, some in bucket_slices(keys, buckets):
            nothing = [pa.nulls(1, f.type) for f in columns] + [pa.nulls(1, pa.int64())] * 3 + [pa.nulls(1, pa.float64())] * 2
            yield out_batch(asked_schema, [pa.array([b]), pa.array([first]), *nothing, pa.array([len(some)]),
                                           pa.array([squeeze_sorted(keys[some])], pa.binary()),
                                           pa.array([squeeze(places[some].astype(np.uint32))], pa.binary())])

    def run(batches):
        for batch in batches:
            offsets, data = texts(batch, at)
            ids = batch.column(at - 1).to_numpy()
            begin, size, parts = 0, 0, []
            for lo, hi in chunk_rows(offsets, PART_BYTES):
                tok, lengths = tokens(offsets, data, lo, hi)
                rows = hi - lo
                row = np.repeat(np.arange(rows), lengths)
                w = words.find(tok)
                there = w >= 0
                flat = np.bincount(row, weights=np.where(there, word_log[w], unseen) if len(word_log) else np.full(len(tok), unseen), minlength=rows)
                known = np.bincount(row[there], minlength=rows)
                total = flat + np.bincount(row[there], weights=word_value[w[there]], minlength=rows)
                ask = np.flatnonzero(~there)
                ask = ask[may_have(bits, tok[ask])]
                asked = [(tok[ask], row[ask] + lo - begin)]
                for _, starts, _, _, keys in grams(tok, lengths, orders):
                    some = np.flatnonzero(may_have(bits, keys))
                    keys, of = keys[some], row[starts[some]]
                    g = frequent.find(keys)
                    there = g >= 0
                    total += np.bincount(of[there], weights=value[g[there]], minlength=rows)
                    asked.append((keys[~there], of[~there] + lo - begin))
                size += sum(len(k) for k, _ in asked)
                parts.append((lengths, known, flat, total, asked))
                if size > HELD_GRAMS or hi == batch.num_rows:
                    n, known, flat, total = (np.concatenate([p[i] for p in parts]) for i in range(4))
                    columns = [c.slice(begin, hi - begin) for c in batch.columns[:kept]]
                    yield from hand_on(int(ids[begin]), columns, n, known, (flat, total), [a for p in parts for a in p[4]])
                    begin, size, parts = hi, 0, []
        give_back()

    def answer(asked: pa.Table, model: pa.Table) -> pa.Table:
        give_back()
        parts = [(unsqueeze_sorted(r["keys"], r["size"], np.int64), unsqueeze(r["counts"], r["size"], np.int64),
                  unsqueeze(r["values"], r["size"], np.float64)) for r in model.to_pylist()]
        keys, counts, values = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        by = np.argsort(keys)
        places_of, counts, values = Places(keys[by]), counts[by], values[by]
        whole = asked.filter(pc.is_null(asked["size"])).select([f.name for f in (answer_schema.fields[: 1 + kept + len(own)])])
        n = whole.num_rows
        out = [out_batch(answer_schema, [*[c.combine_chunks() for c in whole.columns], pa.nulls(n, pa.int64()),
                                         *[pa.nulls(n, pa.binary())] * 4])]
        asked = asked.filter(pc.is_valid(asked["size"]))
        for held, size, k, p in zip(*(asked[c].to_pylist() for c in ("held", "size", "keys", "places")), strict=True):
            hit = places_of.find(unsqueeze_sorted(k, size, np.int64))
            there = hit >= 0
            place, hit = unsqueeze(p, size, np.uint32)[there], hit[there]
            if not len(place):
                continue
            places = np.flatnonzero(np.bincount(place)).astype(np.uint32)
            word = counts[hit] > 0
            log = np.log10(counts[hit] + 1)
            sums = [np.bincount(place, weights=x)[places] for x in (word, log, log + values[hit])]
            nothing = [pa.nulls(1, f.type) for f in whole.schema][1:]
            out.append(out_batch(answer_schema, [
                pa.array([held]), *nothing, pa.array([len(places)]), *[pa.array([x], pa.binary()) for x in (
                    squeeze_sorted(places), squeeze(sums[0].astype(np.uint32)), squeeze(sums[1]), squeeze(sums[2]))]]))
        return pa.Table.from_batches(out)

    def together(table: pa.Table) -> pa.Table:
        whole = table.filter(pc.is_null(table["size"])).sort_by("place")
        n = whole.num_rows
        known, flat, total = (whole[c].to_numpy().copy() for c in ("n_known", "base_score", "score"))
        answers = table.filter(pc.is_valid(table["size"]))
        for size, p, k, b, t in zip(*(answers[c].to_pylist() for c in ("size", "places", "known", "base", "tree")), strict=True):
            places = unsqueeze_sorted(p, size, np.uint32)
            known[places] += unsqueeze(k, size, np.uint32)
            flat[places] += unsqueeze(b, size, np.float64)
            total[places] += unsqueeze(t, size, np.float64)
        columns = [whole[f.name].combine_chunks() for f in fixed]
        return pa.Table.from_batches([out_batch(out_schema, [*columns, whole["n_tokens"].combine_chunks(), known,
                                                             np.full(n, train_tokens), flat, total])])

    answers = base.mapInArrow(run, asked_schema).groupBy("bucket") \
        .cogroup(_packed_tree(tree.weights, buckets).groupBy("bucket")).applyInArrow(answer, answer_schema)
    return answers.groupBy("held").applyInArrow(together, out_schema)
