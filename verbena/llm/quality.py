"""Quality classifier by importance resampling.

Two generative models over hashed token n-grams (one- and two-token runs): the
target text (labelled clean documents) and the raw text.  Each is taken twice:

- occurrences: the raw text is every document; a text's sum of
  log(target / raw) over its n-grams tells junk from prose;
- presence: the shares of labelled documents that have an n-gram at all; the
  distinct n-grams that targets clearly avoid are summed.  A few offensive words
  in a long clean text vanish in the first sum, but not in this one.

For each sum, a cut separates the labelled target documents from the other
labelled ones best.  The log importance weight is the occurrence sum; in a text
with avoided n-grams it is at most the cut plus what the presence sum has over
its own cut.  Documents are then drawn without replacement in
proportion to their weights by Gumbel top-k: weight / temperature plus Gumbel
noise, largest k.  k is the number of documents whose weight reaches the cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import LOWER, SPACE, chunk_rows, give_back, joined, materialise, mix64, out_batch, range_hashes, texts

#: Buckets of the hashed models (as a power of two) and labelled rows that a fit uses at most (expected number).
BUCKET_BITS, FIT_ROWS = 18, 200_000
TEMPERATURE, SMOOTHING = 0.1, 2.0
#: The presence model: its buckets (as a power of two), pseudo count (a share of the labelled documents, and at
#: least as many), and the least |log ratio| that counts.
PRESENCE_BITS, PRESENCE_SHARE, PRESENCE_LEAST, AVOIDED = 20, 0.002, 2.0, 1.5
_U = np.uint64
_FIX, _KEY_BITS = 1 << 16, 48

_CLASS = np.ones(256, dtype=np.uint8)  # 0 space, 1 word, 2 other
_CLASS[:128] = 2
_CLASS[48:58] = _CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[SPACE] = 0


def features(offsets: np.ndarray, data: memoryview, lo: int, hi: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all one- and two-token n-grams of rows lo..hi, and their row.

    Tokens are runs of letters and digits (A-Z lower-cased, any non-ASCII byte) or runs of other signs."""
    buf, row_start = joined(offsets, data, lo, hi, b" ")
    cls = _CLASS[buf]
    change = np.flatnonzero(cls[1:] != cls[:-1]) + 1
    begin, end = np.append(0, change), np.append(change, len(buf))
    word = cls[begin] > 0
    begin, end = begin[word], end[word]
    h = range_hashes(LOWER[buf], begin, end)
    row = np.searchsorted(row_start, begin, side="right") - 1
    pair = row[1:] == row[:-1]
    two = mix64(h[:-1] * _U(0x9E3779B97F4A7C15) + h[1:])[pair]
    bucket = np.concatenate([h, two]) >> _U(64 - bits)
    return bucket.astype(np.int64), np.concatenate([row, row[1:][pair]])


@dataclass
class ImportanceModel:
    """Log ratios per bucket, and the cuts of the two sums."""

    log_ratio: np.ndarray
    avoided: np.ndarray
    fitted: bool
    cuts: tuple[float, float] = (0.0, 0.0)

    def sums(self, offsets: np.ndarray, data: memoryview) -> tuple[np.ndarray, np.ndarray]:
        """The occurrence and the presence sum of every text."""
        uses, presence = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        for lo, hi in chunk_rows(offsets):
            bucket, row = features(offsets, data, lo, hi, PRESENCE_BITS)
            uses[lo:hi] = np.bincount(row, weights=self.log_ratio[bucket >> (PRESENCE_BITS - BUCKET_BITS)], minlength=hi - lo)
            hit = self.avoided[bucket] != 0
            bucket, row = _distinct(bucket[hit], row[hit])
            presence[lo:hi] = np.bincount(row, weights=self.avoided[bucket], minlength=hi - lo)
        return uses, presence

    def weights(self, offsets: np.ndarray, data: memoryview) -> np.ndarray:
        uses, presence = self.sums(offsets, data)
        return np.where(presence < 0, np.minimum(uses, self.cuts[0] + presence - self.cuts[1]), uses)


def _distinct(bucket: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every bucket once per row."""
    both = np.unique((row.astype(np.int64) << PRESENCE_BITS) + bucket)
    return both & ((1 << PRESENCE_BITS) - 1), both >> PRESENCE_BITS


def labelled_sample(labels: DataFrame, target: Column, id_col: str = "doc_id", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``__vl_id, __vl_target``: about ``fit_rows`` labelled ids at most, chosen by a hash of the id.

    An id is a target if every row of it says so; rows with a null id or an undecided target are left out."""
    rows = labels.select(labels[id_col].alias("__vl_id"), target.cast("boolean").alias("__vl_target")) \
        .where(F.col("__vl_id").isNotNull() & F.col("__vl_target").isNotNull())
    one = rows.groupBy("__vl_id").agg(F.bool_and("__vl_target").alias("__vl_target"))
    n = rows.count()
    if n > fit_rows:
        one = one.where(F.pmod(F.xxhash64("__vl_id"), F.lit(1 << 30)) < int((1 << 30) * fit_rows / n))
    return one


def fit_importance(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   smoothing: float = SMOOTHING) -> ImportanceModel:
    """Fit on every row of ``docs``; ``sample`` says which are labelled, and which of those are targets.

    ``sample`` is bounded (see ``labelled_sample``) and broadcast.  Each task
    counts into arrays of 2^bits and hands on the buckets that occur; the
    presence counts only see labelled rows, so they do not grow with the corpus."""
    base = docs.select(docs[id_col].alias("__vl_id"), docs[text_col].cast("string").alias("text")) \
        .join(F.broadcast(sample), "__vl_id", "left") \
        .select("text", F.when(F.col("__vl_target"), 2).when(F.col("__vl_target").isNotNull(), 1).otherwise(0).alias("label"))
    schema = StructType([StructField("bucket", IntegerType()), StructField("raw", LongType()),
                         StructField("target", LongType())])
    size, wide = 1 << BUCKET_BITS, 1 << PRESENCE_BITS

    def count(batches):
        raw, tgt = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        seen, seen_tgt = np.zeros(wide, dtype=np.int32), np.zeros(wide, dtype=np.int32)
        labelled = targets = 0
        for batch in batches:
            offsets, data = texts(batch, 0)
            label = batch.column(1).to_numpy()
            labelled += int((label > 0).sum())
            targets += int((label == 2).sum())
            for lo, hi in chunk_rows(offsets):
                bucket, row = features(offsets, data, lo, hi, PRESENCE_BITS)
                kind = label[lo:hi][row]
                narrow = bucket >> (PRESENCE_BITS - BUCKET_BITS)
                raw += np.bincount(narrow, minlength=size)
                tgt += np.bincount(narrow[kind == 2], minlength=size)
                once, row = _distinct(bucket[kind > 0], row[kind > 0])
                np.add.at(seen, once, 1)
                np.add.at(seen_tgt, once[label[lo:hi][row] == 2], 1)
        at, also = np.flatnonzero(raw), np.flatnonzero(seen)
        yield out_batch(schema, [np.append(at, also + size), np.append(raw[at], seen[also].astype(np.int64)),
                                 np.append(tgt[at], seen_tgt[also].astype(np.int64))])
        yield out_batch(schema, [np.array([size + wide]), np.array([labelled]), np.array([targets])])
        raw = tgt = seen = seen_tgt = None
        give_back()

    got = base.mapInArrow(count, schema).groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()  # at most size + wide + 1 rows
    raw, tgt = np.zeros(size + wide + 1), np.zeros(size + wide + 1)
    at = got["bucket"].to_numpy()
    raw[at], tgt[at] = got["raw"].to_numpy(), got["target"].to_numpy()
    if not tgt[:size].any():
        return ImportanceModel(np.zeros(size), np.zeros(wide), False)
    # both counts at the target's scale with the same pseudo count: n-grams too rare to tell weigh nothing
    expected = raw[:size] * (tgt[:size].sum() / raw[:size].sum())
    ratio = np.log(tgt[:size] + smoothing) - np.log(expected + smoothing)
    expected = raw[size:-1] * (tgt[-1] / raw[-1])
    pseudo = max(PRESENCE_LEAST, PRESENCE_SHARE * raw[-1])
    avoided = np.log(tgt[size:-1] + pseudo) - np.log(expected + pseudo)
    return ImportanceModel(ratio, np.where(avoided < -AVOIDED, avoided, 0.0), True)


def with_sums(thin: DataFrame, model: ImportanceModel) -> DataFrame:
    """``doc_id, uses, presence`` of ``(doc_id, text)`` (0 for a null or empty text)."""
    schema = StructType([thin.schema["doc_id"], StructField("uses", DoubleType()), StructField("presence", DoubleType())])

    def run(batches):
        for batch in batches:
            yield out_batch(schema, [batch.column(0), *map(pa.array, model.sums(*texts(batch, 1)))])
        give_back()

    return thin.mapInArrow(run, schema)


def with_log_weight(docs: DataFrame, model: ImportanceModel, text_col: str = "text",
                    name: str = "__vl_weight") -> DataFrame:
    """All columns of ``docs`` and the log importance weight."""
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            offsets, data = texts(batch, at)
            yield out_batch(schema, [*batch.columns, pa.array(model.weights(offsets, data))])
        give_back()

    return docs.mapInArrow(run, schema)


def gumbel_key(weight: Column, ident: Column, temperature: float = TEMPERATURE, seed: int = 42) -> Column:
    """weight / temperature + Gumbel noise, the noise a hash of the id (repeatable)."""
    u = (F.pmod(F.xxhash64(ident, F.lit(seed)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    return weight / F.lit(temperature) - F.log(-F.log(u))


def _fixed(key: Column) -> Column:
    """The key as a whole number of 48 bits in the same order (steps of 2^-16)."""
    top = (1 << (_KEY_BITS - 1)) - 1
    q = F.round(key * F.lit(float(_FIX))).cast("long")
    return F.greatest(F.lit(-top), F.least(F.lit(top), q)) + F.lit(top)


def kth_largest(keys: DataFrame, k: int) -> int:
    """The k-th largest ``key`` (48 bits) by three counting passes of 16 bits; at most 65,536 counts reach the driver."""
    prefix, left = 0, k
    for shift in (32, 16, 0):
        part = keys.where(F.shiftright("key", shift + 16) == prefix) if shift < 32 else keys
        counts = part.groupBy(F.shiftright("key", shift).alias("p")).agg(F.count("*").alias("n")).collect()
        for r in sorted(counts, key=lambda r: -r["p"]):
            if r["n"] >= left:
                prefix = r["p"]
                break
            left -= r["n"]
    return prefix


@dataclass
class Selection:
    """What a fitted resampling keeps: rows whose key is at least ``least``."""

    model: ImportanceModel
    least: int | None
    temperature: float
    seed: int
    k: int

    def kept(self, weight: Column, ident: Column) -> Column:
        if self.least is None:
            return F.lit(True)
        return _fixed(gumbel_key(weight, ident, self.temperature, self.seed)) >= F.lit(self.least)


def best_cut(weight: np.ndarray, good: np.ndarray) -> float:
    """The weight from which on calling a labelled row a target is right most often."""
    order = np.argsort(-weight, kind="stable")
    w, g = weight[order], good[order].astype(np.int64)
    right = np.concatenate([[0], np.cumsum(g)]) + np.concatenate([[(1 - g).sum()], (1 - g).sum() - np.cumsum(1 - g)])
    ends = np.append(np.flatnonzero(np.append(True, w[1:] != w[:-1])), len(w))  # equal weights go together
    at = int(ends[right[ends].argmax()])
    if at == 0:
        return np.inf
    return float(w[-1]) - 1.0 if at == len(w) else float((w[at - 1] + w[at]) / 2)


def fit_selection(docs: DataFrame, labels: DataFrame, target: Column, id_col: str = "doc_id", text_col: str = "text",
                  k: int | None = None, temperature: float = TEMPERATURE, seed: int = 42,
                  fit_rows: int = FIT_ROWS) -> tuple[Selection, DataFrame]:
    """Fit, and fix the k-th key; also the thin table ``doc_id, log_weight`` of all rows.

    Without a labelled target row (or with an empty table) nothing is known
    and every row is kept.  ``k`` overrides the number that the labels suggest."""
    sample = materialise(labelled_sample(labels, target, id_col, fit_rows).withColumn(
        "__vl_held", F.pmod(F.xxhash64("__vl_id", F.lit(1)), F.lit(5)) == 0), "labelled")
    # four fifths of the labelled rows fit the target model, the rest (if it has both kinds) chooses the cut
    fit = sample.where("not __vl_held") if sample.where("__vl_target").select("__vl_held").distinct().count() == 2 else sample
    model = fit_importance(docs, fit.drop("__vl_held"), id_col, text_col)
    if not model.fitted:  # its targets are not in docs
        model = fit_importance(docs, sample.drop("__vl_held"), id_col, text_col)
    thin = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    scored = materialise(with_sums(thin, model), "weights")
    if model.fitted:
        seen = scored.join(F.broadcast(sample), scored["doc_id"] == sample["__vl_id"]) \
            .select("uses", "presence", "__vl_target", "__vl_held").toPandas()  # the bounded sample
        other = seen[seen["__vl_held"].astype(bool)]
        seen = other if other["__vl_target"].nunique() == 2 else seen
        good = seen["__vl_target"].to_numpy().astype(bool)
        uses, presence = seen["uses"].to_numpy(), seen["presence"].to_numpy()
        # the presence sum only rejects: a text without an avoided n-gram has 0 and passes
        least = min(best_cut(presence, good), 0.0)
        model.cuts = (best_cut(uses[presence >= least], good[presence >= least]), least)
    bound = F.lit(model.cuts[0]) + F.col("presence") - F.lit(model.cuts[1])
    scored = scored.select("doc_id", F.when(F.col("presence") < 0, F.least("uses", bound))
                           .otherwise(F.col("uses")).alias("log_weight"))
    if not model.fitted:
        return Selection(model, None, temperature, seed, scored.count()), scored
    if k is None:
        k = scored.where(F.col("log_weight") >= F.lit(model.cuts[0])).count()
    keys = scored.select(_fixed(gumbel_key(F.col("log_weight"), F.col("doc_id"), temperature, seed)).alias("key"))
    least = kth_largest(keys, k) if k > 0 else 1 << _KEY_BITS
    return Selection(model, least, temperature, seed, k), scored


def importance_resample(docs: DataFrame, labels: DataFrame, target: Column, id_col: str = "doc_id",
                        text_col: str = "text", **options) -> DataFrame:
    """``doc_id, log_weight, gumbel_key, kept`` for every row of ``docs``.

    Null and empty texts weigh 0; rows that repeat an id and text share their
    fate; ties at the k-th key are all kept; other columns are ignored."""
    sel, scored = fit_selection(docs, labels, target, id_col, text_col, **options)
    return scored.select("doc_id", "log_weight",
                         gumbel_key(F.col("log_weight"), F.col("doc_id"), sel.temperature, sel.seed).alias("gumbel_key"),
                         sel.kept(F.col("log_weight"), F.col("doc_id")).alias("kept"))


def keep_quality(docs: DataFrame, labels: DataFrame, target: Column, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that ``importance_resample`` keeps."""
    sel, _ = fit_selection(docs, labels, target, id_col, text_col, **options)
    return with_log_weight(docs, sel.model, text_col).where(sel.kept(F.col("__vl_weight"), F.col(id_col))) \
        .drop("__vl_weight")
