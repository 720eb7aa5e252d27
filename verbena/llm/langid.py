"""Language identification with language-bitmask n-gram filters.

Training counts byte n-grams per language over the whole corpus.  An n-gram
belongs to each language in which it is frequent (share of all n-gram
occurrences at least ``min_share``) and not much rarer than in the language
where it is most frequent (``ratio``).  A bit-sliced Bloom filter holds one
word of language bits per slot: the AND over an n-gram's slots gives all its
languages at once.  A text's hits are counted per language, corrected for the
filter's false positives, and the largest corrected share decides.

``min_share`` bounds the model: a language has at most 1 / min_share n-grams,
whatever the size of the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import LOWER, chunk_rows, id_field, joined, mix64, out_batch, pick, texts

SLOTS_PER_GRAM, PROBES = 16, 4
#: n-grams that a training task holds before it hands its counts on.
HELD_GRAMS = 2_000_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_U = np.uint64


def grams(offsets: np.ndarray, data: memoryview, lo: int, hi: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-gram keys of rows lo..hi (runs of non-letters are one space, also before and after a text), and their row."""
    buf, starts = joined(offsets, data, lo, hi, b"\0")
    letter = _LETTER[buf]
    keep = letter.copy()
    keep[1:] |= ~letter[1:] & letter[:-1]
    keep[starts - 1] = True
    row = np.cumsum(np.bincount(starts - 1, minlength=len(buf)))[keep] - 1
    b = np.where(letter, LOWER[buf], 32)[keep].astype(np.uint64)
    m = len(b) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = b[:m].copy()
    for i in range(1, n):
        key = (key << _U(8)) | b[i: m + i]
    whole = row[:m] == row[n - 1:]
    return key[whole], row[:m][whole]


@dataclass
class LanguageFilter:
    languages: list[str]
    slots: np.ndarray  # (slots, words) of language bits
    false_rate: np.ndarray
    n: int

    def _probe(self, key: np.ndarray):
        h = mix64(key + _U(1))
        step = (h >> _U(32)) | _U(1)
        for j in range(PROBES):
            yield ((h + _U(j) * step) & _U(len(self.slots) - 1)).astype(np.int64)

    @classmethod
    def build(cls, languages: list[str], key: np.ndarray, lang: np.ndarray, n: int) -> LanguageFilter:
        size = 1 << max(6, int(np.ceil(np.log2(max(1, len(np.unique(key))) * SLOTS_PER_GRAM))))
        words = max(1, -(-len(languages) // 64))
        f = cls(languages, np.zeros((size, words), dtype=np.uint64), np.zeros(len(languages)), n)
        bit = _U(1) << (lang % 64).astype(np.uint64)
        for at in f._probe(key):
            np.bitwise_or.at(f.slots, (at, lang // 64), bit)
        for i in range(len(languages)):
            full = np.count_nonzero(f.slots[:, i // 64] >> _U(i % 64) & _U(1)) / size
            f.false_rate[i] = full ** PROBES
        return f

    def hits(self, key: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Per row: n-grams, and hits per language."""
        out = np.zeros((rows, len(self.languages)))
        mask = None
        for at in self._probe(key):
            mask = self.slots[at] if mask is None else mask & self.slots[at]
        for i in range(len(self.languages)):
            out[:, i] = np.bincount(row[(mask[:, i // 64] >> _U(i % 64) & _U(1)).astype(bool)], minlength=rows)
        return np.bincount(row, minlength=rows), out


def fit_language_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", n: int = 4,
                        min_share: float = 1e-5, ratio: float = 0.2) -> LanguageFilter:
    """Learn from all rows of ``docs`` with a text and a language; other rows are ignored.

    Without such rows the filter has no languages.  The driver receives at
    most 1 / ``min_share`` counts per language.
    """
    base = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    schema = StructType([StructField("lang", StringType()), StructField("gram", LongType()),
                         StructField("n", LongType())])

    def merged(held: list) -> list:
        key, n_ = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
        u, inv = np.unique(key, return_inverse=True)
        return [(u, np.bincount(inv, weights=n_, minlength=len(u)).astype(np.int64))]

    def flush(held: dict):
        for lang, parts in held.items():
            (key, cnt), = merged(parts)
            for a in range(0, len(key), 100_000):
                k = key[a: a + 100_000].astype(np.int64)
                yield out_batch(schema, [pa.array([lang] * len(k), pa.string()), k, cnt[a: a + 100_000]])

    def count(batches):
        held: dict[str, list] = {}
        for batch in batches:
            offsets, data = texts(batch, 1)
            langs = batch.column(0).to_pylist()
            names = sorted(set(langs))
            code = np.searchsorted(names, langs)
            for lo, hi in chunk_rows(offsets):
                key, row = grams(offsets, data, lo, hi, n)
                of = code[lo:hi][row]
                for i in np.unique(of):
                    u, c = np.unique(key[of == i], return_counts=True)
                    held.setdefault(names[i], []).append((u, c))
                    if len(held[names[i]]) > 8:
                        held[names[i]] = merged(held[names[i]])
            if sum(len(k) for parts in held.values() for k, _ in parts) > HELD_GRAMS:
                yield from flush(held)
                held = {}
        yield from flush(held)

    counts = base.mapInArrow(count, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    from .common import materialise
    counts = materialise(counts, "language-grams")
    totals = {r["lang"]: r["t"] for r in counts.groupBy("lang").agg(F.sum("n").alias("t")).collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageFilter([], np.zeros((64, 1), dtype=np.uint64), np.zeros(0), n)
    least = F.lit(None)
    for lang in languages:
        least = F.when(F.col("lang") == lang, F.lit(totals[lang] * min_share)).otherwise(least)
    got = counts.where(F.col("n") >= least).toArrow()
    lang = np.searchsorted(languages, got["lang"].to_pylist())
    key = got["gram"].to_numpy().astype(np.uint64)
    share = got["n"].to_numpy() / np.array([totals[x] for x in languages], dtype=float)[lang]
    u, inv = np.unique(key, return_inverse=True)
    most = np.zeros(len(u))
    np.maximum.at(most, inv, share)
    ok = share >= ratio * most[inv]
    return LanguageFilter.build(languages, key[ok], lang[ok], n)


def predict_language(docs: DataFrame, model: LanguageFilter, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, from its whole text alone.

    The score is the winner's corrected share of the text's n-grams (0 to 1);
    ties go to the first language in alphabetical order.  A null or empty text
    or one without letters, and any text if nothing was learned, gives ``und``
    and 0.  Repeated rows are predicted row by row; other columns are ignored.
    """
    base = pick(docs, id_col, text_col)
    schema = StructType([id_field(base), StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches):
        names = np.array([*model.languages, "und"], dtype=object)
        for batch in batches:
            offsets, data = texts(batch, 1)
            rows = len(offsets) - 1
            best, score = np.full(rows, len(model.languages)), np.zeros(rows)
            for lo, hi in chunk_rows(offsets) if model.languages else ():
                key, row = grams(offsets, data, lo, hi, model.n)
                n, hits = model.hits(key, row, hi - lo)
                expected = n[:, None] * model.false_rate
                fixed = np.clip((hits - expected) / (1 - np.minimum(model.false_rate, 0.999)), 0, None)
                top = fixed.argmax(axis=1)
                share = fixed[np.arange(hi - lo), top] / np.maximum(n, 1)
                best[lo:hi], score[lo:hi] = top, np.clip(share, 0, 1)
                buf, starts = joined(offsets, data, lo, hi, b"\0")
                letters = np.append(0, np.cumsum(_LETTER[buf] & (buf < 128)))
                ends = np.append(starts[1:] - 1, len(buf))
                for i in np.flatnonzero(letters[ends] == letters[starts]):  # no ASCII letter: is there any other?
                    if not any(c.isalpha() for c in bytes(data[offsets[lo + i]: offsets[lo + i + 1]]).decode()):
                        best[lo + i], score[lo + i] = len(model.languages), 0.0
            yield out_batch(schema, [batch.column(0), pa.array(names[best], pa.string()), score])

    return base.mapInArrow(run, schema)


def identify_languages(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang", **fit) -> DataFrame:
    """Learn from the rows where ``train`` holds and predict all rows."""
    return predict_language(docs, fit_language_filter(docs.where(train), text_col, lang_col, **fit), id_col, text_col)
