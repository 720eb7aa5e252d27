"""Pre-tokens: the runs between ASCII white space, across which the tokenizers served here never look.

``Pieces`` tokenizes each pre-token that a worker meets once and finds it again by
hash, length and its first and last bytes.

``tokenized`` does so for a whole corpus: every task sends each pre-token of a chunk
once with its count; one aggregation gives the distinct pre-tokens of the corpus
and one pass over them their pieces, written in the shared folder.  The most
frequent ones, up to ``FREQUENT`` of them and ``FREQUENT_BYTES``, are handed to the
tasks as flat arrays searched by 64-bit hash (pre-tokens that share a hash are
never among them); the others are looked up by the caller.
"""

from __future__ import annotations

import json
import os
import sys
import threading
import types
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import CHUNK_BYTES, LOWER, chunk_rows, give_back, joined, materialise, out_batch, range_hashes, texts, word_spans

#: Pre-tokens that are handed to every task at most.
FREQUENT = 1_000_000
#: Bytes of text that are hashed at once.
CHUNK = CHUNK_BYTES
#: Pre-tokens that a ``Pieces`` remembers at most before it forgets those that it met once (and half of them at least).
REMEMBERED = 800_000
#: Seconds after which a worker without a task forgets them.
REST_SECONDS = 2.0


#: Signs of which one may stand between pre-tokens that are tokenized together (the shorter, the faster).
SIGNS = ("\x01", "\U0001F602", "\u2764", "\u2605")


class Tokenizer:
    """A ``tokenizers`` file applied to pre-tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library
        self.library = Library.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        #: A sign with a piece of its own, which no pre-token without the sign can give; None where there is no such sign.
        unknown = getattr(self.library.model, "unk_token", None)
        self.sign = next((x for x in SIGNS if len(self._encode([x])[0]) == 1 and self.library.id_to_token(self._encode([x])[0][0]) != unknown
                          and self._encode([f"a {x} a"])[0].count(self._encode([x])[0][0]) == 1), None)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, words: list[bytes], together: int = 1000) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and how many each word has.

        Many words go through the library as one text, with the sign behind
        each; words that hold the sign go one by one.
        """
        alone = [i for i, w in enumerate(words) if self.sign is None or self.sign.encode() in w]
        if alone and len(alone) < len(words):
            apart = set(alone)
            rest = [i for i in range(len(words)) if i not in apart]
            both = [self.pieces([words[i] for i in part], together) for part in (alone, rest)]
            order = np.argsort(np.concatenate([alone, rest]))
            n = np.concatenate([x[1] for x in both])
            first = np.cumsum(n) - n
            flat = np.concatenate([x[0] for x in both])
            n, first = n[order], first[order]
            return flat[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())], n
        if alone or not words:
            found = self._encode([w.decode() for w in words])
            return np.array([i for x in found for i in x], dtype="<u4"), np.array([len(x) for x in found], dtype=np.int64)
        end = f" {self.sign} "
        found = self._encode([end.join(b"\n".join(words[i: i + together]).decode().split("\n")) + end for i in range(0, len(words), together)])
        ids = np.concatenate([np.array(x, dtype="<u4") for x in found])
        is_end = ids == self._encode([self.sign])[0][0]
        n = np.diff(np.append(-1, np.flatnonzero(is_end))) - 1
        if len(n) != len(words):
            raise ValueError("the tokenizer does not take pre-tokens one by one")
        return ids[~is_end], n


def folds_case(path: str) -> bytes | None:
    """Not None if the tokenizer lower-cases, so that A-Z may be lower-cased before it (composing and white space do
    not look at case): then the first bytes of its added tokens, which are found before that step."""
    with open(path, encoding="utf-8") as f:
        definition = json.load(f)
    rule = definition.get("normalizer") or {}
    steps = rule.get("normalizers", [rule])
    known = all(x.get("type") in ("NFC", "NFKC", "Lowercase") or x.get("type") == "Replace" and x.get("pattern") == {"Regex": "\\s+"} for x in steps)
    if not known or not any(x.get("type") == "Lowercase" for x in steps):
        return None
    return bytes({x["content"].encode()[0] for x in definition.get("added_tokens", []) if x["content"]})


def chunk_words(offsets: np.ndarray, data: memoryview, lo: int, hi: int, fold: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows lo..hi: the bytes, the words' starts, ends and hashes, and each row's word count.

    With ``fold`` A-Z are lower-cased, but in words that hold one of its bytes."""
    buf, row_start = joined(offsets, data, lo, hi, b" ")
    starts, ends, counts = word_spans(buf, row_start)
    if fold is not None:
        low = LOWER[buf]
        as_they_are = np.flatnonzero(np.isin(buf, np.frombuffer(fold, np.uint8)))
        for k in np.unique(np.searchsorted(starts, as_they_are, side="right") - 1).tolist():
            low[starts[k]: ends[k]] = buf[starts[k]: ends[k]]
        buf = low
    return buf, starts, ends, range_hashes(buf, starts, ends), counts


def cut_out(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw = buf.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def ends_of(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last eight bytes of each word as integers (a shorter word: all of it, twice)."""
    padded = np.concatenate([np.zeros(8, np.uint8), buf, np.zeros(8, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    spare = np.maximum(8 - (ends - starts), 0).astype(np.uint64) * np.uint64(8)
    first = np.ascontiguousarray(windows[starts + 8]).view("<u8").ravel() << spare
    last = np.ascontiguousarray(windows[ends]).view("<u8").ravel() >> spare << spare
    return first, last


def distinct_words(docs: DataFrame, fold: bytes | None) -> DataFrame:
    """``(word, n)`` of the second column of ``docs``."""
    schema = StructType([StructField("word", BinaryType()), StructField("n", LongType())])

    def run(batches):
        for batch in batches:
            offsets, data = texts(batch, 1)
            for lo, hi in chunk_rows(offsets, CHUNK):
                buf, starts, ends, h, _ = chunk_words(offsets, data, lo, hi, fold)
                order = np.argsort(h, kind="stable")
                h, starts, ends = h[order], starts[order], ends[order]
                new = np.zeros(len(h), dtype=bool)  # different words of one hash stay apart
                for x in (h, ends - starts, *ends_of(buf, starts, ends)):
                    new[1:] |= x[1:] != x[:-1]
                new[:1] = True
                at = np.flatnonzero(new)
                yield out_batch(schema, [cut_out(buf, starts[at], ends[at]), np.diff(np.append(at, len(h)))])

    return docs.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """``(word, n, hash, pieces)`` of every distinct pre-token, written."""
    schema = StructType([StructField("word", BinaryType()), StructField("n", LongType()), StructField("hash", LongType()),
                         StructField("pieces", LongType())])

    def run(batches):
        tokenizer = Tokenizer(path)
        for batch in batches:
            words = batch.column(0).to_pylist()
            size = np.array([len(w) for w in words], dtype=np.int64)
            ends = np.cumsum(size)
            h = range_hashes(np.frombuffer(b"".join(words), dtype=np.uint8), ends - size, ends)
            yield out_batch(schema, [batch.column(0), batch.column(1), h.view(np.int64), tokenizer.pieces(words)[1]])

    return materialise(distinct_words(docs, folds_case(path)).mapInArrow(run, schema), "pretokens")


class Pieces:
    """The piece ids of a worker's pre-tokens: ``ids[first[k]: first[k] + length[k]]`` for pre-token number k."""

    def __init__(self, path: str):
        self.tokenizer, self.fold = Tokenizer(path), folds_case(path)
        self.forget()

    def forget(self) -> None:
        self.hashes, self.number = np.empty(0, np.uint64), np.empty(0, np.int64)  # sorted by hash
        self.first, self.length, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u4")
        self.again = np.empty(0, np.int32)  # chunks in which a word was met after the first
        self.marks = [np.empty(0, t) for t in (np.int64, np.uint64, np.uint64)]  # word length, first and last bytes

    def _thin_out(self) -> None:
        """Forget the words that were not met again, and more of them if they are not half of all."""
        at = np.flatnonzero(self.again[self.number])
        if len(at) > REMEMBERED // 2:
            at = np.sort(at[np.argsort(-self.again[self.number[at]], kind="stable")[: REMEMBERED // 2]])
        k = self.number[at]
        n = self.length[k]
        first = np.cumsum(n) - n
        self.ids = self.ids[np.repeat(self.first[k] - first, n) + np.arange(n.sum())]
        self.first, self.length, self.again, self.marks = first, n, self.again[k] // 2, [m[k] for m in self.marks]
        self.hashes, self.number = self.hashes[at], np.arange(len(at))

    def _learn(self, words: list[bytes], marks: list[np.ndarray]) -> np.ndarray:
        ids, n = self.tokenizer.pieces(words)
        numbers = len(self.length) + np.arange(len(words))
        self.first = np.append(self.first, len(self.ids) + np.cumsum(n) - n)
        self.length = np.append(self.length, n)
        self.ids = np.append(self.ids, ids)
        self.again = np.append(self.again, np.zeros(len(words), np.int32))
        self.marks = [np.append(a, b) for a, b in zip(self.marks, marks, strict=True)]
        return numbers

    def numbers(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The number of each word of a chunk."""
        if len(self.hashes) > REMEMBERED:
            self._thin_out()
        marks = [ends - starts, *ends_of(buf, starts, ends)]
        unique, at, back = np.unique(h, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, unique)
        new = np.flatnonzero(np.append(self.hashes, 0)[place] != unique if len(self.hashes) else np.ones(len(unique), bool))
        new = np.union1d(new, np.flatnonzero(place == len(self.hashes)))
        self.again[self.number[np.delete(place, new)]] += 1
        k = at[new]
        learned = self._learn(cut_out(buf, starts[k], ends[k]), [m[k] for m in marks])
        self.number = np.insert(self.number, place[new], learned)
        self.hashes = np.insert(self.hashes, place[new], unique[new])
        out = self.number[np.searchsorted(self.hashes, unique)][back]
        # words that share a hash with another one: each is a pre-token of its own
        odd = np.flatnonzero(np.any([m != x[out] for m, x in zip(marks, self.marks, strict=True)], axis=0))
        if len(odd):
            out[odd] = self._learn(cut_out(buf, starts[odd], ends[odd]), [m[odd] for m in marks])
        return out


def remembered(path: str) -> Pieces:
    """The worker's ``Pieces`` of a tokenizer: it outlives the task, so a worker tokenizes a pre-token once for all its tasks.

    (Task code is sent by value, its modules are new in each task; what is to
    stay has a module name of its own.)
    """
    store = sys.modules.setdefault("_verbena_worker_pieces", types.ModuleType("_verbena_worker_pieces")).__dict__
    if (timer := store.pop("timer", None)) is not None:
        timer.cancel()
    if path not in store:
        store[path] = Pieces(path)
    return store[path]


def rest(seconds: float = REST_SECONDS) -> None:
    """At the end of a task: a worker that gets no other one that asks for its ``Pieces`` for so long forgets them.

    (Workers stay for the jobs that follow; what they keep would be missing there.)
    """
    store = sys.modules["_verbena_worker_pieces"].__dict__

    def forget():
        if store.get("timer") is timer:
            for path in [p for p, x in store.items() if hasattr(x, "forget")]:
                del store[path]
            give_back()

    timer = threading.Timer(seconds, forget)
    timer.daemon = True
    store["timer"] = timer
    timer.start()


@dataclass
class Known:
    """Frequent pre-tokens by hash and how many pieces each has; ``complete``: there are no others."""

    hashes: np.ndarray
    pieces: np.ndarray
    complete: bool


def frequent_words(table: DataFrame, limit: int = FREQUENT) -> Known:
    """Of a ``tokenized`` table the most frequent pre-tokens, at most ``limit`` (by powers of two of their counts)."""
    level = F.floor(F.log2("n")).cast("int").alias("level")
    least, rows = None, 0
    levels = table.groupBy(level).agg(F.count(F.lit(1)).alias("rows")).collect()  # at most 63 rows
    for r in sorted(levels, key=lambda r: -r.level):
        rows += r.rows
        if rows > limit:
            break
        least = 1 << r.level
    shared = materialise(table.groupBy("hash").agg(F.count(F.lit(1)).alias("words")).where("words > 1").select("hash"), "collisions")
    some = table.where(F.col("n") >= least) if least is not None else table.limit(0)
    some = some.join(shared, "hash", "left_anti").select("hash", "pieces").toArrow().combine_chunks()
    h = some.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return Known(h[order], some.column("pieces").to_numpy()[order], sum(r.rows for r in levels) == len(h))
