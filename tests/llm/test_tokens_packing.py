"""Token counts and packing against the tokenizer library itself."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_samples import ODD
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from verbena.llm.packing import best_fit_plan, pack_documents
from verbena.llm.token_counts import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
TOK = Tokenizer.from_file(PATH)


def ids(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


def test_counts_match_library(documents, rows):
    got = {r.doc_id: r for r in token_counts(documents, PATH).collect()}
    assert got.keys() == rows.keys()
    for k, t in rows.items():
        n = len(ids(t))
        assert (got[k].n_bytes, got[k].n_tokens, got[k].over_limit) == (len(t.encode()), n, n > 2048)


@pytest.mark.parametrize("frequent", [0, 50])
def test_few_frequent_words(documents, rows, odd, frequent):
    """Words beyond the broadcast part are joined by a shuffle: the same results."""
    got = {r.doc_id: r.n_tokens for r in token_counts(documents, PATH, frequent=frequent).collect()}
    assert got == {k: len(ids(t)) for k, t in rows.items()}
    got = Counter((r.doc_id, r.n_tokens) for r in token_counts(odd, PATH, frequent=frequent).collect())
    assert got == Counter((i, len(ids(t))) for i, t in ODD)


def test_remembered_words_start_anew(documents, rows, monkeypatch):
    from verbena.llm import pretokens
    monkeypatch.setattr(pretokens, "REMEMBERED", 100)
    monkeypatch.setattr(pretokens, "CHUNK", 5000)
    check_packing(pack_documents(documents, PATH).collect(), rows.items(), 2048)


def test_words_met_again_stay_remembered(monkeypatch):
    """A full memory keeps the words that came back, at most half of it, and gives the same pieces."""
    from verbena.llm import pretokens
    monkeypatch.setattr(pretokens, "REMEMBERED", 6)
    pieces, learned = pretokens.Pieces(PATH), []
    found = pieces.tokenizer.pieces
    monkeypatch.setattr(pieces.tokenizer, "pieces", lambda words, *a: learned.append(list(words)) or found(words, *a))
    chunks = ["one two twenty", "one two unhappily", "one two four five", "one six", "two seven", "a b c d e f one two", "a b c d e f one two",
              "a b c d e f one two", "unhappily twenty"]
    for text in chunks:
        raw = text.encode()
        buf, starts, ends, h, _ = pretokens.chunk_words(np.array([0, len(raw)]), memoryview(raw), 0, 1, pieces.fold)
        for w, n in zip(text.split(), pieces.numbers(buf, starts, ends, h), strict=True):
            assert pieces.ids[pieces.first[n]: pieces.first[n] + pieces.length[n]].tolist() == ids(w)
        assert len(pieces.hashes) <= 6 + len(starts)
    met = Counter(w for words in learned for w in words)
    assert met[b"one"] == met[b"two"] == 1


def test_words_of_one_hash_stay_apart(spark, monkeypatch):
    """Hashes that collide cost a lookup, never a result."""
    from verbena.llm import pretokens
    monkeypatch.setattr(pretokens, "range_hashes", lambda buf, a, b: (b - a).astype(np.uint64) % np.uint64(3))
    docs = [(1, "internationalisation of words a bb ccc"), (2, "internationalization bb a zz 123456789 abcdefghi"), (3, "ccc ccc ddd")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((r.doc_id, r.n_tokens) for r in token_counts(df, PATH).collect()) == [(i, len(ids(t))) for i, t in docs]
    check_packing(pack_documents(df, PATH).collect(), docs, 2048)


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_words_tokenized_together(name):
    """Also words that hold the sign between them, odd characters and case."""
    from verbena.llm.pretokens import Tokenizer as Words, folds_case
    path = public_tokenizers.path(name)
    words = ["a", "\U0001F602", "x\U0001F602y", "\u0301e", "E\u0301", "it's", "ABC", "字", "\x00", "\x1c", "\x85", "\xa0", "a\u2003b", "İ", "<|endoftext|>", "9" * 400] * 300
    t = Words(path)
    assert t.sign is not None and folds_case(path) == b"<"
    flat, n = t.pieces([w.encode() for w in words])
    want = [TOK.encode(w, add_special_tokens=False).ids for w in words]
    assert n.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]
    t.sign = None
    assert all((a == b).all() for a, b in zip(t.pieces([w.encode() for w in words]), (flat, n), strict=True))
    assert folds_case(public_tokenizers.path("byte_bpe_50k.json")) is None


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_case_folding_before_the_tokenizer(text):
    text = text.encode("utf-8", "ignore").decode()
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    assert "<" in text or ids(text) == ids(low)


def test_special_strings_in_capitals(spark):
    """Only the exact special string is special: folding must not make one."""
    docs = [(1, "A<|ENDOFTEXT|>B <|endoftext|> C<|EndOfText|>"), (2, "x<|endoftext|>Y <|STARTOFTEXT|>")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((r.doc_id, r.n_tokens) for r in token_counts(df, PATH).collect()) == [(i, len(ids(t))) for i, t in docs]
    check_packing(pack_documents(df, PATH).collect(), docs, 2048)


def test_hashes_of_long_words():
    """Words of a kilobyte that a polynomial hash modulo 2^64 cannot tell apart."""
    from verbena.llm.common import range_hashes
    one = bytes(97 + bin(i).count("1") % 2 for i in range(1024))
    buf = np.frombuffer(one + bytes(195 - x for x in one), dtype=np.uint8)
    h = range_hashes(buf, np.array([0, 1024]), np.array([1024, 2048]))
    assert h[0] != h[1]


def test_counts_of_odd_rows(odd, none):
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts(odd, PATH).collect())
    assert got == Counter((i, len((t or "").encode()), len(ids(t))) for i, t in ODD)
    assert token_counts(none, PATH).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_white_space_never_matters(text):
    text = text.encode("utf-8", "ignore").decode()
    assert len(ids(text)) == sum(len(ids(w.decode())) for w in text.encode().split())


def check_packing(packed, docs, capacity):
    """Pieces, places and bins; returns the number of sequences."""
    want = Counter()
    for k, t in docs:
        x = np.array([*ids(t), 0], dtype="<u4")
        for p, a in enumerate(range(0, len(x), capacity)):
            part = x[a: a + capacity]
            want[k, p, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_matches_library(documents, rows, capacity):
    packed = pack_documents(documents, PATH, capacity=capacity).collect()
    n = check_packing(packed, rows.items(), capacity)
    assert n <= 1.02 * sum(r.length for r in packed) / capacity + 1


def test_packing_of_odd_rows(odd, none):
    check_packing(pack_documents(odd, PATH).collect(), ODD, 2048)
    assert pack_documents(none, PATH).collect() == []


def one_by_one(counts, capacity):
    """Best fit, longest first, a piece at a time."""
    room = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = [(r, i) for i, r in enumerate(room) if r >= length]
            if fit:
                room[min(fit)[1]] -= length
            else:
                room.append(capacity - length)
    return len(room)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=12))
def test_plan_packs_as_best_fit_does(counts):
    plan = best_fit_plan(counts, 50)
    assert plan.sequences == one_by_one(counts, 50)
    used, seen = defaultdict(list), Counter()
    rows = list(zip(plan.length, plan.rank, plan.fill, plan.sequence, plan.offset, strict=True))
    for i, (length, rank, fill, seq, offset) in enumerate(rows):
        end = rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == length else counts[int(length)]
        for r in range(rank, end):
            used[seq + (r - rank) // fill].append((offset + (r - rank) % fill * length, length))
            seen[int(length)] += 1
    assert seen == Counter(counts)
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 50


def test_idle_workers_forget_their_pieces(spark, documents):
    """What workers remember of a tokenizer must not be missing in the jobs that follow."""
    import sys
    import time

    import pyarrow as pa

    pack_documents(documents, PATH).collect()
    time.sleep(4)

    def kept(batches):
        for _ in batches:
            time.sleep(0.2)  # every worker gets some
            held = vars(sys.modules["_verbena_worker_pieces"]) if "_verbena_worker_pieces" in sys.modules else {}
            yield pa.RecordBatch.from_pydict({"n": pa.array([sum(hasattr(x, "forget") for x in held.values())], pa.int64())})

    assert spark.range(0, 32, 1, 32).mapInArrow(kept, "n long").agg({"n": "sum"}).first()[0] == 0
