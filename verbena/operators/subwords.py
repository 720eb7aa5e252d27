"""Sub-word encoding with a given public tokenizer file (E1, E2): a byte-level vocabulary has no unknown word.

The tokenizer is a file of the ``tokenizers`` library, read on the driver and
sent to the tasks (a few megabytes); it is applied, never trained.  Special
strings inside texts are ordinary text.

``subword_counts`` counts the pieces of whole texts without tokenizing a word
twice: texts are cut natively into units (white space and the word behind it; the
tokenizer never joins pieces across such a cut), units are counted by a plain
aggregation, each distinct unit is tokenized once, and its pieces are weighted by
its count.  ``encode_subwords`` turns the head of each text into a fixed frame in
one pass without a shuffle.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..llm.common import give_back, small_batches
from .vocab import BOS, EOS, FIRST_ID, PAD, UNK
from .index import row_index

UNIT = r"\p{IsWhite_Space}*\P{IsWhite_Space}+|\p{IsWhite_Space}+"


@lru_cache(maxsize=4)
def _tokenizer(definition: str):
    """One per Python worker and definition."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(definition)
    t.encode_special_tokens = True
    t.no_truncation()
    t.no_padding()
    return t


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def units(text: Column) -> Column:
    """The text cut in front of the white space before each word."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0))


def subword_counts(df: DataFrame, text: str, tokenizer_path: str) -> DataFrame:
    """``(piece_id, n)``: how often each piece stands in all whole texts; a null text has none."""
    definition = read_definition(tokenizer_path)
    schema = StructType([StructField("piece_id", IntegerType()), StructField("n", LongType())])
    small_batches(df.sparkSession)
    counted = df.select(F.explode(units(F.col(text))).alias("unit")).groupBy("unit").agg(F.count(F.lit(1)).alias("n"))

    def run(batches):
        t = _tokenizer(definition)
        for batch in batches:
            total: dict[int, int] = {}
            for e, n in zip(t.encode_batch(batch.column(0).to_pylist(), add_special_tokens=False), batch.column(1).to_pylist(), strict=True):
                for i in e.ids:
                    total[i] = total.get(i, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array(total.values(), pa.int64())], names=["piece_id", "n"])
        give_back()

    return counted.mapInArrow(run, schema).groupBy("piece_id").agg(F.sum("n").alias("n"))


def subword_vocab(counts: DataFrame) -> DataFrame:
    """``(piece_id, token_id, n)``: pieces in use numbered from 4, most frequent first, ties by piece."""
    ranked = row_index(counts, [F.col("n").desc(), F.col("piece_id").asc()], "__vb_i")
    return ranked.select("piece_id", (F.col("__vb_i") + FIRST_ID).cast("int").alias("token_id"), "n")


def encode_subwords(df: DataFrame, text: str, tokenizer_path: str, max_len: int = 128, vocab: DataFrame | None = None) -> DataFrame:
    """``df`` with ``input_ids`` and ``attention_mask``, both ``max_len`` long.

    ``<s>``, the first ``max_len - 2`` pieces, ``</s>``, then ``<pad>``.  Without
    ``vocab`` a piece's id is its number in the file plus 4; with one (from
    ``subword_vocab``, at most as many rows as the file has pieces) its token id,
    ``<unk>`` for pieces that the vocabulary's corpus never used.  A null text is
    encoded like an empty one.  Every unit gives a piece or only white space that
    the tokenizer drops, so a text is cut behind ``max_len`` words before it is
    tokenized.
    """
    if max_len < 2:
        raise ValueError("max_len must be at least 2")
    small_batches(df.sparkSession)
    definition = read_definition(tokenizer_path)
    ids = None if vocab is None else {r.piece_id: r.token_id for r in vocab.select("piece_id", "token_id").collect()}
    kept = [f for f in df.schema if f.name not in ("input_ids", "attention_mask")]
    frame = df.sparkSession.createDataFrame([], "input_ids array<int>, attention_mask array<int>").schema
    head = F.array_join(F.slice(units(F.col(text)), 1, max_len), "").alias("__vb_head")
    room = max_len - 2

    def run(batches):
        t = _tokenizer(definition)
        for batch in batches:
            rows, masks = [], []
            for e in t.encode_batch(batch.column(batch.num_columns - 1).to_pylist(), add_special_tokens=False):
                body = [i + FIRST_ID if ids is None else ids.get(i, UNK) for i in e.ids[:room]]
                rows.append([BOS, *body, EOS] + [PAD] * (room - len(body)))
                masks.append([1] * (len(body) + 2) + [0] * (room - len(body)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int32()))],
                                             names=[f.name for f in kept] + ["input_ids", "attention_mask"])
        give_back()

    return df.select(*[F.col(f"`{f.name}`") for f in kept], head).mapInArrow(run, StructType(kept + list(frame)))
