"""Token counts without token ids of documents.

Each distinct pre-token (a run without ASCII white space; the tokenizer never
looks across it) is tokenized once.  The table pre-token -> pieces is joined to
the documents' pre-token frequencies: its frequent part, bounded in rows and
bytes, as a broadcast that tasks search by hash, the rest, rows (document,
pre-token, frequency), by a shuffle join on the pre-token itself.  The sum of
frequency times pieces is the count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import chunk_rows, id_field, materialise, out_batch, pick, texts
from .pretokens import CHUNK, FREQUENT, chunk_words, cut_out, folds_case, frequent_words, tokenized


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 max_tokens: int = 2048, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``tokenizer_path`` names a ``tokenizers`` JSON file that every executor
    has, whose pre-tokenizer splits at white space.  No begin, end or added
    tokens; special strings inside a text count as the library takes them.
    Null and empty texts have 0 bytes and 0 tokens; repeated rows and null ids
    are counted row by row; other columns are ignored.  ``frequent`` bounds the
    broadcast part of the join, not the result.
    """
    base = pick(docs, id_col, text_col)
    table = tokenized(base, tokenizer_path)
    known, fold = frequent_words(table, frequent), folds_case(tokenizer_path)
    shared = docs.sparkSession.sparkContext.broadcast((known.hashes, known.pieces))
    word = StructType([StructField("word", BinaryType()), StructField("n", LongType())])
    schema = StructType([id_field(base), StructField("n_bytes", LongType()), StructField("known", LongType()),
                         StructField("rest", ArrayType(word))])

    def run(batches):
        hashes, pieces = shared.value
        pieces = np.append(pieces, 0)  # the last place is that of unknown words
        for batch in batches:
            offsets, data = texts(batch, 1)
            total, rest = np.zeros(len(offsets) - 1, dtype=np.int64), [[] for _ in range(len(offsets) - 1)]
            for lo, hi in chunk_rows(offsets, CHUNK):
                buf, starts, ends, h, counts = chunk_words(offsets, data, lo, hi, fold)
                at = np.full(len(h), -1)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                    at = np.where(hashes[at] == h, at, -1)
                sums = np.append(0, np.cumsum(pieces[at]))
                end = np.cumsum(counts)
                total[lo:hi] = sums[end] - sums[end - counts]
                new = np.flatnonzero(at < 0)
                row = np.repeat(np.arange(lo, hi), counts)[new]
                found: dict = {}
                for k in zip(row.tolist(), cut_out(buf, starts[new], ends[new]), strict=True):
                    found[k] = found.get(k, 0) + 1
                for (i, w), n in found.items():
                    rest[i].append({"word": w, "n": n})
            yield out_batch(schema, [batch.column(0), np.diff(offsets), total, pa.array(rest, pa.list_(
                pa.struct([("word", pa.binary()), ("n", pa.int64())])))])

    found = base.mapInArrow(run, schema)
    n_tokens = F.col("known")
    if not known.complete:
        found = materialise(found.withColumn("row", F.monotonically_increasing_id()), "counted")
        asked = found.select("row", F.inline("rest"))
        more = asked.join(table.select("word", "pieces"), "word").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
        found = found.join(more, "row", "left")
        n_tokens = n_tokens + F.coalesce("more", F.lit(0))
    return found.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > max_tokens).alias("over_limit"))
