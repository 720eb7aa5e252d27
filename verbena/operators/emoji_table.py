"""T3 with a lexicon table: whole emoji sequences, longest match, tables of any usual size.

The table's sequences form a trie over code points, built once in each Python
worker from the table's rows (sent to the tasks as they are, below a measured
size): no regular expression over ranges and no plan literal of names.  At each
place the longest sequence wins, so a family, a flag or a keycap is named as the
table names it and not from its parts.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..llm.common import give_back, small_batches
from .sizes import value_bytes

#: Variation selector 16 asks for the picture form; sequences are compared without it.
VS16 = "️"
LEXICON_BYTES = 64 << 20


class Lexicon:
    """A trie of code points; a node's name stands under the empty key."""

    def __init__(self, pairs):
        self.root: dict = {}
        for sequence, name in pairs:
            node = self.root
            for c in sequence.replace(VS16, ""):
                node = node.setdefault(c, {})
            if node is not self.root:
                node[""] = name
        firsts = "".join(re.escape(c) for c in self.root)
        self.first = re.compile(f"[{firsts}]") if firsts else None

    def longest(self, text: str, at: int) -> tuple[int, str | None]:
        """Where the longest sequence that starts at ``at`` ends, and its name."""
        node, end, name = self.root, at, None
        for i in range(at, len(text)):
            c = text[i]
            if c == VS16 and i > at:
                if end == i:  # belongs to the sequence before it
                    end = i + 1
                continue
            node = node.get(c)
            if node is None:
                break
            if "" in node:
                end, name = i + 1, node[""]
        return end, name

    def named(self, text: str, left: str, right: str) -> str:
        if self.first is None:
            return text
        out, done, m = [], 0, self.first.search(text)
        while m:
            end, name = self.longest(text, m.start())
            if name is None:
                end = m.start() + 1
                out.append(text[done: end])
            else:
                out.append(text[done: m.start()] + left + name + right)
            done, m = end, self.first.search(text, end)
        return "".join(out) + text[done:]


def demojize_with_table(df: DataFrame, text: str, lexicon: DataFrame, out: str | None = None, left: str = ":", right: str = ":",
                        limit: int = LEXICON_BYTES) -> DataFrame:
    """``df`` with every sequence of ``lexicon`` (``emoji``, ``name``) in ``text`` replaced by its name between colons.

    Of rows with one sequence the smallest name counts; rows with a null or an
    empty sequence or a null name are left out.  A null text stays null.  A
    lexicon over ``limit`` bytes is refused: it is held by every worker.
    """
    small_batches(df.sparkSession)
    pairs = lexicon.select(F.translate("emoji", VS16, "").alias("e"), "name").where(
        (F.col("e") != "") & F.col("name").isNotNull()).groupBy("e").agg(F.min("name").alias("name"))
    size = value_bytes(pairs)
    if size > limit:
        raise ValueError(f"the lexicon takes {size} bytes, more than {limit}")
    shared = df.sparkSession.sparkContext.broadcast([tuple(r) for r in pairs.collect()])
    out = out or text
    kept = [f for f in df.schema if f.name != out]
    schema = StructType([*kept, StructField(out, StringType())])

    def run(batches):
        words = Lexicon(shared.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            named = [None if t is None else words.named(t, left, right) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(named, pa.string())], names=[f.name for f in schema])
        give_back()

    return df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(text).cast("string").alias("__vb_text")) \
        .mapInArrow(run, schema).select(*[F.col(f"`{c}`") for c in (df.columns if out in df.columns else [*df.columns, out])])
