"""Exact duplicates by content hash, native DataFrame operations only.

Rows are grouped by the 128-bit MD5 of their normalised text; only the hash,
the id and a row number meet in that shuffle, and both sums and the row that
stays are combined before it, so a text that a third of all rows carry costs
one row a task.  Texts whose hash is shared are then grouped a second time by
hash and bytes (each task sends one row for each distinct text): a hash with
two texts is a collision, and its rows, written apart, are decided by their
bytes instead of their hash.

Defined results: a null text counts as empty; rows with a null id are the
last to stay in their group (a group without any id keeps one of its rows,
``keep_id`` null); of rows that repeat id and text exactly one stays.  An
empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise, pick, sized


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else: ``lower`` does that to texts of ASCII letters alone, others are translated."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def _shared(rows: DataFrame, by: list[str]) -> DataFrame:
    """For each group of ``by`` with more than one row: its size and the row that stays (largest id)."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("doc_id", "row")).alias("stays")) \
        .where(F.col("size") > 1)


def _decided(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Rows with their group's decision; a row of no shared group stays."""
    r, g = rows.alias("r"), groups.alias("g")
    same = [F.col(f"r.{c}") == F.col(f"g.{c}") for c in by]
    alone = F.col("g.size").isNull()
    return r.join(g, same, "left").select(
        "r.doc_id", F.when(alone, F.col("r.doc_id")).otherwise(F.col("g.stays.doc_id")).alias("keep_id"),
        F.coalesce("g.size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("r.row") == F.col("g.stays.row"))).alias("kept"), F.col("r.sha").alias("text_sha256"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     hash_of: Callable[[Column], Column] = content_hash,
                     normalise: Callable[[Column], Column] = lower_ascii) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row for each row of ``docs``.

    Two rows are equal when their normalised texts have the same bytes; the
    row with the largest id of each group stays.  ``hash_of`` only brings
    candidates together: a hash that collides costs time, never a wrong group.
    """
    src = pick(docs, id_col, text_col)
    texts = src.select("doc_id", normalise(F.coalesce("text", F.lit(""))).alias("text")) \
        .withColumn("key", hash_of(F.col("text")))
    rows = materialise(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key",
                                    F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "hashes")
    groups = materialise(_shared(rows, ["key"]), "groups")
    n = groups.count()

    def of_keys(keys: DataFrame, count: int | None = None) -> DataFrame:
        return texts.join(sized(keys, count), "key", "left_semi")

    several = of_keys(groups.select("key"), n).groupBy("key", "text").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("key").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") > 1).select("key")
    collided = materialise(several, "collisions")
    n_collided = collided.count()
    if not n_collided:
        return _decided(rows, sized(groups, n), ["key"])
    apart = materialise(of_keys(collided, n_collided).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "key", "text",
        F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "apart")
    clean = rows.join(sized(collided, n_collided), "key", "left_anti")
    return _decided(clean, sized(groups, n), ["key"]).unionByName(
        _decided(apart, _shared(apart, ["key", "text"]), ["key", "text"]))
