"""Small dictionaries as constant map columns.

A Python dict becomes one ``map<string,string>`` literal after constant
folding, shipped with the task closure like any other constant: no join, no
shuffle.  Only bounded dictionaries may go this way; the size is checked.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Largest dictionary inlined into a plan.  Larger ones take the join path.
MAX_INLINE_ENTRIES = 50_000


class DictionaryTooLarge(ValueError):
    pass


_CACHE: dict = {}


def _app_id() -> str | None:
    """Cached columns belong to one running application (JVM)."""
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    return sc.applicationId if sc is not None else None


def map_literal(mapping: Mapping, key_type: str = "string", value_type: str = "string") -> Column:
    """A constant map column; built once per active JVM and dictionary (building
    thousands of literals is a driver round trip each)."""
    key = (_app_id(), key_type, value_type, tuple(mapping.items()))
    hit = _CACHE.get(key)
    if hit is None:
        hit = _CACHE[key] = _build_map_literal(mapping, key_type, value_type)
        if len(_CACHE) > 64:
            _CACHE.pop(next(iter(_CACHE)))
    return hit


def _build_map_literal(mapping: Mapping, key_type: str, value_type: str) -> Column:
    if len(mapping) > MAX_INLINE_ENTRIES:
        raise DictionaryTooLarge(
            f"{len(mapping)} entries > {MAX_INLINE_ENTRIES}; use the join form")
    return F.expr(_map_sql(mapping, key_type, value_type))


def _map_sql(mapping: Mapping, key_type: str, value_type: str) -> str:
    """SQL text of one constant map; parsed and folded on the JVM in one call."""
    if not mapping:
        return f"cast(map() as map<{key_type},{value_type}>)"
    pairs = [(str(k), str(v)) for k, v in mapping.items() if k is not None and v is not None]
    if not pairs:
        return _map_sql({}, key_type, value_type)
    keys, values = [k for k, _ in pairs], [v for _, v in pairs]
    if any(SEP in x for x in keys + values):
        ks = ", ".join(sql_string(k) for k in keys)
        vs = ", ".join(sql_string(v) for v in values)
        return (f"map_from_arrays(cast(array({ks}) as array<{key_type}>), "
                f"cast(array({vs}) as array<{value_type}>))")
    sep = sql_string(SEP)
    return (f"map_from_arrays(cast(split({sql_string(SEP.join(keys))}, {sep}, -1) as array<{key_type}>), "
            f"cast(split({sql_string(SEP.join(values))}, {sep}, -1) as array<{value_type}>))")


SEP = "\u0001"


def string_array_literal(values: list[str]) -> Column:
    """``array<string>`` constant from one joined literal (one driver call, not one
    per element); constant folding turns ``split(literal)`` into a literal."""
    if any(SEP in v for v in values):
        return F.array(*[F.lit(v) for v in values])
    if not values:
        return F.array().cast("array<string>")
    return F.split(F.lit(SEP.join(values)), SEP, -1)


def sql_string(v: str) -> str:
    """A Spark SQL string literal (backslash escapes are on by default)."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bounded_dict(df, key: str, value: str, limit: int = MAX_INLINE_ENTRIES) -> dict | None:
    """Collect a two-column table as a dict only if it has at most ``limit`` rows.

    The count is taken first (``limit + 1`` rows at most reach the driver), so
    an unexpectedly large table is never pulled whole; ``None`` means "too
    large, use the distributed form".
    """
    rows = df.select(key, value).limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return {r[0]: r[1] for r in rows}


# Largest set used for a hash-set membership test (``IN`` list -> ``InSet``)
MAX_INLINE_SET = 250_000


def hashed_map(spark, mapping: Mapping, key_type: str = "string", value_type: str = "string",
               bucket_size: int = 16):
    """A constant dictionary with hashed lookups, built from map literals.

    A single Spark map literal is searched key by key.  Here the keys are
    dealt into ``len / bucket_size`` buckets by CRC-32 of their UTF-8 bytes
    (``crc32`` in Spark, ``zlib.crc32`` here: the same standard checksum), each
    bucket is a small map literal, and a lookup reads one bucket: about
    ``bucket_size`` comparisons whatever the dictionary size.  Keys are
    compared as strings.  Returns ``lookup(col) -> col`` (null when absent).
    """
    if len(mapping) > MAX_INLINE_ENTRIES:
        raise DictionaryTooLarge(f"{len(mapping)} entries > {MAX_INLINE_ENTRIES}")
    ck = ("hashed", _app_id(), key_type, value_type, bucket_size, tuple(mapping.items()))
    hit = _CACHE.get(ck)
    if hit is None:
        hit = _CACHE[ck] = _hashed_map(mapping, value_type, bucket_size)
    return hit


def _hashed_map(mapping: Mapping, value_type: str, bucket_size: int):
    import zlib

    items = [(str(k), v) for k, v in mapping.items() if k is not None and v is not None]
    n_buckets = max(1, -(-len(items) // bucket_size))
    if n_buckets == 1:
        m = _build_map_literal(dict(items), "string", value_type)
        return lambda c: F.try_element_at(m, c.cast("string"))
    buckets: list[dict] = [dict() for _ in range(n_buckets)]
    for k, v in items:
        buckets[zlib.crc32(k.encode("utf-8")) % n_buckets][k] = v
    # one SQL text for all buckets: a single driver call, folded to one literal
    table = F.expr("array(" + ", ".join(_map_sql(b, "string", value_type) for b in buckets) + ")")

    def lookup(c: Column) -> Column:
        k = c.cast("string")
        slot = (F.crc32(k) % F.lit(n_buckets)).cast("int")
        return F.try_element_at(F.get(table, slot), k)

    return lookup
