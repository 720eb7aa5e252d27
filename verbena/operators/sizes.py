"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, NumericType, StringType

#: Largest side that may be broadcast, in bytes of its values (a hash relation takes a few times as much).
BROADCAST_BYTES = 32 << 20


def value_bytes(df: DataFrame) -> int:
    """Bytes of all values of ``df`` (strings by length, other values 16, array values added up), in one pass."""
    total = F.lit(16)
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType):
            total = total + F.coalesce(F.octet_length(F.array_join(c, "")) + 16 * F.size(c), F.lit(0)) + 16
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, NumericType):
            total = total + 8 * F.coalesce(F.size(c), F.lit(0)) + 16
        elif isinstance(f.dataType, (ArrayType,)) or f.dataType.typeName() in ("map", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) * 2
        else:
            total = total + 16
    return df.agg(F.sum(total.cast("long"))).first()[0] or 0


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if its values are few enough bytes, else as it is."""
    return F.broadcast(df) if value_bytes(df) <= limit else df
