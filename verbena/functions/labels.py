"""Label domains and label recoding (L1-L3).

All lookups are constant maps over a handful of codes: no join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from .maps import map_literal

# Label domains shared by every stage
SENTIMENT_NAMES = {0: "Tiêu cực", 1: "Trung tính", 2: "Tích cực"}
TASK_NAMES = {
    1: "Chất lượng", 2: "Đóng gói", 3: "Giao hàng", 4: "Giá thành", 5: "Hỗ trợ khách hàng",
    6: "Đặt hàng", 7: "Trả hàng", 8: "Khuyến mãi", 9: "Khác",
}
SENTIMENTS = [0, 1, 2]
TASKS = list(range(1, 10))
DEFAULT_SENTIMENT = "1"
DEFAULT_TASK = "9"
UNKNOWN = "Unknown"

# Source codings
NEG_NEU_POS = {"NEG": 0, "NEU": 1, "POS": 2}
BINARY_TO_SENTIMENT = {0: 0, 1: 2}


def _typed_map(mapping: Mapping, key_type: str, value_type: str) -> Column:
    return map_literal(mapping, key_type, value_type)


def recode_label(c: Column, mapping: Mapping, key_type: str = "string",
                 value_type: str = "int") -> Column:
    """L1: unmatched codes become null (the reference's NaN)."""
    return F.try_element_at(_typed_map(mapping, key_type, value_type), c.cast(key_type))


def decode_label(c: Column, names: Mapping[int, str], fallback: str | None = UNKNOWN) -> Column:
    """L2: code to name; unmatched gives ``fallback`` (``None``: null)."""
    v = F.try_element_at(_typed_map(names, "int", "string"), c.try_cast("int"))
    return v if fallback is None else F.coalesce(v, F.lit(fallback))


def task_to_index(c: Column) -> Column:
    """L3: topic 1..9 to 0..8."""
    return c.try_cast("int") - F.lit(1)


def index_to_task(c: Column) -> Column:
    """L3: 0..8 back to 1..9."""
    return c.try_cast("int") + F.lit(1)
