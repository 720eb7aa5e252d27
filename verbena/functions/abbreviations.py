"""T7 expand_abbreviations.

Whitespace tokens, each replaced by its dictionary value when present, joined
by one space.  A bounded dictionary is a constant (hashed) map in the
projection (no shuffle, no Python).  A dictionary too large for that goes through
``verbena.operators.abbreviations.expand_with_table`` (explode + join).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from .maps import map_literal
from .text import tokens


def needs_unicode_strip(abbreviations: Mapping[str, str]) -> bool:
    """True when a value could leave non-ASCII-space whitespace at a text edge,
    i.e. when ``trim`` would not equal Python's ``strip`` after expansion."""
    return any(v.strip(" ").strip() != v.strip(" ") for v in abbreviations.values())


def expand_abbreviations(c: Column, abbreviations: Mapping[str, str]) -> Column:
    if not abbreviations:  # the reference skips the step: spaces survive
        return c
    if len(abbreviations) <= 32:
        m = map_literal(abbreviations)
        return F.array_join(F.transform(
            tokens(c), lambda w: F.coalesce(F.try_element_at(m, w), w)), " ")
    # larger dictionaries: hashed buckets of small map literals (a few
    # comparisons per token, whatever the dictionary size)
    from pyspark.sql import SparkSession
    from .maps import hashed_map
    look = hashed_map(SparkSession.getActiveSession(), abbreviations)
    return F.array_join(F.transform(tokens(c), lambda w: F.coalesce(look(w), w)), " ")
