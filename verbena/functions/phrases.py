"""Apply a phrase model (X1): greedy left-to-right joining of known bigrams with ``_``.

No sequential loop per row: for every position, ``hit`` says whether the
bigram starting there is a phrase; encoded as a string of ``H``/``N``, one
regex pass ``H.?`` -> ``S...`` marks exactly the greedy starts (a match
consumes the next position, like the greedy scan does).  Then one
``transform`` emits ``a_b`` at starts, drops the consumed token, and keeps
the rest.  Linear in the number of tokens, JVM-side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from .maps import MAX_INLINE_SET, sql_string
from .text import tokens


def next_tokens(toks: Column) -> Column:
    """``toks`` shifted left by one (the right neighbour of each token)."""
    return F.slice(toks, 2, F.greatest(F.size(toks), F.lit(1)))


def greedy_join(toks: Column, hit: Column) -> Column:
    """``hit``: ``array<boolean>``, true where tokens k, k+1 form a phrase.

    Lambdas only read their own arguments (``zip_with``): a lambda that
    referenced an outer array would re-evaluate it for every element.
    """
    flags = F.array_join(F.transform(hit, lambda h: F.when(h, "H").otherwise("N")), "")
    starts = F.transform(F.split(F.regexp_replace(flags, "H(.?)", "S$1"), "", -1),
                         lambda c: c == F.lit("S"))
    prev_start = F.concat(F.array(F.lit(False)), starts)
    pairs = F.zip_with(toks, next_tokens(toks), lambda t, n: F.struct(t.alias("t"), n.alias("n")))
    marked = F.zip_with(pairs, starts, lambda p, s: F.struct(
        p["t"].alias("t"), p["n"].alias("n"), F.coalesce(s, F.lit(False)).alias("s")))
    out = F.zip_with(marked, prev_start, lambda x, ps: (
        F.when(x["s"], F.concat(x["t"], F.lit("_"), x["n"]))
        .when(F.coalesce(ps, F.lit(False)), F.lit(None))
        .otherwise(x["t"])))
    return F.array_join(F.filter(out, lambda x: x.isNotNull()), " ")


def bigram_hits(toks: Column, keys: list[str]) -> Column:
    """Membership through ``isin``: the optimizer turns a long literal list into a
    hash set (``InSet``), so a lookup is O(1) - a map literal would scan."""
    return F.zip_with(toks, next_tokens(toks), lambda t, n: F.coalesce(
        F.concat(t, F.lit(" "), n).isin(keys), F.lit(False)))


def bigram_hits_sql(tokens_col: str, keys: list[str]) -> Column:
    """The same test written as SQL text over a named token column: the whole
    ``IN`` list is parsed on the JVM in one call (building it literal by literal
    from Python costs a driver round trip per phrase)."""
    in_list = ", ".join(sql_string(k) for k in keys)
    t = f"`{tokens_col}`"
    return F.expr(
        f"zip_with({t}, slice({t}, 2, greatest(size({t}), 1)), "
        f"(a, b) -> coalesce(concat(a, ' ', b) IN ({in_list}), false))")


def join_phrases(c: Column, phrases: Mapping[str, str] | set) -> Column:
    """Join the bigrams in ``phrases`` (keys ``'a b'``) inside whitespace tokens."""
    keys = sorted(phrases.keys() if isinstance(phrases, Mapping) else phrases)
    if len(keys) > MAX_INLINE_SET:
        raise ValueError("phrase set too large to inline; use operators.phrases.apply_phrases")
    toks = tokens(c)
    if not keys:
        return F.array_join(toks, " ")
    return greedy_join(toks, bigram_hits(toks, keys))
