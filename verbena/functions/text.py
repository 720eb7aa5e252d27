"""Scalar text functions (T1-T11, T13) as native column expressions.

Every function takes and returns a ``Column`` so that a whole cleaning chain
collapses into one projection (Catalyst ``CollapseProject``) and stays inside
the JVM: no Python per row.

Python's ``str`` semantics are reproduced with explicit Unicode classes,
because Java's ``\\s`` / ``\\w`` differ from Python's.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Regex classes equal to Python 3 ``\s`` (and ``str.strip()``)
# and ``\w`` on assigned code points.  Written in a form both Java regex and
# RE2 (DuckDB) accept.
WS = r"[\t-\r\x{1C}-\x{20}\x{85}\p{Z}]"
# the characters of WS
WS_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                             0x202F, 0x205F, 0x3000]))
WORD = r"[\p{L}\p{N}_]"
# anything that is not a word char, whitespace or '.'
SYMBOL = r"[^\p{L}\p{N}_\t-\r\x{1C}-\x{20}\x{85}\p{Z}.]"
# sentence end: whitespace right after '.', '!' or '?'
SENTENCE_BREAK = r"(?<=[.!?])" + WS + "+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace (only the ends are looked at, not the whole text)."""
    return F.trim(_c(c), F.lit(WS_CHARS))


def collapse_ws(c: Column | str) -> Column:
    """Every whitespace run becomes one space."""
    return F.regexp_replace(_c(c), WS + "+", " ")


def clean_text(c: Column | str) -> Column:
    """To string, newlines to space, collapse whitespace, strip.

    After the collapse every whitespace run is a single ASCII space, so the
    cheap ``trim`` (ASCII space only) equals Python's ``strip`` here.
    A null stays null (the reference wrote the text ``nan``).
    """
    return F.trim(collapse_ws(_c(c).cast("string")))


def clean_all_columns(df):
    """T1 on every column, in one ``select`` (all columns become strings)."""
    return df.select([clean_text(F.col(f"`{n}`")).alias(n) for n in df.columns])


def strip_symbols(c: Column | str) -> Column:
    """T4: keep word chars, whitespace and '.'; any other char becomes a space."""
    return F.regexp_replace(_c(c), SYMBOL, " ")


def lowercase(c: Column | str) -> Column:
    """T5."""
    return F.lower(_c(c))


def sentences(c: Column | str) -> Column:
    """``array<string>`` of sentences.

    Strip, split on whitespace that follows '.', '!' or '?', strip the parts,
    drop blank parts.  A null comment gives null (no rows after explode).
    """
    parts = F.split(strip(c), SENTENCE_BREAK, -1)
    return F.filter(F.transform(parts, strip), lambda p: p != F.lit(""))


def preprocess_multitask(c: Column | str, abbreviations: Mapping[str, str] | None = None,
                         lexicon: Mapping[str, str] | None = None) -> Column:
    """Null to '', demojize, collapse, strip symbols, lower, expand, strip."""
    from .abbreviations import expand_abbreviations
    from .emoji import demojize

    x = F.coalesce(_c(c).cast("string"), F.lit(""))
    x = demojize(x, lexicon)
    # T6 then T4 in one regex pass: whitespace runs and single symbols both
    # become one space, and neither step touches what the other produces.
    x = lowercase(F.regexp_replace(x, WS + "+|" + SYMBOL, " "))
    if abbreviations:  # plan-time branch (T7 skipped for an empty dictionary)
        from .abbreviations import needs_unicode_strip
        x = expand_abbreviations(x, abbreviations)
        return strip(x) if needs_unicode_strip(abbreviations) else F.trim(x)
    return F.trim(x)  # only ASCII spaces are left: trim equals str.strip() here


def preprocess_sentiment(c: Column | str, abbreviations: Mapping[str, str] | None = None,
                         lexicon: Mapping[str, str] | None = None,
                         phrases: Mapping[str, str] | None = None) -> Column:
    """Null to '', demojize, strip symbols, lower, expand; no collapse, no strip.

    ``phrases`` (optional) applies a fitted phrase model (X1), the re-aim of
    the reference's word segmentation step.
    """
    from .abbreviations import expand_abbreviations
    from .emoji import demojize

    x = F.coalesce(_c(c).cast("string"), F.lit(""))
    x = demojize(x, lexicon)
    x = lowercase(strip_symbols(x))
    if abbreviations:
        x = expand_abbreviations(x, abbreviations)
    if phrases:
        from .phrases import join_phrases
        x = join_phrases(x, phrases)
    return x


def build_prompt_single(template: str, c: Column | str,
                        lexicon: Mapping[str, str] | None = None) -> Column:
    """Template followed by the demojized comment in double quotes."""
    from .emoji import demojize

    return F.concat(F.lit(template), F.lit('"'), demojize(_c(c), lexicon), F.lit('"'))


def build_prompt_batch(template: str, comments: Column | str,
                       lexicon: Mapping[str, str] | None = None) -> Column:
    """Demojized comments of one batch joined by '|', quoted, after template.

    A pipe inside a comment would shift every later answer of its batch
    (D16), so it is replaced by a space first.
    """
    from .emoji import demojize

    parts = F.transform(_c(comments),
                        lambda x: F.replace(demojize(x, lexicon), F.lit("|"), F.lit(" ")))
    return F.concat(F.lit(template), F.lit('"'), F.array_join(parts, "|"), F.lit('"'))


def tokens(c: Column | str) -> Column:
    """Python ``str.split()``: whitespace tokens, no empty token."""
    return F.filter(F.split(_c(c), WS + "+", -1), lambda t: t != F.lit(""))
