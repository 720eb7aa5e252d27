"""T3 demojize: emoji to ``:name:``, as a native column expression.

The lexicon is a table ``(emoji string, name)``.  The built-in one is made by
a rule from Python's ``unicodedata`` names over the emoji blocks (so some
names differ from CLDR short names, see README); a few common emoji use their
CLDR short name instead.  Users may pass their own dictionary.

Plan: one regex finds emoji sequences (base, optional variation selector /
skin tone, ZWJ continuations; longest match first by construction),
``regexp_extract_all`` returns them in order, ``split`` returns the text
between them, and the two arrays are spliced back with the names looked up
in a constant hashed map.  Rows without an emoji skip the splice (``rlike`` guard).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column, functions as F

from .maps import hashed_map, map_literal

# Code point blocks treated as emoji bases by the built-in lexicon
EMOJI_BLOCKS = [
    (0x1F300, 0x1F5FF),  # miscellaneous symbols and pictographs
    (0x1F600, 0x1F64F),  # emoticons
    (0x1F680, 0x1F6FF),  # transport and map symbols
    (0x1F900, 0x1F9FF),  # supplemental symbols and pictographs
    (0x1FA70, 0x1FAFF),  # symbols and pictographs extended-A
]
# Common emoji outside those blocks
EXTRA_EMOJI = "☀☁☂☃☄☎☑☔☕☘☝☠☢☣☦☪☮☯☸☹☺♀♂♈♉♊♋♌♍♎♏♐♑♒♓♟♠♣♥♦♨♻♾♿⚒⚓⚔⚕⚖⚗⚙⚛⚜⚠⚡⚧⚪⚫⚰⚱⚽⚾⛄⛅⛈⛎⛏⛑⛓⛔⛩⛪⛰⛱⛲⛳⛴⛵⛷⛸⛹⛺⛽✂✅✈✉✊✋✌✍✏✒✔✖✝✡✨✳✴❄❇❌❎❓❔❕❗❣❤➕➖➗➡➰➿⬅⬆⬇⬛⬜⭐⭕"
# CLDR short names used where they differ from unicodedata names
# (code point order)
CLDR_NAMES = {
    "☹": "frowning_face",
    "☺": "smiling_face",
    "✅": "check_mark_button",
    "✔": "check_mark",
    "❤": "red_heart",
    "⭐": "star",
    "👌": "OK_hand",
    "👍": "thumbs_up",
    "👎": "thumbs_down",
    "👏": "clapping_hands",
    "💯": "hundred_points",
    "😁": "beaming_face_with_smiling_eyes",
    "😃": "grinning_face_with_big_eyes",
    "😄": "grinning_face_with_smiling_eyes",
    "😅": "grinning_face_with_sweat",
    "😆": "grinning_squinting_face",
    "😊": "smiling_face_with_smiling_eyes",
    "😋": "face_savoring_food",
    "😍": "smiling_face_with_heart-eyes",
    "😘": "face_blowing_a_kiss",
    "😡": "enraged_face",
    "😤": "face_with_steam_from_nose",
    "🙏": "folded_hands",
    "🤩": "star-struck",
    "🥺": "pleading_face",
}

# CLDR names of the five skin tone modifiers (U+1F3FB..U+1F3FF)
SKIN_TONES = {
    "\U0001F3FB": "light_skin_tone",
    "\U0001F3FC": "medium-light_skin_tone",
    "\U0001F3FD": "medium_skin_tone",
    "\U0001F3FE": "medium-dark_skin_tone",
    "\U0001F3FF": "dark_skin_tone",
}

VS16 = "\ufe0f"
ZWJ = "\u200d"
MODIFIERS = r"[\x{FE0F}\x{1F3FB}-\x{1F3FF}]"


def _name(cp: int) -> str | None:
    ch = chr(cp)
    if unicodedata.category(ch) != "So":
        return None
    n = unicodedata.name(ch, "")
    if not n:
        return None
    return n.lower().replace(" ", "_")


@lru_cache(maxsize=1)
def builtin_lexicon() -> dict[str, str]:
    """emoji -> name (without colons), built by rule from unicodedata."""
    lex: dict[str, str] = {}
    for lo, hi in EMOJI_BLOCKS:
        for cp in range(lo, hi + 1):
            if 0x1F3FB <= cp <= 0x1F3FF:  # skin tone modifiers are not bases
                continue
            n = _name(cp)
            if n:
                lex[chr(cp)] = n
    for ch in EXTRA_EMOJI:
        n = _name(ord(ch))
        if n:
            lex[ch] = n
    lex.update(CLDR_NAMES)
    return lex


def lexicon_table(spark, lexicon: Mapping[str, str] | None = None):
    """The lexicon as a DataFrame ``(emoji, name)``."""
    lex = builtin_lexicon() if lexicon is None else lexicon
    return spark.createDataFrame(sorted(lex.items()), "emoji string, name string")


def _class_for(chars) -> str:
    cps = sorted({ord(c) for c in chars})
    parts, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        parts.append(f"\\x{{{cps[i]:X}}}" + (f"-\\x{{{cps[j]:X}}}" if j > i else ""))
        i = j + 1
    return "[" + "".join(parts) + "]"


# Code point ranges that hold emoji bases (a superset of any lexicon); one range around them comes
# first, so that most characters are tested against that only
CANDIDATE_BASE = (r"[\x{2190}-\x{1FAFF}&&[\x{2190}-\x{21FF}\x{2300}-\x{23FF}\x{2460}-\x{27BF}\x{2900}-\x{2BFF}"
                  r"\x{3030}\x{303D}\x{3297}\x{3299}\x{1F000}-\x{1FAFF}]]")


def sequence_pattern(lexicon: Mapping[str, str]) -> str:
    """Regex for one candidate emoji sequence.

    The base is a short class of whole blocks, not the exact lexicon: a Java
    character class is tested range by range, so hundreds of ranges would be
    scanned for every character of every text.  A candidate that is not in
    the lexicon is put back unchanged, so the wider class changes nothing.
    Lexicon bases outside the blocks are added to the class.
    """
    extra = {k[0] for k in lexicon if k and not _in_candidate_blocks(ord(k[0]))}
    base = CANDIDATE_BASE if not extra else f"(?:{CANDIDATE_BASE}|{_class_for(extra)})"
    unit = base + MODIFIERS + "*"
    return f"{unit}(?:\\x{{200D}}{unit})*"


def _in_candidate_blocks(cp: int) -> bool:
    return (0x2190 <= cp <= 0x21FF or 0x2300 <= cp <= 0x23FF or 0x2460 <= cp <= 0x27BF
            or 0x2900 <= cp <= 0x2BFF or cp in (0x3030, 0x303D, 0x3297, 0x3299)
            or 0x1F000 <= cp <= 0x1FAFF)


def demojize(c: Column, lexicon: Mapping[str, str] | None = None) -> Column:
    """Replace every emoji sequence by ``:name:``.

    A sequence found in the lexicon (with or without the presentation
    selector) takes its name.  Otherwise it is named from its parts: each
    unit's base name, plus its skin tone (``thumbs_up_light_skin_tone``), units
    joined by ``_``.  A sequence with a base outside the lexicon stays as it is.
    """
    lex = builtin_lexicon() if lexicon is None else dict(lexicon)
    if not lex:
        return c
    # keys are looked up with and without the emoji presentation selector
    plain = {}
    for k, v in lex.items():
        plain[k] = v
        plain.setdefault(k.replace(VS16, ""), v)
    from pyspark.sql import SparkSession
    look = hashed_map(SparkSession.getActiveSession(), plain)  # a few comparisons per emoji
    tones = map_literal(SKIN_TONES)

    def unit_name(u: Column) -> Column:
        base = look(F.regexp_replace(u, MODIFIERS, ""))
        tone = F.try_element_at(tones, F.regexp_extract(u, "[\\x{1F3FB}-\\x{1F3FF}]", 0))
        return F.when(tone.isNull(), base).otherwise(F.concat(base, F.lit("_"), tone))

    def name_of(s: Column) -> Column:
        whole = F.coalesce(look(s), look(F.regexp_replace(s, "\\x{FE0F}", "")))
        parts = F.transform(F.split(s, "\\x{200D}", -1), unit_name)
        composed = F.when(F.forall(parts, lambda x: x.isNotNull()), F.array_join(parts, "_"))
        named = F.coalesce(whole, composed)
        return F.when(named.isNull(), s).otherwise(F.concat(F.lit(":"), named, F.lit(":")))

    pat = sequence_pattern(lex)
    found = F.regexp_extract_all(c, F.lit(pat), 0)
    pieces = F.split(c, pat, -1)
    named = F.transform(found, name_of)
    # zip_with: the lambda reads only its arguments (no per-element re-evaluation)
    spliced = F.array_join(F.zip_with(pieces, named, lambda p, n: F.concat(
        F.coalesce(p, F.lit("")), F.coalesce(n, F.lit("")))), "")
    return F.when(c.rlike(pat), spliced).otherwise(c)
