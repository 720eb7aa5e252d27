"""Column functions: each takes and returns a ``Column`` (no UDFs)."""

from .text import (WS, WORD, clean_text, clean_all_columns, collapse_ws, strip, strip_symbols,
                   lowercase, sentences, preprocess_multitask, preprocess_sentiment,
                   build_prompt_single, build_prompt_batch, tokens)
from .emoji import demojize, builtin_lexicon, lexicon_table
from .abbreviations import expand_abbreviations
from .labels import (SENTIMENT_NAMES, TASK_NAMES, recode_label, decode_label, task_to_index,
                     index_to_task)
from .scoring import softmax, argmax, confidence
from .maps import map_literal

__all__ = [
    "WS", "WORD", "clean_text", "clean_all_columns", "collapse_ws", "strip", "strip_symbols",
    "lowercase", "sentences", "preprocess_multitask", "preprocess_sentiment",
    "build_prompt_single", "build_prompt_batch", "tokens", "demojize", "builtin_lexicon",
    "lexicon_table", "expand_abbreviations", "SENTIMENT_NAMES", "TASK_NAMES", "recode_label",
    "decode_label", "task_to_index", "index_to_task", "softmax", "argmax", "confidence",
    "map_literal",
]
