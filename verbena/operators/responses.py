"""Labeler answers as a table (R1-R8, T14 batches).

An answer has the form ``corrected(sentiment-topic)`` per comment, joined by
``|``.  The outside labeler is not part of this library; its answers arrive
as a table ``(batch_id, response)`` (or ``(key, response)`` in single mode)
and are parsed with native string expressions only.

Parsing rules (the reference's behaviour, with D2 applied):
- a part needs both ``(`` and ``)``; otherwise it is kept whole with 1, 9
  (single mode keeps the original comment instead);
- corrected text = before the first ``(``, stripped; tag = from the first
  ``(`` to the next ``)`` inside that segment, stripped;
- no ``-`` in the tag: corrected, 1, 9;
- exactly one ``-``: sentiment kept if ``0``/``1``/``2`` else ``1``; topic
  kept if one digit ``1``-``9`` else ``9`` (pieces are not stripped);
- two or more ``-`` (the reference raised): the whole part, 1, 9 in batch
  mode; the original comment, 1, 9 in single mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import DEFAULT_SENTIMENT, DEFAULT_TASK
from ..functions.text import build_prompt_batch, strip

LABEL_STRUCT = "struct<corrected_text:string,label:string,task:string>"


def _default(text: Column) -> Column:
    return F.struct(text.alias("corrected_text"), F.lit(DEFAULT_SENTIMENT).alias("label"),
                    F.lit(DEFAULT_TASK).alias("task"))


def split_response(response: Column) -> Column:
    """Parts of a stripped answer.

    With a pipe: split, strip, drop blank parts.  Without one the whole
    answer is the single part, even if blank.  A null answer stays null.
    """
    # a pipe is no white space: the whole answer need not be stripped to look for one, nor before its parts are
    parts = F.filter(F.transform(F.split(response, r"\|", -1), strip), lambda p: p != F.lit(""))
    return (F.when(response.isNull(), F.lit(None).cast("array<string>"))
            .when(response.contains("|"), parts).otherwise(F.array(strip(response))))


def parse_part(part: Column, mode: str = "batch", comment: Column | None = None) -> Column:
    """One part to ``struct<corrected_text, label, task>`` (all strings)."""
    if mode not in ("batch", "single"):
        raise ValueError("mode must be 'batch' or 'single'")
    if mode == "single" and comment is None:
        raise ValueError("single mode needs the original comment")
    has_parens = (F.instr(part, "(") > 0) & (F.instr(part, ")") > 0)
    corrected = strip(F.substring_index(part, "(", 1))
    segment = F.split_part(part, F.lit("("), F.lit(2))
    tag = strip(F.substring_index(segment, ")", 1))
    pieces = F.split(tag, "-", -1)
    n_pieces = F.size(pieces)
    sentiment, task = F.get(pieces, 0), F.get(pieces, 1)
    label = F.when(sentiment.isin("0", "1", "2"), sentiment).otherwise(F.lit(DEFAULT_SENTIMENT))
    topic = F.when(task.rlike(r"^[1-9]\z"), task).otherwise(F.lit(DEFAULT_TASK))
    fallback = part if mode == "batch" else comment
    on_null = fallback if mode == "single" else F.lit(None).cast("string")
    return (F.when(part.isNull(), _default(on_null))
            .when(~has_parens, _default(fallback))
            .when(n_pieces == 1, _default(corrected))
            .when(n_pieces == 2, F.struct(corrected.alias("corrected_text"), label.alias("label"),
                                          topic.alias("task")))
            .otherwise(_default(fallback)))


def parse_single(response: Column, comment: Column) -> Column:
    """A single-sentence answer; failures keep the original sentence."""
    return parse_part(strip(response), mode="single", comment=comment)


def parse_responses(responses: DataFrame, key: str = "batch_id",
                    response: str = "response") -> DataFrame:
    """R1-R4 per answer: ``(key, part_no, corrected_text, label, task)``.

    One row per surviving part (``posexplode``); a null answer gives no row.
    """
    parts = responses.select(F.col(key), F.posexplode(split_response(F.col(response)))
                             .alias("part_no", "part"))
    return parts.select(key, "part_no", parse_part(F.col("part")).alias("p")).select(
        key, "part_no", "p.corrected_text", "p.label", "p.task")


def label_of(part: Column, comment: Column) -> Column:
    """R6 + R7: the parsed part of a row, or the row's own comment with 1, 9 where there is none."""
    return F.when(part.isNull(), _default(comment)).otherwise(parse_part(part))


def align_responses(rows: DataFrame, responses: DataFrame, key: str = "batch_id",
                    pos: str = "pos", comment: str = "comment",
                    response: str = "response", answered_only: bool = False) -> DataFrame:
    """J4 + R6 + R7 + R8: labels onto the rows of each batch.

    ``rows`` has one row per comment with ``key`` and its ``pos`` in the
    batch; ``responses`` one row per batch.  Part *i* belongs to row *i*;
    missing parts, null answers and batches without an answer give the row's
    own comment with 1, 9; extra parts are ignored.  The answer is split once
    per batch (before the join), and the join is a plain equi-join on the
    batch key: no positional self-join.  ``answered_only=True`` keeps only
    rows whose batch has an answer row (a streaming answer table joined to a
    static row table).  Of several answers to one batch the smallest non-null
    one counts, so every row gets one label row (not on a stream, which takes
    answers as they come).
    """
    answers = responses if responses.isStreaming else responses.groupBy(key).agg(F.min(response).alias(response))
    parsed = answers.select(F.col(key), split_response(F.col(response)).alias("__vb_parts"))
    joined = parsed.join(rows, key, "inner") if answered_only else rows.join(parsed, key, "left")
    part = F.get(F.col("__vb_parts"), F.col(pos).cast("int"))
    return apply_labels(joined.withColumn("__vb_lab", label_of(part, F.col(comment))).drop("__vb_parts"), "__vb_lab",
                        comment)


def apply_labels(df: DataFrame, struct_col: str, comment: str = "comment") -> DataFrame:
    """Replace ``comment``, ``label``, ``task``; keep every other column."""
    return df.withColumns({
        comment: F.col(f"{struct_col}.corrected_text"),
        "label": F.col(f"{struct_col}.label"),
        "task": F.col(f"{struct_col}.task"),
    }).drop(struct_col)


def batch_prompts(batches: DataFrame, template: str, items: str = "items",
                  comment_field: str = "comment", lexicon=None) -> DataFrame:
    """T14 over ``batch_rows`` output: one prompt per batch."""
    comments = F.transform(F.col(items), lambda s: s[comment_field])
    return batches.withColumn("prompt", build_prompt_batch(template, comments, lexicon))
