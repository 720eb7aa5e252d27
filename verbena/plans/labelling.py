"""Dataset-building jobs: batch mode and single-sentence mode.

Batch: clean (T2) -> resume (J1) -> row index + batches of 5 (W1, A1) ->
prompts (T14) | answers -> align (J4, R1-R8) -> check (P1) -> append (U2).
Single: clean -> sentences (T11, T12) -> resume on the source sentence (J2)
-> prompts (T13) | answers -> parse (R5) -> append.

The outside labeler is not built; its answers are a table keyed by batch id
(batch mode) or by ``(row key, sentence_no)`` (single mode).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.text import build_prompt_single, clean_text
from ..operators.index import batch_rows
from ..operators.responses import align_responses, batch_prompts, parse_single
from ..operators.resume import resume_by_id, resume_by_sentence
from ..operators.sentences import explode_sentences
from ..sources.comments import default_column, require_columns

REQUIRED = ("id", "comment", "label")


def prepare_comments(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Check columns, default topic, clean every column but ``keep``."""
    require_columns(df, REQUIRED)
    df = default_column(df, "task", "9")
    return df.select(*[F.col(c) if c in keep else clean_text(F.col(c)).alias(c)
                       for c in df.columns])


def plan_batches(comments: DataFrame, order_by: Sequence, progress: DataFrame | None = None,
                 size: int = 5, template: str = "", num_partitions: int | None = None):
    """Rows still to label, their batches and one prompt per batch.

    Returns ``(rows, prompts)``; ``rows`` carries ``batch_id`` and ``pos``.
    """
    todo = resume_by_id(comments, progress, "id") if progress is not None else comments
    rows, batches = batch_rows(todo, order_by, size, ("id", "comment"),
                               num_partitions=num_partitions)
    return rows, batch_prompts(batches, template)


def label_batches(rows: DataFrame, responses: DataFrame) -> DataFrame:
    """Answers onto rows (J4, R6-R8); index helper columns dropped."""
    return align_responses(rows, responses).drop("row_idx", "pos")


def plan_sentences(comments: DataFrame, progress: DataFrame | None = None,
                   template: str = "") -> DataFrame:
    """One row per sentence still to label, with its prompt."""
    s = explode_sentences(comments, "comment", "sentence", "sentence_no")
    if progress is not None:
        s = resume_by_sentence(s, progress, "sentence", "source_sentence")
    return s.withColumn("prompt", build_prompt_single(template, F.col("sentence")))


def label_sentences(sentences: DataFrame, responses: DataFrame | None = None,
                    keys: Sequence[str] = ("id", "sentence_no"),
                    response: str = "response") -> DataFrame:
    """R5 + R8: each sentence becomes a labelled row; ``source_sentence`` keeps
    the sentence that was sent (D3), ``comment`` the corrected text."""
    df = sentences if responses is None else sentences.join(responses, list(keys), "left")
    lab = parse_single(F.col(response), F.col("sentence"))
    return (df.withColumn("__vb_l", lab)
            .withColumns({"source_sentence": F.col("sentence"),
                          "comment": F.col("__vb_l.corrected_text"),
                          "label": F.col("__vb_l.label"), "task": F.col("__vb_l.task")})
            .drop("__vb_l", response, "sentence", "prompt"))


def run_batch_labelling(comments: DataFrame, responses: DataFrame, output: str,
                        order_by: Sequence, progress: DataFrame | None = None,
                        size: int = 5, fmt: str = "parquet") -> None:
    """The whole batch job on answers already collected: rows still to label
    (J1 against ``progress``), batches of ``size`` (A1), answers aligned and
    parsed (R1-R8), appended to ``output`` (U2, never rewritten).

    Nothing is returned on purpose: a lazy frame built on ``progress`` would
    change meaning once its own rows are in the output; read ``output``.
    """
    from ..sources.sinks import write_labelled
    rows, _ = plan_batches(comments, order_by, progress, size)
    labelled = label_batches(rows, responses)
    write_labelled(labelled, output, fmt=fmt, mode="append")
