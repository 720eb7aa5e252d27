"""Registered queries over the driver's tables, and their SQL oracle.

Every query reads whole tables (``documents``, ``labels``, ``embeddings``)
through ``sources.derived`` and returns a DataFrame; ``oracle.SQL`` holds the
same computation as DuckDB SQL (``oracle.py``).  Column names and types match
on both sides; doubles are rounded on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions.emoji import demojize
from .functions.labels import SENTIMENT_NAMES, TASK_NAMES, decode_label, task_to_index
from .functions.scoring import softmax
from .functions.text import clean_text, preprocess_multitask, preprocess_sentiment
from .llm.common import materialise
from .operators import metrics as M
from .operators.index import batch_rows, row_index
from .operators.predict import predict_codes, predict_emotion, predict_named
from .operators.responses import align_responses, batch_prompts, parse_responses
from .operators.resume import resume_by_id, resume_by_sentence
from .operators.sentences import explode_sentences
from .operators.split import stratified_split
from .operators.validate import domain_report
from .operators.vocab import encode_fixed, fit_vocab
from .plans.labelling import label_sentences, prepare_comments
from .sources import derived as D
from .sources.abbreviations import last_wins
from .sources.adapters import adapter_a, adapter_b, adapter_c, union_sources

# The inline abbreviation dictionary of the test mapping (line order matters)
ABBREVIATION_LINES = [(0, "the", "THE1"), (1, "de", "von"), (2, "the", "le mot"), (3, "is", "est")]
PROMPT_TEMPLATE = "Label each comment: "
START_ROW = 37
MAX_LEN = 128
PHRASE_MIN_COUNT, PHRASE_DELTA, PHRASE_THRESHOLD = 5, 5.0, 0.0
PHRASE_MAX_LEN = 4
LOSS_WEIGHTS = (0.45, 0.55)


def _inline_dict() -> dict[str, str]:
    d: dict[str, str] = {}
    for _, k, v in sorted(ABBREVIATION_LINES):
        d[k] = v  # last line wins
    return d


def _r6(c):
    return F.round(c, 6)


# ----------------------------------------------------------------------------- Spark side

def q_clean_comments(spark: SparkSession, sf: str) -> DataFrame:
    d = D.table(spark, sf, "documents").withColumnRenamed("doc_id", "id") \
        .withColumnRenamed("text", "comment")
    return prepare_comments(d.withColumn("label", F.lit("1")))


def q_preprocess_multitask(spark, sf):
    d = D.with_emoji(D.table(spark, sf, "documents").select("doc_id", "text"))
    return d.select("doc_id", preprocess_multitask(F.col("text"), _inline_dict()).alias("processed_text"))


def q_preprocess_sentiment(spark, sf):
    d = D.with_emoji(D.table(spark, sf, "documents").select("doc_id", "text"))
    return d.select("doc_id", preprocess_sentiment(F.col("text"), _inline_dict()).alias("processed_text"))


def q_demojize_text(spark, sf):
    d = D.with_emoji(D.table(spark, sf, "documents").select("doc_id", "text"))
    return d.select("doc_id", demojize(F.col("text")).alias("text"))


# Sequences and names of the lexicon table of ``demojize_sequences``
EMOJI_ROWS = [("\U0001F468\u200d\U0001F4BB", "man_technologist"), ("\U0001F468", "man"), ("\U0001F4BB", "laptop"),
              ("\U0001F1FB\U0001F1F3", "Vietnam"), ("1\ufe0f\u20e3", "keycap_1")]


def q_demojize_sequences(spark, sf):
    """T3 with a lexicon table: ZWJ, flag and keycap sequences by their own names."""
    from .operators.emoji_table import demojize_with_table
    k = F.col("doc_id") % 5
    injected = F.when(k == 0, F.concat(F.col("text"), F.lit(EMOJI_ROWS[0][0]))).when(k == 1, F.concat(F.lit(EMOJI_ROWS[3][0]), F.col("text"))) \
        .when(k == 2, F.concat(F.lit(EMOJI_ROWS[4][0] + EMOJI_ROWS[1][0]), F.col("text"))).otherwise(F.col("text"))
    d = D.table(spark, sf, "documents").select("doc_id", injected.alias("text"))
    return demojize_with_table(d, "text", spark.createDataFrame(EMOJI_ROWS, "emoji string, name string"))


def q_split_sentences(spark, sf):
    c = D.comments(spark, sf).select("doc_id", "comment")
    return explode_sentences(c).select("doc_id", F.col("sentence_no").cast("int"), "sentence")


def _derived_abbreviations(spark, sf):
    c = D.table(spark, sf, "documents").select("doc_id", clean_text(F.col("text")).alias("t"))
    return c.select(F.col("doc_id").alias("line_no"), F.lower(F.split_part("t", F.lit(" "), F.lit(1))).alias("abbr"),
                    F.split_part("t", F.lit(" "), F.lit(2)).alias("full"))


def q_abbreviation_last_wins(spark, sf):
    return last_wins(_derived_abbreviations(spark, sf))


def _batched(spark, sf, columns=("id", "comment")):
    c = D.comments(spark, sf).select("doc_id", "id", "comment", F.lit("1").alias("label"))
    return batch_rows(c, ["doc_id"], 5, columns, prepare=lambda rows: prepare_comments(rows, keep=("doc_id",)))


def q_prompt_batches(spark, sf):
    rows, batches = _batched(spark, sf)
    p = batch_prompts(batches, PROMPT_TEMPLATE)
    return p.select("batch_id", F.size("items").cast("int").alias("n_rows"), "prompt")


def q_prompt_sentences(spark, sf):
    """T11-T13 + J2: one prompt per sentence not labelled before (single mode)."""
    from .plans.labelling import plan_sentences
    c = prepare_comments(D.comments(spark, sf).select("doc_id", "id", "comment",
                                                      F.lit("1").alias("label")), keep=("doc_id",))
    done = explode_sentences(
        c.join(D.table(spark, sf, "labels").select("doc_id"), "doc_id").select("comment")
    ).select(F.col("sentence").alias("source_sentence"))
    s = plan_sentences(c, done, PROMPT_TEMPLATE)
    return s.select("doc_id", F.col("sentence_no").cast("int"), "prompt")


def q_parse_batch_responses(spark, sf):
    rows, _ = _batched(spark, sf)
    resp = D.synthetic_responses(rows)
    return parse_responses(resp).select("batch_id", F.col("part_no").cast("int"),
                                        "corrected_text", "label", "task")


def _single(spark, sf):
    c = prepare_comments(D.comments(spark, sf).select("doc_id", "id", "comment",
                                                      F.lit("1").alias("label")), keep=("doc_id",))
    s = explode_sentences(c)
    return D.single_responses(s)


def q_parse_single_responses(spark, sf):
    s = _single(spark, sf)
    out = label_sentences(s)
    return out.select("doc_id", F.col("sentence_no").cast("int"),
                      F.col("comment").alias("corrected_text"), "label", "task")


def q_align_responses(spark, sf):
    rows, _ = _batched(spark, sf)
    resp = D.synthetic_responses(rows)
    return align_responses(rows, resp).select("doc_id", "id", "comment", "label", "task")


def q_labelled_counts(spark, sf):
    """Flagship: the whole batch labelling job, then counts by sentiment x topic."""
    lab = q_align_responses(spark, sf)
    return (lab.groupBy(F.col("label").cast("int").alias("label"),
                        F.col("task").cast("int").alias("task"))
            .agg(F.count(F.lit(1)).alias("n")))


def _done(spark, sf):
    """Earlier output: the rows that already carry labels (ids read back as numbers)."""
    return D.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))


def q_resume_by_id(spark, sf):
    c = D.comments(spark, sf).select("doc_id", "id")
    return resume_by_id(c, _done(spark, sf), "id")


def q_resume_by_sentence(spark, sf):
    c = D.comments(spark, sf).select("doc_id", "comment")
    s = explode_sentences(c)
    done = explode_sentences(
        D.comments(spark, sf).join(D.table(spark, sf, "labels").select("doc_id"), "doc_id")
        .select("comment")).select(F.col("sentence").alias("source_sentence"))
    return resume_by_sentence(s, done).select("doc_id", F.col("sentence_no").cast("int"), "sentence")


def q_skip_rows(spark, sf):
    from .sources.comments import skip_rows
    c = D.comments(spark, sf).select("doc_id", "id")
    return skip_rows(c, START_ROW, ["doc_id"], index_col="row_idx")


def _labelled_by_source(spark, sf):
    """The labelled rows, read once and written partitioned by source letter
    (``doc_id % 3``): each source below reads only its own folder."""
    from .session import shared_dir
    path = shared_dir(spark, "sources")
    letter = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("doc_id") % 3 + 1).cast("int"))
    D.labelled_comments(spark, sf).withColumn("src", letter).write.partitionBy("src").parquet(path)
    return spark.read.parquet(path)


def _sources_table(spark, sf, lab=None):
    """Sources A / B / C in their own codings; every 50th row (``% 50 = 7``) an unknown code."""
    lab = _labelled_by_source(spark, sf) if lab is None else lab
    k = F.col("src")
    unknown = F.col("doc_id") % 50 == 7
    a = lab.filter(k == "A").select("doc_id", F.col("comment").alias("sentence"),
                                  F.when(unknown, 5).otherwise(F.col("label")).alias("sentiment"))
    b = lab.filter(k == "B").select("doc_id", "comment", F.when(unknown, "BAD").otherwise(
        F.element_at(F.create_map(F.lit(0), F.lit("NEG"), F.lit(1), F.lit("NEU"), F.lit(2), F.lit("POS")),
                     F.col("label"))).alias("label"))
    c = lab.filter(k == "C").select("doc_id", "comment", F.when(unknown, 7).otherwise(
        F.when(F.col("label") == 0, 0).when(F.col("label") == 2, 1).otherwise(9)).alias("label"))
    return a, b, c


def q_recode_and_union(spark, sf):
    a, b, c = _sources_table(spark, sf)
    return union_sources(
        adapter_a(a, "sentence", "sentiment", keep=["doc_id"]).withColumn("source", F.lit("A")),
        adapter_b(b, keep=["doc_id"]).withColumn("source", F.lit("B")),
        adapter_c(c, keep=["doc_id"]).withColumn("source", F.lit("C")))


def q_validate_labels(spark, sf):
    lab = _labelled_by_source(spark, sf)
    a, b, c = _sources_table(spark, sf, lab)
    mixed = lab.select("label", "task").unionByName(
        a.select(F.col("sentiment").alias("label"), F.lit(9).alias("task"))).unionByName(
        c.select("label", (F.col("doc_id") % 11).alias("task")))
    return domain_report(mixed, "label", "task")


def q_decode_labels(spark, sf):
    p = D.with_predictions(D.labelled_comments(spark, sf))
    return p.select(
        "doc_id",
        decode_label(F.col("pred_label"), SENTIMENT_NAMES).alias("sentiment_name"),
        decode_label(F.col("pred_task"), TASK_NAMES).alias("task_name"),
        task_to_index(F.col("pred_task")).alias("task_index"),
        decode_label(F.col("label") + 2, SENTIMENT_NAMES).alias("shifted_name"))


def q_stratified_split_multitask(spark, sf):
    lab = D.labelled_comments(spark, sf).select("id", "label", "task")
    return stratified_split(lab, ["label", "task"], "id", 0.15, 0.15, 42)


def q_stratified_split_sentiment(spark, sf):
    lab = D.labelled_comments(spark, sf).select("id", "label")
    return stratified_split(lab, ["label"], "id", 0.0, 0.1, 42)


def _processed_docs(spark, sf):
    d = D.balance(D.table(spark, sf, "documents").select("doc_id", "text"))
    return d.select("doc_id", preprocess_multitask(F.col("text")).alias("processed_text"))


def q_fit_vocab(spark, sf):
    return fit_vocab(_processed_docs(spark, sf), "processed_text")


def q_encode_fixed(spark, sf):
    docs = materialise(_processed_docs(spark, sf), "processed-docs")  # read by the vocabulary and by the encoding
    vocab = fit_vocab(docs, "processed_text")
    return encode_fixed(docs, "processed_text", vocab, MAX_LEN, key="doc_id").select(
        "doc_id", "input_ids", "attention_mask")


#: Public tokenizer file of the sub-word queries (a parameter of the operators).
SUBWORDS = "byte_bpe_50k.json"


def q_subword_vocab(spark, sf):
    """E2 on sub-words: the pieces that the texts use, counted and numbered."""
    import public_tokenizers
    from .operators.subwords import subword_counts, subword_vocab
    return subword_vocab(subword_counts(_processed_docs(spark, sf), "processed_text", public_tokenizers.path(SUBWORDS)))


def q_encode_subwords(spark, sf):
    """E1 on sub-words: no word is unknown."""
    import public_tokenizers
    from .operators.subwords import encode_subwords
    return encode_subwords(_processed_docs(spark, sf), "processed_text", public_tokenizers.path(SUBWORDS), MAX_LEN).select(
        "doc_id", "input_ids", "attention_mask")


def q_phrase_scores(spark, sf):
    from .operators.phrases import phrase_scores
    p = phrase_scores(_processed_docs(spark, sf), "processed_text", PHRASE_MIN_COUNT,
                      PHRASE_DELTA, PHRASE_THRESHOLD)
    return p.withColumn("score", F.round(F.col("score") * 1e6, 3))


def q_apply_phrases(spark, sf):
    from .operators.phrases import apply_phrases, phrase_scores
    docs = materialise(_processed_docs(spark, sf), "processed-docs")
    p = phrase_scores(docs, "processed_text", PHRASE_MIN_COUNT, PHRASE_DELTA, PHRASE_THRESHOLD, written=True)
    return apply_phrases(docs, "processed_text", p, "phrased", key="doc_id").select("doc_id", "phrased")


def _sentiment_texts(spark, sf):
    d = D.with_emoji(D.balance(D.table(spark, sf, "documents").select("doc_id", "text")))
    return d.select("doc_id", preprocess_sentiment(F.col("text"), _inline_dict()).alias("processed_text"))


def q_long_phrases(spark, sf):
    """Phrases of up to four tokens fitted on the sentiment texts."""
    from .operators.segment import fit_phrases
    p = fit_phrases(_sentiment_texts(spark, sf), "processed_text", PHRASE_MAX_LEN, PHRASE_MIN_COUNT, PHRASE_DELTA, PHRASE_THRESHOLD)
    return p.select("phrase", "n_tokens", "n", F.round(F.col("score") * 1e6, 3).alias("score"))


def q_segment_sentiment(spark, sf):
    """T10 with T8: sentiment texts, their words joined by longest match."""
    from .operators.segment import fit_phrases, segment
    docs = materialise(_sentiment_texts(spark, sf), "sentiment-texts")  # read by the fit and by the segmentation
    p = fit_phrases(docs, "processed_text", PHRASE_MAX_LEN, PHRASE_MIN_COUNT, PHRASE_DELTA, PHRASE_THRESHOLD, written=True)
    return segment(docs, "processed_text", p, key="doc_id").select("doc_id", "segmented")


def _predictions(spark, sf):
    return D.with_predictions(D.labelled_comments(spark, sf))


def q_confusion_matrix(spark, sf):
    cm = M.confusion_long(_predictions(spark, sf), [M.SENTIMENT_HEAD, M.TASK_HEAD])
    return cm.select("head", "actual", "predicted", "n")


def q_classification_report(spark, sf):
    cm = M.confusion_long(_predictions(spark, sf), [M.SENTIMENT_HEAD, M.TASK_HEAD])
    r = M.classification_report(cm)
    return r.select("head", "row", _r6(F.col("precision")).alias("precision"),
                    _r6(F.col("recall")).alias("recall"), _r6(F.col("f1")).alias("f1"), "support")


def q_weighted_metrics(spark, sf):
    cm = M.confusion_long(_predictions(spark, sf), [M.SENTIMENT_HEAD, M.TASK_HEAD])
    w = M.weighted_metrics(cm)
    return w.select("head", *[_r6(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "f1")],
                    "support")


def _probs(spark, sf):
    lg = D.logits(spark, sf)
    return lg.select("vec_id", softmax(F.col("sentiment_logits")).alias("ps"),
                     softmax(F.col("task_logits")).alias("pt"), "actual_label", "actual_task")


def q_mean_loss(spark, sf):
    # vec_id % 50 = 7: probability 0 of the true sentiment; % 50 = 9: a label outside the domain
    p = _probs(spark, sf).withColumns({
        "ps": F.when(F.col("vec_id") % 50 == 7, F.transform("ps", lambda v, i: F.when(i == F.col("actual_label"), 0.0)
                                                            .otherwise(v))).otherwise(F.col("ps")),
        "actual_label": F.when(F.col("vec_id") % 50 == 9, 7).otherwise(F.col("actual_label"))})
    return p.agg(_r6(M.mean_loss(p, "ps", "actual_label")).alias("sentiment_loss"),
                 _r6(M.mean_loss(p, "pt", "actual_task", 1)).alias("task_loss"),
                 M.unscorable("ps", "actual_label").alias("sentiment_unscorable"),
                 M.unscorable("pt", "actual_task", 1).alias("task_unscorable"))


def q_joint_loss(spark, sf):
    p = _probs(spark, sf)
    a, b = LOSS_WEIGHTS
    j = F.lit(a) * M.mean_loss(p, "ps", "actual_label") + F.lit(b) * M.mean_loss(p, "pt", "actual_task", 1)
    return p.agg(_r6(j).alias("joint_loss"))


def q_predict_codes(spark, sf):
    out = predict_codes(D.logits(spark, sf), "vec_id", "sentiment_logits", "task_logits")
    return out.select("id_text", "sentiment", _r6(F.col("sentiment_confidence")).alias("sentiment_confidence"),
                      "task", _r6(F.col("task_confidence")).alias("task_confidence"))


def q_predict_named(spark, sf):
    lg = D.logits(spark, sf).withColumn("text", F.col("vec_id").cast("string"))
    out = predict_named(lg, "text", "sentiment_logits", "task_logits")
    return out.select("text", "sentiment", _r6(F.col("sentiment_confidence")).alias("sentiment_confidence"),
                      "task", _r6(F.col("task_confidence")).alias("task_confidence"))


def q_predict_emotion(spark, sf):
    lg = D.logits(spark, sf).withColumn("text", F.col("vec_id").cast("string"))
    out = predict_emotion(lg, "text", "sentiment_logits")
    return out.select("text", "emotion", _r6(F.col("confidence")).alias("confidence"))


def q_score_with_batch_udf(spark, sf):
    from .plans.scoring import linear_scorer, score_with
    e = D.table(spark, sf, "embeddings").select("vec_id", "embedding")
    out = score_with(e, "embedding", linear_scorer(), n_classes=3)
    return out.select("vec_id", "pred", _r6(F.col("confidence")).alias("confidence"))


def q_train_sentiment(spark, sf):
    from .plans.training import train_sentiment_experiment
    return train_sentiment_experiment(spark, sf)


def q_train_multitask(spark, sf):
    from .plans.training import train_multitask_experiment
    return train_multitask_experiment(spark, sf)


def q_train_joint(spark, sf):
    """M2-M4: two heads on one shared layer, early stopping inside the fit."""
    from .plans.joint import train_joint_experiment
    return train_joint_experiment(spark, sf)


def q_label_stream(spark, sf):
    from .streaming.labelling import label_stream_from_tables
    return label_stream_from_tables(spark, sf).select("doc_id", "id", "comment", "label", "task")


def q_label_stream_timeout(spark, sf):
    """ST1 + R7 as streams: unanswered and late batches get the defaults when their deadline passes."""
    from .streaming.timeouts import label_with_timeout_from_tables
    return label_with_timeout_from_tables(spark, sf).select("doc_id", "id", "comment", "label", "task", "answered")


def q_shuffle_order(spark, sf):
    """O1: the repeatable training order (md5 of seed:id, then id) as a 0-based index."""
    from .operators.split import order_key
    lab = D.labelled_comments(spark, sf).select("id")
    return row_index(lab, [order_key("id", 42), F.col("id")], "order_idx")


def q_dataset_counts(spark, sf):
    a, b, c = _sources_table(spark, sf)
    u = union_sources(
        adapter_a(a, "sentence", "sentiment", keep=["doc_id"]).withColumn("source", F.lit("A")),
        adapter_b(b, keep=["doc_id"]).withColumn("source", F.lit("B")),
        adapter_c(c, keep=["doc_id"]).withColumn("source", F.lit("C")))
    return M.dataset_counts(u, "label", ["source"])


def q_score_stream(spark, sf):
    """ST3: the codes-shape scoring run as a stream; equals ``predict_codes``."""
    from .streaming.labelling import score_stream_from_tables
    out = score_stream_from_tables(spark, sf)
    return out.select("id_text", "sentiment", _r6(F.col("sentiment_confidence")).alias("sentiment_confidence"),
                      "task", _r6(F.col("task_confidence")).alias("task_confidence"))


def _counting_rows(spark, sf):
    """Labelled rows with their processed text and a part by hash (train / val / test)."""
    from .operators.split import hash_split
    lab = D.labelled_comments(spark, sf).select("id", "label", preprocess_multitask(F.col("comment")).alias("processed_text"))
    return hash_split(lab, "id", 0.15, 0.15, 42)


def _counting_predictions(spark, sf):
    """M1 + M5: fitted on the training part, saved, loaded, applied to the test part."""
    from .plans.counting import classify, fit_counts
    from .plans.training import load_model, save_model
    from .session import shared_dir
    rows = _counting_rows(spark, sf)
    path = shared_dir(spark, "count-model")
    save_model(fit_counts(rows.where("split = 'train'")), path)
    return classify(load_model(path), rows.where("split = 'test'"))


def q_count_classifier(spark, sf):
    return _counting_predictions(spark, sf).select("id", "label", "pred", _r6(F.col("confidence")).alias("confidence"))


def q_count_classifier_report(spark, sf):
    """M12 + M13: the whole experiment down to the summary of its test part."""
    cm = M.confusion_long(_counting_predictions(spark, sf), [M.Head("sentiment", "label", "pred", [0, 1, 2])])
    w = M.weighted_metrics(cm)
    return w.select("head", *[_r6(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "support")


def q_score_text_stream(spark, sf):
    """ST3 + M5: texts arrive in two sittings; between them a second model version is published."""
    from .plans.counting import classify, fit_counts
    from .session import shared_dir
    from .streaming.scoring import publish, score_texts
    base = shared_dir(spark, "text-stream")
    rows = _counting_rows(spark, sf)
    for version, part in ((1, "split = 'train'"), (2, "split <> 'test'")):
        publish(fit_counts(rows.where(part)), f"{base}/models", version)
        texts = D.table(spark, sf, "documents").where(F.col("doc_id") % 2 == version - 1).select("doc_id", "text")
        texts.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(texts.schema).parquet(f"{base}/in")
        stream = stream.select("doc_id", preprocess_multitask(F.col("text")).alias("processed_text"))
        score_texts(stream, f"{base}/models", classify, f"{base}/out", f"{base}/ckpt", {"availableNow": True}).awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select("doc_id", "pred", _r6(F.col("confidence")).alias("confidence"), F.col("model_version").cast("int"))


def q_append_committed(spark, sf):
    """U2 + K1: three batches appended; one fails after its files and is retried, one is sent twice."""
    from .session import shared_dir
    from .sources.commits import append_once, read_committed, stage
    path = shared_dir(spark, "committed")
    rows = D.labelled_comments(spark, sf).select("id", "label", "task")
    for b in range(3):
        part = rows.where(F.crc32(F.col("id").cast("binary")) % 3 == b)
        if b == 1:
            stage(part, path, f"batch-{b}")  # the attempt that never commits
        append_once(part, path, f"batch-{b}")
        if b == 2:
            append_once(part, path, f"batch-{b}")
    return read_committed(spark, path, rows.schema)


def q_resume_bucketed(spark, sf):
    """J1 against a bucketed history written by two earlier runs."""
    import os
    from .operators.history import add_to_history, open_history, resume_from_history
    from .session import shared_dir
    name = f"history_{os.urandom(4).hex()}"
    open_history(spark, name, shared_dir(spark, "history"), 16)
    for run in (0, 1):
        add_to_history(_done(spark, sf).where(F.col("id") % 2 == run), name, "id")
    return resume_from_history(D.comments(spark, sf).select("doc_id", "id"), name, "id")


def q_dictionary_rejects(spark, sf):
    """S7 over a folder of files: good lines and rejected ones, each with its file and line number."""
    from .session import shared_dir
    from .sources.quarantine import REJECTED, read_abbreviation_lines, write_quarantine
    base = shared_dir(spark, "dictionary")
    k, key, value = F.col("doc_id") % 7, F.col("doc_id").cast("string"), F.col("source")
    line = F.when(k == 0, key).when(k == 1, F.concat_ws(":", key, value, value)).when(k == 2, F.lit("")) \
        .otherwise(F.concat(F.lit("  "), key, F.lit(":"), value, F.lit(" ")))
    part = (F.col("doc_id") % 3).cast("int")
    D.table(spark, sf, "documents").select("doc_id", part.alias("part"), line.alias("value")).repartitionByRange(3, "part") \
        .sortWithinPartitions("part", "doc_id").select("part", "value").write.partitionBy("part").text(f"{base}/lines")
    good, rejected = read_abbreviation_lines(spark, f"{base}/lines")
    write_quarantine(rejected, f"{base}/rejected")
    rejected = spark.read.schema(REJECTED).parquet(f"{base}/rejected")
    of = F.regexp_extract("source_file", r"part=(\d+)", 1).cast("int").alias("part")
    none = F.lit(None).cast("string")
    return good.select(of, "line_no", "abbr", "full", none.alias("line"), none.alias("reason")).unionByName(
        rejected.select(of, "line_no", none.alias("abbr"), none.alias("full"), "line", "reason"))


def q_comment_rejects(spark, sf):
    """S1 + P1 over CSV files: rows that fit, and the records that do not, with the reason."""
    from .session import shared_dir
    from .sources.quarantine import read_comments_checked
    base = shared_dir(spark, "csv")
    k = F.col("doc_id") % 10
    label = F.when(k == 1, "7").when(k == 2, "x").otherwise((F.col("doc_id") % 3).cast("string"))
    task = F.when(k == 3, "0").otherwise((F.col("doc_id") % 9 + 1).cast("string"))
    cells = F.concat_ws(",", F.col("doc_id").cast("string"), F.concat(F.lit('"'), F.col("source"), F.lit(', said ""so""\"')), label, task)
    line = F.when(k == 4, F.concat(cells, F.lit(",more"))).when(k == 5, F.col("doc_id").cast("string")).otherwise(cells)
    D.table(spark, sf, "documents").select(line.alias("value")).write.text(f"{base}/in")
    good, rejected = read_comments_checked(spark, f"{base}/in", "id long, comment string, label int, task int", label="label",
                                           task="task", header=False)
    ident = F.coalesce(F.regexp_extract("line", r"^(\d+)", 1).try_cast("long"), F.get_json_object("line", "$.id").try_cast("long"))
    return good.select("id", "comment", "label", "task", F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select(ident.alias("id"), F.lit(None).cast("string").alias("comment"), F.lit(None).cast("int").alias("label"),
                        F.lit(None).cast("int").alias("task"), "reason"))


def q_json_dictionary(spark, sf):
    """S6 round trip: one JSON object for each 500 lines, read back, the last file's expansion counting."""
    from .session import shared_dir
    from .sources.abbreviations import last_wins, read_abbreviations_json
    base = shared_dir(spark, "json")
    d = _derived_abbreviations(spark, sf).where((F.col("abbr") != "") & (F.col("full") != "")).withColumn(
        "part", F.lpad((F.col("line_no") / 500).cast("long").cast("string"), 12, "0"))
    one = d.groupBy("part", "abbr").agg(F.max_by("full", "line_no").alias("full"))
    one.groupBy("part").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("abbr", "full"))))).alias("value")) \
        .write.partitionBy("part").text(base)
    return last_wins(read_abbreviations_json(spark, base))


def q_report_files(spark, sf):
    """K2 + K3 round trip: the summary as JSON lines and the class report as CSV, both read back."""
    from .session import shared_dir
    from .sources.sinks import write_metrics, write_report
    base = shared_dir(spark, "reports")
    cm = M.confusion_long(_predictions(spark, sf), [M.SENTIMENT_HEAD, M.TASK_HEAD])
    write_metrics(M.weighted_metrics(cm), f"{base}/summary")
    write_report(M.classification_report(cm), f"{base}/report")
    summary = spark.read.schema("head string, accuracy double, f1 double, support long").json(f"{base}/summary")
    report = spark.read.option("header", True).schema("head string, row string, precision double, recall double, f1 double, support long").csv(f"{base}/report")
    return report.select("head", "row", _r6(F.col("f1")).alias("f1"), "support").unionByName(
        summary.select("head", F.lit("summary").alias("row"), _r6(F.col("f1")).alias("f1"), "support"))


def q_progress_append(spark, sf):
    """S11 + K1 + U2 + J1: two runs of a job that reads what it has done, does the rest and appends."""
    from .operators.resume import append_results
    from .session import shared_dir
    from .sources.comments import read_progress
    from .sources.sinks import write_labelled
    path = f"{shared_dir(spark, 'progress')}/out"
    rows = D.labelled_comments(spark, sf).select("id", F.lit("c").alias("comment"), F.col("label").cast("string"), F.col("task").cast("string"))
    for run in range(2):
        todo = resume_by_id(rows, read_progress(spark, path), "id")
        if run == 0:
            write_labelled(todo.where(F.col("id").cast("long") % 3 == 0), path)
        else:
            append_results(todo, path)
    return read_progress(spark, path).select("id", "label", "task")


QUERIES = {
    "labelled_counts": q_labelled_counts,
    "clean_comments": q_clean_comments,
    "preprocess_multitask": q_preprocess_multitask,
    "preprocess_sentiment": q_preprocess_sentiment,
    "demojize_text": q_demojize_text,
    "demojize_sequences": q_demojize_sequences,
    "split_sentences": q_split_sentences,
    "abbreviation_last_wins": q_abbreviation_last_wins,
    "prompt_batches": q_prompt_batches,
    "prompt_sentences": q_prompt_sentences,
    "parse_batch_responses": q_parse_batch_responses,
    "parse_single_responses": q_parse_single_responses,
    "align_responses": q_align_responses,
    "resume_by_id": q_resume_by_id,
    "resume_by_sentence": q_resume_by_sentence,
    "skip_rows": q_skip_rows,
    "validate_labels": q_validate_labels,
    "recode_and_union": q_recode_and_union,
    "decode_labels": q_decode_labels,
    "shuffle_order": q_shuffle_order,
    "dataset_counts": q_dataset_counts,
    "stratified_split_multitask": q_stratified_split_multitask,
    "stratified_split_sentiment": q_stratified_split_sentiment,
    "fit_vocab": q_fit_vocab,
    "encode_fixed": q_encode_fixed,
    "subword_vocab": q_subword_vocab,
    "encode_subwords": q_encode_subwords,
    "phrase_scores": q_phrase_scores,
    "apply_phrases": q_apply_phrases,
    "long_phrases": q_long_phrases,
    "segment_sentiment": q_segment_sentiment,
    "confusion_matrix": q_confusion_matrix,
    "classification_report": q_classification_report,
    "weighted_metrics": q_weighted_metrics,
    "mean_loss": q_mean_loss,
    "joint_loss": q_joint_loss,
    "predict_codes": q_predict_codes,
    "predict_named": q_predict_named,
    "predict_emotion": q_predict_emotion,
    "score_with_batch_udf": q_score_with_batch_udf,
    "train_sentiment": q_train_sentiment,
    "train_multitask": q_train_multitask,
    "train_joint": q_train_joint,
    "label_stream": q_label_stream,
    "score_stream": q_score_stream,
    "score_text_stream": q_score_text_stream,
    "count_classifier": q_count_classifier,
    "count_classifier_report": q_count_classifier_report,
    "append_committed": q_append_committed,
    "resume_bucketed": q_resume_bucketed,
    "dictionary_rejects": q_dictionary_rejects,
    "comment_rejects": q_comment_rejects,
    "json_dictionary": q_json_dictionary,
    "report_files": q_report_files,
    "progress_append": q_progress_append,
    "label_stream_timeout": q_label_stream_timeout,
}
