import json
import os

import pytest
from pyspark.sql import functions as F

from paths import SF001


def test_sinks_round_trip(spark, tmp_path):
    from verbena.operators import metrics as M
    from verbena.sources.derived import labelled_comments, with_predictions
    from verbena.sources.sinks import write_labelled, write_metrics, write_report
    p = with_predictions(labelled_comments(spark, SF001))
    ev = M.evaluate(p)
    write_metrics(ev["summary"], str(tmp_path / "m"))
    files = [f for f in os.listdir(tmp_path / "m") if f.endswith(".json")]
    rows = [json.loads(line) for f in files for line in open(tmp_path / "m" / f)]
    assert {r["head"] for r in rows} == {"sentiment", "task"}
    write_report(ev["report"], str(tmp_path / "r"))
    back = spark.read.option("header", True).csv(str(tmp_path / "r"))
    assert back.count() == ev["report"].count()
    lab = p.select("id", "comment", F.col("label").cast("string"), F.col("task").cast("string"))
    write_labelled(lab, str(tmp_path / "out"), fmt="csv")
    write_labelled(lab.limit(3), str(tmp_path / "out"), fmt="csv")  # append, never rewrite
    from verbena.sources.comments import read_comments
    assert read_comments(spark, str(tmp_path / "out")).count() == lab.count() + 3


def test_plan_batches_resumes(spark):
    from verbena.plans.labelling import plan_batches, prepare_comments
    from verbena.sources.derived import comments
    c = prepare_comments(comments(spark, SF001).select("doc_id", "id", "comment",
                                                       F.lit("1").alias("label")), keep=("doc_id",))
    done = spark.createDataFrame([(i,) for i in range(0, 200, 2)], "id long")
    rows, prompts = plan_batches(c, ["doc_id"], done, template="T:")
    assert rows.count() == 100
    assert rows.filter(F.col("doc_id") % 2 == 0).count() == 0
    assert prompts.count() == 20
    assert prompts.first()["prompt"].startswith('T:"')


def test_validate_fail_and_quarantine(spark):
    from verbena.operators.validate import InvalidLabels, quarantined, validate_domain
    df = spark.createDataFrame([(0, 1), (2, 9), (3, 1), (1, 10)], "label int, task int")
    with pytest.raises(InvalidLabels):
        validate_domain(df)
    assert validate_domain(df, mode="quarantine").count() == 2
    assert quarantined(df).count() == 2


def test_skip_rows_past_end(spark):
    from verbena.sources.comments import skip_rows
    df = spark.range(5)
    assert skip_rows(df, 3, ["id"]).count() == 2
    with pytest.raises(ValueError):
        skip_rows(df, 5, ["id"])


def test_model_save_load_and_score_stream(spark, tmp_path):
    from verbena.operators.predict import predict_named
    from verbena.plans.training import SENTIMENT, TOPIC, fit_features, load_model, predictions, \
        save_model, train_heads, _with_targets
    from verbena.streaming.labelling import score_stream
    from verbena.functions.text import preprocess_multitask
    from verbena.sources.derived import labelled_comments
    lab = labelled_comments(spark, SF001).withColumn(
        "processed_text", preprocess_multitask(F.col("comment")))
    lab = _with_targets(lab, [SENTIMENT, TOPIC], {"sentiment": "label", "task": "task"})
    model = train_heads(fit_features(lab), lab, [SENTIMENT, TOPIC], {"regParam": 0.1, "maxIter": 10})
    save_model(model, str(tmp_path / "model"))
    again = load_model(str(tmp_path / "model"))
    a = {r.id: r.pred_task for r in predictions(model, lab, [SENTIMENT, TOPIC]).collect()}
    b = {r.id: r.pred_task for r in predictions(again, lab, [SENTIMENT, TOPIC]).collect()}
    assert a == b

    src = tmp_path / "in"
    lab.select("id", "comment").write.parquet(str(src))
    stream = spark.readStream.schema("id string, comment string").parquet(str(src))

    def score(df):
        scored = predictions(again, df.withColumn("processed_text",
                                                  preprocess_multitask(F.col("comment"))),
                             [SENTIMENT, TOPIC])
        return predict_named(scored, "comment", "prob_sentiment", "prob_task", logits=False)

    q = score_stream(stream, score, str(tmp_path / "scored"), str(tmp_path / "ck"),
                     {"availableNow": True})
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "scored"))
    assert out.count() == lab.count()
    assert set(out.columns) == {"text", "sentiment", "sentiment_confidence", "task", "task_confidence"}


def test_run_batch_labelling_appends_and_resumes(spark, tmp_path):
    from verbena.plans.labelling import prepare_comments, run_batch_labelling
    from verbena.sources.comments import read_progress
    from verbena.sources.derived import comments, synthetic_responses
    from verbena.operators.index import batch_rows
    c = prepare_comments(comments(spark, SF001).select("doc_id", "id", "comment",
                                                       F.lit("1").alias("label")), keep=("doc_id",))
    rows, _ = batch_rows(c, ["doc_id"], 5, ("id", "comment"))
    answers = synthetic_responses(rows)
    out = str(tmp_path / "labelled")
    first = c.filter(F.col("doc_id") < 50)
    run_batch_labelling(first, answers, out, ["doc_id"], read_progress(spark, out))
    assert read_progress(spark, out).count() == 50
    # the second run skips the 50 rows labelled before and appends the rest
    run_batch_labelling(c, answers, out, ["doc_id"], read_progress(spark, out))
    done = read_progress(spark, out)
    assert done.count() == 200 and done.select("id").distinct().count() == 200


def test_read_order_and_skip_rows_on_csv(spark, tmp_path):
    from verbena.sources.comments import read_comments, skip_rows, with_read_order
    path = tmp_path / "c.csv"
    lines = ["id,comment,label"] + [f'{i},"dòng {i}\nhai",1' for i in range(30)]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    df = with_read_order(read_comments(spark, str(path)))
    rest = skip_rows(df, 25, ["read_order"])
    assert sorted(int(r.id) for r in rest.collect()) == [25, 26, 27, 28, 29]
    assert rest.first()["comment"].startswith("dòng")
