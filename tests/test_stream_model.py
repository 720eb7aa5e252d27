from pyspark.sql import functions as F

from paths import SF001, SF01


def test_label_stream_equals_batch(spark):
    from verbena.queries import q_align_responses
    from verbena.streaming.labelling import label_stream_from_tables
    cols = ["doc_id", "id", "comment", "label", "task"]
    s = {tuple(r) for r in label_stream_from_tables(spark, SF001).select(*cols).collect()}
    b = {tuple(r) for r in q_align_responses(spark, SF001).select(*cols).collect()}
    assert s == b and len(s) == 200


def test_multitask_beats_majority(spark):
    from verbena.plans.training import DEFAULT_GRID, run_multitask
    from verbena.sources.derived import labelled_comments
    lab = labelled_comments(spark, SF01).select("id", "comment", "label", "task")
    res = run_multitask(lab, grid=DEFAULT_GRID[:1])
    summary = {r.head: r for r in res["summary"].collect()}
    jl = res["joint_loss"].first()["joint_loss"]
    assert abs(jl - (0.45 * summary["sentiment"].loss + 0.55 * summary["task"].loss)) < 1e-9
    # majority class baseline on the same test rows, by weighted F1
    cm = res["confusion"]
    for head in ("sentiment", "task"):
        sup = {r.actual: r.s for r in cm.filter(F.col("head") == head).groupBy("actual")
               .agg(F.sum("n").alias("s")).collect()}
        n = sum(sup.values())
        top = max(sup.values())
        base = top / n * (2 * (top / n) / (1 + top / n))
        assert summary[head].support == n
        assert summary[head].f1 >= base - 1e-9


def test_label_stream_restart_adds_nothing(spark, tmp_path):
    from verbena.queries import _batched
    from verbena.sources.derived import synthetic_responses
    from verbena.streaming.labelling import label_stream, pending_rows
    base = str(tmp_path)
    rows, _ = _batched(spark, SF001)
    rows.write.parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    answers = synthetic_responses(rows)
    answers.filter("batch_id < 20").write.parquet(f"{base}/answers")
    cols = ["doc_id", "id", "comment", "label", "task"]
    q = label_stream(spark, f"{base}/answers", rows, f"{base}/out", f"{base}/ck",
                     {"availableNow": True}, output_columns=cols)
    q.awaitTermination()
    first = spark.read.parquet(f"{base}/out").count()
    assert first == 100
    # same checkpoint, nothing new: nothing is added
    q = label_stream(spark, f"{base}/answers", rows, f"{base}/out", f"{base}/ck",
                     {"availableNow": True}, output_columns=cols)
    q.awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == first
    # more answers arrive: only their rows are added
    answers.filter("batch_id >= 20").write.mode("append").parquet(f"{base}/answers")
    q = label_stream(spark, f"{base}/answers", rows, f"{base}/out", f"{base}/ck",
                     {"availableNow": True}, output_columns=cols)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == 200 and out.select("id").distinct().count() == 200
    # a fresh stream over the same output: every row is already labelled
    assert pending_rows(rows, f"{base}/out").count() == 0


def test_score_stream_equals_batch(spark):
    from verbena.queries import q_predict_codes, q_score_stream
    a = {tuple(r) for r in q_score_stream(spark, SF001).collect()}
    b = {tuple(r) for r in q_predict_codes(spark, SF001).collect()}
    assert a == b and len(a) > 0


def test_losses_in_one_pass(spark):
    import math
    from verbena.operators import metrics as M
    df = spark.createDataFrame([(0, 0, [0.5, 0.25, 0.25]), (1, 0, [0.5, 0.25, 0.25])],
                               "a int, p int, pr array<double>")
    ev = M.evaluate(df, [M.Head("h", "a", "p", [0, 1, 2], prob="pr")])
    loss = ev["summary"].first()["loss"]
    assert math.isclose(loss, (-math.log(0.5) - math.log(0.25)) / 2)


def test_parallel_selection_same_choice(spark):
    from verbena.plans import training as T
    from verbena.functions.text import preprocess_multitask
    from verbena.sources.derived import labelled_comments
    lab = labelled_comments(spark, SF001).withColumn("processed_text", preprocess_multitask(F.col("comment")))
    lab = T._with_targets(lab, [T.SENTIMENT], {"sentiment": "label"})
    feats = T.fit_features(lab)
    grid = [{"regParam": r, "maxIter": 5} for r in (1.0, 0.1, 0.01)]
    args = (feats, lab, lab, [T.SENTIMENT], {"sentiment": "label"}, {"sentiment": [0, 1, 2]}, grid, 1)
    one = T.select_best(*args, parallelism=1)
    many = T.select_best(*args, parallelism=3)
    assert one.params == many.params
    assert [h[0] for h in many.history] == [h[0] for h in one.history]


def test_selection_keeps_no_texts(spark, monkeypatch):
    """What is kept for all candidates: features and labels, not the texts and tokens that they come from."""
    from verbena.plans import training as T
    seen, fit = [], T.fit_heads

    def noted(feats, heads, params):
        seen.append(set(feats.columns))
        return fit(feats, heads, params)

    monkeypatch.setattr(T, "fit_heads", noted)
    rows = spark.createDataFrame([(i, f"w{i % 3} w{i % 2}", i % 3) for i in range(30)], "id long, processed_text string, label int")
    rows = T._with_targets(rows, [T.SENTIMENT], {"sentiment": "label"})
    sel = T.select_best(T.fit_features(rows), rows, rows, [T.SENTIMENT], {"sentiment": "label"}, {"sentiment": [0, 1, 2]},
                        [{"regParam": 0.1, "maxIter": 3}])
    assert seen == [{"features", T.SENTIMENT.label}] and sel.score > 0
