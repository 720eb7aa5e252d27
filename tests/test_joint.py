"""Joint training: gradients, exact resumption, decisions, held-out quality."""

import dataclasses

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paths import SF01, SF001
from verbena.plans import joint as J
from verbena.sources.derived import labelled_comments

SMALL = J.Settings(features=128, hidden=4, slots=2, max_steps=12, eval_every=2, patience=3, rate=0.05)
WORDS = pa.array([[1, 2, 2, 7], [], [3], [7, 7, 7, 1], None, [100, 5]], pa.list_(pa.int32()))
TARGETS = {"sentiment": np.array([0, 1, 2, -1, 0, 1]), "task": np.array([8, -1, 3, 3, 0, 4])}


@pytest.fixture(scope="module")
def prepared(spark):
    rows = labelled_comments(spark, SF001).select("id", "comment", "label", "task")
    rows = rows.unionByName(labelled_comments(spark, SF01).select("id", "comment", "label", "task"))
    y = {"sentiment": F.col("label"), "task": F.col("task") - 1}
    part = F.crc32(F.col("id").cast("binary")) % 3
    return [J.prepare(rows.where(c), "comment", y, "id", SMALL) for c in (part > 0, part == 0)]


def test_gradient_by_finite_differences():
    rng = np.random.default_rng(0)
    flat = J.start(SMALL) + rng.normal(0, 0.1, len(J.start(SMALL)))
    weights = rng.uniform(0.5, 2, SMALL.features)
    bags = J.Bags(WORDS, weights)
    loss, grad = J.loss_and_gradient(flat, bags, TARGETS, SMALL)
    touched = np.flatnonzero(np.abs(grad) > 0)
    assert len(touched) > 50
    for i in rng.choice(touched, 60, replace=False).tolist() + [0, len(flat) - 1]:
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        slope = (J.loss_and_gradient(up, bags, TARGETS, SMALL)[0] - J.loss_and_gradient(down, bags, TARGETS, SMALL)[0]) / 2e-6
        assert abs(slope - grad[i]) < 1e-5 * max(1, abs(slope))


def test_both_heads_pull_on_the_shared_layer():
    weights = np.ones(SMALL.features)
    one = {"sentiment": TARGETS["sentiment"], "task": np.full(6, -1)}
    other = {"sentiment": np.full(6, -1), "task": TARGETS["task"]}
    flat, bags = J.start(SMALL), J.Bags(WORDS, weights)
    parts = [J.views(J.loss_and_gradient(flat, bags, t, SMALL)[1], SMALL)["w"] for t in (one, other, TARGETS)]
    assert np.abs(parts[0]).sum() > 0 < np.abs(parts[1]).sum()
    assert np.allclose(parts[0] + parts[1], parts[2])


def test_distributed_gradient_is_the_local_one(spark, prepared):
    rows = prepared[0].cache()
    weights = J.idf(rows, SMALL.features)
    flat = J.start(SMALL)
    local = rows.toArrow().combine_chunks().to_batches()[0]
    loss, grad = J.loss_and_gradient(flat, J.Bags(local.column("words"), weights), J._targets(local, SMALL), SMALL)
    for n in (1, 7):
        g, got_loss, count = J.gradient(rows.repartition(n), flat, weights, SMALL)
        assert count == local.num_rows
        assert np.allclose(g, grad, atol=1e-6) and abs(got_loss - loss) < 1e-6


def test_resumed_run_gives_the_uninterrupted_model(spark, prepared, tmp_path):
    train, val = prepared
    whole = J.fit_joint(train, val, SMALL, str(tmp_path / "whole"))
    J.fit_joint(train, val, SMALL, str(tmp_path / "parts"), stop_at=4)
    assert J.history_of(spark, str(tmp_path / "parts")).count() == 2
    again = J.fit_joint(train, val, SMALL, str(tmp_path / "parts"))
    assert again.step == whole.step and (again.flat == whole.flat).all()
    told = [J.history_of(spark, str(tmp_path / p)).drop("settings").collect() for p in ("whole", "parts")]
    assert told[0] == told[1]
    # finished: a further call reads the same best state and adds nothing
    assert (J.fit_joint(train, val, SMALL, str(tmp_path / "parts")).flat == whole.flat).all()
    with pytest.raises(ValueError, match="other settings"):
        J.fit_joint(train, val, dataclasses.replace(SMALL, rate=0.1), str(tmp_path / "parts"))
    # the decisions, once more by SQL over the scores alone
    J.history_of(spark, str(tmp_path / "whole")).createOrReplaceTempView("history")
    bad = spark.sql("""
      WITH a AS (SELECT *, score > coalesce(max(score) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS imp FROM history),
           b AS (SELECT *, max(IF(imp, step, NULL)) OVER (ORDER BY step) AS last FROM a)
      SELECT * FROM b WHERE improved <> imp OR waited <> (step - last) / 2 OR stop <> (waited >= 3)
             OR abs(score - (scores['sentiment'] + scores['task']) / 2) > 1e-12""").count()
    assert bad == 0
    best = spark.sql("SELECT min_by(step, struct(-score, step)) AS s FROM history").first().s
    assert whole.step == best


def test_decisions():
    history = []
    for found, want in [(0.0, (True, 0, False)), (0.5, (True, 0, False)), (0.5, (False, 1, False)), (0.4, (False, 2, False)),
                        (0.6, (True, 0, False)), (0.1, (False, 1, False)), (0.6, (False, 2, False)), (0.6, (False, 3, True))]:
        got = J.decide(history, found, 3)
        assert got == want
        history.append({"score": found, "waited": got[1]})


def test_weighted_f1_is_the_metrics_table(spark):
    from verbena.operators import metrics as M
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 4 + [(2, 0)] * 3 + [(2, 2)]
    df = spark.createDataFrame(pairs, "label int, pred_label int")
    want = M.weighted_metrics(M.confusion_long(df, [M.SENTIMENT_HEAD])).first().f1
    counts = {p: pairs.count(p) for p in set(pairs)}
    assert abs(J.weighted_f1(counts) - want) < 1e-12 and J.weighted_f1({}) == 0.0


def test_score_keeps_columns_and_odd_texts(spark):
    model = J.JointModel(SMALL, J.start(SMALL), np.ones(SMALL.features))
    df = spark.createDataFrame([("a b c", 1), (None, 2), ("", 3), ("word " * 20000, 4)], "text string, words int").withColumn("pred_task", F.lit("clash"))
    out = J.score(df, "text", model)
    assert out.columns == ["text", "words", "pred_sentiment", "prob_sentiment", "pred_task", "prob_task"]
    got = out.collect()
    assert [r.words for r in got] == [1, 2, 3, 4] and all(abs(sum(r.prob_task) - 1) < 1e-9 for r in got)
    assert got[1].prob_sentiment == got[2].prob_sentiment
    assert J.score(df.limit(0), "text", model).collect() == []


def test_shared_layer_against_independent_heads(spark):
    """Held-out weighted F1, mean of both heads: not below independent heads by more than 0.05."""
    from verbena.plans.training import DEFAULT_GRID, joint_score, run_multitask
    lab = labelled_comments(spark, SF01).select("id", "comment", "label", "task")
    joint = J.train_joint(lab, J.Settings(max_steps=24))
    apart = run_multitask(lab, grid=DEFAULT_GRID[:1])
    assert joint_score(joint["summary"]) >= joint_score(apart["summary"]) - 0.05


def test_batches_are_cut_by_words():
    import pyarrow as pa
    from verbena.plans import joint as J
    words = [[1] * (J.PART_WORDS // 2)] * 3 + [[2] * (2 * J.PART_WORDS), [], [3]]
    batch = pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.int32())), pa.array(range(6))], names=["words", "i"])
    cut = list(J.parts(batch, "words"))
    assert [c.num_rows for c in cut] == [2, 1, 1, 2]
    assert [i for c in cut for i in c["i"].to_pylist()] == list(range(6))
