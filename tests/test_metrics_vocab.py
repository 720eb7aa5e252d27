import math
from collections import Counter

from pyspark.sql import functions as F

from paths import SF01
from verbena.operators import metrics as M
from verbena.operators.vocab import encode_fixed, fit_vocab
from verbena.functions.scoring import argmax, softmax


def brute_report(pairs, domain):
    cm = Counter(pairs)
    out = {}
    labels = sorted({a for a, _ in pairs} | {p for _, p in pairs})
    n = len(pairs)
    wf = 0.0
    for c in labels:
        tp = cm[(c, c)]
        sup = sum(v for (a, _), v in cm.items() if a == c)
        prd = sum(v for (_, p), v in cm.items() if p == c)
        p = tp / prd if prd else 0.0
        r = tp / sup if sup else 0.0
        f = 2 * p * r / (p + r) if p + r else 0.0
        out[c] = (p, r, f, sup)
        wf += f * sup
    return out, wf / n, sum(cm[(c, c)] for c in labels) / n


def test_metrics_match_brute_force(spark):
    from verbena.sources.derived import labelled_comments, with_predictions
    p = with_predictions(labelled_comments(spark, SF01))
    rows = p.select("label", "pred_label").collect()
    per, wf1, acc = brute_report([(r[0], r[1]) for r in rows], [0, 1, 2])
    cm = M.confusion_long(p, [M.SENTIMENT_HEAD])
    assert cm.count() == 9 and cm.agg(F.sum("n")).first()[0] == len(rows)
    s = M.weighted_metrics(cm).first()
    assert math.isclose(s.f1, wf1) and math.isclose(s.accuracy, acc)
    rep = {r.row: r for r in M.classification_report(cm).collect()}
    for c, (pp, rr, ff, sup) in per.items():
        assert math.isclose(rep[str(c)].precision, pp) and rep[str(c)].support == sup
        assert math.isclose(rep[str(c)].f1, ff)


def test_softmax_argmax_tie(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],)], "p array<double>")
    assert df.select(argmax(F.col("p"))).first()[0] == 1
    got = df.select(softmax(F.col("p"))).first()[0]
    assert math.isclose(sum(got), 1.0)


def test_encode_length_and_mask(spark):
    docs = spark.createDataFrame([(1, "a b c a"), (2, ""), (3, " ".join(["z"] * 300))],
                                 "doc_id long, processed_text string")
    vocab = fit_vocab(docs, "processed_text", 2)
    assert {r.token: r.token_id for r in vocab.collect()} == {"z": 4, "a": 5}
    out = {r.doc_id: r for r in encode_fixed(docs, "processed_text", vocab, 128).collect()}
    for r in out.values():
        assert len(r.input_ids) == 128 and len(r.attention_mask) == 128
        assert sum(r.attention_mask) == sum(1 for i in r.input_ids if i != 1)
    assert out[1].input_ids[:6] == [0, 5, 3, 3, 5, 2]
    assert out[2].input_ids[:3] == [0, 2, 1]
    assert out[3].input_ids[-1] == 2 and sum(out[3].attention_mask) == 128


def test_encode_with_and_without_key(spark):
    docs = spark.createDataFrame([(1, "a b c a"), (2, ""), (3, "c c d"), (4, None)], "doc_id long, processed_text string")
    vocab = fit_vocab(docs, "processed_text")
    numbered = {r.doc_id: r.input_ids for r in encode_fixed(docs, "processed_text", vocab, 8).collect()}
    keyed = {r.doc_id: r.input_ids for r in encode_fixed(docs, "processed_text", vocab, 8, key="doc_id").collect()}
    assert numbered == keyed and keyed[4] == keyed[2] == [0, 2, 1, 1, 1, 1, 1, 1]


def test_loss_keeps_the_worst_rows(spark):
    import math
    from verbena.functions.scoring import LOSS_FLOOR, logit_log_loss
    from verbena.operators.metrics import mean_loss, unscorable
    df = spark.createDataFrame([([1 / 3] * 3, 0), ([1.0, 0.0, 0.0], 1), ([1.0, 0.0, 0.0], 9), (None, 0), ([1.0], None)],
                               "p array<double>, y int")
    got = df.agg(mean_loss(df, "p", "y").alias("m"), unscorable("p", "y").alias("u")).first()
    assert math.isclose(got.m, (math.log(3) - math.log(LOSS_FLOOR)) / 2) and got.u == 3
    far = spark.createDataFrame([([0.0, 800.0], 0)], "x array<double>, y int")
    assert far.select(logit_log_loss(F.col("x"), F.col("y"))).first()[0] == 800.0


def test_hash_split_keeps_null_strata_apart(spark):
    from verbena.operators.split import stratified_split
    df = spark.createDataFrame([(str(i), i % 3 or None) for i in range(60)], "id string, label int")
    got = stratified_split(df, ["label"], mode="hash").collect()
    assert all((r.split is None) == (r.label is None) for r in got)


def test_one_label_per_row(spark):
    from verbena.operators.responses import align_responses
    rows = spark.createDataFrame([(0, 0, "a"), (0, 1, "b")], "batch_id long, pos int, comment string")
    answers = spark.createDataFrame([(0, "x(2-1)|y(0-2)"), (0, "z(1-1)|z(1-1)"), (0, None)], "batch_id long, response string")
    got = align_responses(rows, answers).orderBy("pos").collect()
    assert [(r.comment, r.label, r.task) for r in got] == [("x", "2", "1"), ("y", "0", "2")]


def test_dictionary_without_blank_cells(spark):
    from verbena.sources.abbreviations import dictionary, expand_with_table
    table = spark.createDataFrame([(0, "a", None), (1, None, "x"), (2, "b", "bee")], "line_no long, abbr string, full string")
    assert dictionary(table) == {"b": "bee"}
    df = spark.createDataFrame([(1, "a  b"), (2, None)], "k long, t string")
    assert {r.k: r.t for r in expand_with_table(df, "t", "k", table).collect()} == {1: "a bee", 2: None}
    assert {r.k: r.t for r in expand_with_table(df, "t", "k", table.limit(0)).collect()} == {1: "a  b", 2: None}


def test_prediction_shapes(spark):
    from verbena.operators.predict import predict_codes, predict_emotion, predict_named
    from verbena.operators.metrics import confusion_matrix, confusion_wide
    df = spark.createDataFrame([("a", [0.0, 2.0, 1.0], [0.0] * 8 + [5.0])],
                               "t string, s array<double>, k array<double>")
    c = predict_codes(df, "t", "s", "k").first()
    assert (c.id_text, c.sentiment, c.task) == ("a", 1, 9)
    n = predict_named(df, "t", "s", "k").first()
    assert (n.sentiment, n.task) == ("Trung tính", "Khác")
    e = predict_emotion(df, "t", "s").first()
    assert e.emotion == "Trung tính" and 0.5 < e.confidence < 1
    pairs = spark.createDataFrame([(0, 0), (0, 1), (2, 2), (2, 2)], "a int, p int")
    wide = {r.actual: (r.p0, r.p1, r.p2)
            for r in confusion_wide(confusion_matrix(pairs, "a", "p", [0, 1, 2]), [0, 1, 2]).collect()}
    assert wide == {0: (1, 1, 0), 1: (0, 0, 0), 2: (0, 0, 2)}
