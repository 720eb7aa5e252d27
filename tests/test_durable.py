"""Committed appends, bucketed history, rejected rows, and models on a text stream."""

import os

import pytest
from pyspark.sql import functions as F

from paths import SF01
from verbena.operators import history as H
from verbena.sources import commits as C
from verbena.sources import quarantine as Q

SCHEMA = "id long, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def some(spark, lo, hi):
    return spark.range(lo, hi).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))


def test_append_survives_a_failure_between_files_and_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert C.read_committed(spark, path, SCHEMA).collect() == []
    assert C.append_once(some(spark, 0, 10), path, "a")
    with monkeypatch.context() as m:
        m.setattr(C, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            C.append_once(some(spark, 10, 20), path, "b")
    assert len(os.listdir(tmp_path / "t/data")) == 2  # the files are there, no reader sees them
    assert rows(C.read_committed(spark, path, SCHEMA)) == rows(some(spark, 0, 10))
    assert C.append_once(some(spark, 10, 20), path, "b")
    assert not C.append_once(some(spark, 10, 20), path, "b")
    assert rows(C.read_committed(spark, path, SCHEMA)) == rows(some(spark, 0, 20))


def test_of_two_attempts_one_commits(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = (C.stage(some(spark, 0, 5), path, "x") for _ in range(2))
    assert C.commit(spark, path, "x", second) and not C.commit(spark, path, "x", first)
    assert C.committed(spark, path) == {"x": second}
    assert rows(C.read_committed(spark, path, SCHEMA)) == rows(some(spark, 0, 5))
    assert not [f for f in os.listdir(tmp_path / "t/_commits") if f.startswith(".x.") and not f.endswith(".crc")]
    with pytest.raises(ValueError):
        C.append_once(some(spark, 0, 5), path, "../x")


def test_empty_batch_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert C.append_once(some(spark, 0, 0), path, "none") and C.read_committed(spark, path, SCHEMA).collect() == []


def test_history_is_not_shuffled(spark, tmp_path):
    name = "history_test"
    H.open_history(spark, name, str(tmp_path / "h"), 8)
    H.add_to_history(spark.range(0, 3000), name, "id")
    H.add_to_history(spark.createDataFrame([(None,), ("3001",), ("3001",)], "id string"), name, "id")
    todo = spark.createDataFrame([(i, "x") for i in (5, 2999, 3000, 3001)] + [(None, "x")], "id long, history_key string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = H.resume_from_history(todo, name, "id")
        assert rows(out) == rows(todo.where("id is null or id = 3000"))
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan  # only the new rows are dealt
    spark.sql(f"DROP TABLE {name}")
    H.open_history(spark, name, str(tmp_path / "h"), 8)  # a later session: the same files
    assert spark.table(name).count() == 3001
    spark.sql(f"DROP TABLE {name}")


def test_line_numbers_over_splits(spark, tmp_path):
    for f, n in (("one.txt", 2000), ("two.txt", 3), ("three.txt", 0)):
        (tmp_path / f).write_text("".join(f"line {i + 1}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        got = Q.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 2003 and all(r.value == f"line {r.line_no}" for r in got)
    assert len({r.source_file for r in got}) == 2


def test_rejected_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("ko:không\nbad\n\n a : b \nx:y:z\n:\n")
    (tmp_path / "in/b.txt").write_text("k:kông")
    good, bad = Q.read_abbreviation_lines(spark, str(tmp_path / "in"))
    assert sorted((os.path.basename(r.source_file), r.line_no, r.abbr, r.full) for r in good.collect()) == [
        ("a.txt", 1, "ko", "không"), ("a.txt", 4, "a ", " b"), ("a.txt", 6, "", ""), ("b.txt", 1, "k", "kông")]
    counts = Q.write_quarantine(bad, str(tmp_path / "q"))
    assert sorted((r.reason, r.n) for r in counts.collect()) == [("no colon", 2), ("several colons", 1)]
    assert sorted((r.line_no, r.line, r.reason) for r in bad.collect()) == [(2, "bad", "no colon"), (3, "", "no colon"), (5, "x:y:z", "several colons")]
    (tmp_path / "none").mkdir()
    (tmp_path / "none/e.txt").write_text("")
    good, bad = Q.read_abbreviation_lines(spark, str(tmp_path / "none"))
    assert good.collect() == [] == bad.collect()


def test_rejected_records(spark, tmp_path):
    (tmp_path / "c.csv").write_text('id,comment,label,task\n1,"a, ""b""",2,9\n2,short\n3,x,9,1\n4,x,1,1,extra\n5,x,,1\nsix,x,1,1\n7,x,0,12\n8,,0,1\n')
    good, bad = Q.read_comments_checked(spark, str(tmp_path / "c.csv"), "id int, comment string, label int, task int", label="label", task="task")
    assert rows(good) == [(1, 'a, "b"', 2, 9), (8, None, 0, 1)]
    assert sorted((r.reason, r.line[:8]) for r in bad.collect()) == [
        ("label", '{"id":3,'), ("label", '{"id":5,'), ("malformed", "2,short"), ("malformed", "4,x,1,1,"), ("malformed", "six,x,1,"), ("task", '{"id":7,')]


def test_stream_takes_up_new_versions_and_replays_with_the_old(spark, tmp_path):
    from verbena.plans.counting import classify, fit_counts
    from verbena.queries import _counting_rows
    from verbena.streaming.scoring import newest, publish, score_texts
    data = _counting_rows(spark, SF01).cache()
    models = [fit_counts(data.where("split = 'train'")), fit_counts(data.where("split = 'val'"))]
    texts = data.select("id", "processed_text")

    def run():
        score_texts(spark.readStream.schema(texts.schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/models", classify, f"{tmp_path}/out",
                    f"{tmp_path}/ck", {"availableNow": True}).awaitTermination()

    def out():
        return sorted((r.id, r.pred, round(r.confidence, 9), r.model_version) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    want = []
    for v, part in enumerate(("split = 'test'", "split = 'train'")):
        publish(models[v], f"{tmp_path}/models", v + 1)
        texts.where(F.col("id").isin([r.id for r in data.where(part).select("id").collect()])).write.mode("append").parquet(f"{tmp_path}/in")
        run()
        want += [(r.id, r.pred, round(r.confidence, 9), v + 1) for r in classify(models[v], data.where(part)).collect()]
    assert out() == sorted(want) and newest(spark, f"{tmp_path}/models") == 2
    publish(models[0], f"{tmp_path}/models", 3)
    last = max((f for f in os.listdir(tmp_path / "ck/commits") if f.isdigit()), key=int)
    (tmp_path / "ck/commits" / last).unlink()
    (tmp_path / "ck/commits" / f".{last}.crc").unlink()
    run()  # the replayed epoch keeps its version although a newer one is out
    assert out() == sorted(want)
    with pytest.raises(ValueError):
        publish(models[0], f"{tmp_path}/models", 3)
    with pytest.raises(ValueError):
        newest(spark, f"{tmp_path}/nothing")
