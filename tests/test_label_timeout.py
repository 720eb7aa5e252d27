"""Two live streams: answers in time, late, twice, null or never; restarts and replays."""

import os
from datetime import datetime, timedelta

import pytest

from paths import SF001
from verbena.streaming import timeouts as T

START = datetime(2024, 1, 1)


def minute(m):
    return START + timedelta(minutes=m)


def batch(i, at, n=3):
    return (i, minute(at), [(k, i * 10 + k, str(i * 10 + k), f"comment {i} {k}") for k in range(n)])


BATCHES = [batch(0, 0), batch(1, 1), batch(2, 2), batch(3, 3), batch(4, 4, 1), batch(5, 5), batch(6, 6, 2)]
ANSWERS = [(0, "a(0-1)|b(1-2)|c(2-3)", minute(5)), (1, "late(0-1)|late(0-1)", minute(40)), (2, None, minute(3)), (2, "x(2-9)", minute(32)),
           (4, "one(2-4)|extra(1-1)", minute(10)), (4, "second(0-0)", minute(12)), (5, "early(0-1)", minute(4)),
           (6, "p(1-1)", minute(36)), (99, "nobody asked(1-1)", minute(6))]
WANT = sorted([(0, 0, "a", "0", "1", True), (0, 1, "b", "1", "2", True), (0, 2, "c", "2", "3", True),
               *[(1, k, f"comment 1 {k}", "1", "9", False) for k in range(3)],
               (2, 0, "x", "2", "9", True), *[(2, k, f"comment 2 {k}", "1", "9", True) for k in (1, 2)],
               *[(3, k, f"comment 3 {k}", "1", "9", False) for k in range(3)],
               (4, 0, "one", "2", "4", True), *[(5, k, f"comment 5 {k}", "1", "9", False) for k in range(3)],
               (6, 0, "p", "1", "1", True), (6, 1, "comment 6 1", "1", "9", True)])


def rows(df):
    return sorted(tuple(r) for r in df.select("batch_id", "pos", "comment", "label", "task", "answered").collect())


class Job:
    def __init__(self, spark, base):
        self.spark, self.base = spark, str(base)

    def sitting(self, batches=(), answers=()):
        for some, schema, name in ((batches, T.BATCHES, "b"), (answers, T.ANSWERS, "a")):
            self.spark.createDataFrame(list(some), schema).coalesce(1).write.mode("append").parquet(f"{self.base}/{name}")
        self.run()

    def run(self):
        T.start_labelling(self.spark.readStream.schema(T.BATCHES).parquet(f"{self.base}/b"),
                          self.spark.readStream.schema(T.ANSWERS).parquet(f"{self.base}/a"), f"{self.base}/out",
                          f"{self.base}/ck", "30 minutes", "20 minutes", {"availableNow": True}).awaitTermination()

    def out(self):
        return self.spark.read.parquet(f"{self.base}/out")


def test_batch_twin(spark):
    got = T.label_in_time(spark.createDataFrame(BATCHES, T.BATCHES), spark.createDataFrame(ANSWERS, T.ANSWERS), "30 minutes")
    assert rows(got) == WANT


def test_stream_over_restarts_and_replay(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.sitting(BATCHES[:3], ANSWERS[:1])
    assert rows(job.out()) == WANT[:3]  # the open batches wait
    job.sitting(BATCHES[3:], ANSWERS[2:6])
    assert {r[0] for r in rows(job.out())} == {0, 2, 4}
    job.sitting([], ANSWERS[6:])
    T.heartbeat(spark, f"{tmp_path}/b", f"{tmp_path}/a", "2024-01-02 00:00:00")
    job.run()  # a restart on the same checkpoint: every deadline passes
    assert rows(job.out()) == WANT
    job.sitting([], ANSWERS[1:2])  # below the watermark: the stream drops it
    assert rows(job.out()) == WANT
    # a failure after the files and before the commit: the epoch is written again, over itself
    last = max((f for f in os.listdir(tmp_path / "ck/commits") if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if (tmp_path / "ck/commits" / f).exists():
            (tmp_path / "ck/commits" / f).unlink()
    job.run()
    assert rows(job.out()) == WANT
    late = T.late_answers(spark.read.schema(T.ANSWERS).parquet(f"{tmp_path}/a"), job.out())
    assert sorted((r.batch_id, r.response) for r in late.collect()) == [(1, "late(0-1)|late(0-1)"), (5, "early(0-1)")]


def test_tables_equal_align_responses(spark):
    """Batches answered in time have the labels of the batch job, the others the defaults."""
    from verbena.queries import q_align_responses, q_label_stream_timeout
    got = {r.doc_id: tuple(r) for r in q_label_stream_timeout(spark, SF001).collect()}
    want = {r.doc_id: tuple(r) for r in q_align_responses(spark, SF001).collect()}
    assert got.keys() == want.keys()
    assert sum(not r[-1] for r in got.values()) == sum(5 for b in range(40) if b % 11 in (3, 7))
    for k, r in got.items():
        assert r[:-1] == want[k] if r[-1] else r[3:5] == ("1", "9")


def test_empty_streams(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.sitting()
    assert not os.path.exists(f"{tmp_path}/out") or job.out().count() == 0


@pytest.mark.parametrize("answers", [[], [(0, "", minute(1))]])
def test_batch_twin_without_answers(spark, answers):
    got = rows(T.label_in_time(spark.createDataFrame(BATCHES[:1], T.BATCHES), spark.createDataFrame(answers, T.ANSWERS), "30 minutes"))
    # an empty answer is an answer: its one blank part labels the first row
    assert [r[5] for r in got] == [bool(answers)] * 3


def test_an_answer_is_split_once_for_its_batch_not_for_each_item(spark):
    """beside the explode, Spark puts the splitting above it."""
    got = T.label_in_time(spark.createDataFrame(BATCHES, T.BATCHES), spark.createDataFrame(ANSWERS, T.ANSWERS), "30 minutes")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("\\|, -1")


def test_texts_go_when_the_streams_have_taken_them(spark, monkeypatch):
    """Of the two streams' input, their state and the numbered rows only the labelled rows are left; no table is kept beside the streams' folders."""
    import os
    from verbena import session
    from verbena.streaming.timeouts import label_with_timeout_from_tables
    made = []
    monkeypatch.setattr(session, "shared_dir", lambda s, name, f=session.shared_dir: made.append(f(s, name)) or made[-1])
    out = label_with_timeout_from_tables(spark, SF001)
    assert out.count() == spark.read.parquet(f"{SF001}/documents.parquet").count()
    paths = [m.removeprefix("file:") for m in made]
    left = {x for p in paths if "label-timeout" in p for x in os.listdir(p) if not x.startswith(".")}
    assert left == {"out"} and not any(os.path.exists(p) for p in paths if "row-index" in p)
