import pytest
from pyspark.sql import functions as F

from verbena.operators.responses import (align_responses, parse_part, parse_responses, parse_single,
                                         split_response)

GOLDEN = [
    ("tốt lắm(2-1)", "tốt lắm", "2", "1"),
    ("x (0-4) ", "x", "0", "4"),
    ("x(5-3)", "x", "1", "3"),
    ("x(2 - 1)", "x", "1", "9"),
    ("x(2-10)", "x", "2", "9"),
    ("x(2-)", "x", "2", "9"),
    ("x(2-23)", "x", "2", "9"),
    ("x(2-1-3)", "x(2-1-3)", "1", "9"),
    ("x(21)", "x", "1", "9"),
    ("plain", "plain", "1", "9"),
    ("a)b(c", "a)b", "1", "9"),
    ("a(b)(2-1)", "a", "1", "9"),
]


def test_parse_batch_golden(spark):
    df = spark.createDataFrame([(p,) for p, *_ in GOLDEN], "part string")
    got = [tuple(r[0]) for r in df.select(parse_part(F.col("part"))).collect()]
    assert got == [g[1:] for g in GOLDEN]


def test_parse_single_mode(spark):
    df = spark.createDataFrame([("plain",), ("x(2-1-3)",), ("y(0-2)",), (None,)], "r string")
    got = [tuple(r[0]) for r in df.select(parse_single(F.col("r"), F.lit("ORIG"))).collect()]
    assert got == [("ORIG", "1", "9"), ("ORIG", "1", "9"), ("y", "0", "2"), ("ORIG", "1", "9")]


def test_whole_response_example(spark):
    resp = "sản phẩm này có chất lượng tốt(2-1)|giá thành hợp lý (2-4)|đóng hàng nhanh(2-2)"
    df = spark.createDataFrame([(0, resp)], "batch_id long, response string")
    got = [(r.corrected_text, r.label, r.task) for r in parse_responses(df).orderBy("part_no").collect()]
    assert got == [("sản phẩm này có chất lượng tốt", "2", "1"), ("giá thành hợp lý", "2", "4"),
                   ("đóng hàng nhanh", "2", "2")]


@pytest.mark.parametrize("resp,parts", [
    ("a(1-1)| |b", ["a(1-1)", "b"]),
    ("  ", [""]),
    ("|", []),
    (None, None),
])
def test_split_response(spark, resp, parts):
    df = spark.createDataFrame([(resp,)], "r string")
    assert df.select(split_response(F.col("r"))).first()[0] == parts


def test_align_missing_extra_null(spark):
    rows = spark.createDataFrame(
        [(0, 0, "c0"), (0, 1, "c1"), (0, 2, "c2"), (1, 0, "d0"), (2, 0, "e0"), (2, 1, "e1")],
        "batch_id long, pos int, comment string")
    resp = spark.createDataFrame(
        [(0, "x(2-1)||y(0-3)"), (1, None), (2, "p(1-2)|q(2-2)|extra(1-1)")],
        "batch_id long, response string")
    got = {(r.batch_id, r.pos): (r.comment, r.label, r.task)
           for r in align_responses(rows, resp).collect()}
    assert got == {(0, 0): ("x", "2", "1"), (0, 1): ("y", "0", "3"), (0, 2): ("c2", "1", "9"),
                   (1, 0): ("d0", "1", "9"), (2, 0): ("p", "1", "2"), (2, 1): ("q", "2", "2")}


def test_every_row_gets_one_label(spark):
    from verbena.queries import q_align_responses
    from paths import SF001
    out = q_align_responses(spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert out.count() == docs.count() == out.select("id").distinct().count()
    assert out.filter(~F.col("label").isin("0", "1", "2")).count() == 0
    assert out.filter(~F.col("task").rlike("^[1-9]$")).count() == 0
