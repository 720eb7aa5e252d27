"""Stages of the pipeline decide row by row, also where ids repeat or are null."""

import corpus_pipeline
from verbena.llm.decontaminate import drop_contaminated


def text(prefix, n=40):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_near_dedup_decides_by_row(spark):
    docs = [(1, text("a")), (2, text("a")), (2, text("b")), (3, text("c")), (3, text("c")), (None, text("a")),
            (None, text("d")), (None, text("d")), (4, None), (4, None), (5, ""), (None, "")]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert got.columns == ["doc_id", "text"]
    want = [(1, text("a")), (2, text("b")), (3, text("c")), (None, text("d")), (4, None), (5, ""), (None, "")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_decontamination_decides_by_row(spark):
    docs = [(1, text("a")), (1, text("b")), (None, text("a")), (None, text("c")), (2, None)]
    items = spark.createDataFrame([(7, text("a"))], "item_id long, text string")
    got = drop_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [docs[1], docs[3], docs[4]]))


def test_decontamination_takes_passages_without_an_id(spark, tmp_path):
    items = [(7, text("a")), (None, text("b")), (None, text("b")), (8, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(1, text("a")), (2, text("x") + " " + text("b")), (3, text("b", 20)), (None, text("b", 39)), (4, None)]
    got = corpus_pipeline.decontaminate(spark, spark.createDataFrame(docs, "doc_id long, text string"), str(tmp_path))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [docs[2], docs[4]]))
