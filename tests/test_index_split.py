from pyspark.sql import Window, functions as F

from paths import SF001, SF01
from verbena.operators.index import batch_rows, row_index
from verbena.operators.split import stratified_split


def test_row_index_exact(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    r = row_index(d, [F.col("doc_id").desc()], num_partitions=7)
    w = Window.orderBy(F.col("doc_id").desc())
    bad = r.withColumn("rn", F.row_number().over(w) - 1).filter("rn != row_idx").count()
    assert bad == 0 and r.count() == d.count()


def test_row_index_exact_when_sampling(spark):
    # 10,000 rows in 16 ranges: the range bounds come from a sample
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    r = row_index(d, ["doc_id"], num_partitions=16)
    assert r.filter(F.col("row_idx") != F.col("doc_id")).count() == 0


def test_row_index_grouped_with_null_group(spark):
    rows = [(i, None if i % 5 == 0 else i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, g int")
    r = row_index(df, ["k"], group_by=["g"], num_partitions=5)
    got = sorted((x.g if x.g is not None else -1, x.k, x.row_idx) for x in r.collect())
    want = []
    for g in sorted({(-1 if g is None else g) for _, g in rows}):
        ks = sorted(k for k, gg in rows if (-1 if gg is None else gg) == g)
        want += [(g, k, i) for i, k in enumerate(ks)]
    assert got == want


def test_batch_rows_sizes(spark):
    df = spark.range(23).withColumn("comment", F.col("id").cast("string")).withColumn(
        "id", F.col("id").cast("string")).withColumn("n", F.col("comment").cast("long"))
    rows, batches = batch_rows(df, ["n"], 5)
    sizes = sorted(r[0] for r in batches.select(F.size("items")).collect())
    assert sizes == [3, 5, 5, 5, 5]
    first = batches.filter("batch_id = 0").first()["items"]
    assert [i["comment"] for i in first] == ["0", "1", "2", "3", "4"]


def test_split_disjoint_complete_quotas(spark):
    from verbena.sources.derived import labelled_comments
    lab = labelled_comments(spark, SF01).select("id", "label", "task")
    out = stratified_split(lab, ["label", "task"], "id", 0.15, 0.15, 42)
    assert out.count() == lab.count() == out.select("id").distinct().count()
    stats = out.groupBy("label", "task").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t"),
        F.count_if(F.col("split") == "val").alias("v")).collect()
    for s in stats:
        assert abs(s.t - 0.15 * s.n) <= 1
        assert abs(s.v - 0.15 * s.n) <= 1.5
        if s.n == 1:
            assert s.t == 0 and s.v == 0  # a single row lands in train


def test_split_repeatable(spark):
    from verbena.sources.derived import labelled_comments
    lab = labelled_comments(spark, SF001).select("id", "label", "task")
    a = {(r.id, r.split) for r in stratified_split(lab, ["label", "task"], "id").collect()}
    b = {(r.id, r.split) for r in stratified_split(lab, ["label", "task"], "id").collect()}
    assert a == b


def test_split_null_label_kept(spark):
    df = spark.createDataFrame([(str(i), None if i == 3 else i % 3) for i in range(30)], "id string, label int")
    out = stratified_split(df, ["label"], "id", 0.0, 0.1)
    assert out.count() == 30
    assert out.filter("label is null").first()["split"] is None


def test_hash_split_shares(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    out = stratified_split(df, [], "id", 0.15, 0.15, 42, mode="hash")
    shares = {r.split: r["count"] / 20000 for r in out.groupBy("split").count().collect()}
    assert abs(shares["test"] - 0.15) < 0.01 and abs(shares["val"] - 0.15) < 0.01
    again = stratified_split(df.filter("id < '5'"), [], "id", 0.15, 0.15, 42, mode="hash")
    a = {r.id: r.split for r in out.filter("id < '5'").collect()}
    assert a == {r.id: r.split for r in again.collect()}


def test_prepared_rows_are_prepared_after_the_range_exchange(spark):
    """sampling the bounds must not do the projection once more."""
    df = spark.range(23).select(F.col("id").alias("n"), F.format_string("c%d", F.col("id")).alias("comment"))
    ready = lambda d: d.select("n", F.upper("comment").alias("comment"))
    got, batches = batch_rows(df, ["n"], 5, ("n", "comment"), prepare=ready)
    want, _ = batch_rows(ready(df), ["n"], 5, ("n", "comment"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    assert [i.comment for r in batches.orderBy("batch_id").collect() for i in r["items"]] == [f"C{n}" for n in range(23)]
