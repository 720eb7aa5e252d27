import json

from pyspark.sql import functions as F

from verbena.functions.phrases import join_phrases
from verbena.operators.phrases import apply_phrases, phrase_scores
from verbena.sources.abbreviations import dictionary, read_abbreviations
from verbena.operators.resume import resume_by_id
from verbena.sources.comments import read_progress


def greedy(tokens, phrases):
    out, i = [], 0
    while i < len(tokens):
        if i + 1 < len(tokens) and f"{tokens[i]} {tokens[i + 1]}" in phrases:
            out.append(tokens[i] + "_" + tokens[i + 1]); i += 2
        else:
            out.append(tokens[i]); i += 1
    return " ".join(out)


def test_greedy_join_matches_python(spark):
    phrases = {"a b", "b c", "c d", "x x"}
    texts = ["a b c d", "b c d e", "x x x x x", "a", "", "q a b a b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(join_phrases(F.col("t"), phrases)).collect()]
    assert got == [greedy(t.split(), phrases) for t in texts]


def test_phrase_fit_and_apply(spark):
    texts = ["new york is big", "i love new york", "new york new york", "york new"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, t string")
    sc = phrase_scores(df, "t", min_count=2, delta=1.0)
    pairs = {(r.a, r.b) for r in sc.collect()}
    assert ("new", "york") in pairs
    numbered = {r.doc_id: r.phrased for r in apply_phrases(df, "t", sc, "phrased").collect()}
    small = {r.doc_id: r.phrased for r in apply_phrases(df, "t", sc, "phrased", key="doc_id").collect()}
    assert small == numbered
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "new")], "doc_id long, t string")
    assert [r.phrased for r in apply_phrases(odd, "t", sc).orderBy("doc_id").collect()] == [None, "", "new"]
    assert small[2] == "new_york new_york"


def test_abbreviation_readers(spark, tmp_path):
    csv = tmp_path / "a.csv"
    csv.write_text("viết_tắt,từ_đầy_đủ\nsp,sản phẩm\nko,không\nsp,sản phẩm 2\n", encoding="utf-8")
    assert dictionary(read_abbreviations(spark, str(csv))) == {"sp": "sản phẩm 2", "ko": "không"}
    js = tmp_path / "a.json"
    js.write_text(json.dumps({"k": "không", "dc": "được"}, ensure_ascii=False), encoding="utf-8")
    assert dictionary(read_abbreviations(spark, str(js))) == {"k": "không", "dc": "được"}
    txt = tmp_path / "a.txt"
    txt.write_text("k:không\nnocolon\na:b:c\ndc:được\n", encoding="utf-8")
    # bad lines are skipped, not fatal
    assert dictionary(read_abbreviations(spark, str(txt))) == {"k": "không", "dc": "được"}


def test_resume_twice_adds_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    todo = spark.createDataFrame([(str(i), f"c{i}") for i in range(10)], "id string, comment string")
    assert read_progress(spark, out).count() == 0
    first = resume_by_id(todo, read_progress(spark, out))
    first.write.mode("append").parquet(out)
    second = resume_by_id(todo, read_progress(spark, out))
    assert second.count() == 0
    # numbers read back still match string ids
    done_numeric = spark.createDataFrame([(1,), (2,)], "id long")
    assert resume_by_id(todo, done_numeric).count() == 8


def test_abbreviations_last_wins_across_files(spark, tmp_path):
    d = tmp_path / "dicts"
    d.mkdir()
    (d / "a.txt").write_text("k:một\nx:y\n", encoding="utf-8")
    (d / "b.txt").write_text("k:hai\n", encoding="utf-8")
    from verbena.sources.abbreviations import read_abbreviations_txt
    assert dictionary(read_abbreviations_txt(spark, str(d))) == {"k": "hai", "x": "y"}


def test_held_and_joined_phrase_tables_agree(spark):
    """Also for rows whose key repeats (other texts under one id) or is null."""
    from verbena.operators.phrases import apply_phrases
    docs = [(0, "a b a b c"), (1, "b a  b"), (2, None), (3, ""), (4, "new york new york"), (4, "a b"), (None, "a b c")]
    df = spark.createDataFrame(docs, "id long, text string").repartition(2)
    p = spark.createDataFrame([("a", "b"), ("b", "c"), ("new", "york"), (None, "x"), ("a b", None), ("a ", "b")], "a string, b string")
    got, want = ([tuple(r) for r in sorted(apply_phrases(df, "text", p, "o", "id", limit=n).collect(), key=str)] for n in (1 << 20, 0))
    assert got == want and (0, "a b a b c", "a_b a_b c") in got
