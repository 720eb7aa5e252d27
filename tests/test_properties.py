"""Hand-worked rows for the parsers and properties that hold for any input."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from verbena.functions.text import clean_text, sentences
from verbena.operators.responses import parse_part, split_response

# part -> corrected, label, task (worked by hand from SURVEY 2.3)
GOLDEN = [
    ("x(2-1)", "x", "2", "1"), (" x (0-4) ", "x", "0", "4"), ("x(5-3)", "x", "1", "3"), ("x(2 - 1)", "x", "1", "9"),
    ("x(2-10)", "x", "2", "9"), ("x(2-)", "x", "2", "9"), ("x(-3)", "x", "1", "3"), ("x()", "x", "1", "9"),
    ("x(21)", "x", "1", "9"), ("x(2-1-3)", "x(2-1-3)", "1", "9"), ("plain", "plain", "1", "9"), ("", "", "1", "9"),
    ("(2-2)", "", "2", "2"), ("a(b)(2-1)", "a", "1", "9"), ("a(b", "a(b", "1", "9"), ("a)b(c", "a)b", "1", "9"),
    ("x(1-9", "x(1-9", "1", "9"), ("x( 2-1 )", "x", "2", "1"), ("x((2-1))", "x", "1", "9")]


@pytest.mark.parametrize("part,corrected,label,task", GOLDEN)
def test_parse_part_golden(spark, part, corrected, label, task):
    got = spark.createDataFrame([(part,)], "p string").select(parse_part(F.col("p"))).first()[0]
    assert tuple(got) == (corrected, label, task)


def test_split_response_golden(spark):
    rows = [("a|b", ["a", "b"]), (" a | | b ", ["a", "b"]), ("a", ["a"]), ("  ", [""]), ("|", []), ("a|", ["a"])]
    got = spark.createDataFrame([(r,) for r, _ in rows], "p string").select(split_response(F.col("p"))).collect()
    assert [r[0] for r in got] == [w for _, w in rows]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="x (-)|0129 \t", max_size=14), min_size=30, max_size=30))
def test_parse_part_stays_in_the_domain(spark, parts):
    df = spark.createDataFrame([(p,) for p in parts], "p string")
    for (p,), (got,) in zip([(p,) for p in parts], df.select(parse_part(F.col("p"))).collect(), strict=True):
        assert got[1] in "012" and got[2] in "123456789" and p.find(got[0]) >= 0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="ab .!?\n\t\u0085\x1c", max_size=16), min_size=30, max_size=30))
def test_sentences_and_clean_keep_every_character(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, (parts, clean) in zip(texts, df.select(sentences(F.col("t")), clean_text(F.col("t"))).collect(), strict=True):
        solid = "".join(t.split())
        assert "".join("".join(parts).split()) == solid == "".join(clean.split())
        assert all(s == s.strip() and s for s in parts)
        assert all(s[-1] in ".!?" for s in parts[:-1])
        assert clean == " ".join(clean.split())
