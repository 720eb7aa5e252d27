from pyspark.sql import functions as F

from verbena.functions.abbreviations import expand_abbreviations
from verbena.functions.emoji import demojize
from verbena.functions.text import (clean_text, preprocess_multitask, preprocess_sentiment,
                                    sentences, strip, build_prompt_batch)


def col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(expr(F.col("t"))).collect()]


def test_sentence_split_golden(spark):
    got = col(spark, ["  Tốt lắm!  Giao nhanh? ok.   ", "a.b c. d", "...  x", "\n a! b \t", "   ", ""],
              sentences)
    assert got == [["Tốt lắm!", "Giao nhanh?", "ok."], ["a.b c.", "d"], ["...", "x"], ["a!", "b"], [], []]


def test_sentence_split_golden(spark):
    rows = [("Một. Hai!  Ba?\tBốn", ["Một.", "Hai!", "Ba?", "Bốn"]), ("x. y", ["x.", "y"]),
            ("no break.here", ["no break.here"]), ("end.  ", ["end."])]
    assert col(spark, [t for t, _ in rows], sentences) == [w for _, w in rows]


def test_demojize_golden(spark):
    assert col(spark, ["ok 😀 tốt❤️❤️"], demojize) == ["ok :grinning_face: tốt:red_heart::red_heart:"]


def test_demojize_custom_lexicon_and_unknown(spark):
    lex = {"😀": "grin"}
    assert col(spark, ["a😀b🙂"], lambda c: demojize(c, lex)) == ["a:grin:b🙂"]


def test_abbreviations_golden(spark):
    d = {"sp": "sản phẩm", "ko": "không"}
    d["sp"] = "sản phẩm 2"  # a later line wins
    assert col(spark, ["sp  ko tot"], lambda c: expand_abbreviations(c, d)) == ["sản phẩm 2 không tot"]


def test_abbreviations_empty_keeps_spaces(spark):
    assert col(spark, ["a  b"], lambda c: expand_abbreviations(c, {})) == ["a  b"]


def test_clean_text_idempotent_and_null(spark):
    vals = ["  a\n\rb\t c  ", None, "x　y"]
    once = col(spark, vals, clean_text)
    assert once == ["a b c", None, "x y"]
    assert col(spark, once, clean_text) == once


def test_strip_matches_python(spark):
    vals = ["  a \u0085", "\x1c b \x1f", "c"]
    assert col(spark, vals, strip) == [v.strip() for v in vals]


def test_preprocess_multitask_golden(spark):
    abbr = {"sp": "sản phẩm", "k": "không"}
    rows = [("SP này K tốt!!! (giao) nhanh...", "sản phẩm này không tốt giao nhanh..."), (None, ""),
            ("  Ñoño, ¿qué?  ", "ñoño qué"), ("a_b-c", "a_b c")]
    got = col(spark, [t for t, _ in rows], lambda c: preprocess_multitask(c, abbr))
    assert got == [w for _, w in rows]


def test_preprocess_sentiment_no_strip(spark):
    got = col(spark, ["  Hi!  "], lambda c: preprocess_sentiment(c))
    assert got == ["  hi   "]


def test_prompt_batch_replaces_pipes(spark):
    df = spark.createDataFrame([(["a|b", "c"],)], "xs array<string>")
    got = df.select(build_prompt_batch("T:", F.col("xs"))).first()[0]
    assert got == 'T:"a b|c"'


def test_expand_with_table_equals_inline(spark):
    from verbena.sources.abbreviations import expand_with_table
    table = spark.createDataFrame([(0, "sp", "sản phẩm"), (1, "ko", "không"), (2, "sp", "sản phẩm 2")],
                                  "line_no long, abbr string, full string")
    df = spark.createDataFrame([(1, "sp  ko tot"), (2, ""), (3, "x")], "k long, t string")
    got = {r.k: r.t for r in expand_with_table(df, "t", "k", table).collect()}
    assert got == {1: "sản phẩm 2 không tot", 2: "", 3: "x"}


def test_large_dictionary_hashed(spark):
    d = {f"k{i}": f"v{i}" for i in range(500)}
    got = col(spark, ["k1 x k499  k250", ""], lambda c: expand_abbreviations(c, d))
    assert got == ["v1 x v499 v250", ""]


def test_hashed_map_ints(spark):
    from verbena.functions.maps import hashed_map
    look = hashed_map(spark, {f"t{i}": i for i in range(300)}, "string", "int")
    df = spark.createDataFrame([("t0",), ("t299",), ("zz",)], "k string")
    assert [r[0] for r in df.select(look(F.col("k"))).collect()] == [0, 299, None]


def test_demojize_skin_tone_and_zwj(spark):
    got = col(spark, ["ok 👍🏻!", "a👨‍💻b", "x❤️y"], demojize)
    assert got == ["ok :thumbs_up_light_skin_tone:!", "a:man_personal_computer:b", "x:red_heart:y"]


def test_strip_of_every_white_space_looks_at_the_ends_only(spark):
    """``str.strip`` for every character, without a regex over the whole text."""
    import sys
    space = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    texts = [None, "", " ", "".join(space), "a", *[f"{c}{c}a{c}\u200bb{c}" for c in space], "\u200b a \ufeff", " \u00e9 \U0001F600\u3000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip(F.col("t")).alias("s"))
    assert [r.s for r in df.collect()] == [t if t is None else t.strip() for t in texts]
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
