"""Whole sequences by their table names, against trying every sequence at every place."""

import random

import pytest
from pyspark.sql import functions as F

from verbena.operators.emoji_table import Lexicon, demojize_with_table

MAN, ZWJ, LAPTOP, VS = "\U0001F468", "‍", "\U0001F4BB", "️"
# Sequences and names of the test lexicon
TABLE = [(MAN + ZWJ + LAPTOP, "man_technologist"), (MAN, "man"), (LAPTOP, "laptop"), ("\U0001F1FB\U0001F1F3", "Vietnam"), ("1" + VS + "⃣", "keycap_1"),
         ("❤" + VS, "red_heart"), ("\U0001F44D\U0001F3FD", "thumbs_up_medium_skin_tone"), ("\U0001F44D", "thumbs_up"),
         (MAN + ZWJ + "\U0001F469" + ZWJ + "\U0001F467", "family_man_woman_girl")]


def brute(text, table):
    if text is None:
        return None
    known = {}
    for e, n in table:
        if e and n is not None and e.replace(VS, ""):
            e = e.replace(VS, "")
            known[e] = min(n, known.get(e, n))
    out, i = "", 0
    while i < len(text):
        best = None
        for j in range(i + 1, len(text) + 1):
            if text[i] != VS and text[i:j].replace(VS, "") in known:
                best = j
        if best is None:
            out += text[i]
            i += 1
        else:
            out += f":{known[text[i:best].replace(VS, '')]}:"
            i = best
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(TABLE + [(None, "x"), ("", "y"), (VS, "z"), ("\U0001F600", None), (MAN, "man_again")], "emoji string, name string")


def test_sequences_by_name(spark, table):
    rng = random.Random(7)
    parts = [e for e, _ in TABLE] + [MAN, ZWJ, LAPTOP, VS, "1", "a ", "❤", "\U0001F1FB", "\U0001F469", "\U0001F3FD", "1⃣"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(300)] + [None, "", VS, "plain", MAN + ZWJ, "12" + VS]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").withColumns({c: F.lit("clash") for c in ("emoji", "name", "e")})
    got = demojize_with_table(df, "text", table)
    assert got.columns == df.columns
    assert {r.k: r.text for r in got.collect()} == {k: brute(t, TABLE) for k, t in enumerate(texts)}
    extra = demojize_with_table(df, "text", table, out="named", left="<", right=">")
    assert extra.columns == [*df.columns, "named"]
    one = spark.createDataFrame([(f"I am a {MAN}{ZWJ}{LAPTOP} from \U0001F1FB\U0001F1F3, no 1{VS}⃣!",)], "text string")
    assert demojize_with_table(one, "text", table).first().text == "I am a :man_technologist: from :Vietnam:, no :keycap_1:!"


def test_hundred_thousand_names(spark):
    big = spark.range(100_000).select(F.concat(F.lit("\U0001F600"), F.conv(F.col("id").cast("string"), 10, 36)).alias("emoji"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    df = spark.createDataFrame([("x \U0001F60015WX y \U0001F600ZZZZZ",)], "text string")
    out = demojize_with_table(df, "text", big)
    assert out.first().text == "x :n54321: y :n46655:ZZ"
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 4000  # no literal of names
    with pytest.raises(ValueError, match="more than"):
        demojize_with_table(df, "text", big, limit=1000)


def test_empty_lexicon_and_table(spark, table):
    df = spark.createDataFrame([("a" + MAN,)], "text string")
    assert demojize_with_table(df, "text", table.limit(0)).first().text == "a" + MAN
    assert demojize_with_table(df.limit(0), "text", table).collect() == []


def test_trie_prefers_the_longest():
    lex = Lexicon([("ab", "two"), ("abcd", "four")])
    assert lex.named("abcabcdab", "<", ">") == "<two>c<four><two>"
