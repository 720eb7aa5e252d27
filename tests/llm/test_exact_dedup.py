"""Exact duplicates against a plain grouping by text."""

from collections import defaultdict
from hashlib import sha256

import pytest
from llm_samples import ODD
from pyspark.sql import functions as F

from verbena.llm.exact_dedup import exact_duplicates

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def norm(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[norm(t)].append(i)
    out = []
    for t, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i))
        out += [(i, ids[-1], len(ids), k == len(ids) - 1, sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def weak_hash(text):
    """Two bits: nearly every group collides."""
    return F.crc32(text.cast("binary")) % 4


CASES = [(1, "Straße É"), (2, "straße É"), (3, "straße é"), (4, "STRASSE"), (9, "strasse"), (5, "K"), (6, "k"), (7, "K"),
         (-3, "a b"), (-4, "A B"), (11, "a  b"), (12, ""), (13, None), (14, "İ"), (15, "i̇")]


@pytest.mark.parametrize("hashed", [None, weak_hash])
def test_groups_match_brute_force(spark, hashed):
    docs = CASES + ODD + [(1000 + i, f"Common {i % 3}") for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    extra = {"hash_of": hashed} if hashed else {}
    assert got(exact_duplicates(df, **extra)) == brute(docs)


def test_documents(documents, rows):
    assert got(exact_duplicates(documents)) == brute(list(rows.items()))


def test_clashing_columns_and_empty_table(spark, odd, none):
    assert got(exact_duplicates(odd.withColumns({c: F.lit(1) for c in ("size", "stays", "texts", "sha")}))) == brute(ODD)
    assert got(exact_duplicates(none)) == []


def test_no_python_on_the_path(documents):
    plan = exact_duplicates(documents)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
