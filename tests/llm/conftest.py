import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from llm_samples import ODD, SF001  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    clashing = ["key", "row", "n", "m", "cls", "length", "lang", "kind", "value", "bucket", "score", "rank"]
    return df.withColumns({c: F.lit("clash") for c in clashing})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
