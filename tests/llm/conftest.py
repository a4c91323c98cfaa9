import os
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture(scope="session")
def clashing():
    """Adds columns whose names operators use inside."""
    names = ("size", "key", "n", "shard", "slot", "fp", "root", "mark", "line", "ids", "taken", "target", "copies",
             "kept", "body", "len", "head", "hit", "base", "linked", "n_lines", "n_removed", "score", "at", "first",
             "vec", "cid", "label", "count", "pick", "part", "node", "col", "copy")

    def add(df):
        for n in names:
            if n not in df.columns:
                df = df.withColumn(n, F.lit("x"))
        return df

    return add


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, a tie, repeats, one very long line and a null key."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "the same text here, word for word by word"),
            (5, "the same text here, word for word by word"), (5, "the same text here, word for word by word"),
            (6, long), (7, long + " end"), (None, "a text without a key"), (None, None), (8, "one")]

