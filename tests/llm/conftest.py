import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

WORDS = ("the of and to in is that was for with onder erent tion ingly ésta señal straße über naïve "
         "don't it's x1 42 well-known end. stop! (par) a,b").split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + (rng.choice(["", "", "s", "ed"])) for _ in range(n))


@pytest.fixture()
def make(spark):
    """Documents from texts, or from (doc_id, text, source) rows, with an extra clashing column."""

    def build(rows, extra=None):
        full = []
        for i, r in enumerate(rows):
            doc_id, text, source = r if isinstance(r, tuple) else (i, r, f"s{i % 3}")
            full.append((doc_id, text, "en", source, len(text or "")))
        df = spark.createDataFrame(full, DOCS)
        for c in extra or ():
            from pyspark.sql import functions as F
            df = df.withColumn(c, F.lit("x"))
        return df

    return build


@pytest.fixture()
def rng():
    return random.Random(7)
