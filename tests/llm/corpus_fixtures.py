import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
#: Extra input columns named like the operators' own.
CLASHING = ["kept", "row", "size", "h", "n", "g", "fp", "words", "shard", "slot", "rule", "host",
            "path", "verdict", "labels", "score", "n_words", "target", "start", "length", "ids",
            "sequence_id", "offset", "block", "c", "w", "key", "spans", "held_out"]


def make_docs(seed=5, n=120):
    """Random documents with copies, near copies, shared passages, blanks, nulls and repeats."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["The", "THE", "é", "ñandú", "語", "a,", "b."]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage = text(70)
    rows = []
    for i in range(n):
        kind = i % 12
        t = text(rng.randint(1, 160))
        if kind == 1:
            t = f"{text(20)} {passage} {text(9)}"
        elif kind == 2 and rows and rows[-1][1]:
            t = rows[-1][1].replace(" ", "\t \n", 2)
        elif kind == 3:
            t = text(120) + " same tail of a text"
        elif kind == 4 and rows and rows[-1][1]:
            t = rows[-1][1] + " x"
        elif kind == 5:
            t = rng.choice([None, "", " \n\t", "one"])
        elif kind == 6:
            t = "A line that comes again.\n" * 3 + text(40)
        rows.append((i, t, "en", rng.choice(["s1", "s2", "s2", "s2", "S", None]), len(t or "")))
    rows += [rows[7], rows[7], (n + 1, rows[8][1], None, None, None), (None, rows[9][1], "en", "s1", 3),
             (None, None, None, None, None), (n + 2, "z " * 3000, "en", "s2", 6000),
             (n + 3, "x" * 20000, "en", "s2", 20000)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    from wattspark.session import ship_package

    ship_package(spark)
    return spark.createDataFrame(make_docs(), DOCS).repartition(5).checkpoint()


@pytest.fixture(scope="session")
def rows(docs):
    return docs.collect()


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def wide_docs(docs):
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("own") for c in CLASHING})


def as_multiset(df, *cols):
    return sorted(map(repr, df.select(*cols).collect()))
