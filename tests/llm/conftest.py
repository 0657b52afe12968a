import random

import pytest
from pyspark.sql import types as T

WORDS = [f"{a}{b}{c}" for a in ("lor", "mi", "tan", "que", "sol") for b in ("a", "e", "ou") for c in ("n", "st", "rel", "")]

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names that the operators use inside.
EXTRA = ("h", "g", "node", "key", "size", "token", "score", "kept", "rank", "part", "c0", "_key", "_size", "grp", "page", "first")


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "", ",", "."]) for _ in range(n))


def table(spark, rows, schema=DOCUMENT, extra=False):
    """Rows as a DataFrame; `extra` adds columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, schema)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({n: F.lit(n) for n in EXTRA})
    return df


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def awkward():
    """Nulls everywhere, empty and very long texts, copies, repeated rows, odd white space."""
    shared = prose(7, 80)
    long = prose(8, 9000)
    rows = [document(k, prose(k, 40 + 7 * k), "en" if k % 2 else "fr", "abc"[k % 3]) for k in range(10, 30)]
    rows += [
        document(0, None),
        document(1, ""),
        document(2, " \n\t "),
        document(None, prose(50, 60), None, None),
        document(None, prose(50, 60), None, None),
        document(3, "one", None, None),
        document(4, shared + " " + prose(60, 50), "fr", None),
        document(5, prose(61, 50) + "\n" + shared, "fr", "b"),
        document(6, long, "en", "b"),
        document(6, long, "en", "b"),
        document(7, long[:-20] + "changed here", "en", "c"),
        document(8, "  two  spaces and été\r\nlines\n\nx " + "=" * 300, "en", "c"),
        document(9, "☃ \U0001f600 " * 60, None, "c"),
    ]
    return rows


@pytest.fixture
def docs(spark):
    return table(spark, awkward(), extra=True)


@pytest.fixture
def empty(spark):
    return table(spark, [])
