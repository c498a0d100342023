"""Small hostile tables: nulls everywhere, empty and very long texts, repeated rows and
extra columns whose names the operators use themselves."""

import random

import pytest
from pyspark.sql import types as T

CLASHES = ["id", "h", "n", "t", "text_sha256", "score", "kept", "name", "level", "label", "rate", "copies", "fp",
           "doc_tokens", "drop_id", "mix_id", "Predicted"]
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
     T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in CLASHES])
LABELS = "doc_id long, quality int, toxic int, score string, label string, fold string"


def hostile_rows():
    rnd = random.Random(3)
    vocab = ["".join(rnd.choice("abcdefghijklmnoprstuvwz") for _ in range(rnd.randint(2, 9))) for _ in range(400)]

    def prose(n, r=rnd):
        return " ".join(r.choice(vocab) for _ in range(n))

    texts = [None, "", "", " \t\n", "one", "two words", "Ünïcode ÀÉ and 日本語 text", "ASCII Text here", "ascii text HERE",
             "Ünïcode Àé", "ünïcode Àé"]
    texts += [prose(rnd.randint(3, 120)) for _ in range(120)]
    base = prose(400)
    texts += [base] * 6 + [base.upper(), base + " tail", base + " tail"]
    texts.append(prose(60_000))
    texts += ["word " * 2000, "x" * 50_000]
    rows = [(i, t, None if i % 7 == 0 else "en", "src", len(t) if t else None) + (str(i),) * len(CLASHES)
            for i, t in enumerate(texts)]
    rows += [(None, None, None, None, None) + (None,) * len(CLASHES), (None, "no id at all", "en", None, 3) + ("x",) * len(CLASHES)]
    rows += [rows[20], rows[20], rows[21]]                       # repeated rows
    rows += [(30, "same id, another text", "de", "s", 1) + ("y",) * len(CLASHES)]
    return rows


@pytest.fixture(scope="session")
def hostile(spark):
    return spark.createDataFrame(hostile_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def few_labels(spark):
    rows = [(i, i % 3 != 0, i % 5 == 0) for i in range(0, 130, 2)]
    rows = [(i, int(q), int(t), "s", "l", "f") for i, q, t in rows]
    rows += [(None, 1, 0, None, None, None), (4, None, None, None, None, None), (6, 0, 1, "s", "l", "f"), (6, 1, 1, "s", "l", "f")]
    return spark.createDataFrame(rows, LABELS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)
