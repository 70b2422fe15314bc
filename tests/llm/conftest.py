import random

import pytest
from pyspark.sql import types as T

#: The documents' columns, and others whose names the operators use inside.
EXTRA = ["row", "value", "fp", "start", "length", "epochs", "cut", "kept", "n_words", "clean_text", "sequence_id", "bin", "key", "size", "owner", "repo", "held_out", "candidates", "target"]


def document_schema(extra=()):
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
    return T.StructType([T.StructField(*f) for f in fields] + [T.StructField(e, T.StringType()) for e in extra])


def sample_texts():
    r = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "delta.", "naïve", "día", "x", "don't", "über", "seven7"]
    base = " ".join(r.choice(words) for _ in range(120))
    secret = "password = 'Abcdef0123456789xyz' and AKIA" + "ABCDEFGHIJ234567 plus deadbeefdeadbeef00"
    return [
        None, "", " \n\t ", "one", "two words", "a b c", base, base, base.replace("alpha", "alphas", 1), base.upper(),
        "line one.\nline one.\n\nHome | About | Contact | Login\nline two is here.\n" + base, secret + " " + base, "text with <|endoftext|> inside and  two spaces\n\n\nthree lines\r\n", "日本語のテキスト。😀 " * 30,
        " ".join(f"w{i}" for i in range(30_000)), "z" * 5000, "### $$$ &&& " * 40, "the same words " * 60, "mixed ghp_" + "a1B2" * 10 + " tail", "token: token: abcdefghijklmnop",
    ]


@pytest.fixture(scope="session")
def documents(spark):
    """Nulls in every column, empty and long texts, copies, repeated rows, and clashing extra columns."""
    rows = [(i, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else f"src{i % 3}", None if t is None else len(t), *(None if i % 2 else "x" for _ in EXTRA)) for i, t in enumerate(sample_texts())]
    rows += [rows[6], rows[6], (None, "no id here", None, None, None, *(None for _ in EXTRA))]
    return spark.createDataFrame(rows, document_schema(EXTRA)).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], document_schema(EXTRA))


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(20)] + [(3, 1, 1), (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
