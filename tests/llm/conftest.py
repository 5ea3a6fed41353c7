import datetime

import duckdb
import pyarrow.dataset as ds
import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def tables():
    """Tables of the smallest data as pandas frames."""
    return lambda name: ds.dataset(f"{SF_DIR}/{name}.parquet").to_table().to_pandas()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


LONG = "lorem ipsum dolor sit amet. " * 12_000 + "user@mail.example.com. " + "x" * 50_000


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = [(*r, *("en", "s")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCUMENT)

    return make


@pytest.fixture
def odd(documents):
    """Nulls everywhere, empty and very long texts, repeated rows, equal texts, and columns whose names operators use."""
    from pyspark.sql import functions as F

    rows = [
        (1, "a b c d e f g h", "en", "s1"),
        (1, "a b c d e f g h", "en", "s1"),
        (2, "a b c d e f g h", "en", "s2"),
        (3, None, "en", "s1"),
        (4, "", None, None),
        (5, " \n\t ", "fr", "s1"),
        (6, LONG, "en", "s3"),
        (7, "!?", "de", "s1"),
        (None, "no id here at all", "en", "s1"),
        (None, None, None, None),
        (-8, "Ünïcode 你好 \U0001f642 word", "de", "s2"),
    ]
    names = "ids decoded score rejected lang_pred key node label n_lines n_removed _row _kept _id h1 h2 print _lower value at".split()
    clashing = {n: F.lit(i) for i, n in enumerate(names)}
    return documents(rows).withColumns(clashing | {"when": F.lit(datetime.date(2024, 1, 2))})


@pytest.fixture
def nothing(documents):
    return documents([])
