import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, empty and odd texts, ties and repeated rows.
ODD = [
    (1, "one two three four five six", "en", "a", 27), (1, "one two three four five six", "en", "a", 27),
    (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \n\t ", "de", None, 4), (None, "no id here at all", "en", "b", 17),
    (None, None, None, None, None), (7, "mail me at jo.x@a-b.example.com or +1 (555) 010-9999 now", "en", "b", 50),
    (8, "i d i o t and m0r0n and scuuuum", "en", "b", 31), (9, "x" * 70_000, "en", "c", 70_000),
    (10, "word " * 9_000, "en", "c", 45_000), (11, "токен 中文 \U0001f600 é", "xx", "d", 10),
]


@pytest.fixture(scope="session")
def spark():
    from tandem.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="tandem-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """``df`` with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    names = ("score", "fp", "root", "component_id", "bucket", "w", "p", "m", "script", "row", "pos", "n_tokens", "label", "host", "tokens")
    return df.withColumns({n: F.lit("x") for n in names if n not in df.columns})
