import random

import duckdb
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone cloud amber signal winter garden copper lantern meadow harbor violet timber".split()


def prose(n: int, seed: int = 0) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ly", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank, odd and long texts, copies, repeated rows, and
    extra columns named like those the operators use."""
    long = prose(30_000, 1)
    rows = [
        (1, "Alpha beta Gamma delta", "en", "a", 5),
        (2, "alpha BETA gamma delta", None, None, None),
        (3, None, "en", "a", 0),
        (4, "", "de", "a", 0),
        (5, "  \n\t ", "de", "b", 4),
        (6, long, "en", "b", 1),
        (7, long.upper(), "en", "b", 1),
        (8, "Ä ß € \U0001f642 ▁x <|endoftext|> </s>", "fr", "c", 3),
        (9, "word", "fr", "c", 3),
        (9, "word", "fr", "c", 3),
        (None, "no id", "fr", "c", 3),
        (None, "NO ID", None, "c", 3),
        (10, "a" * 50_000, "es", "c", 3),
        (11, prose(60, 5), "en", "c", 3),
        (12, prose(60, 5) + " end", "en", "c", 3),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    names = "id sha key bucket fp row raw best same size kept label passages body spans lot group root t_id".split()
    for name in [*names, "__raw", "__held", "__statistics", "__passages", "k_id"]:
        frame = frame.selectExpr("*", f"'x' as `{name}`")
    return frame


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given(sf_dir):
    """A table's rows as tuples, read without Spark."""

    def read(name: str, columns: str):
        return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()

    return read
