import duckdb
import pytest

from tests.conftest import SF_MID, SF_SMALL

TABLES = ("documents", "embeddings", "pages", "labels", "benchmark")


def duck_over(**paths):
    """DuckDB with a view for each table; ``paths`` replaces some of them."""
    con = duckdb.connect()
    for table in TABLES:
        where = paths.get(table, f"{SF_SMALL}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{where}')")
    return con


@pytest.fixture(scope="session")
def duck_small():
    return duck_over()


@pytest.fixture(scope="session")
def duck_mid():
    return duck_over(**{t: f"{SF_MID}/{t}.parquet" for t in TABLES})


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    words = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, "one two three four five six seven eight nine ten", "a", "x"),
        (1, "one two three four five six seven eight nine ten", "a", "x"),
        (1, "another text under the same id", "a", None),
        (2, None, "a", "x"),
        (3, "", None, "x"),
        (None, "a text without an id", None, None),
        (None, None, None, None),
        (4, words, "b", "x"),
        (5, words + " end", "b", "x"),
        (6, " \t\n\x0b ", "b", "x"),
        (7, "l1 a\nl2 b\nl3 c\nl4 d", "b", "x"),
        (8, "zero\n\nl1 a\nl2 b\nl3 c\nlast", "b", "x"),
        (9, "x" * 3000, "", "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
