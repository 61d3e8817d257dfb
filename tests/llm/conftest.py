from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep_id long, p string, _rank int, part string, sequence_id string"

#: nulls in any column, empty, one-word and very long texts, ties, repeated rows, clashing extra columns
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
ODD_ROWS = [
    (1, None, None, None, None, 9, "x", 1, "a", "s"),
    (2, "", "en", "", 0, 9, "x", 1, "a", "s"),
    (3, "   \t\n ", "en", "s1", 0, None, None, None, None, None),
    (4, "one", "en", "s1", 3, 9, "x", 1, "a", "s"),
    (5, "one two three four", "en", "s1", 18, 9, "x", 1, "a", "s"),
    (6, "one two three four", "fr", "s2", 18, 9, "x", 1, "a", "s"),
    (6, "one two three four", "fr", "s2", 18, 9, "x", 1, "a", "s"),
    (7, "ONE two three four", "en", None, 18, 9, "x", 1, "a", "s"),
    (None, "one two three four five six", "en", "s2", 27, 9, "x", 1, "a", "s"),
    (8, LONG, "en", "s1", len(LONG), 9, "x", 1, "a", "s"),
    (9, LONG + " tail", "en", "s1", len(LONG) + 5, 9, "x", 1, "a", "s"),
    (10, "12345 !!! 678", "de", "s3", 13, 9, "x", 1, "a", "s"),
    (11, "été naïve Straße <|endoftext|> İ́ 中文", "fr", "s3", 40, 9, "x", 1, "a", "s"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD_ROWS, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def duck(sql: str, sf: str = SF):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def same_rows(df, sql: str, sf: str = SF) -> None:
    columns, want = duck(sql, sf)
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, got)) == sorted(map(repr, want))
