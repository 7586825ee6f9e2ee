"""Shared fixtures and helpers of the operator tests (imported by name; the session fixture is in the parent conftest)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF01 = "/root/testdata/sf0.01"
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


LONG = " ".join(f"word{k % 7919} goes" for k in range(30_000))

#: Nulls, empties, a very long text, ties and repeated rows; the last columns clash with names used inside.
ODD_ROWS = [
    (1, "The cat sat on the mat and looked at the dog that was there.", "en", "a", 61),
    (1, "The cat sat on the mat and looked at the dog that was there.", "en", "a", 61),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, "   \n\t\n ", "de", "b", 6),
    (None, "A row without an id has a text all the same.", "en", "b", 44),
    (5, LONG, "en", "b", len(LONG)),
    (6, "The cat sat on the mat and looked at the dog that was there.\nÜber 12 Zeilen.", None, "c", 80),
    (7, "1234 5678 !!!", "en", None, 13),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with further columns named like outputs and internals."""
    from pyspark.sql import functions as F
    names = ["score", "size", "copy", "fp", "digest", "line_no", "words", "kept", "component", "row", "lang_pred", "a.b",
             "__key", "__lines", "__gone", "__id", "gone", "gone_id", "gone_key", "lines", "kept_id", "kept_key", "mix_size", "mix_copies", "mix_note",
             "document"]
    return odd.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def canon(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def same_as_oracle(df, con, sql):
    cols = sorted(df.columns)
    got = canon(tuple(r) for r in df.select(*cols).collect())
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    at = [names.index(c) for c in cols]
    want = canon(tuple(r[i] for i in at) for r in res.fetchall())
    assert cols == sorted(names)
    assert got == want


class Sets:
    """Union-find for brute-force components."""

    def __init__(self, n):
        self.p = list(range(n))

    def find(self, x):
        while self.p[x] != x:
            self.p[x] = self.p[self.p[x]]
            x = self.p[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.p[max(a, b)] = min(a, b)
