from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, start long, slice int, page_id long"

LONG = " ".join(f"w{k % 977}x{k % 613}" for k in range(60_000))
PLAIN = "Of the many who came that day only a few stayed on to hear the old man speak of rivers and of rain again"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


HARD_ROWS = [
    (1, PLAIN, "en", "a"),
    (2, PLAIN + " tonight", "en", "a"),
    (2, PLAIN + " tonight", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \t\n\r ", "en", ""),
    (None, PLAIN, "en", "b"),
    (None, None, None, None),
    (6, LONG, "fr", "b"),
    (7, LONG, "fr", "b"),
    (8, "one two", "en", "b"),
    (9, "Eins　zwei\x00drei   vier  ", "de", "c"),
    (10, ("the same words again and " * 40).strip(), "en", None),
    (-3, PLAIN.upper(), "en", "a"),
    (11, "mail a.b@c.example.com or +1 (217) 555-7713, card 4111 1111 1111 1111, host 10.0.0.255 300.1.1.1", "en", "a"),
]


@pytest.fixture(scope="session")
def hard(spark):
    """Nulls in any column, empty and long texts, repeated rows, clashing names."""
    rows = [(*r, 0, 7, 7, 7, 7) for r in HARD_ROWS]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same_rows(got, expected):
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, expected), key=key)
