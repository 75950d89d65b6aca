import pytest

ODD_TEXTS = [
    "",
    " \t\n",
    None,
    "a",
    "One two three",
    "one TWO three four",
    "one two three four five six seven",
    "Éa ß 日本 語 \U0001f600 x1",
    "word " * 3000,
    "\x00\x0b\x0c mixed\x85white space",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, repeated rows and ids, odd texts, clashing extra columns."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (6, "another text under a known id", None, None, None)]
    rows += [(None, "a text without an id", "en", "src1", 20), (None,) * 5]
    rows = [(*r, 1, 2, "three", 4.0) for r in rows]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long,"
        " fp int, part int, spans string, row double",
    )


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
