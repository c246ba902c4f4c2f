import pytest


ODD_TEXTS = [
    None,
    "",
    " \t\r\n\x0b\x0c ",
    "one",
    "Two words",
    "ÉCOLE école İ ß 漢字 \U0001f600 ▁mark nbsp",
    "\x00\x1c\x85 control line",
    "aaaa " * 3000,
    "x" * 40000,
    "</s>[INST] & | &amp; &lt;/s&gt; <s>user|0\nhi</s>",
    "a\n\nb\n \nc\n",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, odd and long texts, repeated rows, a null id, clashing extra columns."""
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], rows[7], (None, "no id here at all"), (3, "another text of id three"), (90, ODD_TEXTS[7])]
    return spark.createDataFrame(
        [(d, t, "x", 1, 2, "y", "z", 0, 0.5) for d, t in rows],
        "doc_id long, text string, kept string, n_words long, rep long, _text string, _doc string, component long, n double",
    )


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
