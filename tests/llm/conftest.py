import pytest

from cairn.llm.ship import ship_package


@pytest.fixture(scope="module")
def llm(spark):
    ship_package(spark)
    return spark


EDGE_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, id long, row long, h long, "
    "digest string, part int, home long, bucket long, length long, component_id long, kept boolean, label int"
)
PASSAGE = "One passage of text that several of these documents share word for word, long enough to count as a repeat. "


def edge_rows():
    """Nulls, empty and blank texts, ties, repeated rows and a long text."""
    texts = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "tie"),
        (5, "tie"),
        (5, "tie"),
        (None, "tie"),
        (None, None),
        (6, PASSAGE + "Tail one."),
        (7, "Head. " + PASSAGE),
        (8, "word " * 60_000),
        (9, "é ñ ü 漢字 😀 " * 30),
        (10, "x" * 5000),
        (11, "All rights reserved. " + PASSAGE + "password=abcd1234efgh"),
        (12, "A b C d"),
        (13, "a b c d"),
    ]
    return [(i, t, "en", None, None, 9.0, 1, 2, 3, "d", 4, 5, 6, 7, 8, True, 1) for i, t in texts]


@pytest.fixture(scope="module")
def edge(llm):
    return llm.createDataFrame(edge_rows(), EDGE_SCHEMA)


@pytest.fixture(scope="module")
def empty(llm):
    return llm.createDataFrame([], EDGE_SCHEMA)
