import pytest

from brandlens.llm.shared import ship_package

# Null ids and texts, blank, short and long texts, equal rows, one id twice.
LONG = " ".join(f"wort{i % 977}x{i % 13}" for i in range(30_000))
ROWS = [(1, "the same text of some words, " * 30), (2, "the same text of some words, " * 30), (2, "the same text of some words, " * 30),
        (3, None), (4, ""), (5, " \n\t "), (None, "a text without id. " * 40), (6, LONG), (7, LONG + " end"), (8, "ein Wort"), (9, "Ñandú élan ſ 日本 <|endoftext|>\x85 x"),
        (10, None), (11, "a"), (11, "b c")]


@pytest.fixture(scope="session")
def llm(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def odd(llm):
    """Odd rows, with further columns that have the operators' own names."""
    rows = [(d, t, ("en", None)[i % 2], i, "x", b"y", 0.5, None, 7) for i, (d, t) in enumerate(ROWS)]
    return llm.createDataFrame(rows, "doc_id long, text string, lang string, n long, ids string, context binary, rate double, quality_score double, part int").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("doc_id < -1")
