import pytest

LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empties, a very long text, ties, repeated rows, and columns whose names clash."""
    rows = [
        (1, "one two three four five six"), (2, "one  two three\tfour five six"), (3, None), (4, ""), (5, " \n"), (6, LONG), (7, LONG), (8, "x"), (8, "x"), (9, "x"),
        (None, "x"), (None, None), (10, "idiot <|endoftext|> MIT License é𝒳"), (-1, "one two three four five six"), (11, "...!!!"),
    ]
    out = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "cast(length(text) as long) as n_chars")
    return out.selectExpr("*", "1 as n", "2 as row", "'k' as sha", "3 as norm", "4 as salt", "5 as node", "6 as best", "7 as md5", "8 as whole", "9 as words", "10 as key", "11 as length", "12 as prefix", "13 as _id")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
