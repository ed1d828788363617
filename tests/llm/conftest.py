from __future__ import annotations

import pytest

#: Texts that every operator must take: null, empty, blank, very long, repeated, odd characters.
LONG = "lorem ipsum dolor sit amet consectetur " * 20_000


@pytest.fixture(scope="session")
def odd(spark):
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", None, 1), (3, " \t\n ", None, "a", 2), (4, LONG, "en", "b", 3), (5, "one two three", "en", "a", 4), (5, "one two three", "en", "a", 4),
        (None, "a row without an id, whose text is a line of its own", "fr", "b", 5), (7, "é̂ 漢字 \U0001f600 <|endoftext|> \x1c", "zz", "", 6),
    ]
    # columns whose names clash with those that operators add
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long").selectExpr("*", "'x' as node", "0.5D as score", "1 as kept", "'t' as size")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
