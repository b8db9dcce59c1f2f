import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text) pairs, with columns whose names an operator might use itself."""

    def make(rows):
        extra = "row int, hits int, id int, score int, key int, digest int"
        return spark.createDataFrame([(i, t, 7, 7, 7, 7, 7, 7) for i, t in rows], f"doc_id long, text string, {extra}")

    return make


#: Nulls, empties, ties, repeats, case, a long text, white space, emoji, a special token's string.
EDGE = [
    (1, None), (2, ""), (3, "   \n\t"), (4, "One two three four five."), (5, "ONE two THREE four five."),
    (6, "One two three four five."), (6, "One two three four five."), (None, "One two three four five."), (None, None),
    (7, "a"), (8, "a b c"), (9, "Ünï cödé ÄÖÜ straße 北京 😀 text"), (10, "<|endoftext|> and more <|endoftext|>"),
    (11, "word " * 30000), (12, " ".join(f"w{i}" for i in range(20000))), (13, "ünï cödé ÄÖÜ straße 北京 😀 text"),
    (14, "tab\tand\nline\r\nends"), (15, "0 1 2 3 4 5 6 7 8 9"),
]
