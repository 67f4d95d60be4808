import pytest

from barlab.llm.shared import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, token string, h long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text, lang, source), with extra columns whose names could clash."""
    prepare(spark)

    def make(rows):
        full = [(i, t, lang, source, len(t or ""), "x", 1) for i, t, lang, source in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    return [
        (None, "a b c d", None, None),
        (1, None, None, None),
        (2, "", "en", "s"),
        (3, " \t\n ", "en", None),
        (4, "one", "en", "s"),
        (5, "one two three four", "en", "s"),
        (5, "one two three four", "en", "s"),
        (6, "ONE two\nthree four", "fr", "t"),
        (7, long, "en", "s"),
        (8, long + " end", None, "t"),
        (9, "a​b ▁ <|endoftext|> <s> né ß 中文", "en", "s"),
    ]
