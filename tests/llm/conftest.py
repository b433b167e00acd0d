import pytest

#: Nulls in any column, empty and long texts, ties, repeated rows, and columns whose names operators use themselves.
COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, score double, row string, id long, key long, "
           "node long, hash string, tie long, k1 long, predicted int, shard int")
WORDS = [f"w{i % 211}x{i % 17}" for i in range(30000)]
PASSAGE = " ".join(f"p{i}" for i in range(60))


def _row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), 0.5, "r", doc_id, 1, 2, "h", 3, 4, 5, 6)


ROWS = [
    _row(1, "one two three four five six seven"),
    _row(2, "one two three four five six seven"),
    _row(9, "One  two three\tfour five six\nseven"),
    _row(3, None),
    _row(4, ""),
    _row(5, " \n\t "),
    _row(6, "short"),
    _row(7, f"start {PASSAGE} end of seven", "b"),
    _row(8, f"{PASSAGE} other end", None),
    _row(10, " ".join(WORDS), "b"),
    _row(11, "same " * 500),
    _row(12, "a repeated row"),
    _row(12, "a repeated row"),
    _row(None, "no id here at all"),
    _row(None, "another without an id, which is longer"),
    _row(13, "naïve café ▁ 漢字 🎉 \x0b end"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
