import pytest

LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, key string, node int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, clashing names."""
    prose = "The quick brown fox jumps over the lazy dog while seven wise owls look on from the old oak"
    texts = [
        (1, prose), (1, prose), (2, None), (3, ""), (4, " \n\t \n"), (5, LONG), (5, LONG),
        (None, prose + " tonight"), (None, None), (6, prose), (7, "one"), (8, "one two"),
        (9, "\n".join([prose] * 3)), (10, "ÄÖÜ ß 你好 мир 🙂 " * 20), (11, prose.upper()),
    ]
    rows = [
        (i, t, None if n % 4 == 0 else "en", None if n % 5 == 0 else f"s{n % 3}", None if n % 3 == 0 else n, "x", "y", "z", n)
        for n, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def corpus(spark):
    """A folder's ``documents`` and ``labels``."""

    def read(sf: str = "0.001"):
        folder = f"/root/testdata/sf{sf}"
        return [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels", "benchmark")]

    return read
