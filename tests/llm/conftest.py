import pytest

SF = "/root/testdata/sf0.001"
# Extra columns under names that the operators use inside.
EXTRA = "row string, id string, text_hash string, lines string, counts string, kept string, shard string, found string"
SCHEMA = f"doc_id long, text string, lang string, source string, {EXTRA}"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long_text = " ".join(f"word{k % 997} tail{k}" for k in range(60_000)) + "\nthe line that many share\n" + "x" * 100_000
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    texts = [(1, base + "\nthe line that many share\nend"), (2, base + "\nThe Line that many share \nend"), (3, None), (4, ""),
             (5, " \t\n"), (6, long_text), (7, "short"), (7, "short"), (None, base), (None, None), (8, "naïve ÀÉ 世界 😀"),
             (9, "\n\n"), (10, base), (11, "the line that many share")]
    rows = [(i, t, None if i == 2 else "en", None if i == 8 else "s", *["junk"] * 7, None) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
