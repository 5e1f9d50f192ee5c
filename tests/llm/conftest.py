import pytest

CLASHES = ["row", "cls", "ids", "score", "spans", "kept", "n_words", "label", "base", "at", "grp", "_t", "_w", "items"]
LONG = " ".join(f"w{k % 977}x{k % 13}" for k in range(20_000))
TEXTS = [
    (1, "The cat sat on the mat and looked at the other cat for a long while."),
    (2, "the cat sat on the mat and looked at the other cat for a long while."),
    (3, "The cat sat on the mat and looked at the other cat for a long time."),
    (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "one"), (9, "one two"),
    (10, LONG), (11, LONG + " end"), (12, LONG), (None, "a row without an id"), (None, "one"),
    (13, "Ünï çødé – 日本語 😀 mail me.now@example.org or +1 (202) 555-0143 at 10.0.0.1 with 4111 1111 1111 1111."),
    (14, "a a a a a a b b b b b b"), (14, "a a a a a a b b b b b b"),
    (15, "line one\nline one\nline two #*$\nline one"), (16, "\x1codd\x1c blanks\x0band\x0cfeeds\r\nhere"),
]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and long texts, copies, a repeated row, and columns whose names operators use themselves."""
    rows = [(i, t, *[f"{i}"] * len(CLASHES)) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHES)).repartition(5)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)
