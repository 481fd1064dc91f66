import pytest

ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "Héllo wörld, it's a test. " * 3,
    "the quick brown fox jumps over the lazy dog near the old stone bridge at dawn while nobody "
    "watches the river rise and fall again",
    "x\x00y <|endoftext|> z w",
    "日本語 text — “quoted” ½ İ",
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(20, ODD_TEXTS[5]), (21, long), (22, long + " end"), (23, ODD_TEXTS[5] + " indeed")]
    rows += [(24, "same row"), (24, "same row"), (None, "no id"), (25, "same row")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.selectExpr(
        "doc_id", "text", "'xx' lang", "'s' source", "length(text) n_chars", "1 part", "2 n", "3 tag",
        "4 kept", "5 score", "6 host", "7 ids", "8 n_words",
    )


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.filter("false")
