import pytest

LONG = " ".join(f"word{i % 997} und{i % 13}" for i in range(20_000))
CLASHING = (
    "spans", "hits", "n_words", "score", "predicted", "size", "shard", "slot", "start", "length", "ids", "node",
    "bands", "_rare", "_row", "_slice", "_task", "query_id", "term", "held_out", "group", "text_key", "_tie",
)

TEXTS = [
    (1, "Plain words, nothing else."),
    (2, None),
    (3, ""),
    (None, "A text without an id, mail me at someone@example.org or +1 (555) 123-4567."),
    (None, None),
    (4, LONG),
    (5, "same text in two rows with more than five words"),
    (5, "same text in two rows with more than five words"),
    (6, "same text in two rows with more than five words"),
    (7, "   \n\t \n"),
    (8, "é ñ ü 日本語 text with other  blanks \x1c and marks!!"),
    (9, "4111 1111 1111 1111 is a card, 10.0.0.1 is an address, 300.1.1.1 is not"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Null and empty texts and ids, a very long text, repeated rows, and columns named like those of operators."""
    extra = ", ".join(f"{name} string" for name in CLASHING)
    rows = [(i, t, *(["kept"] * len(CLASHING))) for i, t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, {extra}").repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
