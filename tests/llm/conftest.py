import public_tokenizers
import pytest

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

#: Null, empty and blank texts, odd characters, one very long text, ties, repeated rows and rows without an id.
EDGE_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (4, "one"),
    (5, "one two three four five six seven eight nine ten eleven"),
    (6, "one two three four five six seven eight nine ten eleven"),
    (7, "Ünïcode   wörds 日本語 \x1c mixed́ <|endoftext|> 👍🏽 ﷐e"),
    (8, "lorem ipsum dolor sit amet " * 40_000),
    (None, "a text without an id"),
    (9, "!!! ... 123 456"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Edge rows with extra columns whose names operators use themselves."""
    rows = [(i, t, "en", "src", 7, True, 0.5) for i, t in EDGE_TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, held_out boolean, score double"
    )


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("doc_id < 0")


@pytest.fixture(scope="session")
def vocabulary():
    return VOCABULARY
