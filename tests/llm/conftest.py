import pytest


@pytest.fixture(scope="session")
def small(spark):
    """The smallest documents with their edge cases: null, empty, white space alone, one very long text, repeated rows."""
    return [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two three four five six seven eight nine ten eleven"), (5, "one two three four five six seven eight nine ten eleven"), (None, "no id here"), (7, "ünïcode — “quoted” 日本語   text\x1c end"), (8, " ".join(f"w{i % 977}" for i in range(30000)))]


@pytest.fixture(scope="session")
def docs(spark, small):
    """With columns whose names operators use themselves."""
    rows = [(i, t, "en", "s", 0, 1, "x", 2.0) for i, t in small]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int, score int, rule string, fp double")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def byte_bpe():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_bpe():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
