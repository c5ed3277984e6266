import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def byte_tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def docs(spark):
    """Documents from (id, text) or (id, text, source), with columns whose names operators use inside."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 7, "x", 1.5) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, shard int, node string, n_tokens double")
    return make
