import pytest
from llm_texts import odd_texts

#: Names that operators use inside, as further columns of the documents.
CLASHING = "word words term position row class n group shard slot moved spans owner item start length wanted places flagged label key listed".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None):
        ids = ids if ids is not None else range(len(texts))
        rows = [(i, t, "en", f"src{k % 3}", len(t) if t else 0, *("x" for _ in CLASHING)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Odd texts, two rows without an id, and two rows that occur twice."""
    texts = odd_texts()
    ids = [*range(len(texts))]
    return make_docs([*texts, texts[5], texts[1], texts[5], texts[9]], [*ids, None, None, 5, 9])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
