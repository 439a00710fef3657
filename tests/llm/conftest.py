import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(texts, extra=()):
        rows = [(at, text, "en", "s", None if text is None else len(text)) for at, text in enumerate(texts)]
        return spark.createDataFrame([*rows, *extra], SCHEMA)

    return make
