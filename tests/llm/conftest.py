import pytest

from groundshift.llm import scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    scratch._ship(spark.sparkContext)


@pytest.fixture
def docs(spark):
    """Documents from (id, text) or (id, text, source) rows, with extra columns whose names clash with inner ones."""

    def build(rows):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 7, "x", 1, "k") for r in rows]
        return spark.createDataFrame(rows, f"{DOCS}, text_key string, SIZE int, mix_key string")

    return build


@pytest.fixture
def same_rows():
    def check(got, want):
        key = lambda r: tuple((v is None, str(v)) for v in r)
        assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)

    return check
