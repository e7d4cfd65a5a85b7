import pytest

TEXT = "documents"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = ("The committee met in the old town hall and talked about the new bridge for two hours before anyone thought of "
         "asking what the river itself would do in spring when the snow melts")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text, lang, source) rows; `extra` adds a clashing column."""
    def make(rows, extra=None):
        full = [(*r[:2], *(r[2:] or ("en", "s")), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumns({name: F.lit("mine") for name in extra})
        return df

    return make


@pytest.fixture(scope="session")
def labels_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")

    return make


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Nulls in every column, empty and long texts, repeated rows and ties, and columns that clash."""
    rows = [
        (1, PROSE, "en", "a"), (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, None, "en", "a"), (4, "", "en", None),
        (None, PROSE, None, None), (None, None, None, None), (5, " \n\t ", "de", "b"), (6, "x" * 300_000, "de", "b"),
        (7, (PROSE + "\n") * 800, "fr", "b"), (8, "Été \U0001f600 naïve", "fr", "c"),
    ]
    return docs_of(rows, extra=["score", "_key", "shard", "kept", "fp", "words", "hashes", "block"])
