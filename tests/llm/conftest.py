import pytest


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with the other columns of the table and one whose name clashes."""
    def build(*rows):
        schema = ("doc_id long, text string, lang string, source string, n_chars long, text_hash string, "
                  "bucket string, label string, found string")
        return spark.createDataFrame(
            [(i, t, None, "s", None if t is None else len(t), "x", None, "y", "z") for i, t in rows], schema)

    return build
