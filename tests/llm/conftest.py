import pytest


@pytest.fixture()
def docs(spark):
    """Documents from (doc_id, text) pairs, with an extra column that clashes with result names."""

    def make(rows, partitions=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, keep_id string"
        full = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make
