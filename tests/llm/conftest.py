import pytest


@pytest.fixture()
def docs_of(spark):
    """(doc_id, text) pairs -> documents with all columns and one more of a clashing name."""

    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, rk string")

    return make


@pytest.fixture()
def sf_of(spark, tmp_path):
    """Tables written as a data folder."""

    def make(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make
