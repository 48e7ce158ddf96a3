"""Small document tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing names."""

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    def make(rows, extra=False):
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DDL)
        if extra:  # names that the operators use inside
            df = df.selectExpr("*", "1 AS id", "2 AS node", "3 AS row", "4 AS kept", "'x' AS h1", "5 AS p", "'y' AS ids", "6 AS n_words")
        return df

    return make
