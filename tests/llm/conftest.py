from __future__ import annotations

import pytest
from pyspark.sql import functions as F


@pytest.fixture()
def documents(spark):
    """Makes a documents table from texts, or from (id, text) pairs, with further columns."""

    def make(texts, **extra):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for name, value in ({"lang": "en", "source": "src1", "n_chars": 1} | extra).items():
            df = df.withColumn(name, F.lit(value))
        return df

    return make
