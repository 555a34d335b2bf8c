import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def docs(spark):
    """Make documents (doc_id, text and clashing extra columns) from (doc_id, text) rows."""

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        return df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(1).alias("size"), F.lit(2).alias("key"), F.lit(3).alias("length"))

    return make
