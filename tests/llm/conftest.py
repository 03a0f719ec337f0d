import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def table(spark):
    """Documents with further columns that clash with the operators' own names."""

    def make(rows, ddl="doc_id bigint, text string"):
        df = spark.createDataFrame(rows, ddl)
        clashing = ["id", "row", "key", "node", "fp", "doc", "version", "n", "best", "run", "kept", "out", "part", "ids", "Text2"]
        return df.selectExpr("*", *[f"'{c}' AS `{c}`" for c in clashing]).repartition(3)

    return make
