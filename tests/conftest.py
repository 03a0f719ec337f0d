import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from check import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tiny inputs: few partitions, and no time spent on compiling stages (tests/check.py runs the queries compiled).
    return session("4", "3", **{"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"})


@pytest.fixture()
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
