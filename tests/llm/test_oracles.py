"""The operators that SQL can express, on the given tables."""

import os

import pytest

from parity import compare, oracle_connection
from tidemark.llm import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_equals_its_oracle(spark, name):
    assert compare(spark, oracle_connection(SF), SF, name)[0].startswith("ok")
