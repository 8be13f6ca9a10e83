"""The queries that have SQL against it, over whole tables."""

import pytest
from compare import database, differences

from trialstats.llm import catalog

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert differences(spark, database(SF), catalog.queries()[name], catalog.oracle_sql()[name], SF) == []
