"""Training-data queries against their SQL."""

from __future__ import annotations

import pytest

from orderflow.llm.oracle import ORACLE_SQL
from orderflow.llm.queries import QUERIES
from tests.check_oracle import differences
from tests.llm.conftest import SF


@pytest.mark.parametrize("name", sorted(set(ORACLE_SQL) - {"op11_licenses"}))
def test_query_equals_sql(spark, small_duck, name):
    assert differences(spark, small_duck, QUERIES[name], ORACLE_SQL[name], SF) == []
