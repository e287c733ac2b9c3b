"""Every query of the library proper against its SQL."""

from __future__ import annotations

import pytest

from quillstone.queries import oracle_sql, queries
from tests.oracle import differences


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_its_sql(spark, sf_dir, name):
    assert differences(spark, sf_dir, queries()[name], oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_returns_rows(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0
