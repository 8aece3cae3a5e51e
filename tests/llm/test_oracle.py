"""Queries against their SQL, value by value, over the whole given tables."""

import os

import pytest

from tests.test_oracle import expected
from visitlens.llm.queries import all_queries, all_sql


def rows(found):
    return sorted((tuple(sorted(row.asDict().items())) for row in found), key=repr)


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_matches_sql(spark, name):
    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    types, wanted = expected(all_sql()[name], sf_dir, ["documents", "benchmark", "conversations", "embeddings"])
    found = all_queries()[name](spark, sf_dir)
    assert dict(found.dtypes) == types
    assert rows(found.collect()) == wanted
    assert wanted
