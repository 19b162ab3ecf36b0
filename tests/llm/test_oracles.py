"""Queries with SQL against it on the smallest tables, and registration."""

import pytest

from cliplake.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_matches_sql(name, same_rows):
    same_rows(queries.queries()[name], oracle.oracle_sql()[name])


def test_registered():
    import __spark_entry__ as e

    names = set(e.queries())
    assert {k.split("_")[0] for k in names if k.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names
