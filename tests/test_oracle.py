"""All registered queries against their DuckDB oracle at sf0.001
(``python tests/oracle_compare.py`` runs them at sf0.01)."""
import pytest
from conftest import SF001
from oracle_compare import compare

from starloom import registry

@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF001, [name])[name]
    assert res["match"], res


def test_every_query_has_an_oracle_or_is_declared():
    import __spark_entry__ as E
    assert set(registry.QUERIES) - set(E.oracle_sql()) == E.NO_ORACLE
