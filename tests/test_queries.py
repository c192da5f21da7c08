import sys
from importlib.util import find_spec

import pytest

import __spark_entry__ as contract
from candlewick.plans.oracle import oracle
from candlewick.plans.registry import registered
from oracle_check import compare, database


@pytest.fixture(scope="module")
def connection(small):
    return database(small)


@pytest.mark.parametrize("name", list(registered()))
def test_query_equals_its_sql(spark, connection, small, name):
    assert compare(spark, connection, small, name) == []


def test_every_query_has_sql_and_the_other_way():
    assert set(registered()) == set(oracle())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_without_the_text_package(monkeypatch):
    """Both folders of the text operators gone: everything else is still registered, and the pipeline is not."""
    monkeypatch.setattr(contract, "find_spec", lambda name: None if name == "candlewick.llm" else find_spec(name))
    monkeypatch.setitem(sys.modules, "candlewick.llm", None)
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    assert set(contract.queries()) == set(registered()) and set(contract.oracle_sql()) == set(oracle())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
