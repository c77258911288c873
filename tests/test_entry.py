"""The driver's entry points stand without the llm subpackage, or with one that cannot be imported."""

import sys

import pytest

import __spark_entry__ as entry
from tidewise.queries import QUERIES, SQL


@pytest.mark.parametrize("hidden", ["xxhash", "tidewise.llm", "public_tokenizers", None])
def test_core_queries_stand_alone(monkeypatch, hidden):
    for name in [n for n in sys.modules if n.startswith("tidewise.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    if hidden:
        monkeypatch.setitem(sys.modules, hidden, None)  # importing it raises ImportError
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    if hidden:
        assert set(entry.queries()) == set(QUERIES)


def test_the_entry_query_runs(spark):
    assert entry.entry(spark).count() > 0
