"""The entry module without the corpus part, or without a library that it needs."""

import importlib
import sys

import pytest

import __spark_entry__ as entry_points
from tillroll.plans import catalog


@pytest.mark.parametrize("missing", ["tillroll.llm", "corpus_pipeline", "ahocorasick", "tiktoken"])
def test_other_queries_stay(monkeypatch, missing):
    for name in list(sys.modules):
        if name == "corpus_pipeline" or name.startswith("tillroll.llm"):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    try:
        with pytest.warns(UserWarning, match="left out"):
            importlib.reload(entry_points)
        assert entry_points.queries().keys() == catalog.queries().keys() == entry_points.oracle_sql().keys()
    finally:
        monkeypatch.undo()
        importlib.reload(entry_points)
