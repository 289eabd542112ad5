"""The entry module with and without what the corpus queries need."""

import importlib
import sys
import warnings

import pytest

import __spark_entry__ as entry
from lodgepole.registry import QUERIES


class _Missing:
    """Makes an import fail as a module that is not installed does."""

    def __init__(self, name):
        self.name = name

    def find_spec(self, name, path=None, target=None):
        if name == self.name or name.startswith(self.name + "."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return None


@pytest.mark.parametrize("name", ["corpus_pipeline", "lodgepole.llm", "tiktoken", "zstandard", "xxhash", "regex", "public_tokenizers"])
def test_core_queries_survive_anything_missing(monkeypatch, name):
    gone = [m for m in sys.modules if m in ("corpus_pipeline", name) or m.startswith(("lodgepole.llm", name + "."))]
    for m in gone:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setattr(sys, "meta_path", [_Missing(name), *sys.meta_path])
    with warnings.catch_warnings(record=True):
        warnings.simplefilter("always")
        again = importlib.reload(entry)
    try:
        assert set(again.queries()) == set(QUERIES) and set(again.oracle_sql()) == set(QUERIES)
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
