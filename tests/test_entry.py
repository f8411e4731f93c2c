"""The entry point without the optional packages."""

import importlib

import pytest

import __spark_entry__
from hitlens.plans import registry


def test_other_queries_stay_if_the_corpus_package_cannot_be_imported(monkeypatch):
    real = importlib.import_module

    def without(name, *args):
        if name.startswith("hitlens.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name}")
        return real(name, *args)

    monkeypatch.setattr(importlib, "import_module", without)
    with pytest.warns(UserWarning, match="is left out"):
        assert set(__spark_entry__.queries()) == set(registry.queries())
        assert set(__spark_entry__.oracle_sql()) == set(registry.queries())
