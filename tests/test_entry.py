"""The optional part may be absent as a whole, and nothing else may be missing silently."""

import builtins
import importlib.util
import os

import pytest

ENTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                     "__spark_entry__.py")


def _load(monkeypatch, failure):
    real = builtins.__import__

    def broken(name, *rest):
        if name == "corpus_pipeline":
            raise failure
        return real(name, *rest)

    spec = importlib.util.spec_from_file_location("entry_again", ENTRY)
    module = importlib.util.module_from_spec(spec)
    monkeypatch.setattr(builtins, "__import__", broken)
    spec.loader.exec_module(module)
    return module


@pytest.mark.parametrize("name", ["corpus_pipeline", "orderloom.llm"])
def test_without_the_optional_part(monkeypatch, name):
    module = _load(monkeypatch, ModuleNotFoundError("gone", name=name))
    assert "fct_orders" in module.queries() and "pipeline" not in module.queries()


@pytest.mark.parametrize("failure", [
    ModuleNotFoundError("gone", name="tokenizers"), ImportError("cannot import name 'x'"),
    ModuleNotFoundError("gone", name="orderloom.llm.toxicity")])
def test_a_broken_part_is_not_hidden(monkeypatch, failure):
    with pytest.raises(ImportError):
        _load(monkeypatch, failure)
