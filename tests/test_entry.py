"""The entry points with and without their optional part."""

import sys

import pytest

import __spark_entry__ as entry_points
from equigauge import catalog


class Absent:
    """Finds nothing under `name`, as if it had been deleted."""

    def __init__(self, name):
        self.name = name

    def find_spec(self, name, path=None, target=None):
        if name == self.name or name.startswith(self.name + "."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)


@pytest.mark.parametrize("absent", ["equigauge.llm", "corpus_pipeline"])
def test_the_rest_loads_without_an_optional_part(absent, monkeypatch):
    for name in [n for n in sys.modules if n.split(".")[0] == "corpus_pipeline" or n.startswith("equigauge.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Absent(absent), *sys.meta_path])
    assert set(catalog.queries()) <= set(entry_points.queries())
    assert set(catalog.oracles()) <= set(entry_points.oracle_sql())
    assert "pipeline" not in entry_points.queries()


def test_other_missing_modules_are_reported(monkeypatch):
    def missing(name):
        raise ModuleNotFoundError("No module named 'other'", name="other")
    monkeypatch.setattr(entry_points, "import_module", missing)
    with pytest.raises(ModuleNotFoundError):
        entry_points.queries()
