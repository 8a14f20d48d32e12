"""What the entry file offers when optional parts are absent."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from oracle.queries_sql import expected

ROOT = Path(__file__).resolve().parents[1]


def keys_without(module: str) -> list[str]:
    """The registered queries when ``module`` cannot be imported."""
    code = f"import sys; sys.modules[{module!r}] = None; import __spark_entry__ as e; print(*e.queries())"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()


@pytest.mark.parametrize("module", ["corpus_pipeline", "hardwood.llm", "xxhash"])
def test_an_absent_module_costs_the_text_queries_only(module):
    assert set(keys_without(module)) >= expected().keys()
    assert not any(key == "pipeline" or key.startswith("op1_") for key in keys_without(module))


def test_a_fault_of_the_library_is_not_hidden():
    with pytest.raises(subprocess.CalledProcessError):
        keys_without("hardwood.operators.sizes")
