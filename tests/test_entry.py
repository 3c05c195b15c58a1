"""The driver's entry module without the optional subpackage, or without a library of it."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("absent", ["ahocorasick", "lakeload.llm", "corpus_pipeline"])
def test_core_queries_stay_without_the_optional_ones(absent):
    code = (f"import sys, warnings; warnings.simplefilter('ignore'); sys.modules[{absent!r}] = None; import __spark_entry__ as e; "
            "assert len(e.queries()) >= 65 and not any(k.startswith('op') for k in e.queries()); assert e.oracle_sql().keys() <= e.queries().keys()")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
