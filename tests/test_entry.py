"""The entry points without the optional part."""

import subprocess
import sys
from pathlib import Path

import pytest

from shopscope.catalog import CATALOG

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["tiktoken", "shopscope.llm", "corpus_pipeline"])
def test_queries_without_a_library_of_the_optional_part(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(CATALOG))] * 2, done.stderr
    assert missing in done.stderr
