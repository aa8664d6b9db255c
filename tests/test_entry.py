"""The entry points without the optional subpackage, or without a library that it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("hidden", ["public_tokenizers", "zstandard", "sluice.llm", "corpus_pipeline"])
def test_core_queries_without_the_optional_part(hidden):
    code = (
        f"import sys; sys.modules[{hidden!r}] = None\n"
        "import __spark_entry__ as E\n"
        "from workload.queries import ORACLE, QUERIES\n"
        "assert E.queries() == QUERIES and E.oracle_sql() == ORACLE and len(QUERIES) > 50"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
