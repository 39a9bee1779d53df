"""The driver contract with and without the text operators."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len([q for q in e.queries() if not q.startswith('op') and q != 'pipeline']), len(e.queries()), len(e.oracle_sql()))"


def counted(before=""):
    out = subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {ROOT!r}); {before}{COUNT}"], capture_output=True, text=True, cwd="/")
    assert out.returncode == 0, out.stderr[-2000:]
    return tuple(map(int, out.stdout.split()[-3:]))


@pytest.mark.parametrize("missing", ["readloom.llm", "xxhash", "regex", "public_tokenizers", "tokenizers", "corpus_pipeline"])
def test_other_queries_register_without(missing):
    """A module that can't be imported takes along what needs it, and nothing else."""
    own, every, oracles = counted()
    blocked = counted(f"sys.modules[{missing!r}] = None; ")
    assert blocked[0] == own > 120 and own <= blocked[1] <= every and own <= blocked[2] <= oracles
