"""The entry without the corpus operators, or without a library that they need."""

import json
import subprocess
import sys

import pytest

HIDDEN = """
import json, sys
for name in {hidden!r}:
    sys.modules[name] = None
sys.path.insert(0, {root!r})
import __spark_entry__ as e
print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))
"""


@pytest.mark.parametrize("hidden", [["zstandard"], ["sentencepiece"], ["forecourt.llm"], ["corpus_pipeline"], ["ahocorasick"]])
def test_other_queries_stay(hidden):
    from verification.oracle import all_oracles
    from verification.queries import all_queries

    root = str(__import__("pathlib").Path(__file__).resolve().parent.parent)
    code = HIDDEN.format(hidden=hidden, root=root)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    queries, oracles = json.loads(done.stdout.splitlines()[-1])
    assert queries == sorted(all_queries()) and oracles == sorted(all_oracles())
    assert "no corpus queries" in done.stderr
