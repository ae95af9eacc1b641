"""The registered queries where a package of the operators for training data is missing."""

import subprocess
import sys
from pathlib import Path

from marquee.registry.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]


def test_catalogue_is_there_without_a_package():
    code = (
        "import sys; sys.modules['ahocorasick'] = None; sys.modules['public_tokenizers'] = None\n"
        "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    assert [set(line.split()) for line in out.splitlines()] == [set(QUERIES)] * 2
