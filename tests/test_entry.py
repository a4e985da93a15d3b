"""The entry points without what the training-data package needs."""

import subprocess
import sys
from pathlib import Path

from parcelyard.plans import catalogue

ROOT = Path(__file__).resolve().parent.parent


def test_other_queries_stay_where_a_package_is_missing():
    code = (
        "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; "
        "print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    names, sql = (line.split() for line in done.stdout.splitlines())
    assert names == sql == sorted(catalogue.QUERIES)
