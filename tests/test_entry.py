import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_are_listed_without_a_session():
    """What a driver imports first must not need Spark to run; every query outside the operators for text has its SQL."""
    code = "import __spark_entry__ as e; from tilewright import plans; assert len(e.queries()) >= len(plans.queries()); assert set(plans.queries()) == set(plans.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
