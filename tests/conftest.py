import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from checks.compare import session

    return session(4)


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a column function to Python values and return the results in order."""

    def run(fn, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", fn(F.col("v")).alias("out"))
        return [r["out"] for r in sorted(df.collect(), key=lambda r: r["i"])]

    return run
