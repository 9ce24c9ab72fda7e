import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerline.session import build_session

    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column expression over a list of values of one column ``v``."""
    from pyspark.sql import functions as F

    def run(items, make, kind="string"):
        rows = [(i, v) for i, v in enumerate(items)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r.out for r in df.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
