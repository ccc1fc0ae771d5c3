import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from openroles import build_session

    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluates an expression over rows: ``one(expr, schema, rows) -> values``."""
    def run(expression, schema, rows):
        indexed = [(i, *r) for i, r in enumerate(rows)]
        frame = spark.createDataFrame(indexed, f"_i int, {schema}")
        return [r[1] for r in frame.select("_i", expression.alias("x")).orderBy("_i").collect()]
    return run
