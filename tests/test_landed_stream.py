"""Tables landed for streams: files of a bounded number of rows, in a fixed number of batches."""

import os

import pytest

from openroles.catalog import streams
from openroles.catalog.views import Views
from openroles.session import scratch_path
from openroles.streaming import incremental as inc

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
def test_batches_of_a_large_table_have_many_files(spark, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    v, root = Views(spark, FOLDER), scratch_path(spark, "landed-stream")
    stream = streams.landed_stream(v, root, "lineitem")
    files = len(spark.read.parquet(f"{root}/in").inputFiles())
    assert files >= v("lineitem").count() / 100
    sizes = []
    inc._merge_stream(stream, f"{root}/state", lambda batch, _: sizes.append(batch.count())).awaitTermination()
    assert len(sizes) == streams.BATCHES and sum(sizes) == v("lineitem").count()


def test_state_of_first_rows_holds_a_row_once(spark):
    rows = spark.createDataFrame([("k", 2, "b"), ("k", 1, "c"), ("k", 1, "a"), ("l", 3, None)], "key string, at int, x string")
    firsts = inc.first_of_each(rows, "key", ["at"])
    assert sorted(firsts.select("key", "at", "x").collect()) == [("k", 1, "a"), ("l", 3, None)]
    assert "min_by" not in firsts._jdf.queryExecution().optimizedPlan().toString()
