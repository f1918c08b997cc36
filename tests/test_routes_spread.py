"""Routed messages are made where the micro-batch lies."""

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from gaugeline.operators.decode import decode
from gaugeline.session import scratch_path
from gaugeline.streaming.station_job import FanOut


@pytest.mark.parametrize("files", [1, 2])
def test_routes_are_made_where_the_batch_lies(spark, arrivals_of, reading_json, files):
    rows = arrivals_of([reading_json(s_no=n, weather={"humidity": 90}) for n in range(40)]).repartition(4)
    task = F.udf(lambda: str(TaskContext.get().partitionId())).asNondeterministic()
    root = scratch_path(spark, "t-routes")
    sinks = FanOut(spark, root)
    sinks._rows = files * sinks.settings.archive_rows_per_task
    sinks._write_routed(decode(rows).withColumn("value", F.concat_ws("|", "value", task())), 0)
    routed = spark.read.parquet(f"{root}/routed/batch_id=0")
    assert routed.count() == 40
    assert routed.select(F.input_file_name()).distinct().count() == files
    assert routed.select(F.regexp_extract("value", r"\|(\d+)", 1)).distinct().count() == 4
