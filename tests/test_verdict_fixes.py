"""Late first-seen readings, cleared messages and extreme numbers."""

from pyspark.sql import functions as F

from gaugeline.config import PipelineSettings
from gaugeline.operators import metrics, sequences
from gaugeline.session import scratch_path, streaming_session
from gaugeline.sources.arrivals import file_stream
from gaugeline.streaming import dedup


def test_late_first_seen_readings_are_kept(spark, arrivals_of, reading_json):
    """Eight files in eight micro-batches; arrival times run backwards by days, and the
    last file repeats the first."""
    path = scratch_path(spark, "late-feed")
    for k in range(8):
        texts = [reading_json(s_no=10 * (k % 7) + i) for i in range(3)]
        at = F.timestamp_seconds(F.lit(1_700_000_000 - 86_400 * k) + F.col("kafka_offset"))
        arrivals_of(texts, key=f"k{k}").withColumn("arrival_ts", at).coalesce(1).write.mode("append").parquet(path)
    session = streaming_session(spark, 2)
    rows = dedup.unique_readings(file_stream(session, path, 1), PipelineSettings().dedup_horizon)
    out = scratch_path(spark, "late-out")
    query = rows.select("station_id", "s_no").writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", scratch_path(spark, "late-checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    kept = sorted(r["s_no"] for r in spark.read.parquet(out).collect())
    assert kept == sorted(10 * k + i for k in range(7) for i in range(3))


def test_extreme_sequence_numbers(spark):
    low, high = -(2 ** 63), 2 ** 63 - 1
    sent = spark.createDataFrame([(1, low, 1), (1, high, 2), (2, 5, 1), (2, 8, 2)],
                                 "station_id bigint, s_no bigint, kafka_offset bigint")
    gaps = {r["station_id"]: (r["gap_from"], r["gap_to"], r["missing"]) for r in sequences.gap_list(sent).collect()}
    assert gaps == {1: (low + 1, high - 1, None), 2: (6, 7, 2)}
    lost = {r["station_id"]: r["lost"] for r in sequences.lost_readings(sent).collect()}
    assert lost == {1: None, 2: 2}


def test_timings_of_zero(spark):
    timings = spark.createDataFrame([("read", 0), ("read", 0)], "op string, ns bigint")
    assert metrics.op_latency(timings).first()["ops_per_second"] is None
