"""Feeds whose files and micro-batches do not grow with the input."""

from pyspark.sql import functions as F

from gaugeline.plans import fixtures as fx
from gaugeline.sources.arrivals import file_table


def test_a_larger_feed_has_more_files_and_bounded_batches(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(fx, "_written", {})
    monkeypatch.setattr(fx, "FEED_ROWS", 20)
    monkeypatch.setattr(fx, "BATCH_FILES", 9)
    sent = fx.arrivals(spark, sf_dir).count()
    for path in (fx.feed_path, fx.misnamed_feed_path, fx.late_feed_path):
        sizes = [r["n"] for r in file_table(spark, path(spark, sf_dir)).groupBy(F.input_file_name()).agg(
            F.count("*").alias("n")).collect()]
        assert sum(sizes) == sent and len(sizes) >= sent // 20 and max(sizes) <= 60
    assert fx.batch_files(spark, sf_dir, 1) == min(9, fx.feed_share(spark, sf_dir))
    assert fx.batch_files(spark, sf_dir, 4) == 9


def test_a_small_feed_stays_eight_files(spark, sf_dir):
    assert [fx.batch_files(spark, sf_dir, n) for n in (1, 2, 4)] == [1, 2, 4]
