from pyspark.sql import functions as F

from gaugeline.operators import latest as L
from gaugeline.operators.decode import decode
from gaugeline.operators.dedup import eviction_set, keep_first, older_than
from gaugeline.operators.validate import accepted
from gaugeline.session import scratch_path
from gaugeline.sources.latest_store import LatestStore, export_csv, read_csv_export


def test_invalid_copy_does_not_hide_a_valid_one(arrivals_of, reading_json):
    bad = reading_json(weather={"humidity": 130})
    good = reading_json()
    rows = keep_first(accepted(decode(arrivals_of([bad, good, good])))).collect()
    assert [(r.value, r.kafka_offset) for r in rows] == [(good, 1)]


def test_dedup_prunes_copies_before_the_shuffle(arrivals_of, reading_json):
    plan = keep_first(accepted(decode(arrivals_of([reading_json()])))) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange") == 1


def test_eviction_set(spark):
    tracked = spark.range(100).select(
        F.lit(1).alias("station_id"), "id", F.col("id").alias("s_no"),
        (1000 - F.col("id")).alias("recorded_at"))
    gone = eviction_set(tracked, capacity=50).collect()
    assert [r.s_no for r in gone] == [99, 98, 97, 96, 95]
    assert eviction_set(tracked, capacity=100).count() == 0
    assert older_than(tracked, 910).count() == 9


def test_latest_is_by_arrival_not_by_reading_time(arrivals_of, reading_json):
    first = reading_json(s_no=5, status_timestamp=2_000_000_000)
    second = reading_json(s_no=4, status_timestamp=1_000_000_000)
    rows = L.latest_by_station(accepted(decode(arrivals_of([first, second])))).collect()
    assert [(r.key, r.value) for r in rows] == [("1", second)]


def test_lookups_and_reconciliation(spark):
    stored = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "key STRING, value STRING")
    probes = spark.createDataFrame([("a",), ("a",), ("z",)], "key STRING")
    counts = {r.key: (r.probes, r.hits, r.misses) for r in L.lookup_counts(probes, stored).collect()}
    assert counts == {"a": (2, 2, 0), "z": (1, 0, 1)}
    assert [r.key for r in L.missing_keys(probes, stored).collect()] == ["z"]
    assert L.batch_lookup(probes, stored).where("value IS NULL").count() == 1
    wanted = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None), ("d", "4")],
                                   "key STRING, value STRING")
    extra = stored.union(spark.createDataFrame([("e", "5")], "key STRING, value STRING"))
    status = {r.key: r.status for r in L.reconcile(wanted, extra).collect()}
    assert status == {"a": "ok", "b": "mismatch", "c": "ok", "d": "missing", "e": "extra"}
    assert L.point_lookup(stored, "nope").count() == 0


def test_compact_log_last_write_wins(spark):
    log = spark.createDataFrame(
        [("s1", 1, "k", "old"), ("s1", 9, "k", "mid"), ("s2", 2, "k", "new"), ("s1", 3, "j", "x")],
        "segment STRING, pos BIGINT, key STRING, value STRING")
    assert {r.key: r.value for r in L.compact_log(log).collect()} == {"k": "new", "j": "x"}


def test_latest_store_retries_and_compaction(spark, arrivals_of, reading_json):
    store = LatestStore(spark, scratch_path(spark, "t-latest"))
    assert store.read().count() == 0
    texts = [reading_json(s_no=n, station_id=1 + n % 2) for n in range(6)]
    rows = accepted(decode(arrivals_of(texts)))
    early, late = rows.where("kafka_offset < 3"), rows.where("kafka_offset >= 3")

    def state():
        return {r.key: r.value for r in store.read().collect()}

    store.write_batch(early, 0)
    store.write_batch(early, 0)
    assert state() == {"1": texts[2], "2": texts[1]}
    assert store.compact() == 1
    assert state() == {"1": texts[2], "2": texts[1]}
    store.write_batch(late, 1)
    assert state() == {"1": texts[4], "2": texts[5]}
    store.write_batch(early, 0)
    assert store.compact() == 2
    assert state() == {"1": texts[4], "2": texts[5]}


def test_csv_export_quotes_everything(spark):
    rows = [("1", '{"a":"b,c"}'), ("2", 'line\nbreak "q"')]
    path = scratch_path(spark, "t-csv")
    export_csv(spark.createDataFrame(rows, "key STRING, value STRING"), path)
    back = read_csv_export(spark, path).orderBy("key").collect()
    assert [tuple(r) for r in back] == rows
    text = "".join(sorted(r.value + "\n" for r in spark.read.text(path).collect()))
    assert '"1","{""a"":""b,c""}"' in text
