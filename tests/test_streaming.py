from __future__ import annotations

import datetime as dt

from helpers import rows
from pyspark.sql import functions as F

from airloom.sources.tables import Table
from airloom.streaming import ingest

DDL = "city string, ts timestamp_ntz, value double, seq int"
BASE = dt.datetime(2024, 1, 1)


def event(city, minute, value, seq=1):
    return (city, BASE + dt.timedelta(minutes=minute), value, seq)


def land(spark, path, events):
    spark.createDataFrame(events, DDL).coalesce(1).write.mode("append").parquet(path)


def test_incremental_upsert(spark, tmp_path):
    landing, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    table = Table(spark, str(tmp_path / "out"), monthly=True)

    def take():
        stream = spark.readStream.schema(DDL).parquet(landing)
        ingest.upsert_stream(stream, table, progress, seq="seq").awaitTermination()

    land(spark, landing, [event("a", 0, 1.0), event("a", 60, 2.0)])
    take()
    land(spark, landing, [event("a", 60, 5.0, 1), event("a", 60, None, 2), event("b", 0, 7.0)])
    take()
    take()  # nothing new
    assert rows(table.read(), "city", "value") == [("a", 1.0), ("a", None), ("b", 7.0)]


def test_prepare_runs_on_each_batch(spark, tmp_path):
    landing = str(tmp_path / "in")
    land(spark, landing, [event("a", 0, 1.0)])
    table = Table(spark, str(tmp_path / "out"))
    ingest.upsert_stream(
        spark.readStream.schema(DDL).parquet(landing), table, str(tmp_path / "p"), seq="seq",
        prepare=lambda b: b.withColumn("value", F.col("value") * 10)).awaitTermination()
    assert table.read().first()["value"] == 10.0


def test_hourly_stream_equals_batch(spark, tmp_path):
    landing = str(tmp_path / "in")
    events = [event(c, 7 * i, float(i)) for i in range(100) for c in ("a", "b")]
    land(spark, landing, events)
    stream = ingest.hourly_readings(spark.readStream.schema(DDL).parquet(landing))
    table = Table(spark, str(tmp_path / "out"))
    ingest.upsert_stream(stream, table, str(tmp_path / "p"), output_mode="update").awaitTermination()
    batch = ingest.hourly_readings(spark.read.parquet(landing))
    assert rows(table.read()) == rows(batch) and batch.count() == 2 * 12


def test_late_events_are_dropped(spark, tmp_path):
    landing, progress = str(tmp_path / "in"), str(tmp_path / "p")
    table = Table(spark, str(tmp_path / "out"))

    def take():
        hours = ingest.hourly_readings(spark.readStream.schema(DDL).parquet(landing))
        ingest.upsert_stream(hours, table, progress, output_mode="update").awaitTermination()

    land(spark, landing, [event("a", 0, 1.0), event("a", 600, 1.0)])
    take()
    land(spark, landing, [event("a", 1, 100.0), event("a", 590, 3.0)])  # the first is ten hours late
    take()
    got = {r["ts"].hour: r["total"] for r in table.read().collect()}
    assert got == {0: 1.0, 9: 3.0, 10: 1.0}


def test_first_arrival_wins(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    for value in (1.0, 2.0):
        land(spark, landing, [event("a", 0, value), event("b", 0, value)])
        stream = ingest.first_by_key(spark.readStream.schema(DDL).parquet(landing))
        ingest.append_stream(stream, out, str(tmp_path / "p")).awaitTermination()
    assert rows(spark.read.parquet(out), "city", "value") == [("a", 1.0), ("b", 1.0)]


def test_late_events_are_kept_and_replays_change_nothing(spark, tmp_path):
    table, late = Table(spark, str(tmp_path / "out"), monthly=True), str(tmp_path / "late")
    batches = [[event("a", 0, 1.0), event("a", 600, 2.0), ("a", None, 5.0, 1)], [event("a", 1, 100.0), event("a", 590, 3.0), event("a", 540, None)],
               [event("b", 479, 4.0), event("b", 700, 4.0)]]

    def state():
        return (rows(table.read(), "city", "ts", "n", "n_values", "total"), rows(spark.read.parquet(late), "city", "ts", "value", "batch"),
                table.snapshot()["marks"])

    for n, batch in enumerate(batches):
        ingest.fold_hours(spark.createDataFrame(batch, DDL), table, late, n)
    hour = lambda h: BASE + dt.timedelta(hours=h)
    want = [("a", hour(0), 1, 1, 1.0), ("a", hour(9), 2, 1, 3.0), ("a", hour(10), 1, 1, 2.0), ("b", hour(11), 1, 1, 4.0)]
    kept = [("a", None, 5.0, 0), ("a", BASE + dt.timedelta(minutes=1), 100.0, 1), ("b", BASE + dt.timedelta(minutes=479), 4.0, 2)]
    before = state()
    assert before[0] == sorted(want, key=repr) and before[1] == sorted(kept, key=repr) and before[2]["batch"] == 2
    for n in (1, 2):
        ingest.fold_hours(spark.createDataFrame(batches[n], DDL), table, late, n)
    assert state() == before
    ingest.fold_hours(spark.createDataFrame([], DDL), table, late, 3)
    assert state()[:2] == before[:2] and state()[2]["watermark"] == before[2]["watermark"]


def test_a_batch_that_fails_before_its_snapshot_runs_again(spark, tmp_path, monkeypatch):
    table, late = Table(spark, str(tmp_path / "out"), monthly=True), str(tmp_path / "late")
    ingest.fold_hours(spark.createDataFrame([event("a", 600, 1.0)], DDL), table, late, 0)
    batch = spark.createDataFrame([event("a", 1, 7.0), event("a", 601, 2.0)], DDL)
    with monkeypatch.context() as m:
        m.setattr(Table, "_commit", lambda self, state: (_ for _ in ()).throw(OSError("lost")))
        try:
            ingest.fold_hours(batch, table, late, 1)
        except OSError:
            pass
    ingest.fold_hours(batch, table, late, 1)
    assert rows(table.read(), "n", "total") == [(2, 3.0)] and rows(spark.read.parquet(late), "value") == [(7.0,)]


def test_late_duplicates_are_counted(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    late = []
    for events in ([event("a", 0, 1.0), event("b", 300, 1.0)], [event("a", 0, 2.0), event("b", 300, 2.0), event("c", 310, 2.0)]):
        land(spark, landing, events)
        stream = ingest.first_by_key(spark.readStream.schema(DDL).parquet(landing))
        run = ingest.append_stream(stream, out, str(tmp_path / "p"))
        run.awaitTermination()
        late.append(ingest.late_rows(run))
    assert rows(spark.read.parquet(out), "city", "value") == [("a", 1.0), ("b", 1.0), ("c", 2.0)] and late == [0, 1]
