"""Streams: late parts, markers, upserts over months, windows; restarts from checkpoints."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rastrum.streaming import completion, markers, upsert
from rastrum.streaming.staging import drained, file_stream

PART = "tile_id long, scene_id string, at timestamp, px array<int>"
N = -9999
T0 = datetime(2024, 6, 1)


def test_tiles_complete_once_over_a_restart(spark, tmp_path):
    day = lambda k: T0 + timedelta(days=k)
    put = lambda *rows: spark.createDataFrame(list(rows), PART).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    told = lambda: sorted((r["tile_id"], r["status"], r["parts"], r["missing"], r["last_scene"], r["px"]) for r in completion.run(spark, f"{tmp_path}/in", f"{tmp_path}/run", PART).collect())
    put((1, "a", day(0), [1, N, N]), (2, "a", day(0), [1, 2, 3]), (3, "a", day(0), [N, N, 7]), (4, "a", day(0), [1, N, 1]))
    assert told() == [(2, "complete", 1, 0, "a", [1, 2, 3])]
    # A new run goes on with the state of the one before; a part of a complete tile changes nothing.
    put((1, "b", day(1), [9, 5, None]), (2, "b", day(1), [7, 7, 7]), (1, "c", day(2), [8, 8, 8]), (4, "b", day(1), None))
    assert told() == [(1, "complete", 3, 0, "c", [1, 5, 8]), (2, "complete", 1, 0, "a", [1, 2, 3])]
    # Time moves on: tiles that nobody completes are told as abandoned; state goes.
    put((9, None, day(60), None))
    last = told()
    assert last[2:] == [(3, "abandoned", 1, 2, "a", [N, N, 7]), (4, "abandoned", 1, 1, "a", [1, N, 1])] and len(last) == 4
    put((3, "z", day(70), [4, 4, 4]))
    assert (3, "complete", 1, 0, "z", [4, 4, 4]) in told()


def test_steps_wait_for_their_markers(spark, tmp_path):
    at = lambda h: T0 + timedelta(hours=h)
    step, mark = "k long, step long, ts timestamp", "k long, marker long, m_ts timestamp"
    put = lambda rows, kind, to: spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{to}")

    def told():
        s, m = file_stream(spark, f"{tmp_path}/s", step), file_stream(spark, f"{tmp_path}/m", mark)
        drained(markers.gated(s, m, "k").writeStream.format("parquet").outputMode("append").option("path", f"{tmp_path}/out"), f"{tmp_path}/c")
        rows = spark.read.schema("k long, step long, ts timestamp, marker long, m_ts timestamp").parquet(f"{tmp_path}/out")
        return sorted((r["step"], r["status"], r["marker"]) for r in markers.first_marker(rows, "k").where("k > 0 and step is not null").collect())

    put([(1, 10, at(0)), (2, 20, at(0)), (3, 30, at(0)), (4, None, at(0)), (None, 50, at(0))], step, "s")
    put([(1, 11, at(1))], mark, "m")
    assert told() == [(10, "released", 11)]
    put([(2, 22, at(11)), (2, 21, at(9)), (3, 31, at(13)), (1, 12, at(2))], mark, "m")  # late, twice; and beyond the grace
    assert told() == [(10, "released", 11), (20, "released", 21)]
    put([(-1, 0, at(500))], step, "s")
    put([(-1, 0, at(500))], mark, "m")
    assert told() == [(10, "released", 11), (20, "released", 21), (30, "left over", None)]


def test_upserts_move_keys_between_months(spark, tmp_path):
    kind = "k long, ts timestamp, ym string"
    row = lambda k, month, day: (k, datetime(2024, month, day), f"2024-{month:02}")
    sink = upsert.upsert_into(spark, f"file://{tmp_path}/t", ["k"], [F.col("ts").desc()])
    now = lambda: [(r["k"], r["ym"], r["ts"].day) for r in upsert.current(spark, f"file://{tmp_path}/t", kind).orderBy("k", "ts").collect()]
    first = spark.createDataFrame([row(1, 1, 5), row(1, 1, 9), row(2, 1, 3), row(3, 2, 2)], kind)
    sink(first, 0)
    assert now() == [(1, "2024-01", 9), (2, "2024-01", 3), (3, "2024-02", 2)]
    sink(spark.createDataFrame([row(1, 2, 1), row(2, 1, 1), row(4, 3, 1), row(None, 3, 2)], kind), 1)
    assert now() == [(None, "2024-03", 2), (1, "2024-02", 1), (2, "2024-01", 3), (3, "2024-02", 2), (4, "2024-03", 1)]
    sink(first, 0)  # a batch that comes again
    sink(spark.createDataFrame([row(1, 1, 30)], kind), 2)  # late for its key: the newer one stays
    assert now() == [(None, "2024-03", 2), (1, "2024-02", 1), (2, "2024-01", 3), (3, "2024-02", 2), (4, "2024-03", 1)]
    sink(spark.createDataFrame([], kind), 3)
    sink(spark.createDataFrame([row(None, 4, 1)], kind), 4)
    assert len(now()) == 5 and now()[0] == (None, "2024-04", 1)
