"""Streams on stateful processors: what they keep, restarts, pieces of hot keys, ends and handovers."""

import pytest
from helpers import events, rows, stream_of, write_batches
from pyspark.sql import functions as F

from tidemark import operators, streaming
from tidemark.functions.geo import ride_event_time
from tidemark.plans import views
from tidemark.plans.runs import run_appending
from tidemark.shared import scratch_dir

SUMMARY = ("start_ts", "end_ts", "n_events", "length_ms", "max_speed", "avg_speed")


@pytest.fixture
def feed(spark, tmp_path):
    def start(*frames, name="in"):
        path = str(tmp_path / name)
        write_batches(frames, path)
        return stream_of(spark, frames[0].schema, path)

    return start


@pytest.fixture
def end(spark):
    return streaming.EndMarker.of(spark, f"{scratch_dir(spark)}/end")


def speeds(rng, cars, first, last, step=1):
    """Events of some cars, with stops and a few unknown speeds."""
    data = []
    for s in range(first, last, step):
        for car in cars:
            kind = rng.random()
            data.append((car, s + rng.random() * 0.9, 0.0 if kind < 0.1 else None if kind < 0.15 else float(rng.integers(1, 90))))
    return data


def with_ids(spark, batches):
    """Frames of events with ids that go on from frame to frame."""
    out, n = [], 0
    for batch in batches:
        out.append(events(spark, batch).withColumn("event_id", F.col("event_id") + n))
        n += len(batch)
    return out


def union(frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def rounded(df, *columns):
    return rows(df.withColumn("avg_speed", F.round("avg_speed", 6)), *columns)


def progress_of(spark, stream, tmp_path, name="q"):
    with streaming.strict_lateness(spark), streaming.keyed_processors(spark):
        query = (
            stream.writeStream.format("noop")
            .option("checkpointLocation", str(tmp_path / f"cp-{name}"))
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    return [p for p in query.recentProgress if p["numInputRows"]]


def test_a_batch_writes_what_it_brings_and_not_what_is_held(spark, feed, tmp_path):
    import numpy as np

    rng = np.random.default_rng(1)
    frames = with_ids(spark, [speeds(rng, "ab", i * 100, i * 100 + 100) for i in range(6)])
    # Nothing becomes due, so all rows stay held.
    stream = streaming.with_event_watermark(feed(*frames), lag_ms=10**9)
    found = progress_of(spark, streaming.stop_segments_stream(stream, ["car_id"], stretch="10 seconds"), tmp_path)
    written = [p["stateOperators"][0]["customMetrics"]["rocksdbTotalBytesWritten"] for p in found]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in found]
    assert len(written) == 6 and held[-1] > 5 * held[0]
    assert max(written[1:]) < 1.5 * min(written[1:])


def test_join_state_written_does_not_grow(spark, feed, tmp_path):
    def part(name, i):
        ids = spark.range(i * 100, i * 100 + 100)
        return ids.select(F.col("id").alias("trade_id"), (F.col("id") % 2).alias("customer_id"),
                          F.timestamp_seconds(F.col("id") + 10**9).alias("ts"), F.lit(name).alias("value"))

    streams = [feed(*[part(n, i) for i in range(5)], name=n) for n in ("t", "c")]
    trades, customers = (streaming.with_event_watermark(s, lag_ms=10**9) for s in streams)
    joined = streaming.event_time_join_stream(trades, customers.drop("trade_id"), stretch="10 seconds")
    found = progress_of(spark, joined, tmp_path)
    written = [p["stateOperators"][0]["customMetrics"]["rocksdbTotalBytesWritten"] for p in found]
    assert len(written) == 5 and max(written[1:]) < 1.5 * min(written[1:])


def test_segments_restart_from_checkpoint(spark, tmp_path):
    import numpy as np

    rng = np.random.default_rng(2)
    frames = with_ids(spark, [speeds(rng, "ab", i * 50, i * 50 + 50) for i in range(4)] + [[("z", 10**6, 1.0)]])

    def run(some):
        write_batches(some, str(tmp_path / "in"))
        stream = streaming.with_event_watermark(stream_of(spark, frames[0].schema, str(tmp_path / "in")), lag_ms=7000)
        segments = streaming.stop_segments_stream(stream, ["car_id"], stretch="10 seconds")
        with streaming.strict_lateness(spark), streaming.keyed_processors(spark):
            query = (
                segments.writeStream.format("parquet")
                .option("checkpointLocation", str(tmp_path / "cp"))
                .trigger(availableNow=True)
                .start(str(tmp_path / "out"))
            )
        query.awaitTermination()

    run(frames[:2])
    run(frames[2:])
    want = operators.stop_segments(union(frames), ["car_id"])
    assert rounded(spark.read.parquet(str(tmp_path / "out"))) == rounded(want) != []


@pytest.mark.parametrize("keys", [[], ["car_id"]])
def test_segments_in_pieces_equal_a_table(spark, feed, end, keys):
    import numpy as np

    rng = np.random.default_rng(3)
    batches = [speeds(rng, "ab", i * 40, i * 40 + 40) for i in range(3)]
    # One car moves on without a stop for many pieces.
    batches.append([("c", float(s), 5.0) for s in range(120, 400, 3)] + [("c", 401.0, 0.0)])
    frames = with_ids(spark, batches)
    stream = streaming.with_end(feed(*frames), end, "5 seconds")
    out = run_appending(streaming.stop_segments_stream(stream, keys, piece="20 seconds"), end, chained=True)
    want = operators.stop_segments(union(frames), keys)
    assert rounded(out, *keys, *SUMMARY) == rounded(want, *keys, *SUMMARY)
    assert want.count() > 20


def test_pieces_are_asked_for_without_keys(spark, feed):
    stream = streaming.with_event_watermark(feed(events(spark, [("a", 0, 1.0)])))
    with pytest.raises(ValueError):
        streaming.stop_segments_stream(stream)


def test_no_task_holds_more_than_a_piece():
    from tidemark.streaming.segments import _runs_of_piece

    import numpy as np

    us = np.arange(1000)
    speed = np.where(us % 10 == 9, 0.0, 1.0)
    runs = _runs_of_piece(5, us, us, speed)
    # Of a hundred runs one goes to the step that joins pieces; the others pass it by.
    assert len(runs) == 100 and (runs["lane"] == 0).sum() == 1
    runs = _runs_of_piece(5, us, us, np.ones(1000))
    assert runs[["lane", "closed", "n"]].values.tolist() == [[0, False, 1000]]
    assert _runs_of_piece(5, us[:0], us[:0], speed[:0]).empty


def ride_frames(spark, sf_dir, hot=False):
    rides = views.rides(spark, sf_dir).where("ride_id < 400")
    if hot:
        # Nine of ten rides end in one cell, in one direction.
        for c, v in (("start_lon", -74.0), ("start_lat", 40.6), ("end_lon", -73.9), ("end_lat", 40.8)):
            moved = F.lit(v) + (F.col("ride_id") % 97) / 1e4 * (1 if "end" in c else -1)
            rides = rides.withColumn(c, F.when(F.col("ride_id") % 10 > 0, moved).otherwise(F.col(c)))
    return [rides.where(f"ride_id between {i * 100} and {i * 100 + 99}") for i in range(4)]


@pytest.mark.parametrize("hot", [False, True])
def test_predictions_in_pieces_equal_a_table(spark, feed, end, sf_dir, hot):
    frames = ride_frames(spark, sf_dir, hot)
    rides = feed(*frames).withColumn("ts", ride_event_time())
    # Records come out of order by up to an hour.
    stream = streaming.with_end(rides, end, "2 hours")
    predicted = streaming.predict_travel_time_stream(stream, grid=views.COARSE_GRID, piece="2 days")
    out = run_appending(predicted, end, chained=True)
    want = operators.predict_travel_time(union(frames), grid=views.COARSE_GRID)
    assert rows(out) == rows(want)
    assert want.where("predicted_minutes is not null").count() > (100 if hot else 20)


def test_hot_model_is_spread_over_tasks(spark, sf_dir):
    from tidemark.operators.prediction import trips
    from tidemark.streaming.pieces import in_pieces

    frames = ride_frames(spark, sf_dir, hot=True)
    rows_ = trips(union(frames), grid=views.COARSE_GRID).withColumn("event_us", F.unix_micros("ts"))
    most = rows_.groupBy("cell", "bucket").count().agg(F.max("count")).first()[0]
    piece = in_pieces(rows_, ["cell", "bucket"], 2 * 86_400 * 10**6).count().agg(F.max("count")).first()[0]
    assert most > 0.8 * rows_.count() and piece < 0.5 * most


def test_handover_from_table_to_stream(spark, feed, sf_dir):
    frames = ride_frames(spark, sf_dir)
    early = union(frames[:2])
    models = operators.travel_models(early, grid=views.COARSE_GRID)
    stream = feed(*frames[2:])
    later = run_appending(streaming.predict_travel_time_stream(stream, grid=views.COARSE_GRID, models=models))
    before = operators.predict_travel_time(early, grid=views.COARSE_GRID)
    want = operators.predict_travel_time(union(frames), grid=views.COARSE_GRID)
    assert rows(before.unionByName(later)) == rows(want)


def test_end_gives_what_is_left(spark, feed, end):
    frames = with_ids(spark, [[("a", 0, 1.0), ("b", 3, 1.0)], [("a", 5, 2.0), ("a", 40, 3.0)], [("b", 41, 4.0)]])
    stream = streaming.with_end(feed(*frames), end, "5 seconds")
    assert stream.columns == frames[0].columns
    out = run_appending(operators.gap_segments(stream, ["car_id"]), end, processors=False)
    assert rows(out, "car_id", *SUMMARY) == rows(operators.gap_segments(union(frames), ["car_id"]), "car_id", *SUMMARY)


def test_end_passes_filters_that_events_do_not(spark, feed, end):
    frames = with_ids(spark, [[("a", 0, 1.0), ("b", 3, 1.0)]])
    stream = streaming.with_end(feed(*frames), end, "5 seconds").where("car_id = 'a' and speed > 0")
    out = run_appending(streaming.event_time_sort_stream(stream, ["car_id"]), end, processors=False)
    assert rows(out, "car_id", "ts") == [("a", 0.0)]


def test_words_change_by_change(spark, feed):
    texts = ["to be or not", "to be be", None, "", "Not to", "be or be to", "x" * 50, "to"]
    lines = spark.createDataFrame(list(enumerate(texts)), "line int, text string")
    frames = [lines.where(f"line div 3 = {i}") for i in range(3)]
    stream = streaming.word_running_count_stream(feed(*frames), "line", lines_per_piece=2, buckets=3)
    out = run_appending(stream, chained=True)
    want = operators.word_running_count(lines, ["line"])
    columns = ("line", "pos", "word", "cnt")
    assert rows(out, *columns) == rows(want, *columns) and out.schema["line"].dataType.typeName() == "integer"


def test_words_go_through_the_steps_as_lines(spark, feed):
    lines = spark.createDataFrame([(1, "to be to"), (1, "be to to"), (None, "to"), (2, " - ")], "line int, text string")
    stream = streaming.word_running_count_stream(feed(lines), "line")
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert plan.index("Generate") < plan.index("TransformWithState") and plan.count("Generate") == 1
    out = run_appending(stream, chained=True)
    want = operators.word_running_count(lines.where("line is not null"), ["line"])
    assert rows(out, "line", "pos", "word", "cnt") == rows(want, "line", "pos", "word", "cnt")


def test_panes_give_the_same_places_with_less_state(spark, tmp_path, sf_dir):
    rides = views.rides(spark, sf_dir)
    frames = [rides.where(f"ride_id between {i * 250} and {i * 250 + 249}") for i in range(4)]
    found, held = [], []
    for by_panes in (False, True):
        write_batches(frames, str(tmp_path / f"in-{by_panes}"))
        stream = streaming.with_ride_watermark(stream_of(spark, rides.schema, str(tmp_path / f"in-{by_panes}")), "3 days")
        places = operators.popular_places(
            stream, grid=views.COARSE_GRID, window="24 hours", slide="2 hours", threshold=2, by_panes=by_panes
        )
        query = (
            places.writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / f"cp-{by_panes}"))
            .trigger(availableNow=True)
            .start(str(tmp_path / f"out-{by_panes}"))
        )
        query.awaitTermination()
        held.append(max(sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress))
        found.append(spark.read.parquet(str(tmp_path / f"out-{by_panes}")))
    assert rows(found[0]) == rows(found[1]) != []
    assert held[1] < held[0] / 2


def test_panes_need_a_slide_that_divides(spark, sf_dir):
    with pytest.raises(ValueError):
        operators.popular_places(views.rides(spark, sf_dir), window="15 minutes", slide="4 minutes", by_panes=True)
