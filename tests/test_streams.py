"""Streams, fed file by file, against golden cases and the batch operators."""

import pytest
from helpers import DAY, at, events, rows, stream_of, write_batches
from pyspark.sql import functions as F

from tidemark import operators, sources, streaming
from tidemark.plans import views
from tidemark.plans.runs import run_appending, run_updating
from tidemark.streaming.ordering import sorted_batches


@pytest.fixture
def feed(spark, tmp_path):
    """A stream over frames, one micro-batch each."""

    def start(*frames, name="in"):
        path = str(tmp_path / name)
        write_batches(frames, path)
        return stream_of(spark, frames[0].schema, path)

    return start


@pytest.fixture(scope="module")
def split_cars(spark, sf_dir):
    """Car events as four frames in time order, of which the second is badly out of order."""
    cars = views.car_events(spark, sf_dir)
    quarter = F.floor(F.col("event_id") * 4 / cars.count())
    swapped = F.when(F.col("event_id") % 40 == 7, quarter - 1).otherwise(quarter)
    numbered = cars.withColumn("part", F.greatest(swapped, F.lit(0)))
    return [numbered.where(F.col("part") == i).drop("part").cache() for i in range(4)]


def _all(frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _cut(df, lag_ms):
    newest = df.agg(F.unix_millis(F.max("ts"))).first()[0]
    return F.timestamp_millis(F.lit(newest - lag_ms))


def test_word_count(spark, feed):
    lines = [spark.createDataFrame([(t,)], "text string") for t in ("a b a", "b a.", "C")]
    updates = run_updating(operators.word_count(feed(*lines)))
    assert rows(updates, "batch", "word", "cnt") == [
        (0, "a", 2),
        (0, "b", 1),
        (1, "a", 3),
        (1, "b", 2),
        (2, "c", 1),
    ]


def test_event_time_sort(spark, feed):
    batches = [[10, 5, 20], [15, 16, 12, 30], [50]]
    frames = [events(spark, [("a", s, 1.0) for s in b]) for b in batches]
    stream = streaming.with_event_watermark(feed(*frames), lag_ms=5000)
    out = run_appending(streaming.event_time_sort_stream(stream, ["car_id"]))
    assert [r[0] for r in rows(out.select(out.ts))] == [10.0, 16.0, 20.0, 30.0, 5.0]


def test_event_time_sort_batches_are_in_order(spark, feed, tmp_path):
    data = [[("a", 10), ("b", 7), ("a", 5)], [("b", 30), ("a", 21)], [("a", 60)], [("a", 90)]]
    frames = [events(spark, [(k, s, 1.0) for k, s in batch]) for batch in data]
    stream = streaming.with_event_watermark(feed(*frames), lag_ms=5000)
    seen = []

    def write(batch, batch_id):
        seen.append([(r.car_id, r.ts.timestamp()) for r in batch.collect()])

    with streaming.strict_lateness(spark):
        query = (
            streaming.event_time_sort_stream(stream, ["car_id"])
            .writeStream.foreachBatch(sorted_batches(["car_id"], ["ts"], write))
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    assert all(batch == sorted(batch) for batch in seen)
    for car in "ab":
        times = [t for batch in seen for k, t in batch if k == car]
        assert times == sorted(times) and times


def test_late_rows_are_dropped_before_sorting(spark, feed, split_cars):
    stream = streaming.with_event_watermark(feed(*split_cars), lag_ms=3_600_000)
    out = run_appending(streaming.event_time_sort_stream(stream, ["car_id"]))
    # What the watermark of the batches before leaves of each batch.
    newest, kept = None, []
    for frame in split_cars:
        times = [(r.event_id, r.ts) for r in frame.collect()]
        kept += [e for e, t in times if newest is None or t.timestamp() > newest - 3600]
        newest = max([t.timestamp() for _, t in times] + ([newest] if newest else []))
    cut = _cut(_all(split_cars), 3_600_000)
    due = _all(split_cars).where(F.col("ts") <= cut).where(F.col("event_id").isin(kept))
    assert rows(out, "event_id") == rows(due, "event_id")


def test_gap_segments(spark, feed, sf_dir):
    cars = views.car_events(spark, sf_dir)
    frames = [cars.where(f"event_id % 3 = {i}") for i in range(3)]
    lag = 40 * 24 * 3_600_000  # all of the table, so nothing is late
    last = events(spark, [(0, 100 * 86_400, 1.0)], "long")
    stream = streaming.with_event_watermark(feed(*frames, last), lag_ms=lag)
    out = run_appending(operators.gap_segments(stream, ["car_id"], "6 hours"))
    want = operators.gap_segments(cars, ["car_id"], "6 hours")
    columns = ("car_id", "start_ts", "end_ts", "n_events", "length_ms", "max_speed")
    assert rows(out, *columns) == rows(want, *columns)


def test_popular_places_filter_does_not_hold_back_time(spark, feed):
    def ride(ride_id, s, lon):
        frame = spark.createDataFrame([(float(s),)], "s double").select(at("s").alias("t"))
        cells = f"{ride_id}L ride_id, true is_start, t start_time, t end_time"
        return frame.selectExpr(
            *cells.split(", "), f"{lon}D start_lon", "40.75D start_lat", "-73.9D end_lon", "40.6D end_lat"
        )

    inside, outside = ride(1, 0, -73.98), ride(2, 3600, -80.0)
    stream = streaming.with_ride_watermark(feed(inside, outside))
    out = run_appending(operators.popular_places(stream, threshold=0))
    # The ride outside the area closes the windows of the one inside.
    assert [r[0] - DAY * 1000 for r in rows(out, "window_end")] == [300_000, 600_000, 900_000]


def test_stop_segments_golden(spark, feed):
    data = [(0, 10.0), (5, 20.0), (9, 0.0), (12, 0.0), (20, 30.0), (30, 0.0), (40, 15.0)]
    shuffled = [data[3], data[0], data[2], data[1]], [data[5], data[4], data[6]], [(100, 1.0)]
    frames = [events(spark, [("a", *d) for d in batch]) for batch in shuffled]
    stream = streaming.with_event_watermark(feed(*frames), lag_ms=5000)
    out = run_appending(streaming.stop_segments_stream(stream, ["car_id"]))
    assert rows(out) == [
        ("a", 0.0, 9.0, 3, 9000, 20.0, 10.0),
        ("a", 20.0, 30.0, 2, 10000, 30.0, 15.0),
    ]


def test_stop_segments_like_batch(spark, feed, split_cars):
    lag = 40 * 24 * 3_600_000
    last = events(spark, [(0, 100 * 86_400, 1.0)], "long")
    stream = streaming.with_event_watermark(feed(*split_cars, last), lag_ms=lag)
    out = run_appending(streaming.stop_segments_stream(stream, ["car_id"]))
    want = operators.stop_segments(_all(split_cars), ["car_id"])
    columns = ("car_id", "start_ts", "end_ts", "n_events", "length_ms", "max_speed")
    assert rows(out, *columns) == rows(want, *columns)


def _trades(spark, data):
    frame = spark.createDataFrame(data, "trade_id long, customer_id string, s double")
    return frame.select("trade_id", "customer_id", at("s").alias("ts"))


def _customers(spark, data):
    frame = spark.createDataFrame(data, "customer_id string, s double, value string")
    return frame.select("customer_id", at("s").alias("ts"), "value")


@pytest.mark.parametrize("salts", [1, 3])
def test_event_time_join(spark, feed, salts):
    trades = feed(
        _trades(spark, [(i, "c", float(s)) for i, s in enumerate((5, 10, 15))] + [(9, "d", 8.0)]),
        _trades(spark, [(3, "c", 25.0)]),
        _trades(spark, [(4, "c", 99.0)]),
        name="trades",
    )
    customers = feed(
        _customers(spark, [("c", 20.0, "B"), ("c", 10.0, "A")]),
        _customers(spark, [("c", 24.0, None)]),
        _customers(spark, [("x", 99.0, "X")]),
        name="customers",
    )
    trades, customers = (
        streaming.with_event_watermark(s, lag_ms=5000) for s in (trades, customers)
    )
    out = run_appending(streaming.event_time_join_stream(trades, customers, salts=salts))
    found = {r.trade_id: r.customer and r.customer["value"] for r in out.collect()}
    assert found == {0: None, 1: "A", 2: "A", 3: None, 9: None}
    known = out.where("trade_id = 3").first().customer
    assert known is not None and known["ts"].timestamp() == DAY + 24
    assert out.where("final").count() == 5


def test_event_time_join_early(spark, feed):
    trades = feed(_trades(spark, [(0, "c", 15.0)]), _trades(spark, [(1, "d", 99.0)]), name="t")
    customers = feed(
        _customers(spark, [("c", 10.0, "A")]),
        _customers(spark, [("c", 12.0, "B"), ("x", 99.0, "X")]),
        name="c",
    )
    trades, customers = (
        streaming.with_event_watermark(s, lag_ms=5000) for s in (trades, customers)
    )
    out = run_appending(streaming.event_time_join_stream(trades, customers, early=True))
    assert rows(out.select("trade_id", "final", "customer.value")) == [
        (0, False, "A"),
        (0, True, "B"),
        (1, False, None),
    ]


def test_event_time_join_like_batch(spark, feed, sf_dir):
    trades, customers = views.trades(spark, sf_dir), views.customers(spark, sf_dir)
    streams = [
        feed(*[t.where(f"{F_ID} % 3 = {i}") for i in range(3)], name=name)
        for t, name, F_ID in ((trades, "t", "trade_id"), (customers, "c", "unix_micros(ts)"))
    ]
    lag = 40 * 24 * 3_600_000
    streams = [streaming.with_event_watermark(s, lag_ms=lag) for s in streams]
    out = run_appending(streaming.event_time_join_stream(*streams, early=True))
    # With this lag nothing becomes due; every trade is given early, once.
    assert rows(out, "trade_id", "final") == rows(trades.selectExpr("trade_id", "false final"))


def test_predict_travel_time_like_batch(spark, feed, sf_dir):
    rides = views.rides(spark, sf_dir)
    frames = [rides.where(f"ride_id between {i * 250} and {i * 250 + 249}") for i in range(4)]
    out = run_appending(
        streaming.predict_travel_time_stream(feed(*frames), grid=views.COARSE_GRID)
    )
    want = operators.predict_travel_time(_all(frames), grid=views.COARSE_GRID)
    assert rows(out) == rows(want)
    assert want.where("predicted_minutes is not null").count() > 100


def test_restart_from_checkpoint(spark, tmp_path, sf_dir):
    rides = views.rides(spark, sf_dir)
    frames = [rides.where(f"ride_id between {i * 250} and {i * 250 + 249}") for i in range(4)]

    def run(upto):
        write_batches(frames[upto - 2 : upto], str(tmp_path / "in"))
        stream = stream_of(spark, rides.schema, str(tmp_path / "in"))
        predicted = streaming.predict_travel_time_stream(stream, grid=views.COARSE_GRID)
        with streaming.keyed_processors(spark):
            query = (
                predicted.writeStream.option("checkpointLocation", str(tmp_path / "cp"))
                .trigger(availableNow=True)
                .start(str(tmp_path / "out"), format="parquet")
            )
        query.awaitTermination()

    run(2)
    run(4)
    want = operators.predict_travel_time(_all(frames), grid=views.COARSE_GRID)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(want)


def test_place_documents_are_written_once(spark, feed, tmp_path, sf_dir):
    rides = views.rides(spark, sf_dir)
    stream = streaming.with_ride_watermark(feed(rides))
    places = operators.popular_places(
        stream, grid=views.COARSE_GRID, window="24 hours", slide="8 hours", threshold=2
    )
    path = str(tmp_path / "docs")
    write = sources.folder_writer(path)

    def twice(documents, batch_id):
        write(documents, batch_id)
        write(documents, batch_id)

    query = sources.write_place_documents(
        places, twice, str(tmp_path / "cp"), availableNow=True
    )
    query.awaitTermination()
    docs = spark.read.schema("time string, location string, isStart string, cnt string").json(path)
    assert docs.count() == docs.dropDuplicates(["time", "location", "isStart"]).count() > 30


def test_state_functions_need_no_package_on_executors():
    import pickle

    from pyspark import cloudpickle

    from tidemark.streaming import asof, prediction, segments

    for function in (prediction._Learn(), asof._AsOf("k", True, 1000), segments._Follow(["k"], 1000)):
        assert b"tidemark.streaming.state" not in pickle_imports(cloudpickle.dumps(function))
        assert pickle.loads(cloudpickle.dumps(function)) is not None


def pickle_imports(data: bytes) -> bytes:
    """The modules that unpickling would import functions from."""
    import pickletools

    strings, imported = [], []
    for op, arg, _ in pickletools.genops(data):
        if isinstance(arg, str):
            strings.append(arg)
        if op.name == "STACK_GLOBAL":
            imported.append(strings[-2])
    return " ".join(imported).encode()
