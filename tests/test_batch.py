"""Golden cases of the batch operators."""

import pytest
from helpers import at, events, rows, stream_of
from pyspark.sql import functions as F

from tidemark import operators, sources
from tidemark.functions import NYC_GRID, grid_cell, grid_cell_center, words
from tidemark.operators.prediction import fitted_minutes
from tidemark.plans import views
from tidemark.plans.runs import run_appending
from tidemark.streaming import predict_travel_time_stream

# Four lines of a well-known play.
LINES = [
    "To be, or not to be,--that is the question:--",
    "Whether 'tis nobler in the mind to suffer",
    "The slings and arrows of outrageous fortune",
    "Or to take arms against a sea of troubles,",
]


def _lines(spark):
    return spark.createDataFrame(list(enumerate(LINES)), "line_id long, text string")


def test_word_count(spark):
    counts = dict(rows(operators.word_count(_lines(spark))))
    assert len(counts) == 26 and sum(counts.values()) == 34
    assert {w: c for w, c in counts.items() if c > 1} == {"to": 4, "the": 3, "be": 2, "of": 2, "or": 2}


@pytest.mark.parametrize(
    ("text", "expected"),
    [("", []), ("--", []), ("To be,--été  x_1 ", ["to", "be", "t", "x_1"])],
)
def test_words(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "text string")
    assert frame.select(words(F.col("text"))).first()[0] == expected


def test_word_running_count(spark):
    out = operators.word_running_count(_lines(spark), ["line_id"])
    assert [r for r in rows(out, "word", "line_id", "pos", "cnt") if r[0] == "to"] == [
        ("to", 0, 0, 1),
        ("to", 0, 4, 2),
        ("to", 1, 6, 3),
        ("to", 3, 1, 4),
    ]


def _rides(spark, data):
    schema = (
        "ride_id long, is_start boolean, s double, e double,"
        " start_lon double, start_lat double, end_lon double, end_lat double"
    )
    frame = spark.createDataFrame(data, schema)
    return frame.withColumns({"start_time": at("s"), "end_time": at("e")}).drop("s", "e")


HERE, THERE, OUTSIDE = (-73.98, 40.75), (-73.90, 40.60), (-75.0, 40.75)


def test_popular_places_threshold_is_strict(spark):
    def places(n):
        data = [(i, True, 0.0, 600.0, *HERE, *THERE) for i in range(n)]
        return operators.popular_places(_rides(spark, data))

    assert places(20).count() == 0
    found = places(21).collect()
    day_ms = 1_704_067_200_000
    assert sorted(r.window_end - day_ms for r in found) == [300_000, 600_000, 900_000]
    assert {(r.is_start, r.cnt) for r in found} == {(True, 21)}
    assert found[0].lon == pytest.approx(HERE[0], abs=0.0014)
    assert found[0].lat == pytest.approx(HERE[1], abs=0.00125)


def test_popular_places_of_ride_files(spark, tmp_path):
    # Files have no column ts, neither in sight nor below a projection.
    data = [(i, True, 0.0, 60.0, -73.98, 40.75, -73.98, 40.75) for i in range(21)]
    no_time = [(i, True, None, 60.0, -73.98, 40.75, -73.98, 40.75) for i in range(21, 30)]
    columns = [f.name for f in sources.RIDE_SCHEMA]
    _rides(spark, data + no_time).select(columns).write.csv(str(tmp_path / "rides"), compression="gzip")
    rides = sources.read_rides(spark, str(tmp_path / "rides"))
    found = operators.popular_places(rides)
    assert [r.cnt for r in found.collect()] == [21] * 3
    assert operators.popular_places(sources.usable(rides, "start_time")).count() == 3


def test_popular_places_counts_starts_and_ends_apart(spark):
    data = [
        (1, True, 0.0, 60.0, *HERE, *THERE),
        (1, False, 0.0, 60.0, *HERE, *THERE),
        (2, True, 0.0, 60.0, *HERE, *OUTSIDE),
        (3, True, 0.0, 60.0, *OUTSIDE, *HERE),
    ]
    found = operators.popular_places(_rides(spark, data), threshold=0)
    kinds = found.groupBy("is_start", F.round("lon", 1).alias("lon")).agg(F.max("cnt").alias("cnt"))
    assert rows(kinds, "is_start", "cnt") == [(False, 1), (True, 1)]


def test_grid_cell_center_lies_in_its_cell(spark):
    cells = spark.range(0, 100_000, 37).select(F.col("id").cast("int").alias("cell"))
    lon, lat = grid_cell_center(F.col("cell"))
    back = cells.withColumn("again", grid_cell(lon.cast("double"), lat.cast("double"), NYC_GRID))
    assert back.where("cell <> again").count() == 0


def test_gap_segments(spark):
    data = [("a", 0, 1.0), ("a", 15, 3.0), ("a", 30.001, 5.0), ("b", 7, 2.0)]
    out = operators.gap_segments(events(spark, data), ["car_id"])
    assert rows(out) == [
        ("a", 0.0, 15.0, 2, 15000, 3.0, 2.0),
        ("a", 30.001, 30.001, 1, 0, 5.0, 5.0),
        ("b", 7.0, 7.0, 1, 0, 2.0, 2.0),
    ]


STOPS = [(0, 10.0), (5, 20.0), (9, 0.0), (12, 0.0), (20, 30.0), (30, 0.0), (40, 15.0)]


@pytest.mark.parametrize("data", [STOPS, STOPS[::-1], STOPS[3:] + STOPS[:3]])
def test_stop_segments(spark, data):
    out = operators.stop_segments(events(spark, [("a", *d) for d in data]), ["car_id"])
    assert rows(out) == [
        ("a", 0.0, 9.0, 3, 9000, 20.0, 10.0),
        ("a", 20.0, 30.0, 2, 10000, 30.0, 15.0),
    ]


def test_stop_segments_over_all_cars(spark):
    data = [("a", 0, 10.0), ("b", 1, 0.0), ("a", 2, 20.0), ("a", 3, 0.0)]
    everything = events(spark, data)
    lengths = rows(operators.stop_segments(everything), "start_ts", "length_ms")
    assert lengths == [(0.0, 1000), (2.0, 1000)]
    by_car = operators.stop_segments(everything, ["car_id"])
    assert rows(by_car, "car_id", "n_events", "length_ms") == [("a", 3, 3000)]


def test_event_time_sort(spark, sf_dir):
    cars = views.car_events(spark, sf_dir)
    out = operators.event_time_sort(cars.repartition(8), ["car_id"], partitions=5)
    parts = out.withColumn("part", F.spark_partition_id()).toPandas()
    assert len(parts) == cars.count() and parts.part.nunique() > 1
    keys = ["car_id", "ts", "event_id"]
    assert parts[keys].equals(parts[keys].sort_values(keys))


def test_late_rows(spark):
    data = [("a", s, 1.0) for s in (10, 20, 15, 14, 30)] + [("b", 1, 1.0)]
    out = operators.late_rows(events(spark, data), ["car_id"], ("event_id",))
    assert rows(out, "car_id", "ts", "watermark") == [("a", 14.0, 15.0), ("a", 15.0, 15.0)]


def _trades(spark, data):
    frame = spark.createDataFrame(data, "trade_id long, customer_id string, s double, amount double")
    return frame.select("trade_id", "customer_id", at("s").alias("ts"), "amount")


def _customers(spark, data):
    frame = spark.createDataFrame(data, "customer_id string, s double, info struct<value: string>")
    return frame.select("customer_id", at("s").alias("ts"), "info")


TRADES = [(i, "c1", float(s), 1.0) for i, s in enumerate((5, 10, 15, 20, 99))]
TRADES += [(5, "c2", 10.0, 1.0), (6, None, 50.0, 1.0)]
CUSTOMERS = [("c1", 10.0, ("A",)), ("c1", 20.0, ("B",)), (None, 1.0, ("N",))]


def test_event_time_join(spark):
    out = operators.event_time_join(_trades(spark, TRADES), _customers(spark, CUSTOMERS))
    assert out.columns == ["trade_id", "customer_id", "ts", "amount", "customer"]
    values = {r.trade_id: r.customer and r.customer["info"]["value"] for r in out.collect()}
    assert values == {0: None, 1: "A", 2: "A", 3: "B", 4: "B", 5: None, 6: None}


def test_event_time_join_keeps_empty_records(spark):
    customers = _customers(spark, [("c1", 10.0, ("A",)), ("c1", 20.0, None)])
    out = operators.event_time_join(_trades(spark, TRADES[:5]), customers)
    found = {r.trade_id: r.customer for r in out.collect()}
    assert found[4] is not None and found[4]["info"] is None


def test_predict_travel_time(spark):
    # Trips due east that end in one cell, so that distance follows the start.
    lat, end = 40.75, -73.75
    per_m = 1 / (111_320 * 0.7575649843866)

    def ride(ride_id, is_start, event, km, minutes):
        s, e = (event, event + 60) if is_start else (event - 60 * minutes, event)
        return (ride_id, is_start, float(s), float(e), end - km * 1000 * per_m, lat, end, lat)

    data = [
        ride(1, True, 10_000, 3, 0),
        ride(2, False, 10_010, 1, 10),
        ride(3, True, 10_020, 3, 0),
        ride(4, False, 10_030, 2, 20),
        ride(5, True, 10_030, 3, 0),
    ]
    out = operators.predict_travel_time(_rides(spark, data))
    assert rows(out) == [(1, None), (3, None), (5, 30)]
    same = [ride(1, False, 10_000, 2, 10), ride(2, False, 10_010, 2, 20), ride(3, True, 10_020, 2, 0)]
    assert rows(operators.predict_travel_time(_rides(spark, same))) == [(3, None)]


def _short_trips(spark, more):
    """Two good trips that predict ten minutes for ride 5, and more records like them."""
    lat, end, east = 40.75, -73.75, 0.00002
    good = [
        (1, False, 9_000.0, 9_000.0 + 600, end - 500 * east, lat, end, lat),
        (2, False, 9_010.0, 9_010.0 + 600, end - 700 * east, lat, end, lat),
        (5, True, 20_000.0, 20_060.0, end - 600 * east, lat, end, lat),
    ]
    return _rides(spark, good + [(i, kind, a, b, end - 600 * east, lat, end, lat) for i, kind, a, b in more])


@pytest.mark.parametrize(
    "more",
    [
        [],
        [(3, False, None, 10_000.0)],
        [(3, False, 9_000.0, None)],
        [(3, None, 9_000.0, 10_000.0)],
        [(3, None, None, None), (4, False, None, None)],
    ],
)
def test_records_that_cannot_train_change_no_prediction(spark, tmp_path, more):
    rides = _short_trips(spark, more)
    assert rows(operators.predict_travel_time(rides)) == [(5, 10)]
    rides.coalesce(1).write.parquet(f"{tmp_path}/rides")
    stream = predict_travel_time_stream(stream_of(spark, rides.schema, f"{tmp_path}/rides"))
    assert rows(run_appending(stream)) == [(5, 10)]


def test_huge_sums_of_a_model_agree_in_both_modes(spark, tmp_path):
    rides = _short_trips(spark, [(100 + i, False, -3e8 + i, 10_000.0) for i in range(400)])
    out = rows(operators.predict_travel_time(rides))
    rides.coalesce(1).write.parquet(f"{tmp_path}/rides")
    stream = predict_travel_time_stream(stream_of(spark, rides.schema, f"{tmp_path}/rides"))
    assert rows(run_appending(stream)) == out and out[0][1] > 1_000_000


def test_rows_without_a_time_or_value_do_not_count(spark):
    timed = [("A", 0, 2.0), ("A", 5, 3.0), ("A", 9, 0.0)]
    data = events(spark, timed)
    untimed = data.limit(1).withColumns({"ts": F.lit(None).cast("timestamp"), "speed": F.lit(99.0)})
    got = rows(operators.stop_segments(data.union(untimed), ["car_id"]))
    assert got == rows(operators.stop_segments(data, ["car_id"])) and len(got) == 1
    rides = _short_trips(spark, [(3, True, None, 9_000.0)]).withColumn("ts", F.col("start_time"))
    assert operators.rides_in_bbox(rides, event_time="ts").count() == 3
    records = sources.rides_to_records(rides).union(spark.sql("select 'k', cast(null as string)"))
    assert sources.records_to_rides(records).count() == 4


def test_fitted_minutes_survives_huge_sums(spark):
    n, d, t = 300_000_000_000, 50_000, 3_000_000
    sums = f"""{n}L n, {n * d}L x, {n * t}L y,
        cast({n * (d * d + 100)} as decimal(38,0)) xx, cast({n * (d * t + 6000)} as decimal(38,0)) xy,
        {d}L at"""
    frame = spark.sql(f"select {sums}")
    minutes = fitted_minutes(*map(F.col, ("n", "x", "y", "xx", "xy", "at")))
    assert frame.select(minutes).first()[0] == 50


@pytest.mark.parametrize(("window", "slide"), [("15 minutes", "5 minutes"), ("7 hours", "3 hours")])
def test_popular_places_like_sliding_windows(spark, sf_dir, window, slide):
    rides = views.rides(spark, sf_dir)
    got = operators.popular_places(
        rides, grid=views.COARSE_GRID, window=window, slide=slide, threshold=0
    )
    cells = operators.ride_cells(operators.rides_in_bbox(rides), views.COARSE_GRID)
    windows = cells.groupBy(F.window("ts", window, slide), "cell", "is_start").count()
    want = windows.select(F.unix_millis("window.end").alias("window_end"), "is_start", "count")
    assert rows(got, "window_end", "is_start", "cnt") == rows(want)
