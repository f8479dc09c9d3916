"""Operators cut hot keys into pieces without changing what comes out."""

import pytest
from helpers import at, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import operators
from tidemark.operators import hot_keys
from tidemark.operators.hot_keys import Running, find_hot_keys, ordered
from tidemark.plans import views

# Every key is cut up with one size, none with the other.
CUT, WHOLE = 20, 10_000_000


@pytest.fixture(scope="module")
def cars(spark, sf_dir):
    """Car events of which one car has more than a third, and some have no car at all."""
    events = views.car_events(spark, sf_dir)
    car = F.when(F.col("event_id") % 5 < 2, 3).when(F.col("event_id") % 11 > 0, F.col("car_id"))
    shuffled = events.withColumn("car_id", car.cast("long")).orderBy(F.xxhash64("event_id"))
    return shuffled.cache()


def _same(build):
    cut, whole = build(CUT), build(WHOLE)
    assert cut.schema.names == whole.schema.names
    expected = rows(whole)
    assert expected and rows(cut) == expected


def _rounded(segments):
    return segments.withColumn("avg_speed", F.round("avg_speed", 6))


@pytest.mark.parametrize("gap", ["30 minutes", "3 hours", "30 days"])
def test_gap_segments(cars, gap):
    _same(lambda n: _rounded(operators.gap_segments(cars, ["car_id"], gap, rows_per_piece=n)))


@pytest.mark.parametrize("keys", [[], ["car_id"]])
def test_stop_segments(cars, keys):
    _same(lambda n: _rounded(operators.stop_segments(cars, keys, rows_per_piece=n)))


def test_event_time_position(cars):
    _same(lambda n: operators.event_time_position(cars, ["car_id"], rows_per_piece=n))


def test_late_rows(cars):
    arrival = (F.col("event_id") + (F.col("event_id") * 7919) % 300).alias("arrival")
    arrived = cars.select("*", arrival)
    _same(
        lambda n: operators.late_rows(
            arrived, ["car_id"], ("arrival", "event_id"), "12 hours", rows_per_piece=n
        )
    )


def test_event_time_join(cars):
    trades = cars.where("event_id % 2 = 0").select(F.col("car_id").alias("c"), "ts", "event_id")
    records = cars.where("event_id % 7 = 0").select(F.col("car_id").alias("c"), "ts", "speed")

    def joined(n):
        out = operators.event_time_join(trades, records, "c", rows_per_piece=n)
        return out.select("c", "ts", "event_id", "customer.speed")

    _same(joined)


def test_predict_travel_time(spark, sf_dir):
    rides = views.rides(spark, sf_dir)
    _same(
        lambda n: operators.predict_travel_time(rides, grid=views.COARSE_GRID, rows_per_piece=n // 4)
    )


def test_word_running_count(spark, sf_dir):
    lines = views.lines(spark, sf_dir).where("doc_id % 10 = 0")
    _same(lambda n: operators.word_running_count(lines, ["doc_id"], rows_per_piece=n * 10))


def test_words_are_counted_in_pieces_of_lines(spark, sf_dir):
    # Ids that repeat or are null, and lines without words.
    lines = views.lines(spark, sf_dir).withColumns(
        {
            "doc_id": F.expr("case when doc_id in (40, 80) then null when doc_id = 60 then 35 else doc_id end"),
            "text": F.expr("case when doc_id % 7 = 0 then ' -- ' when doc_id % 11 = 0 then null else text end"),
        }
    )
    plain = operators.word_running_count(lines, ["doc_id"])
    cut = operators.word_running_count(lines, ["doc_id"], kb_per_piece=100)
    assert "CoGroupsInArrow" in cut._jdf.queryExecution().optimizedPlan().toString()
    assert cut.schema == plain.schema
    assert rows(cut) == rows(plain) != []


def test_words_of_lines_that_no_cut_parts(spark, sf_dir):
    lines = views.lines(spark, sf_dir).where("doc_id % 10 = 0").withColumn("doc_id", F.lit(1))
    plain = operators.word_running_count(lines, ["doc_id"])
    cut = operators.word_running_count(lines, ["doc_id"], kb_per_piece=10)
    assert "CoGroupsInArrow" not in cut._jdf.queryExecution().optimizedPlan().toString()
    assert rows(cut) == rows(plain)


def test_pieces_are_balanced_and_in_order(cars):
    hot = find_hot_keys(cars, ["car_id"], ["ts", "event_id"], CUT)
    pieces = ordered(cars, ["car_id"], ["ts", "event_id"], hot).df
    sizes = pieces.groupBy("car_id", "__piece").agg(
        F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b")
    )
    frame = sizes.toPandas()
    assert frame.n.max() <= 2 * CUT
    assert frame["__piece"].max() > 10
    big = frame[frame.car_id == 3].sort_values("__piece")
    assert (big.a.to_numpy()[1:] > big.b.to_numpy()[:-1]).all()


def test_no_hot_keys_leaves_the_plain_plan(cars):
    assert find_hot_keys(cars, ["car_id"], ["ts", "event_id"]) is None
    assert find_hot_keys(cars, [], ["ts", "event_id"]) is None


def test_every_large_key_of_many_is_split(spark):
    many = spark.range(3000).select((F.col("id") % 60).alias("k"), "id")
    hot = find_hot_keys(many, ["k"], ["id"], CUT)
    pieces = ordered(many, ["k"], ["id"], hot).df.groupBy("k", "__piece").count().toPandas()
    assert pieces["count"].max() <= 2 * CUT
    assert (pieces.groupby("k").size() >= 2).all() and pieces.k.nunique() == 60


def test_no_single_task_over_rows_or_samples(cars, monkeypatch):
    seen = []
    keep = hot_keys._counted_up
    monkeypatch.setattr(hot_keys, "_counted_up", lambda *a: seen.append(keep(*a)) or seen[-1])
    out = operators.stop_segments(cars, rows_per_piece=CUT)
    for frame in (seen[0], out):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        single = [x for x in plan.split("\n") if "SinglePartition" in x]
        # Only the sums of ranges and of pieces, a row each, come together.
        assert len(single) <= 1
    assert operators.stop_segments(cars, rows_per_piece=WHOLE).count() == out.count()


def test_search_over_several_blocks(spark):
    many = spark.range(2000).withColumn("v", F.col("id") % 7)
    hot = find_hot_keys(many, [], ["id"], 5)
    assert hot.count > 3 * 64
    out = ordered(many, [], ["id"], hot).with_running(Running("total", "sum", F.col("v"))).rows()
    want, total = [], 0
    for i in range(2000):
        total += i % 7
        want.append(total)
    assert [r.total for r in out.orderBy("id").collect()] == want


def test_sampled_cuts(spark):
    many = spark.range(200_000).withColumn("k", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")))
    hot = find_hot_keys(many, ["k"], ["id"], rows_per_piece=5_000)
    assert hot.cuts.num_rows == 1 and 5 < hot.count < 30


EVENT = st.tuples(
    st.sampled_from(["a", "b"]), st.integers(0, 40), st.sampled_from([0.0, 1.0, 2.0])
)


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(EVENT, min_size=1, max_size=60), st.sampled_from([1, 3, 7]))
def test_stop_segments_like_a_plain_loop(spark, data, rows_per_piece):
    numbered = [(i, *row) for i, row in enumerate(data)]
    frame = spark.createDataFrame(
        [(i, k, float(s), v) for i, k, s, v in numbered],
        "event_id long, car_id string, s double, speed double",
    ).withColumn("ts", at("s"))

    def expected(picked):
        out, open_ = [], []
        for row in sorted(picked, key=lambda r: (r[2], r[0])):
            open_.append(row)
            if row[3] == 0.0:
                if row[2] > open_[0][2]:
                    out.append((float(open_[0][2]), float(row[2]), len(open_)))
                open_ = []
        return out

    columns = ("start_ts", "end_ts", "n_events")
    got = operators.stop_segments(frame, rows_per_piece=rows_per_piece)
    assert rows(got, *columns) == sorted(expected(numbered), key=repr)
    got = operators.stop_segments(frame, ["car_id"], rows_per_piece=rows_per_piece)
    by_car = [e for k in "ab" for e in expected([r for r in numbered if r[1] == k])]
    assert rows(got, *columns) == sorted(by_car, key=repr)


@pytest.mark.parametrize("stop", [False, True])
def test_copies_are_added_up(spark, stop):
    """Half of all events are copies of one, which no cut can part."""
    speed = "0.0D" if stop else "5.0D"
    events = spark.range(400).selectExpr(
        "if(id < 200, 100L, id) event_id",
        "1L car_id",
        "timestamp_seconds(if(id < 200, 100L, id) * 10) ts",
        f"if(id < 200, {speed}, if(id % 50 = 0, 0.0D, double(id % 7))) speed",
    )
    order = ["ts", "event_id"]
    assert find_hot_keys(events, ["car_id"], order, CUT).copies
    assert not find_hot_keys(events.where("event_id <> 100"), ["car_id"], order, CUT).copies
    _same(lambda n: _rounded(operators.stop_segments(events, ["car_id"], rows_per_piece=n)))
    _same(lambda n: _rounded(operators.gap_segments(events, ["car_id"], "15 seconds", rows_per_piece=n)))
