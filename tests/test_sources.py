"""Readers, ride records and place documents."""

import gzip
import json

import pytest
from helpers import rows
from pyspark.sql import types as T

from tidemark import sources
from tidemark.plans import views
from tidemark.plans.runs import run_appending, scratch_dir

CARS = "1,7,1704067200500,3.5\n2,7,oops,1.0\n3,7,1704067201000\n4,7,,2.0\nnothing\n"
RIDE = "{},true,2024-01-01 00:00:00,2024-01-01 00:10:00,-73.98,40.75,-73.9,40.6\n"


@pytest.fixture
def car_path(tmp_path):
    (tmp_path / "cars").mkdir()
    (tmp_path / "cars" / "a.csv").write_text(CARS)
    return str(tmp_path / "cars")


def test_bad_car_events_are_set_aside(spark, car_path):
    lines = sources.read_car_events(spark, car_path)
    good, bad = sources.usable(lines, "ts"), sources.rejected(lines, "ts")
    assert rows(good) == [(1, 7, 0.5, 3.5)]
    assert bad.count() == 4
    # A line is judged by all its fields even if only one is asked for.
    assert good.select("event_id").count() == 1


def test_car_events_of_another_layout(spark, tmp_path):
    (tmp_path / "x.csv").write_text("c1|2024-01-01 00:00:01|2.5\n")
    schema = T.StructType(
        [
            T.StructField("car_id", T.StringType()),
            T.StructField("ts", T.TimestampType()),
            T.StructField("speed", T.DoubleType()),
        ]
    )
    lines = sources.read_car_events(spark, str(tmp_path / "x.csv"), schema, sep="|")
    assert rows(sources.usable(lines, "ts")) == [("c1", 1.0, 2.5)]


def test_car_event_stream(spark, car_path):
    stream = sources.read_car_events(spark, car_path, streaming=True, maxFilesPerTrigger=1)
    assert stream.isStreaming
    assert run_appending(sources.usable(stream, "ts")).count() == 1


def test_gzip_rides(spark, tmp_path):
    with gzip.open(tmp_path / "rides.gz", "wt") as out:
        out.writelines(RIDE.format(i) for i in range(100))
    rides = sources.read_rides(spark, str(tmp_path / "rides.gz"), partitions=4)
    assert rides.rdd.getNumPartitions() == 4
    good = sources.usable(rides, "start_time", "end_time")
    assert good.count() == 100
    assert good.schema == sources.RIDE_SCHEMA


def test_ride_records_round_trip(spark, sf_dir):
    rides = views.rides(spark, sf_dir)
    records = sources.rides_to_records(rides)
    assert records.columns == ["key", "value"]
    back = sources.records_to_rides(records)
    assert sources.rejected(back).count() == 0
    assert rows(sources.usable(back)) == rows(rides)


def test_malformed_record_is_kept_aside(spark):
    records = spark.createDataFrame([("1", RIDE.format(1).strip()), ("2", "1,x,y")], "key string, value string")
    rides = sources.records_to_rides(records)
    assert sources.usable(rides, "start_time").count() == 1
    assert [r["_corrupt_record"] for r in sources.rejected(rides, "start_time").collect()] == ["1,x,y"]


def test_place_document(spark):
    places = spark.sql(
        "select float(-73.98) lon, float(40.75) lat, 1357000200000 window_end, true is_start, 25 cnt"
    )
    row = sources.place_documents(places).first()
    assert row.doc == (
        '{"time":"1357000200000","location":"40.75,-73.98","isStart":"true","cnt":"25"}'
    )
    assert row.id == "-73.98-40.75-true-1357000200000"


def test_place_documents_of_a_table(spark, tmp_path):
    places = spark.sql("select float(1) lon, float(2) lat, 3L window_end, false is_start, 4 cnt")
    sources.write_place_documents(places, sources.folder_writer(str(tmp_path / "d")))
    lines = spark.read.text(str(tmp_path / "d")).collect()
    assert [json.loads(r.value)["location"] for r in lines] == ["2.0,1.0"]


def test_scratch_folder_is_the_shared_one(spark):
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark) != scratch_dir(spark)
