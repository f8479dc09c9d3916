"""Small inputs for tests: seconds after 2024-01-01 00:00:00 UTC stand for times."""

import time

from pyspark.sql import functions as F

DAY = 1_704_067_200  # 2024-01-01 00:00:00 UTC


def at(column):
    return F.timestamp_millis((F.col(column).cast("double") * 1000 + DAY * 1000).cast("long"))


def seconds(column):
    return (F.unix_millis(column) - F.lit(DAY * 1000)) / 1000.0


def rows(df, *columns):
    """Rows as sorted tuples; timestamp columns as seconds of the test day."""
    picked = [
        seconds(c).alias(c) if df.schema[c].dataType.typeName() == "timestamp" else F.col(c)
        for c in columns or df.columns
    ]
    return sorted((tuple(r) for r in df.select(*picked).collect()), key=repr)


def events(spark, data, key_type="string"):
    """Car events out of ``(car_id, seconds, speed)``."""
    numbered = [(i, *row) for i, row in enumerate(data)]
    schema = f"event_id long, car_id {key_type}, s double, speed double"
    frame = spark.createDataFrame([(i, k, float(s), v) for i, k, s, v in numbered], schema)
    return frame.select("event_id", "car_id", at("s").alias("ts"), "speed")


def write_batches(frames, path):
    """One file per frame, in order of their modification times."""
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.05)


def stream_of(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
