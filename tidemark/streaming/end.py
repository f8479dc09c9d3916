"""The end of an input: a marker that moves the watermark past all rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Later than any event, and early enough for windows and lags to be added to it.
END_OF_TIME = "9000-01-01 00:00:00 UTC"
_SCHEMA = "ended timestamp"


@dataclass(frozen=True)
class EndMarker:
    """A folder that is empty until `write` puts the marker there.

    The folder must be in the shared store. Writing the marker twice does no harm.
    """

    path: str

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> EndMarker:
        marker = cls(path)
        # A file stream wants its folder to be there.
        spark.createDataFrame([], _SCHEMA).write.mode("append").parquet(path)
        return marker

    def write(self, spark: SparkSession) -> None:
        """Say that all rows have been read. Rows that come after it are too late."""
        spark.sql(f"select timestamp'{END_OF_TIME}' as ended").write.mode("append").parquet(self.path)


def with_end(events: DataFrame, end: EndMarker, lag: str = "0 seconds", ts: str = "ts") -> DataFrame:
    """The stream with a watermark on ``ts`` that the marker moves past all events.

    Use it in place of `with_event_watermark`: the marker is one more row of the watermarked
    column. It is taken out behind the watermark, so what follows sees events only. When the
    marker has come, windows, sessions and held rows are all given out, like those of a table.
    Filters that follow are not moved in front of it; put those that save reading before it.
    """
    spark = events.sparkSession
    ended = spark.readStream.schema(_SCHEMA).parquet(end.path)
    marker = ended.select(F.col("ended").cast(events.schema[ts].dataType).alias(ts), F.lit(True).alias("__ended"))
    both = events.where(F.col(ts).isNotNull()).withColumn("__ended", F.lit(False))
    both = both.unionByName(marker, allowMissingColumns=True).withWatermark(ts, lag)
    # The first part names the watermarked column and stays behind the watermark; the second is not
    # deterministic for Spark, so later filters, which the marker would not pass, stay behind both.
    is_event = F.when(F.col(ts).isNull(), F.lit(False)).otherwise(~F.col("__ended"))
    return both.where(is_event & (F.spark_partition_id() >= 0)).drop("__ended")
