"""Popular places as JSON documents of a search index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Where the documents are indexed.
PLACE_INDEX = "nyc-places"
PLACE_TYPE = "popular-locations"


def place_documents(places: DataFrame) -> DataFrame:
    """``id, doc``: a JSON document per place with all values as strings.

    ``location`` is latitude first. The id names the place, kind and window, so
    that writing a document again replaces it.
    """
    lon, lat, start, end = (
        F.col(c).cast("string") for c in ("lon", "lat", "is_start", "window_end")
    )
    document = F.struct(
        end.alias("time"),
        F.concat_ws(",", lat, lon).alias("location"),
        start.alias("isStart"),
        F.col("cnt").cast("string").alias("cnt"),
    )
    return places.select(
        F.concat_ws("-", lon, lat, start, end).alias("id"), F.to_json(document).alias("doc")
    )


def index_writer(resource: str = f"{PLACE_INDEX}/{PLACE_TYPE}", **options) -> Callable:
    """A batch writer for a search index, through its Spark connector.

    The connector must be on the class path. Documents are stored under their id.
    """

    def write(documents: DataFrame, batch_id: int) -> None:
        fields = "time string, location string, isStart string, cnt string"
        parsed = documents.select("id", F.from_json("doc", fields).alias("d")).select("id", "d.*")
        (
            parsed.write.format("org.elasticsearch.spark.sql")
            .options(**{"es.mapping.id": "id", "es.mapping.exclude": "id", **options})
            .mode("append")
            .save(resource)
        )

    return write


def folder_writer(path: str) -> Callable:
    """A batch writer that keeps one folder of JSON lines per batch.

    A batch that is run again after a failure overwrites its own folder.
    """

    def write(documents: DataFrame, batch_id: int) -> None:
        documents.select("doc").write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return write


def write_place_documents(
    places: DataFrame, write: Callable, checkpoint: str | None = None, **trigger
) -> StreamingQuery | None:
    """Hand the documents of ``places`` to ``write(documents, batch_id)``.

    A table is one batch with id 0. A stream is started with ``checkpoint`` and
    the given ``trigger``.
    """
    documents = place_documents(places)
    if not places.isStreaming:
        write(documents, 0)
        return None
    sink = documents.writeStream.foreachBatch(write).outputMode("append")
    if trigger:
        sink = sink.trigger(**trigger)
    return sink.option("checkpointLocation", checkpoint).start()
