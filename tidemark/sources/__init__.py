from tidemark.sources.committed import read_committed, write_committed
from tidemark.sources.documents import (
    folder_writer,
    index_writer,
    place_documents,
    write_place_documents,
)
from tidemark.sources.readers import (
    CAR_EVENT_SCHEMA,
    RIDE_SCHEMA,
    read_car_events,
    read_rides,
    rejected,
    usable,
)
from tidemark.sources.records import (
    read_ride_topic,
    records_to_rides,
    rides_to_records,
    write_ride_topic,
)

__all__ = [
    "CAR_EVENT_SCHEMA",
    "RIDE_SCHEMA",
    "folder_writer",
    "index_writer",
    "place_documents",
    "read_car_events",
    "read_committed",
    "read_ride_topic",
    "read_rides",
    "records_to_rides",
    "rejected",
    "rides_to_records",
    "usable",
    "write_committed",
    "write_place_documents",
    "write_ride_topic",
]
