from tidemark.streaming.asof import event_time_join_stream
from tidemark.streaming.end import EndMarker, with_end
from tidemark.streaming.ordering import event_time_sort_stream
from tidemark.streaming.prediction import predict_travel_time_stream
from tidemark.streaming.segments import stop_segments_stream
from tidemark.streaming.state import keyed_processors
from tidemark.streaming.watermark import strict_lateness, with_event_watermark, with_ride_watermark
from tidemark.streaming.words import word_running_count_stream

__all__ = [
    "EndMarker",
    "event_time_join_stream",
    "event_time_sort_stream",
    "keyed_processors",
    "predict_travel_time_stream",
    "stop_segments_stream",
    "strict_lateness",
    "with_end",
    "with_event_watermark",
    "with_ride_watermark",
    "word_running_count_stream",
]
