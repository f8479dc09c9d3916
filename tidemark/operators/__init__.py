from tidemark.operators.asof import event_time_join
from tidemark.operators.ordering import event_time_position, event_time_sort, late_rows
from tidemark.operators.places import popular_places, ride_cells, rides_in_bbox
from tidemark.operators.prediction import predict_travel_time, travel_models
from tidemark.operators.segments import stop_segments
from tidemark.operators.sessions import gap_segments
from tidemark.operators.words import tokens, word_count, word_running_count

__all__ = [
    "event_time_join",
    "event_time_position",
    "event_time_sort",
    "gap_segments",
    "late_rows",
    "popular_places",
    "predict_travel_time",
    "ride_cells",
    "rides_in_bbox",
    "stop_segments",
    "tokens",
    "travel_models",
    "word_count",
    "word_running_count",
]
