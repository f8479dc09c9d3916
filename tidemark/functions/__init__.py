from tidemark.functions.geo import (
    BoundingBox,
    Grid,
    NYC_BOX,
    NYC_GRID,
    grid_cell,
    grid_cell_center,
    in_box,
    ride_event_time,
    travel_features,
)
from tidemark.functions.text import words

__all__ = [
    "BoundingBox",
    "Grid",
    "NYC_BOX",
    "NYC_GRID",
    "grid_cell",
    "grid_cell_center",
    "in_box",
    "ride_event_time",
    "travel_features",
    "words",
]
