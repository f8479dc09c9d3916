"""Geographic columns: bounding box, grid cells, ride event time and travel features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BoundingBox:
    """Closed longitude/latitude rectangle in degrees."""

    west: float
    east: float
    south: float
    north: float


@dataclass(frozen=True)
class Grid:
    """Cells counted row by row from the north-west corner, ``columns`` to a row."""

    west: float
    north: float
    cell_lon: float
    cell_lat: float
    columns: int


# The New York area and its grid of roughly 100 m cells.
NYC_BOX = BoundingBox(west=-74.05, east=-73.70, south=40.5, north=41.0)
NYC_GRID = Grid(west=-74.05, north=41.0, cell_lon=0.0014, cell_lat=0.00125, columns=250)

# Fixed values for the travel features.
KM_PER_DEGREE = 111.32
DIRECTION_BUCKET_DEGREES = 45


def in_box(lon: Column, lat: Column, box: BoundingBox = NYC_BOX) -> Column:
    return lon.between(box.west, box.east) & lat.between(box.south, box.north)


def grid_cell(lon: Column, lat: Column, grid: Grid = NYC_GRID) -> Column:
    """Integer id of the grid cell that holds the coordinate."""
    col = F.floor((lon - F.lit(grid.west)) / F.lit(grid.cell_lon))
    row = F.floor((F.lit(grid.north) - lat) / F.lit(grid.cell_lat))
    return (col + row * F.lit(grid.columns)).cast("int")


def grid_cell_center(cell: Column, grid: Grid = NYC_GRID) -> tuple[Column, Column]:
    """Longitude and latitude of the middle of a cell, as floats."""
    col = F.pmod(cell, F.lit(grid.columns))
    row = F.floor((cell - col) / F.lit(grid.columns))
    lon = F.lit(grid.west) + (col + F.lit(0.5)) * F.lit(grid.cell_lon)
    lat = F.lit(grid.north) - (row + F.lit(0.5)) * F.lit(grid.cell_lat)
    return lon.cast("float"), lat.cast("float")


def ride_event_time() -> Column:
    """When a ride record happened: its start for start records, else its end."""
    return F.when(F.col("is_start"), F.col("start_time")).otherwise(F.col("end_time"))


def travel_features() -> dict[str, Column]:
    """Columns describing the trip of a ride record.

    ``direction`` is in whole degrees counter-clockwise from east, 0 to 359;
    ``distance_m`` and ``travel_ms`` are integers so that sums over them are exact.
    """
    start_lon, start_lat, end_lon, end_lat = map(
        F.col, ("start_lon", "start_lat", "end_lon", "end_lat")
    )
    dlon, dlat = end_lon - start_lon, end_lat - start_lat
    direction = F.pmod(F.floor(F.degrees(F.atan2(dlat, dlon)) + F.lit(360.0)), F.lit(360))
    east_km = dlon * F.lit(KM_PER_DEGREE) * F.cos(F.radians((start_lat + end_lat) / F.lit(2.0)))
    north_km = dlat * F.lit(KM_PER_DEGREE)
    distance_km = F.sqrt(east_km * east_km + north_km * north_km)
    travel_ms = F.unix_millis("end_time") - F.unix_millis("start_time")
    return {
        "direction": direction.cast("int"),
        "distance_km": distance_km,
        "distance_m": F.round(distance_km * F.lit(1000.0)).cast("long"),
        "travel_ms": travel_ms,
        "travel_minutes": travel_ms / F.lit(60000.0),
    }
