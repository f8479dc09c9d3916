"""The registered queries as DuckDB SQL."""

from __future__ import annotations

from tidemark.functions.geo import DIRECTION_BUCKET_DEGREES, KM_PER_DEGREE, NYC_BOX
from tidemark.plans import views

_GRID = views.COARSE_GRID
_CAR = f"car as ({views.car_events_sql()})"
_RIDES = f"rides as ({views.rides_sql(views.DUCKDB_SECONDS)})"
_IN_BOX = " and ".join(
    f"{p}_lon between {NYC_BOX.west} and {NYC_BOX.east}"
    f" and {p}_lat between {NYC_BOX.south} and {NYC_BOX.north}"
    for p in ("start", "end")
)
_INSIDE = f"inside as (select * from rides where {_IN_BOX})"
_WORDS = r"""words as (
    select doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '\W+'),
                                      lambda w: length(w) > 0)) as word,
           cast(generate_subscripts(list_filter(regexp_split_to_array(lower(text), '\W+'),
                                                lambda w: length(w) > 0), 1) - 1 as integer) as pos
    from documents)"""


def _cell(lon: str, lat: str) -> str:
    return (
        f"cast(floor(({lon} - ({_GRID.west})) / {_GRID.cell_lon})"
        f" + floor(({_GRID.north} - {lat}) / {_GRID.cell_lat}) * {_GRID.columns} as integer)"
    )


def _center(cell: str) -> tuple[str, str]:
    col = f"({cell} % {_GRID.columns})"
    row = f"(({cell} - {col}) // {_GRID.columns})"
    return (
        f"cast({_GRID.west} + ({col} + cast(0.5 as double)) * {_GRID.cell_lon} as float)",
        f"cast({_GRID.north} - ({row} + cast(0.5 as double)) * {_GRID.cell_lat} as float)",
    )


_SEGMENT = """min(ts) as start_ts, max(ts) as end_ts, count(*) as n_events,
       epoch_us(max(ts)) // 1000 - epoch_us(min(ts)) // 1000 as length_ms,
       max(speed) as max_speed, round(avg(speed), 6) as avg_speed"""


def word_count() -> str:
    return f"with {_WORDS} select word, count(*) as cnt from words group by word"


def word_running_count() -> str:
    return f"""with {_WORDS}
        select doc_id, pos, word,
               count(*) over (partition by word order by doc_id, pos
                              rows unbounded preceding) as cnt
        from words"""


def rides_in_bbox() -> str:
    return f"with {_RIDES} select * from rides where {_IN_BOX}"


def grid_cells() -> str:
    lon, lat = _center("cell")
    start = _cell("start_lon", "start_lat")
    end = _cell("end_lon", "end_lat")
    return f"""with {_RIDES}, {_INSIDE}, cells as (
            select ride_id, case when is_start then start_time else end_time end as ts,
                   case when is_start then {start} else {end} end as cell
            from inside)
        select ride_id, ts, cell, {lon} as lon, {lat} as lat from cells"""


def _places() -> str:
    lon, lat = _center("cell")
    start = _cell("start_lon", "start_lat")
    end = _cell("end_lon", "end_lat")
    return f"""{_RIDES}, {_INSIDE}, cells as (
            select case when is_start then start_time else end_time end as ts, is_start,
                   case when is_start then {start} else {end} end as cell
            from inside),
        panes as (
            select time_bucket(interval 8 hours, ts, timestamp '1970-01-01') as pane,
                   is_start, cell
            from cells),
        counts as (
            select cell, is_start, pane + (i + 1) * interval 8 hours as window_end,
                   cast(count(*) as integer) as cnt
            from panes, range(3) r(i) group by all),
        places as (
            select cell, {lon} as lon, {lat} as lat, epoch_ms(window_end) as window_end, is_start, cnt
            from counts where cnt > {views.COARSE_THRESHOLD})"""


def popular_places() -> str:
    return f"""with {_places()}
        select lon, lat, window_end, is_start, cnt from places"""


def place_documents() -> str:
    return f"""with {_places()}
        select concat_ws('-', cast(lon as varchar), cast(lat as varchar),
                         cast(is_start as varchar), cast(window_end as varchar)) as id,
               '{{"time":"' || window_end || '","location":"' || cast(lat as varchar) || ','
                 || cast(lon as varchar) || '","isStart":"' || cast(is_start as varchar)
                 || '","cnt":"' || cnt || '"}}' as doc
        from places"""


def gap_segments() -> str:
    return f"""with {_CAR},
        flagged as (
            select *, case when ts - lag(ts) over w <= interval 6 hours then 0 else 1 end as opens
            from car window w as (partition by car_id order by ts)),
        numbered as (
            select *, sum(opens) over (partition by car_id order by ts) as n from flagged),
        sessions as (select car_id, {_SEGMENT} from numbered group by car_id, n)
        select * from sessions"""


def stop_segments(keyed: bool) -> str:
    key = "car_id, " if keyed else ""
    part = "partition by car_id" if keyed else ""
    return f"""with {_CAR},
        numbered as (
            select *, coalesce(sum(case when speed = 0 then 1 else 0 end) over (
                {part} order by ts, event_id
                rows between unbounded preceding and 1 preceding), 0) as n
            from car)
        select {key}{_SEGMENT} from numbered group by {key}n
        having bool_or(speed = 0) and epoch_us(max(ts)) // 1000 > epoch_us(min(ts)) // 1000"""


def event_time_sort() -> str:
    return f"""with {_CAR}
        select *, row_number() over (partition by car_id order by ts, event_id) as seq from car"""


def car_events() -> str:
    return f"with {_CAR} select * from car"


def late_rows() -> str:
    return f"""with {_CAR},
        arrived as (select *, event_id + (event_id * 7919) % 3000 as arrival from car),
        marked as (
            select *, max(ts) over (partition by car_id order by arrival, event_id
                                    rows between unbounded preceding and 1 preceding)
                      - interval 12 hours as watermark
            from arrived)
        select event_id, car_id, ts, arrival, watermark from marked where ts <= watermark"""


def event_time_join() -> str:
    return f"""with trades as ({views.trades_sql()}), customers as ({views.customers_sql()})
        select t.trade_id, t.customer_id, t.ts, t.amount,
               c.ts as known_since, c.value as customer_value
        from trades t asof left join customers c
          on t.customer_id = c.customer_id and t.ts >= c.ts"""


def _features() -> str:
    return f"""{_RIDES}, {_INSIDE},
        deltas as (
            select *, case when is_start then start_time else end_time end as ts,
                   {_cell("end_lon", "end_lat")} as cell,
                   end_lat - start_lat as dlat,
                   (end_lon - start_lon) * cast({KM_PER_DEGREE} as double)
                     * cos(radians((start_lat + end_lat) / cast(2.0 as double))) as east_km,
                   (end_lat - start_lat) * cast({KM_PER_DEGREE} as double) as north_km,
                   cast(floor(degrees(atan2(end_lat - start_lat, end_lon - start_lon)) + 360.0)
                        as integer) % 360 as direction
            from inside),
        features as (
            select *, sqrt(east_km * east_km + north_km * north_km) as distance_km,
                   cast(round(sqrt(east_km * east_km + north_km * north_km) * 1000.0) as bigint)
                     as distance_m,
                   epoch_ms(end_time) - epoch_ms(start_time) as travel_ms,
                   direction // {DIRECTION_BUCKET_DEGREES} as bucket
            from deltas)"""


def travel_features() -> str:
    return f"""with {_features()}
        select ride_id, direction, round(distance_km, 6) as distance_km, distance_m,
               travel_ms / cast(60000.0 as double) as travel_minutes
        from features"""


def predict_travel_time() -> str:
    seen = (
        "over (partition by cell, bucket order by ts, is_start, ride_id"
        " rows between unbounded preceding and 1 preceding)"
    )
    return f"""with {_features()},
        sums as (
            select ride_id, is_start, ts, distance_m as d,
                   count(*) filter (not is_start and distance_m is not null and travel_ms is not null) {seen} as n,
                   coalesce(sum(distance_m) filter (not is_start and distance_m is not null and travel_ms is not null) {seen}, 0) as x,
                   coalesce(sum(travel_ms) filter (not is_start and distance_m is not null and travel_ms is not null) {seen}, 0) as y,
                   coalesce(sum(distance_m * distance_m) filter (not is_start and distance_m is not null and travel_ms is not null) {seen}, 0) as xx,
                   coalesce(sum(distance_m * travel_ms) filter (not is_start and distance_m is not null and travel_ms is not null) {seen}, 0) as xy
            from features),
        lines as (
            select ride_id, d, n, x, y, cast(n * xx - x * x as double) as spread,
                   cast(n * xy - x * y as double) as covered
            from sums where is_start and ts is not null)
        select ride_id, case when n >= 2 and spread > 0 then cast(round(
                   (cast(y as double) + covered / spread
                      * (cast(n as double) * cast(d as double) - cast(x as double)))
                   / cast(n as double) / cast(60000.0 as double)) as integer) end
                   as predicted_minutes
        from lines"""


def ride_records() -> str:
    stamp = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
    columns = [
        "cast(ride_id as varchar)",
        "cast(is_start as varchar)",
        stamp.format("start_time"),
        stamp.format("end_time"),
        *[f"cast({p}_{c} as varchar)" for p in ("start", "end") for c in ("lon", "lat")],
    ]
    return f"""with {_RIDES}, {_INSIDE}
        select cast(ride_id as varchar) as key, concat_ws(',', {", ".join(columns)}) as value
        from inside"""


def car_events_file() -> str:
    return f"""with {_CAR}
        select event_id, car_id, time_bucket(interval 1 millisecond, ts) as ts, speed from car"""
