"""As-of join: each event with the record that was valid at its time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.hot_keys import ROWS_PER_PIECE, Running, find_hot_keys, ordered
from tidemark.shared import written

# What a record takes besides its values.
_RECORD_BYTES = 64


def event_time_join(
    trades: DataFrame,
    customers: DataFrame,
    key: str = "customer_id",
    ts: str = "ts",
    rows_per_piece: int = ROWS_PER_PIECE,
    small_bytes: int | None = None,
) -> DataFrame:
    """Every trade with ``customer``: the newest customer record not after it.

    ``customer`` is a struct of the record's columns other than the key, and null
    when there is none. A record with the trade's own time counts as known.
    Of several records of one time the one with the greatest hash is taken.

    Both sides share one shuffle and no pairs are formed, so the work is that of
    sorting the two tables whatever the number of records per key.

    With ``small_bytes`` the records are measured first. If they take no more than that (as JSON,
    with some bytes a record and key besides), each key's records become one sorted array, which
    is broadcast and searched, and trades are not shuffled at all. Beyond it, or where records
    hold maps, which have no order, the two sides are sorted as without.
    """
    if small_bytes is not None:
        records = _orderable(customers, key, ts)
        if records is not None and _bytes(records) <= small_bytes:
            return _searched(trades, records, key, ts)
    fields = [c for c in customers.columns if c != key]
    trade_fields = [c for c in trades.columns if c not in (key, ts)]
    # A null key matches nothing, so such records need not be looked at.
    records = customers.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        key,
        ts,
        F.lit(0).alias("__side"),
        F.xxhash64(*[F.col(c) for c in fields]).alias("__tie"),
        F.struct(*fields).alias("customer"),
    )
    requests = trades.select(
        key,
        ts,
        F.lit(1).alias("__side"),
        F.xxhash64(*[F.col(c) for c in trades.columns]).alias("__tie"),
        F.struct(*trade_fields).alias("__trade"),
    )
    both = records.unionByName(requests, allowMissingColumns=True)
    order = [ts, "__side", "__tie"]
    hot = find_hot_keys(both, [key], order, rows_per_piece)
    known = Running("customer", "last", F.col("customer"))
    rows = ordered(both, [key], order, hot).with_running(known).rows()
    return rows.where(F.col("__side") == 1).select(
        *[F.col(c) if c in (key, ts) else F.col(f"__trade.{c}").alias(c) for c in trades.columns],
        "customer",
    )


def _orderable(customers: DataFrame, key: str, ts: str) -> DataFrame | None:
    """``key, __record``: the records as ``ts, tie, customer``; None if they have no order."""
    fields = [c for c in customers.columns if c != key]
    if "map<" in customers.select(fields).schema.simpleString():
        return None
    tie = F.xxhash64(*[F.col(c) for c in fields])
    record = F.struct(F.col(ts).alias("ts"), tie.alias("tie"), F.struct(*fields).alias("customer"))
    known = customers.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    return known.select(key, record.alias("__record"))


def _bytes(records: DataFrame) -> int:
    each = F.octet_length(F.to_json("__record")) + F.lit(_RECORD_BYTES)
    return records.agg(F.coalesce(F.sum(each), F.lit(0)).alias("n")).first()["n"]


def _searched(trades: DataFrame, records: DataFrame, key: str, ts: str) -> DataFrame:
    line = F.sort_array(F.collect_list("__record")).alias("__line")
    lines = written(records.groupBy(key).agg(line).withColumn("__times", F.transform("__line", lambda r: r["ts"])))
    longest = lines.agg(F.coalesce(F.max(F.size("__line")), F.lit(0)).alias("n")).first()["n"]
    # A column of its own for each step of the search, which Spark compiles into one loop body.
    out = trades.join(F.broadcast(lines), key, "left").withColumn("__at", F.lit(0))
    step = 1 << max(longest, 1).bit_length() - 1
    while step:
        there = F.col("__at") + F.lit(step)
        fits = (there <= F.size("__times")) & (F.get("__times", there - 1) <= F.col(ts))
        out = out.withColumn("__at", F.when(fits, there).otherwise(F.col("__at")))
        step //= 2
    found = F.get("__line", F.col("__at") - 1)["customer"]
    return out.select(*trades.columns, F.when(F.col("__at") > 0, found).alias("customer"))
