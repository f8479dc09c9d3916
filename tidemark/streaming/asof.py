"""As-of join of two streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.streaming.state import Held, gather, stretch_us

_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}
_KNOWN = "us bigint, tie bigint, doc string"


def event_time_join_stream(
    trades: DataFrame,
    customers: DataFrame,
    key: str = "customer_id",
    ts: str = "ts",
    early: bool = False,
    salts: int = 1,
    stretch: str = "1 minute",
) -> DataFrame:
    """Every trade with ``customer``, the newest customer record not after it.

    Both streams need a watermark on ``ts``. A trade is held until the smaller of
    the two has passed it and given once, with ``final`` true. With ``early`` it is
    also given on arrival, with what is known then and ``final`` false. Trades at
    or below the watermark are dropped, and so are such customer records. State keeps
    the newest record up to the watermark and, in chunks of one ``stretch`` of time,
    all newer records and trades. Write the result in append mode, started inside
    `keyed_processors`.

    With ``salts`` above 1 the trades of each key are spread over that many tasks
    and its customer records are copied to all of them, for keys with many trades.
    """
    trade_fields = [c for c in trades.columns if c != key]
    customer_fields = [c for c in customers.columns if c != key]
    # A trade without key or time can have no customer record and waits for nothing.
    salt = F.pmod(F.xxhash64(*trades.columns), F.lit(salts)).cast("int")
    requests = _tagged(trades, key, ts, trade_fields, 1).withColumn("__salt", salt)
    records = _tagged(customers.where(F.col(key).isNotNull()), key, ts, customer_fields, 0)
    records = records.withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    columns = [key, ts, "__salt", "event_side", "event_us", "event_tie", "event_doc"]
    joined = (
        records.select(*columns)
        .unionByName(requests.select(*columns))
        .groupBy(key, "__salt")
        .transformWithStateInPandas(
            _AsOf(key, early, stretch_us(stretch)),
            f"`{key}` {trades.schema[key].dataType.simpleString()},"
            " trade string, customer string, final boolean",
            "append",
            "EventTime",
        )
    )
    trade = F.from_json("trade", _schema(trades, trade_fields), _JSON)
    customer = F.from_json("customer", _schema(customers, customer_fields), _JSON)
    parsed = joined.select(key, trade.alias("t"), customer.alias("customer"), "final")
    return parsed.select(
        *[F.col(key) if c == key else F.col(f"t.{c}").alias(c) for c in trades.columns],
        "customer",
        "final",
    )


def _tagged(rows: DataFrame, key: str, ts: str, fields: list[str], side: int) -> DataFrame:
    return rows.where(F.col(ts).isNotNull()).withColumns(
        {
            "event_side": F.lit(side),
            "event_us": F.unix_micros(ts),
            "event_tie": F.xxhash64(*fields),
            "event_doc": F.to_json(F.struct(*fields), _JSON),
        }
    )


def _schema(rows: DataFrame, fields: list[str]) -> str:
    return ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in fields)


class _AsOf(StatefulProcessor):
    def __init__(self, key_name: str, early: bool, stretch: int):
        self.key_name, self.early, self.stretch = key_name, early, stretch

    def init(self, handle) -> None:
        self.held = Held(handle, self.stretch, {"us": "int64", "side": "int8", "tie": "int64", "doc": "object"})
        # The newest record up to the watermark still serves trades after it.
        self.known = handle.getValueState("known", _KNOWN)

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        us, side, tie, doc = gather(rows, "event_us", "event_side", "event_tie", "event_doc")
        fresh = us > watermark
        us, side, tie, doc = us[fresh].astype("int64"), side[fresh], tie[fresh], doc[fresh]
        self.held.add(us, [side, tie, doc], timerValues.getCurrentProcessingTimeInMs(), watermark)
        asked = side == 1
        if self.early and asked.any():
            records = self._records(*self.held.look(int(us[asked].max())))
            yield self._matched(key, records, us[asked], doc[asked], final=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        us, side, tie, doc = self.held.take(timerValues.getCurrentWatermarkInMs() * 1000)
        at, ties, known = self._records(us, side, tie, doc)
        if (side == 0).any():
            self.known.update((int(at[-1]), int(ties[-1]), known[-1]))
        due = side == 1
        if due.any():
            yield self._matched(key, (at, ties, known), us[due], doc[due], final=True)

    def _records(self, us, side, tie, doc):
        """The known record and those among the rows, in order."""
        found = [us[side == 0], tie[side == 0], doc[side == 0]]
        if self.known.exists():
            before = self.known.get()
            found = [np.append(column, np.array([v], column.dtype)) for column, v in zip(found, before)]
        order = np.lexsort((found[1], found[0]))
        return [column[order] for column in found]

    def _matched(self, key, records, trade_us, trades, final: bool) -> pd.DataFrame:
        at, _, known = records
        found = np.searchsorted(at, trade_us, side="right") - 1
        customer = [known[i] if i >= 0 else None for i in found]
        columns = {self.key_name: key[0], "trade": trades, "customer": customer, "final": final}
        return pd.DataFrame(columns, index=range(len(trades)))

    def close(self) -> None:
        pass
