"""Out-of-order streams put into event-time order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_time_sort_stream(
    events: DataFrame, keys: list[str], ts: str = "ts", tie: str = "event_id"
) -> DataFrame:
    """Hold events back until the watermark has passed them.

    ``events`` needs a watermark on ``ts``. Every batch then gives exactly the
    events that became due, all of them later than those of the batches before.
    Start the query inside `strict_lateness` to have late rows dropped, and write
    it with `sorted_batches` to have the rows of a batch in order.

    Events wait in groups of one key and one instant, so the events of a busy key
    are spread over all tasks.
    """
    rest = [c for c in events.columns if c not in (*keys, ts)]
    by_tie = [tie, *[c for c in rest if c != tie]]
    due = events.groupBy(*keys, ts).agg(
        F.sort_array(F.collect_list(F.struct(*by_tie))).alias("__due")
    )
    rows = due.select(*keys, ts, F.inline("__due"))
    return rows.select(*events.columns)


def sorted_batches(keys: list[str], order: list[str], write):
    """A ``foreachBatch`` function that sorts each batch before ``write(batch, id)``."""

    def sort_and_write(batch: DataFrame, batch_id: int) -> None:
        by = [*keys, *order]
        write(batch.repartitionByRange(*by).sortWithinPartitions(*by), batch_id)

    return sort_and_write
