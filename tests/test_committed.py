"""The sink that commits batches, and the as-of join with a small side."""

import pytest
from helpers import rows, stream_of, write_batches
from pyspark.sql import functions as F

from tidemark import operators, sources
from tidemark.plans import views
from tidemark.sources import committed


def documents(spark, n, first=0, doc="a"):
    ids = spark.range(first, first + n).select(F.col("id").cast("string").alias("id"))
    return ids.withColumn("doc", F.concat(F.lit(f'{{"v":"{doc}'), "id", F.lit('"}')))


def found(spark, path):
    return rows(sources.read_committed(spark, path))


def test_batches_are_committed(spark, tmp_path):
    frames = [documents(spark, 50), documents(spark, 50, 30, "b")]
    write_batches(frames, str(tmp_path / "in"))
    stream = stream_of(spark, frames[0].schema, str(tmp_path / "in"))
    path = f"file://{tmp_path}/out"
    sources.write_committed(stream, path, str(tmp_path / "cp"), availableNow=True).awaitTermination()
    expected = {r.id: r.doc for f in frames for r in f.collect()}
    assert dict(found(spark, path)) == expected


def test_a_killed_batch_leaves_each_document_once(spark, tmp_path):
    frame = documents(spark, 40).repartition(4)
    write_batches([frame], str(tmp_path / "in"))
    stream = stream_of(spark, frame.schema, str(tmp_path / "in")).repartition(4)
    path, flag = f"file://{tmp_path}/out", str(tmp_path / "killed")

    def killed(value):
        # The first attempt dies when some tasks have written their files.
        import os
        import time

        if value == "7" and not os.path.exists(flag):
            time.sleep(1)
            open(flag, "w").close()
            raise RuntimeError("killed")
        return value

    failing = stream.withColumn("id", F.udf(killed)("id"))
    with pytest.raises(Exception, match="killed"):
        sources.write_committed(failing, path, str(tmp_path / "cp"), availableNow=True).awaitTermination()
    assert not (tmp_path / "out" / "commits").exists()
    sources.write_committed(failing, path, str(tmp_path / "cp"), availableNow=True).awaitTermination()
    assert found(spark, path) == rows(frame)
    named = spark.read.json(f"{path}/commits").collect()
    kept = [f"{path}/files/{r.file}" for r in named]
    assert spark.read.json(kept).count() == 40 and {r.batch for r in named} == {0}


def test_files_of_attempts_without_commit_do_not_count(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    writer = committed.CommittedWriter(path)
    lost, first, again = (writer.write(iter(documents(spark, 3).collect())) for _ in range(3))
    writer.commit([first, None, writer.write(iter([]))], 0)
    writer.commit([again], 0)
    other = writer.write(iter(documents(spark, 3, 10).collect()))
    writer.abort([other, None, committed.Written(None)], 1)
    writer.commit([], 2)
    assert len({lost.file, first.file, again.file}) == 3
    assert found(spark, path) == rows(documents(spark, 3))
    assert not (tmp_path / "out" / "files" / other.file).exists()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_with_a_small_side(spark, sf_dir):
    trades, customers = views.trades(spark, sf_dir), views.customers(spark, sf_dir)
    more = spark.createDataFrame([(-1, None, 5.0), (-2, 3, None)], "trade_id long, customer_id long, amount double")
    trades = trades.unionByName(more, allowMissingColumns=True)
    customers = customers.unionByName(customers.limit(20).withColumn("value", F.col("value") + 1))
    small = operators.event_time_join(trades, customers, small_bytes=10**8)
    assert "BroadcastHashJoin" in plan(small) and "hashpartitioning" not in plan(small)
    assert "rangepartitioning" not in plan(small) and "Window" not in plan(small)
    want = operators.event_time_join(trades, customers)
    columns = ("trade_id", "customer_id", "ts", "amount", "customer")
    assert rows(small, *columns) == rows(want, *columns)
    assert small.where("customer is not null").count() > 100
    beyond = operators.event_time_join(trades, customers, small_bytes=1000)
    assert "BroadcastHashJoin" not in plan(beyond) and rows(beyond, *columns) == rows(want, *columns)


def test_join_with_no_records_and_with_maps(spark, sf_dir):
    trades, customers = views.trades(spark, sf_dir), views.customers(spark, sf_dir)
    none = operators.event_time_join(trades, customers.limit(0), small_bytes=10**8)
    assert none.where("customer is null").count() == trades.count()
    maps = customers.withColumn("m", F.create_map(F.lit("a"), "value"))
    # Maps have no order: such records take the way of a large side, whatever their size.
    assert "BroadcastHashJoin" not in plan(operators.event_time_join(trades, maps.drop("m"), small_bytes=1))
    from tidemark.operators.asof import _orderable

    assert _orderable(maps, "customer_id", "ts") is None
