"""A sink of documents whose batches take effect as a whole, written as a Python data source."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

import tidemark

# The source travels with its query, so executors need not have the package.
cloudpickle.register_pickle_by_value(tidemark)

FORMAT = "committed_documents"
_FILES, _COMMITS = "files", "commits"


def write_committed(documents: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start a stream of ``id, doc`` into a folder that `read_committed` reads.

    ``path`` is a URI of a store that pyarrow reaches from all executors (``file:`` on a shared
    disk, ``hdfs:``, ``s3:`` and others). Each task writes a file of its own and reports its name;
    a batch counts once the driver has written the list of its files. A batch that fails leaves
    files that no list names; one that is run again replaces its list.
    """
    documents.sparkSession.dataSource.register(CommittedDocuments)
    sink = documents.select("id", "doc").writeStream.format(FORMAT).outputMode("append")
    if trigger:
        sink = sink.trigger(**trigger)
    return sink.option("checkpointLocation", checkpoint).start(path)


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """``id, doc`` of all committed batches; of documents of one id, that of the last batch."""
    lists = spark.read.schema("batch long, file string").json(f"{path.rstrip('/')}/{_COMMITS}")
    lists = lists.where(F.col("file").isNotNull())
    files = spark.read.schema("id string, doc string").json(f"{path.rstrip('/')}/{_FILES}")
    named = files.select("*", F.col("_metadata.file_name").alias("file")).join(lists, "file")
    return named.groupBy("id").agg(F.max_by("doc", F.struct("batch", "doc")).alias("doc"))


class CommittedDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "id string, doc string"

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return CommittedWriter(self.options["path"])


@dataclass
class Written(WriterCommitMessage):
    file: str | None


class CommittedWriter(DataSourceStreamWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator) -> Written:
        """Put the rows of a task into a new file; an attempt never touches that of another."""
        store, base = _store(self.path)
        name, out = f"{uuid.uuid4().hex}.json", None
        for row in iterator:
            if out is None:
                store.create_dir(f"{base}/{_FILES}", recursive=True)
                out = store.open_output_stream(f"{base}/{_FILES}/{name}")
            out.write(json.dumps({"id": row["id"], "doc": row["doc"]}).encode() + b"\n")
        if out is None:
            return Written(None)
        out.close()
        return Written(name)

    def commit(self, messages, batchId: int) -> None:
        """Name the files of a batch: under a name of its own first, so that lists are whole."""
        store, base = _store(self.path)
        store.create_dir(f"{base}/{_COMMITS}", recursive=True)
        lines = [{"batch": batchId, "file": m.file} for m in messages if m is not None and m.file]
        # Spark's readers pass over names that begin with a dot.
        draft = f"{base}/{_COMMITS}/.{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            out.write("".join(json.dumps(line) + "\n" for line in lines).encode())
        store.move(draft, f"{base}/{_COMMITS}/{batchId:020d}.json")

    def abort(self, messages, batchId: int) -> None:
        """Remove what the tasks that did end have written."""
        store, base = _store(self.path)
        for m in messages:
            if m is not None and m.file:
                store.delete_file(f"{base}/{_FILES}/{m.file}")


def _store(path: str):
    from pyarrow.fs import FileSystem

    store, base = FileSystem.from_uri(path if ":" in path else f"file://{path}")
    return store, base.rstrip("/")
