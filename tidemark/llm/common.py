"""Tables kept between steps, and words as bytes."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_RNG = np.random.default_rng(20240229)
_WORD_WEIGHTS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session may go without that setting; it then gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written as a table of the shared folder and read back: a cut in the lineage."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove the files of a :func:`stored` table that nothing reads any more."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


def map_batches(
    df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch], dict], keeps: str = ""
) -> DataFrame:
    """``rows`` turns a batch into columns by name; batches are bounded by Spark's Arrow limits.

    ``keeps`` names what it keeps by :func:`of_worker`; what others have kept is let go.
    """
    names = [part.split()[0] for part in _fields(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_worker(keeps)
        for batch in batches:
            if batch.num_rows:
                out = rows(batch)
                yield pa.RecordBatch.from_arrays([out[n] for n in names], names=names)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose binary or list ``column`` holds at most ``most`` bytes or entries,
    or one row that holds more."""
    values = batch.column(column)
    sizes = values.value_lengths() if pa.types.is_list(values.type) else pc.binary_length(values)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


_HOLDER = "tidemark_of_worker"


def of_worker(name: str) -> dict:
    """A dictionary that lasts until the Python worker ends or turns to another name.

    Functions travel by value, so the variables of their modules are made anew for every task;
    what takes long to make is kept in a module that is found by its name instead. Spark hands
    idle workers from one job to the next, so what was kept under any other name is let go:
    otherwise the caches of all steps of a session would add up in each worker.
    """
    holder = sys.modules.setdefault(_HOLDER, types.ModuleType(_HOLDER))
    kept = vars(holder).setdefault("kept", {})
    others = kept.keys() - {name}
    for other in others:
        del kept[other]
    if others:
        pa.default_memory_pool().release_unused()
    return kept.setdefault(name, {})


def _fields(schema: str) -> list[str]:
    depth, fields = 0, [""]
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            fields.append("")
        else:
            fields[-1] += c
    return [f.strip() for f in fields]


def texts(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns with ``text`` as UTF-8 bytes; a missing text is empty."""
    return df.select(*columns, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def words(text: bytes) -> list[bytes]:
    """Maximal runs of bytes other than ``\\x20`` and ``\\x09-\\x0D``, A-Z in lower case."""
    return text.translate(_LOWER).split()


def hash_words(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of fewer words, the whole sequence."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(n, size)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total += hashes[i : n - width + 1 + i] * _WORD_WEIGHTS[i]
    return np.unique(mixed(total))
