"""What the operators of this subpackage share: reading a table, cutting lineage, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir, which all executors share. Only where it names
    none and one machine does all work, as in tests, a folder of this machine is made and set."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="stratafold-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """df without its lineage: a reliable checkpoint in the shared folder. For slim rows: ids, hashes, counts, never texts."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: Rows and bytes of an Arrow batch with texts in it.
BATCH_ROWS, BATCH_BYTES = 2_000, 16 << 20


def in_batches(df: DataFrame) -> DataFrame:
    """df, whose texts are about to go to Python. Spark's batches of 10,000 rows are for slim rows; where the session has not been
    told otherwise, its batches are made smaller, so that a worker and Arrow's buffers hold a few megabytes each."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return None


def returned() -> None:
    """Gives memory that this process no longer uses back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def lean(run: Callable) -> Callable:
    """run, a function for mapInArrow. Spark keeps Python workers for later tasks; here each gives its memory back when a task ends."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            returned()

    return each


def stored(docs: DataFrame) -> int:
    """Bytes of the input as the files hold them, by what Spark knows, or, where it knows nothing, half the bytes of the texts."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= 1 << 60:
        size = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 2
    return size


def chunks(column: pa.Array, most: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8; null as empty) of runs of rows with at most `most` bytes together,
    one row at least. No text is cut."""
    first, size, held = 0, 0, []
    for i, x in enumerate(column.cast(pa.large_binary())):
        data = x.as_py() or b""
        if held and size + len(data) > most:
            yield first, held
            first, size, held = i, 0, []
        held.append(data)
        size += len(data)
    if held:
        yield first, held


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8; null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
