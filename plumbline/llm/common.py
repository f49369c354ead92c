"""Tables, shared folders and helpers that all training-data operators use."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once.
SLICE_BYTES = 1 << 18
#: Bytes of an Arrow batch that goes to a Python worker.
BATCH_BYTES = 8 << 20
#: Rows of a batch that Parquet readers hold, and bytes of a row group that writers
#: hold: both are for texts of kilobytes, not for numbers.
BATCH_ROWS, ROW_GROUP_BYTES = 512, 32 << 20
#: Bytes of an operator's source for each file of an intermediate table.
FILE_BYTES = 32 << 20
#: Folders of the `file` scheme are written without checksum files and without a
#: process started for each file's permissions; other schemes don't read these.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
#: Words `[^\x20\x09-\x0D]+`, as Java's split() wants their gaps.
GAP = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir where
    the cluster names one, else (tests, one machine) a folder of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session is already down
        pass


class Work:
    """Intermediate tables of one call, written to the shared folder.

    A written table cuts the lineage and survives lost executors.  Tables that
    a result still reads go when the session ends; drop() removes one earlier."""

    def __init__(self, spark: SparkSession, what: str, source: DataFrame | None = None) -> None:
        """source: what the call reads; its size (as the optimizer knows it from
        the files) says how many files a table is worth."""
        self.size = size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) if source is not None else 0
        self.files = max(2 * spark.sparkContext.defaultParallelism, min(-(-size // FILE_BYTES), (1 << 31) - 1))
        self.spark, self.base = spark, f"{shared_dir(spark)}/plumbline/{what}-{uuid.uuid4().hex}"
        atexit.register(_delete, spark, self.base)
        # Long texts and wide rows: the number of rows alone doesn't bound a batch.
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(BATCH_ROWS))

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def keep(self, df: DataFrame, name: str, codec: str = "uncompressed") -> DataFrame:
        """Writes and reads again.  Most of these tables are hashes, which don't
        compress; a codec is for such as hold texts."""
        path = self.path(name)
        self.few(df).write.mode("overwrite").option("compression", codec).option("parquet.block.size", ROW_GROUP_BYTES).options(**PLAIN_FILES).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def few(self, df: DataFrame) -> DataFrame:
        """df in no more tasks than its source's size asks for (two a core at the
        least): small inputs don't become hundreds of small files."""
        return df.coalesce(self.files)

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(self.spark, self.path(name))

    def release(self) -> None:
        """Let Spark remove the shuffle files of plans that are done with."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def binary_rows(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of a flat array, as binary values."""
    data = np.ascontiguousarray(flat)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets * data.itemsize, dtype=np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def row_key(*cols: str):
    """A key for one row: rows that agree in all of cols are alike."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in cols])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
