"""What several corpus operators share: the word pattern, scratch tables, Arrow text access and hash folds."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run without ASCII white space. bytes.split() splits at the same characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of an Arrow batch that are worked on and given back at a time.
AT_ONCE = 256


class Scratch:
    """Intermediate tables of one operator run, written as Parquet to the folder that the cluster shares.

    The folder is the session's spark.checkpoint.dir; only a local session without one gets a folder of our own.
    Written tables cut lineage: a lost executor costs the tasks that it ran, not the whole plan.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = "/tmp/checkpoints"
        self.root = f"{root.rstrip('/')}/noticeloom-{uuid.uuid4().hex}"
        atexit.register(self._leave)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _leave(self) -> None:
        """Results may be read as long as the program runs; then the folder goes."""
        with contextlib.suppress(Exception):  # the session may be gone by now
            self.drop()

    def drop(self, name: str = "") -> None:
        """Delete a table that nothing reads any more; without a name, all of them."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def binary(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 of a text column without decoding it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, AT_ONCE at most at a time: a batch of whole texts is tens of megabytes, and what is made of it as many again."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def crc_fold(folds: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def uniform(*columns: Column | str, seed: int) -> Column:
    """A number in (0, 1) that depends on the columns and the seed alone."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("long"), *columns), 11).cast("double") + 0.5) / float(2**53)
