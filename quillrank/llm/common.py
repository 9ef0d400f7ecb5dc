"""Helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One run of ASCII white space; words are what lies between.
WORD_GAP = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; null has none. split() leaves an empty item at either end."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


@functools.lru_cache(maxsize=1)
def _local_root() -> str:
    return f"file://{tempfile.mkdtemp(prefix='quillrank-')}"


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share: below spark.checkpoint.dir, or in tests a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            root = current.get()
        elif spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
            root = _local_root()
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = f"{root.rstrip('/')}/quillrank-{uuid.uuid4().hex}"
    for made in _scopes:
        made.append(folder)
    return folder


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, all folders that shared_dir() gave within it: what is made of them must be written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        dropped(spark, *_scopes.pop())


def few(df: DataFrame) -> DataFrame:
    """df from a quarter as many tasks as the session's shuffles have, or four a core if that is more: a small table that comes
    out of a shuffle would else be as many small files. The number follows the session's setting, and so the size of the job."""
    spark = df.sparkSession
    return df.coalesce(max(int(spark.conf.get("spark.sql.shuffle.partitions")) // 4, 4 * spark.sparkContext.defaultParallelism))


def stored(df: DataFrame, folder: str | None = None, shuffled: bool = True) -> DataFrame:
    """df, written to the shared folder and read back: it cuts the lineage and survives lost executors. shuffled: it comes out of
    a shuffle and SQL alone, and is written from few() tasks; else, as for all work in Python, each partition is a task and a file."""
    spark = df.sparkSession
    folder = folder or shared_dir(spark)
    (few(df) if shuffled else df).write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def dropped(spark: SparkSession, *folders: str) -> None:
    """Deletes folders of stored() that nothing reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def freed(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files that no plan refers to any more: it does so when the driver's JVM collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def task_files(df: DataFrame) -> int:
    """Partitions for work that is bound by Python: a few for each core, by what the session says."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer; QUILLRANK_TOKENIZERS names another folder than the usual one."""
    return os.path.join(os.environ.get("QUILLRANK_TOKENIZERS", "/opt/tokenizers"), name)


def slices(batch: pa.RecordBatch, column: int, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, so many at a time that the texts of a column have about size bytes; a longer text comes alone."""
    before = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.flatnonzero(np.diff(before // size, prepend=0)).tolist()
    for a, b in zip([0, *cuts], [*cuts, len(batch)], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run, after which a Python worker gives its freed memory back: Spark keeps the worker for later tasks, beside others."""

    @functools.wraps(run)
    def tidied(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return tidied
