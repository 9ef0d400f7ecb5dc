"""Places in an order over a whole table, and digests of what stands in one."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillrank.sources import scratch

#: monotonically_increasing_id() counts the rows of a partition in so many bits.
_ROW_BITS = 33


def numbered(df: DataFrame, *order: str, name: str = "position", first: int = 1) -> DataFrame:
    """df with each row's place in the order of columns that tell all rows apart.

    Rows are dealt out by ranges and counted within them, and written once, so that the ranges hold; then each range's count, of which
    there is one for each partition, moves those after it. No task has the whole table.
    """
    spark = df.sparkSession
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path := scratch.folder(spark, "numbered"))
    rows = spark.read.schema(", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), "_at bigint"])).parquet(path)
    rows = rows.withColumn("_range", F.shiftright("_at", _ROW_BITS))
    counts = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n") + first).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return rows.join(F.broadcast(before), "_range").select(*df.columns, place.cast("long").alias(name))


def digest(df: DataFrame, column: str, order: str | None = None, head: str = "", between: str = "", tail: str = "", render: Callable[[str], str] = str, name: str = "digest") -> DataFrame:
    """One row: the SHA-256 of all values of a column, rendered, with head, between and tail; in their own order or that of another
    column. Nulls are left out.

    The digest of a sequence is made from end to end. Values are sorted by ranges; one task then streams them, range after range, and
    holds no more than a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, any_ = hashlib.sha256(head.encode()), False
        for batch in batches:
            for value in batch.column(0).to_pylist():
                out.update(((between if any_ else "") + render(value)).encode())
                any_ = True
        out.update(tail.encode())
        yield pa.RecordBatch.from_arrays([pa.array([out.hexdigest()])], [name])

    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v"), F.col(order or column).alias("o"))
    ordered = values.repartitionByRange("o", "v").sortWithinPartitions("o", "v").select("v").coalesce(1)
    none = hashlib.sha256((head + tail).encode()).hexdigest()  # of an empty table no task may run
    return ordered.mapInArrow(run, f"{name} string").agg(F.coalesce(F.max(name), F.lit(none)).alias(name))
