"""Line-delimited JSON: strict scans that name the faulty line, typed reads, and writers."""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan(spark: SparkSession, path: str, required: Sequence[str] = (), known: Sequence[str] | None = None) -> DataFrame:
    """file, line_no, line and issue of each line; issue is null for a good one.

    Lines are numbered within their file, which is one task's to number; a run's table is a folder of many files.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"), F.col("value").alias("line"))
    lines = lines.withColumn("line_no", F.row_number().over(Window.partitionBy("file").orderBy("_b", "_i")))
    value = F.try_parse_json("line")
    keys = F.json_object_keys("line")
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    issue = F.when(F.trim("line") == "", "blank line").when(value.isNull(), "bad JSON").when(~is_object, "not an object")
    if required:
        issue = issue.when(F.size(F.array_except(F.array(*map(F.lit, required)), keys)) > 0, "missing field")
    if known is not None:
        issue = issue.when(F.size(F.array_except(keys, F.array(*map(F.lit, known)))) > 0, "unknown field")
    return lines.select("file", "line_no", "line", issue.alias("issue"))


def read(spark: SparkSession, path: str, schema: StructType | str, required: Sequence[str] = (), closed: bool = True) -> DataFrame:
    """Typed rows; the first faulty line is an error that names it. A missing path has no rows."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
        return spark.createDataFrame([], schema)
    kind = spark.createDataFrame([], schema).schema
    bad = scan(spark, path, required, kind.names if closed else None).where("issue is not null").orderBy("file", "line_no").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['file']}, line {bad[0]['line_no']}: {bad[0]['issue']}")
    return spark.read.schema(kind).json(path, mode="FAILFAST")


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def replace(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """The whole table anew; Spark commits its files at once."""
    df.write.mode("overwrite").partitionBy(*by).json(path)


def document(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A file that is one JSON object, as one row."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def torn(spark: SparkSession, path: str) -> DataFrame:
    """Files whose last line has no line break."""
    files = spark.read.format("binaryFile").load(path)
    return files.where((F.col("length") > 0) & (F.substring("content", -1, 1) != F.lit(b"\n"))).select("path")


def repair(path: str) -> int:
    """Cuts a local file after its last line break, and tells how many bytes went. Only done when asked for."""
    size = at = os.path.getsize(path)
    with open(path, "rb+") as f:
        keep = 0
        while at and not keep:  # from the end, block by block
            begin = max(0, at - (1 << 16))
            f.seek(begin)
            found = f.read(at - begin).rfind(b"\n")
            keep, at = (begin + found + 1 if found >= 0 else 0), begin
        f.truncate(keep)
    return size - keep


def write_document(path: str, value: object) -> None:
    """A local JSON document, complete or not at all."""
    part = f"{path}.part"
    with open(part, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, sort_keys=True, ensure_ascii=False)
        f.write("\n")
        f.flush()
        os.fsync(f.fileno())
    os.replace(part, path)


def catalog(spark: SparkSession, root: str, schema: str = "run_id string, created_at string, status string") -> DataFrame:
    """Runs, one for each folder that holds a manifest, the newest first."""
    return listed(document(spark, f"{root}/*/manifest.json", schema))


def listed(manifests: DataFrame) -> DataFrame:
    """Runs, the newest first, those of one time by falling id."""
    return manifests.orderBy(F.desc("created_at"), F.desc("run_id"))


def cached(wanted: DataFrame, store: DataFrame, digest: str = "digest") -> DataFrame:
    """wanted with the store's payload, null where there is none."""
    return wanted.join(store.dropDuplicates([digest]), digest, "left")
