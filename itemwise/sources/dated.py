"""Dated sources: one folder per day, many parquet files per folder."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_dated(spark: SparkSession, root: str, prefix: str, schema: T.StructType | None = None,
               days: Sequence[str] | None = None, ds: str = "ds", position: str | None = None) -> DataFrame:
    """Read ``<root>/<prefix><day>/**.parquet`` for the given days (all days
    when ``days`` is None) as one DataFrame with a ``ds`` column taken from
    the folder name.  Non-parquet files in the folders are skipped; missing
    columns in some files read as null (declared schema, or mergeSchema).
    With a declared schema a day without a folder, or with no parquet file,
    has no rows, and no day at all gives the empty source.

    ``position`` names a column for a row's place: its file and its number in
    it, which order the rows as reading the files one after another would."""
    place = [T.StructField(position, POSITION)] if position else []
    paths = [f"{root}/{prefix}{d}" for d in days] if days else [f"{root}/{prefix}*"]
    if schema is not None:
        paths = [p for p in paths if _exists(spark, p)]
        if not paths:
            return empty_like(spark, T.StructType([*schema.fields, *place, T.StructField(ds, T.StringType())]))
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    df = reader.parquet(*paths)
    day = F.regexp_extract(F.col("_metadata.file_path"), re.escape(prefix) + r"([0-9]+)", 1)
    return (with_position(df, position) if position else df).withColumn(ds, day)


POSITION = T.StructType([T.StructField("file", T.StringType()), T.StructField("row", T.LongType())])


def with_position(df: DataFrame, name: str) -> DataFrame:
    """A scan of parquet files with each row's place.  It is read off the file,
    so it is the same for any split of the files and after a task is run again."""
    return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"),
                                        F.col("_metadata.row_index").alias("row")))


def _exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any folder matches, in whatever store the path names."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(conf).globStatus(path)
    return found is not None and len(found) > 0


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty source with its declared columns, so later joins still work."""
    return spark.createDataFrame([], schema)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column missing from a frame is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_days(stage: DataFrame, days: Sequence[str], ds: str = "ds") -> DataFrame:
    """Rows of the wanted days from a ``ds``-partitioned stage (partition
    pruning reads only those folders).  A wanted day that is absent is
    reported; none present is an error."""
    wanted = list(days)
    present = {r[0] for r in stage.where(F.col(ds).isin(wanted)).select(ds).distinct().collect()}
    absent = [d for d in wanted if d not in present]
    if not present:
        raise ValueError(f"none of the wanted days is in the stage: {absent}")
    if absent:
        warnings.warn(f"days without rows in the stage: {absent}", stacklevel=2)
    return stage.where(F.col(ds).isin(sorted(present)))
