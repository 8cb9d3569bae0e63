"""Stages whose days are replaced atomically.

Every write puts its days' files under a fresh name and then adds one
manifest, a small text file that names the folder of each day.  A manifest is
numbered; the next number is claimed by creating its file, which only one
writer can do, and the file is complete before it gets its name.  Readers take
the manifest of the highest number, so they see a day before or after its
replacement and never between, also when a writer fails halfway: without a
manifest its files are in nobody's way until ``vacuum`` removes them.

A manifest has a line for each day, so its size is bounded by the days, never
by the rows.  The store has to refuse a rename onto a file that exists, as HDFS
does; a local folder is only looked at first, which is enough for one driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemwise.sources.files import write_stage

MANIFESTS, DATA = "_manifests", "data"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"     # the folder of rows without a day


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    store, place = _store(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(place)) if store.exists(place) else []


def versions(spark: SparkSession, stage: str) -> list[int]:
    return [int(n) for n in _names(spark, f"{stage}/{MANIFESTS}") if n.isdigit()]


def manifest(spark: SparkSession, stage: str, version: int | None = None) -> dict[str, str]:
    """Day -> folder of the newest (or a given) version; empty before any."""
    known = versions(spark, stage)
    if not known:
        return {}
    rows = spark.read.text(f"{stage}/{MANIFESTS}/{known[-1] if version is None else version:012d}").collect()
    return dict(json.loads(r.value) for r in rows)


def _claim(spark: SparkSession, stage: str, version: int, days: dict[str, str]) -> bool:
    """Whether this writer made the version: the file is written aside and
    renamed, and a rename onto an existing name is refused."""
    folder = f"{stage}/{MANIFESTS}"
    store, target = _store(spark, f"{folder}/{version:012d}")
    _, aside = _store(spark, f"{folder}/.{uuid.uuid4().hex}")
    text = "".join(json.dumps([d, days[d]]) + "\n" for d in sorted(days))
    out = store.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not store.exists(target) and store.rename(aside, target):
        return True
    store.delete(aside, False)
    return False


def replace_days(df: DataFrame, stage: str, ds: str = "ds", files_per_day: int = 8, tries: int = 20) -> int:
    """Write the days that ``df`` holds, replacing those the stage has, and
    return the new version.  Writers of other days may run at the same time:
    the one that comes second adds its days to the other's manifest."""
    spark = df.sparkSession
    fresh = f"{DATA}/{uuid.uuid4().hex}"
    write_stage(df, f"{stage}/{fresh}", ds, files_per_day)
    made = {n.split("=", 1)[1]: f"{fresh}/{n}" for n in _names(spark, f"{stage}/{fresh}") if n.startswith(f"{ds}=")}
    return _switch(spark, stage, lambda have: have | made, tries)


def drop_days(spark: SparkSession, stage: str, days: list[str], tries: int = 20) -> int:
    return _switch(spark, stage, lambda have: {d: f for d, f in have.items() if d not in days}, tries)


def _switch(spark: SparkSession, stage: str, change, tries: int) -> int:
    for _ in range(tries):
        version = max(versions(spark, stage), default=0) + 1
        have = manifest(spark, stage, version - 1) if version > 1 else {}
        if _claim(spark, stage, version, change(have)):
            return version
    raise RuntimeError(f"{stage}: other writers took {tries} versions in a row")


def read_days(spark: SparkSession, stage: str, schema: T.StructType, ds: str = "ds",
              days: list[str] | None = None, version: int | None = None) -> DataFrame:
    """The stage as its newest (or a given) version has it; ``days`` reads only
    those.  A day is text.  What was read stays what it was: later versions
    write elsewhere."""
    have = manifest(spark, stage, version)
    wanted = sorted(have) if days is None else [d for d in days if d in have]
    if not wanted:
        return spark.createDataFrame([], schema)
    inner = T.StructType([f for f in schema.fields if f.name != ds])
    df = spark.read.schema(inner).parquet(*[f"{stage}/{have[d]}" for d in wanted])
    place = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    day = F.nullif(F.url_decode(F.element_at(F.split(place, "=", 2), 2)), F.lit(NO_DAY))
    return df.withColumn(ds, day).select(*[F.col(f"`{c}`") for c in schema.fieldNames()])


def vacuum(spark: SparkSession, stage: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` versions and every data folder that
    none of them names.  Not while a writer is at work."""
    known = versions(spark, stage)
    kept = known[-keep:]
    named = {f.split("/")[1] for v in kept for f in manifest(spark, stage, v).values()}
    for v in known[:-keep]:
        store, place = _store(spark, f"{stage}/{MANIFESTS}/{v:012d}")
        store.delete(place, False)
    for n in _names(spark, f"{stage}/{DATA}"):
        if n not in named:
            store, place = _store(spark, f"{stage}/{DATA}/{n}")
            store.delete(place, True)
