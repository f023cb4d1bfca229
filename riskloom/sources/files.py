"""File sources and sinks: typed CSV scan, Parquet sink/scan, CSV sink, reuse.

Reads use an explicit schema (derived from a contract) so there is no inference pass;
``infer_schema=True`` is kept as an option. Existence checks go through the Hadoop
FileSystem API, so they work on any cluster file system, not only a local disk. A materialised table is
reused while its source is the one it was made from.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.features import parse_timestamp

CORRUPT_COL = "_corrupt_record"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType | None = None,
    infer_schema: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Header CSV; malformed rows kept (PERMISSIVE) with the raw line when asked."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        if keep_corrupt:
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType(), True)])
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", bool(infer_schema))
    return reader.csv(path)


def with_parsed_timestamp(df: DataFrame, column: str | None) -> DataFrame:
    """Parse the datetime column when present; bad text becomes NULL (for the contract)."""
    if not column or column not in df.columns:
        return df
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return df
    return df.withColumn(column, parse_timestamp(F.col(f"`{column}`").cast("string")))


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def ingest_csv_to_parquet(
    spark: SparkSession,
    raw_path: str,
    parquet_path: str,
    *,
    schema: T.StructType | None = None,
    datetime_col: str | None = None,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> str:
    """CSV -> typed DataFrame -> Parquet; returns the Parquet path."""
    df = with_parsed_timestamp(read_csv(spark, raw_path, schema=schema, infer_schema=schema is None), datetime_col)
    return write_parquet(df, parquet_path, mode=mode, partition_by=partition_by)


MANIFEST = "_manifest"


def source_state(spark: SparkSession, raw_path: str) -> dict[str, str]:
    """Fingerprint of the files of each folder under ``raw_path``, by the folder's path below it.

    Count, bytes and a hash of names, sizes and times of change, added up by Spark from the file listing (no content is read); a
    row per folder reaches the driver.
    """
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(raw_path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = fs.makeQualified(hpath).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(raw_path).select("path", "length", "modificationTime")
    named = files.withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1)).where(~F.substring_index("path", "/", -1).rlike("^[._]"))
    mark = F.xxhash64(F.substring_index("path", "/", -1), "length", "modificationTime")
    per = named.groupBy("folder").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), F.sum(mark.cast("decimal(38,0)")).alias("mark"))
    found = {}
    for r in per.collect():
        at = r["folder"].find(root.split(":", 1)[-1].lstrip("/"))
        inner = r["folder"][at + len(root.split(":", 1)[-1].lstrip("/")) :].strip("/") if at >= 0 else ""
        found[inner] = f"{r['n']} files, {r['bytes']} bytes, {r['mark']}"
    return found


def _manifest(spark: SparkSession, parquet_path: str) -> dict | None:
    """What was written with the table, None if there is no table or it was not finished."""
    if not path_exists(spark, f"{parquet_path}/{MANIFEST}"):
        return None
    return json.loads(spark.read.text(f"{parquet_path}/{MANIFEST}", wholetext=True).first()[0])


def _options(kw: dict) -> dict:
    schema = kw.get("schema")
    return {"schema": schema.json() if schema is not None else None, "datetime_col": kw.get("datetime_col"), "partition_by": list(kw.get("partition_by", ()))}


def materialize(
    spark: SparkSession,
    raw_path: str,
    parquet_path: str,
    *,
    reuse: bool = True,
    **kw,
) -> DataFrame:
    """The Parquet table of a raw CSV file or folder, ingested only as far as the source has changed.

    A manifest beside the table holds the fingerprint of the source's files (:func:`source_state`), the schema and the options. With
    ``reuse`` the table is taken as it is if all agree. If the source is a folder of ``column=value`` folders and the table is
    partitioned by that column, only folders that changed are read again and replace their partitions, and partitions whose folders are gone
    go; else everything is written anew. Without schema and options the call takes those of the manifest.
    The manifest is written last, so a job that dies in between is ingested again. A missing raw file is an error naming the path.
    """
    if not path_exists(spark, raw_path):
        raise FileNotFoundError(f"raw input {raw_path} does not exist")
    old = _manifest(spark, parquet_path) if reuse else None
    if old and not kw:
        stored = old["options"]
        kw = {"schema": T.StructType.fromJson(json.loads(stored["schema"])) if stored["schema"] else None, "datetime_col": stored["datetime_col"], "partition_by": stored["partition_by"]}
    new = {"options": _options(kw), "files": source_state(spark, raw_path)}
    if old != new:
        changed = _changed_folders(old, new)
        if changed is None:
            ingest_csv_to_parquet(spark, raw_path, parquet_path, **kw)
        else:
            _replace_partitions(spark, raw_path, parquet_path, old, new, changed, kw)
        spark.createDataFrame([(json.dumps(new),)], "manifest string").coalesce(1).write.mode("overwrite").text(f"{parquet_path}/{MANIFEST}")
    return spark.read.parquet(parquet_path)


def _changed_folders(old: dict | None, new: dict) -> list[str] | None:
    """Folders to read again, None if the whole table must be written."""
    by = new["options"]["partition_by"]
    if not old or old["options"] != new["options"] or len(by) != 1:
        return None
    if not all(re.fullmatch(f"{re.escape(by[0])}=[^/]+", folder) for folder in {*old["files"], *new["files"]}):
        return None
    return sorted(folder for folder, mark in new["files"].items() if old["files"].get(folder) != mark)


def _replace_partitions(spark: SparkSession, raw_path: str, parquet_path: str, old: dict, new: dict, changed: list[str], kw: dict) -> None:
    column = new["options"]["partition_by"][0]
    schema = kw.get("schema")
    if schema is not None:
        schema = T.StructType([f for f in schema.fields if f.name != column])
    for folder in changed:
        value = unquote(folder.split("=", 1)[1])
        part = read_csv(spark, f"{raw_path}/{folder}", schema=schema, infer_schema=schema is None).withColumn(column, F.lit(value))
        part = with_parsed_timestamp(part, kw.get("datetime_col"))
        part.write.partitionBy(column).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(parquet_path)
    for folder in sorted({*old["files"]} - {*new["files"]}):
        gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{parquet_path}/{folder}")
        gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
