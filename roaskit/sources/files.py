"""File sources and sinks.

Spreadsheet exports are read all-string and typed afterwards with ``try_``
casts; type inference would turn numeric ids into integers and break the
text-id rule of the contracts.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roaskit.sources.master import BUCKETS, KeyedMaster, log_of, read_committed

BOM = "﻿"


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               fmt: str | None = None, header: bool = True) -> DataFrame:
    """Headered CSV (or parquet) scan with a declared schema."""
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_messy_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8",
                   header: bool = True, multiline: bool = True,
                   columns: list[str] | None = None) -> DataFrame:
    """Spreadsheet export: odd separators, latin-1, quoted line breaks, BOM,
    blank trailing columns.  Everything is read as text; the blank header columns
    Spark names ``_c<n>`` are dropped."""
    reader = (spark.read.option("sep", sep).option("encoding", encoding)
              .option("multiLine", multiline).option("quote", '"').option("escape", '"')
              .option("header", header).option("inferSchema", False))
    if columns is not None:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    df = reader.csv(path)
    keep = [c for c in df.columns if not re.fullmatch(r"_c\d+", c)]
    return df.select(*keep)


def normalize_name(name: str) -> str:
    """S3 rule for one name: strip BOM, lower-case, space and '-' -> '_'."""
    return re.sub(r"[ \-]", "_", name.replace(BOM, "").strip().lower())


def normalize_columns(df: DataFrame) -> DataFrame:
    """S3: normalise every column name."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def rename_columns(df: DataFrame, mapping: dict[str, str], first_as: str | None = None) -> DataFrame:
    """Rename by map; ``first_as`` renames the first column (e.g. ``year_period``)."""
    mapping = dict(mapping)
    if first_as is not None and df.columns:
        mapping[df.columns[0]] = first_as
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def scan_drop_folder(spark: SparkSession, path: str, glob: str = "*.csv",
                     schema: StructType | None = None, header: bool = True) -> DataFrame:
    """One scan over every file of a folder, with the file name as provenance."""
    reader = (spark.read.option("header", header).option("pathGlobFilter", glob)
              .option("recursiveFileLookup", False))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    return df.withColumn("source_file", F.col("_metadata.file_name"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrite an output table."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; storage and permission errors are raised."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def append_to_master(spark: SparkSession, df: DataFrame, path: str, key: list[str] | None = None,
                     fmt: str = "parquet", duplicates: str | None = None, buckets: int = BUCKETS) -> None:
    """Append rows to a master table, creating it when missing.

    With ``key`` the master is laid out in ``buckets`` of its key (``master.KeyedMaster``) and the append is
    idempotent: rows whose key already exists in the master are left out, for which only the buckets that the
    rows' keys fall in are read, and of rows that share a key the first in the order of all columns wins, so one
    file delivered twice does not double the table.  The rows left out are appended to the table ``duplicates``,
    when given.  Both show at once, when the append is committed; read them with ``read_master``.
    """
    if not key:
        df.write.mode("append").format(fmt).save(path)
        return
    if fmt != "parquet":
        raise ValueError("a keyed master is parquet")
    KeyedMaster(spark, path, key, buckets).append(df, duplicates=duplicates)


def read_master(spark: SparkSession, path: str, of: str | None = None) -> DataFrame | None:
    """The committed rows of a keyed master, or of the table of rows that appends to the master ``of`` left out."""
    return read_committed(spark, path, log_of(of) if of else None)
