"""Keyed master tables and the commit log of their batches.

A batch writes its rows into folders of its own, ``<table>/batch_id=<id>``, and is not there for readers until one
small file, ``_commits/<id>.json``, names everything that it wrote.  That file is written last and at once, so a
batch that wrote several tables shows in all of them or in none, whatever crashed in between; a batch that is run
again overwrites its own folders, and one that is committed is not run again.

A keyed master lays each batch out in buckets of a hash of the key, ``batch_id=<id>/key_bucket=<k>``, and the commit
tells the rows of each bucket.  To find the keys that the master has already, an append reads the key columns of the
buckets that its own keys fall in, and of no other.  ``compact`` puts the rows of all batches into one folder a bucket.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

BATCH, BUCKET = "batch_id", "key_bucket"
#: Buckets of a new keyed master.
BUCKETS = 64


class _Files:
    """The few file operations that a log needs, on whatever file system holds the path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.at(path).getFileSystem(self.conf)

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.at(path))] if self.fs.exists(self.at(path)) else []

    def text(self, path: str) -> str:
        stream = self.fs.open(self.at(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """Written beside its place and renamed, so no reader sees half of it."""
        draft = self.at(f"{path}.{uuid.uuid4().hex}.draft")
        stream = self.fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.rename(draft, self.at(path)):
            self.fs.delete(draft, False)
            raise FileExistsError(path)

    def delete(self, path: str) -> None:
        self.fs.delete(self.at(path), True)


class CommitLog:
    """The committed batches of one or several tables that are written together."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.files = path.rstrip("/"), _Files(spark, path)

    def commits(self) -> dict[str, dict]:
        """What each batch wrote, without batches that a later one replaces."""
        found = {n[:-5]: json.loads(self.files.text(f"{self.path}/{n}")) for n in self.files.names(self.path) if n.endswith(".json")}
        gone = {b for entry in found.values() for b in entry["replaces"]}
        return {b: entry for b, entry in found.items() if b not in gone}

    def has(self, batch) -> bool:
        return f"{batch}.json" in self.files.names(self.path)

    def commit(self, batch, tables: dict[str, dict], replaces: list[str] = ()) -> None:
        """Make the batch's tables (path to what was written) visible."""
        entry = {"tables": tables, "replaces": list(replaces)}
        self.files.put(f"{self.path}/{batch}.json", json.dumps(entry, sort_keys=True))


def log_of(table: str) -> str:
    """The place of a table's own log; readers of the folder skip names that start with an underscore."""
    return f"{table.rstrip('/')}/_commits"


def read_committed(spark: SparkSession, table: str, log: str | None = None, buckets: list[int] | None = None,
                   skip: tuple = ()) -> DataFrame | None:
    """The rows of the committed batches of a table, without layout columns; None if there are none.

    ``buckets`` reads only these of a keyed master, ``skip`` leaves batches out.
    """
    table, paths, schema = table.rstrip("/"), [], None
    for batch, entry in sorted(CommitLog(spark, log or log_of(table)).commits().items()):
        wrote = entry["tables"].get(table)
        if wrote is None or batch in skip:
            continue
        folder, schema = f"{table}/{BATCH}={batch}", wrote["schema"]
        if buckets is None:
            paths.append(folder)
        else:
            paths += [f"{folder}/{BUCKET}={k}" for k in buckets if str(k) in wrote["buckets"]]
    if schema is None:
        return None
    schema = StructType.fromJson(schema)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).option("recursiveFileLookup", True).parquet(*paths)


def write_batch(frame: DataFrame, table: str, batch) -> dict:
    """Write a batch's rows of a table; what its commit has to tell about it."""
    frame.write.mode("overwrite").parquet(f"{table.rstrip('/')}/{BATCH}={batch}")
    return {"schema": json.loads(frame.schema.json())}


class KeyedMaster:
    """A master table whose batches are laid out in buckets of its key."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = BUCKETS, log: str | None = None):
        self.spark, self.path, self.key = spark, path.rstrip("/"), list(key)
        self.log = CommitLog(spark, log or log_of(self.path))
        entries = [e["tables"][self.path] for e in self.log.commits().values() if self.path in e["tables"]]
        for wrote in entries:
            if wrote.get("key") != self.key:
                raise ValueError(f"{self.path} has the key {wrote.get('key')}, not {self.key}")
        self.buckets = entries[0]["of"] if entries else buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame | None:
        return read_committed(self.spark, self.path, self.log.path)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that the keys of ``rows`` fall in (one small number each)."""
        return sorted(r["k"] for r in rows.select(self.bucket().alias("k")).distinct().collect())

    def keys(self, buckets: list[int], skip: tuple = ()) -> DataFrame | None:
        """The distinct keys that these buckets hold."""
        rows = read_committed(self.spark, self.path, self.log.path, buckets, skip)
        return None if rows is None else rows.select(*self.key).distinct()

    def split(self, rows: DataFrame, order: list[str], skip: tuple = (), apart: Column | None = None,
              kept: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
        """``rows`` whose key is new, the first in ``order`` of each key; and the others.

        ``rows`` is read by each of the two, and once more if the master holds rows.  A null key is a value like any
        other.  Rows for which ``apart`` is true take no part: they are among the others, whatever their key, and as
        each is a group of its own, many of one key are no large group.

        ``kept``, the columns that ``order`` begins with, are all that the new rows have: the first row is found by them
        alone, as rows that tie in them are the same without the rest, and the rest is not read or moved for it.
        """
        names, lone = [F.col(f"`{c}`") for c in rows.columns], F.lit(None).cast("bigint")
        by = [F.col(f"`{c}`") for c in order]
        first, own = by, names
        if kept is not None:
            if order[:len(kept)] != list(kept):
                raise ValueError(f"the order {order} does not begin with {kept}")
            own = [F.col(f"`{c}`") for c in rows.columns if c in kept]
            # 0.0 and -0.0 tie in an order but are not the same
            signs = [F.when(F.col(f"`{c}`") == 0, F.col(f"`{c}`").cast("string")) for c, kind in rows.dtypes
                     if c in kept and kind in ("double", "float")]
            first, by = by[:len(kept)] + signs, by[:len(kept)] + signs + by[len(kept):]
        held = any(self.path in e["tables"] and b not in skip for b, e in self.log.commits().items())
        sure = rows if apart is None else rows.where(~apart)
        known = self.keys(self.touched(sure), skip) if held else None
        if known is not None:
            known = known.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(self.key)], lone.alias("_l"), F.lit(True).alias("_seen"))

        def told(some: DataFrame, by: list[Column]) -> DataFrame:
            nth = F.row_number().over(Window.partitionBy(*self.key, "_lone").orderBy(*by))
            some = some.withColumn("_nth", nth)
            if known is None:
                return some.withColumn("_known", F.lit(False))
            same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.key)] + [F.col("_lone").eqNullSafe(F.col("_l"))]
            return some.join(known, same, "left").withColumn("_known", F.coalesce("_seen", F.lit(False)))

        new = (F.col("_nth") == 1) & ~F.col("_known") & F.col("_lone").isNull()
        marked = rows.withColumn("_lone", lone if apart is None else F.when(apart, F.monotonically_increasing_id()))
        sure = sure.select(*own).withColumn("_lone", lone)
        return told(sure, first).where(new).select(*own), told(marked, by).where(~new).select(*names)

    def write(self, rows: DataFrame, batch) -> dict:
        """Write a batch's rows in buckets; what its commit has to tell about it."""
        at = f"{self.path}/{BATCH}={batch}"
        laid = rows.withColumn(BUCKET, self.bucket())
        laid.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(at)
        held = [n.split("=", 1)[1] for n in self.log.files.names(at) if n.startswith(f"{BUCKET}=")]
        return {"schema": json.loads(rows.schema.json()), "key": self.key, "of": self.buckets, "buckets": sorted(held, key=int)}

    def append(self, rows: DataFrame, batch=None, duplicates: str | None = None) -> None:
        """Append the rows whose key is new and commit; the rows left out go to the table ``duplicates``."""
        batch = batch or uuid.uuid4().hex
        if self.log.has(batch):
            return
        rows = rows.persist()
        try:
            new, again = self.split(rows, rows.columns)
            tables = {self.path: self.write(new, batch)}
            if duplicates:
                tables[duplicates.rstrip("/")] = write_batch(again, duplicates, batch)
            self.log.commit(batch, tables)
        finally:
            rows.unpersist()

    def compact(self) -> None:
        """Put the rows of all committed batches into one; the replaced folders stay until ``vacuum``."""
        old = self.log.commits()
        rows = self.read()
        if rows is not None and len(old) > 1:
            batch = uuid.uuid4().hex
            mine = [b for b, e in old.items() if list(e["tables"]) == [self.path]]  # tables of other paths are not merged here
            if len(mine) == len(old):
                self.log.commit(batch, {self.path: self.write(rows, batch)}, replaces=mine)

    def vacuum(self) -> None:
        """Delete the folders of batches that are not committed or replaced; no append may run meanwhile."""
        live = {f"{BATCH}={b}" for b in self.log.commits()}
        for name in self.log.files.names(self.path):
            if name.startswith(f"{BATCH}=") and name not in live:
                self.log.files.delete(f"{self.path}/{name}")
