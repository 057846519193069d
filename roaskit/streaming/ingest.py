"""Incremental drop-folder ingestion (S8, T1, T2) with Structured Streaming.

The stream lists new files in the inbox (file source + checkpoint).  Each
micro-batch groups its files by their header line, and one header at a time is
read by name: an alias stands for its column, order does not matter, and the
first contract whose columns the header holds takes the file.  Every row is
checked against that contract; accepted rows go to the master table, the
others to the quarantine with their reasons and their raw text.  Rows with too
few or too many fields are rejected as ``malformed_row``, rows of files that
no contract takes as ``unknown_header``.

Quoted line breaks belong to their field: files with a line that leaves a
quote open are read whole, one task a file, the others in splits.  Only a
file's first line is its header; a later line that equals it is data.  Files
without a byte are nothing to Spark's file source.

Exactly-once output: every micro-batch writes to ``<table>/batch_id=<id>``
with overwrite, and its master, quarantine and counts become visible together
when its commit (``<master>/_commits/<id>.json``) is written, last of all;
``read_committed`` reads committed batches only.  ``foreachBatch`` is
at-least-once -- a batch replayed after a crash has the same id and the same
files, so it replaces its own earlier output, and a committed one is not run
again.  ``cleanSource=archive`` moves a file out of the inbox once a later
batch has committed.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roaskit.functions.scalars import sha256_id
from roaskit.operators.quality import Contract, validation_counts, with_errors
from roaskit.sources.master import BUCKETS, CommitLog, KeyedMaster, log_of, write_batch

#: Columns that ingestion adds to the contract's own.
SOURCE, RAW, MALFORMED = "source_file", "raw", "_malformed"
#: Table of the rows of files that none of several contracts takes.
UNROUTED = "unrouted"


def header_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file (None if it is empty)."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def header_names(line: str) -> list[str]:
    """Column names of a header line, without a byte order mark and outer spaces."""
    return [c.strip() for c in next(csv.reader([line.lstrip("\ufeff")]), [])]


def route(names: list[str], contracts: list[Contract]) -> Contract | None:
    """Q1: the first contract whose columns the header holds once each, by name or alias."""
    for contract in contracts:
        told = columns_by_name(names, contract)
        if all(told.count(c) == 1 for c in contract.types):
            return contract
    return None


def columns_by_name(names: list[str], contract: Contract) -> list[str]:
    """Header names with aliases resolved; an alias beside its own column stays as it is."""
    return [contract.aliases[c] if contract.aliases.get(c, c) not in names else c for c in names]


def _literal(path: str) -> str:
    """A path in which no character is a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _with_breaks(spark: SparkSession, paths: list[str]) -> set[str]:
    """The names of the files in which a line leaves a quote open (at most the files of a micro-batch)."""
    rows = spark.read.text([_literal(p) for p in paths]).select(F.col("_metadata.file_path").alias("path"), "value")
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    return {r["path"] for r in rows.where(quotes % 2 == 1).select("path").distinct().collect()}


def _same_file(listed: str, told: set[str]) -> bool:
    """Whether a listed file is among the paths that a scan told, which escape some characters."""
    tails = {unquote(p).split(":", 1)[-1].lstrip("/") for p in told}
    return unquote(listed).split(":", 1)[-1].lstrip("/") in tails or listed.split(":", 1)[-1].lstrip("/") in tails


def _cells(spark: SparkSession, names: list[str], paths: list[str], contract: Contract, breaks: bool) -> DataFrame:
    """The contract's columns as text, with source file, raw row and malformed line, of files with one header."""
    fields = [f"_c{i}" for i in range(len(names))]
    schema = StructType([StructField(c, StringType()) for c in [*fields, MALFORMED]])
    rows = (spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
            .option("multiLine", breaks).option("columnNameOfCorruptRecord", MALFORMED).csv([_literal(p) for p in paths]))
    told = columns_by_name(names, contract)
    whole = F.to_json(F.struct(*[F.col(c).alias(f"{n}#{i}" if names.count(n) > 1 else n) for i, (c, n) in enumerate(zip(fields, names))]),
                      {"ignoreNullFields": "false"})
    return rows.select(*[F.col(fields[told.index(c)]).alias(c) for c in contract.types],
                       F.col("_metadata.file_name").alias(SOURCE), F.coalesce(MALFORMED, whole).alias(RAW), MALFORMED)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines below the header, of files that no contract takes: one field, no quotes, the first line skipped."""
    rows = (spark.read.schema(f"{RAW} string").option("header", True).option("enforceSchema", True).option("sep", "\u0001")
            .option("quote", "").option("escape", "\u0002").csv([_literal(p) for p in paths]))
    return rows.select(F.col("_metadata.file_name").alias(SOURCE), RAW, F.array(F.lit("unknown_header")).alias("errors"))


def _store(spark: SparkSession, cells: DataFrame | None, strangers: DataFrame | None, contract: Contract, master: str,
           quarantine: str, dedup_key: list[str] | None, counts: str | None, batch_id: int, log: CommitLog, buckets: int) -> dict:
    """Check one contract's rows of a batch and write its tables; ``strangers`` go to the quarantine as they are.

    Returns what the batch's commit tells about the tables."""
    if cells is None:
        cells = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*contract.types, SOURCE, RAW, MALFORMED]))
    checked = with_errors(cells, contract)
    broken = F.when(F.col(MALFORMED).isNotNull(), F.array(F.lit("malformed_row"))).otherwise(F.array().cast("array<string>"))
    checked = checked.withColumn("errors", F.concat(broken, "errors")).drop(MALFORMED)
    if contract.hashed:  # in rejected rows too, and their raw text with them
        checked = checked.withColumns({c: sha256_id(c) for c in [*contract.hashed, RAW]})
    # each table's write reads the files of the batch again: less work than to keep all rows, and a task reads no more than its split
    rejected, wrote = F.size("errors") > 0, {}
    if dedup_key:
        # the first row in order of the contract's columns, then file and text, wins; the others are kept in quarantine
        keyed = KeyedMaster(spark, master, dedup_key, buckets, log.path)
        stays = [*contract.types, SOURCE]
        good, bad = keyed.split(checked, [*stays, RAW], skip=(str(batch_id),), apart=rejected, kept=stays)
        bad = bad.withColumn("errors", F.when(rejected, F.col("errors")).otherwise(F.array(F.lit("duplicate_key"))))
    else:
        good, bad = checked.where(~rejected).drop("errors"), checked.where(rejected)
    if strangers is not None:
        bad = bad.unionByName(strangers, allowMissingColumns=True)
    if counts:  # Q8: accepted / rejected per file, one small table per batch
        every = checked.select(SOURCE, "errors")
        if strangers is not None:
            every = every.unionByName(strangers.select(SOURCE, "errors"))
        wrote[counts] = write_batch(validation_counts(every, [SOURCE]), counts, batch_id)
    wrote[master] = keyed.write(good, batch_id) if dedup_key else write_batch(good.drop(RAW), master, batch_id)
    wrote[quarantine] = write_batch(bad, quarantine, batch_id)
    return wrote


def _batch_writer(spark: SparkSession, contracts: list[Contract], several: bool, master: str, quarantine: str,
                  dedup_key: list[str] | None, counts: str | None, buckets: int):
    log = CommitLog(spark, log_of(master))

    def process(batch: DataFrame, batch_id: int) -> None:
        if log.has(batch_id):  # the crash came after the commit
            return
        # at most max_files_per_trigger names; the source tells some twice when a name holds a pattern character
        files = sorted({r["path"] for r in batch.select("path").collect()})
        by_header = defaultdict(list)
        for path in files:
            by_header[header_line(spark, path) or ""].append(path)
        cells, strangers, breaks = defaultdict(list), [], _with_breaks(spark, files) if files else set()
        for line, paths in by_header.items():
            names = header_names(line)
            contract = route(names, contracts)
            if contract is None:
                strangers.append(_lines(spark, paths))
                continue
            split = {b: [p for p in paths if _same_file(p, breaks) == b] for b in (False, True)}
            cells[contract.name] += [_cells(spark, names, own, contract, b) for b, own in split.items() if own]
        union = lambda frames: reduce(DataFrame.unionByName, frames) if frames else None
        odd, wrote = union(strangers), {}
        for contract in contracts:
            mine = f"/{contract.name}" if several else ""
            rows = union(cells[contract.name])
            if rows is not None or not several:
                wrote |= _store(spark, rows, None if several else odd, contract, f"{master}{mine}", f"{quarantine}{mine}",
                                dedup_key, f"{counts}{mine}" if counts else None, batch_id, log, buckets)
        if several and odd is not None:
            wrote[f"{quarantine}/{UNROUTED}"] = write_batch(odd, f"{quarantine}/{UNROUTED}", batch_id)
        log.commit(batch_id, wrote)
    return process


def ingest_stream(spark: SparkSession, inbox: str, contract: Contract | list[Contract], master: str, quarantine: str,
                  checkpoint: str, archive: str | None = None, glob: str = "*.csv",
                  dedup_key: list[str] | None = None, available_now: bool = True,
                  max_files_per_trigger: int = 1000, counts: str | None = None, buckets: int = BUCKETS):
    """Start the ingestion stream; with ``available_now`` it processes what
    is in the inbox and stops (call again later, or run continuously with
    ``available_now=False``).  With a list of contracts each has its own tables
    ``<master>/<contract name>`` and ``<quarantine>/<contract name>``, and rows
    of files that none takes go to ``<quarantine>/unrouted``.
    ``max_files_per_trigger`` bounds each micro-batch (its file names and header
    lines are read on the driver, and its files are read again for each table
    that is written); ``available_now`` still drains the whole inbox, batch
    by batch.  With ``dedup_key`` a master is laid out in ``buckets`` of the key,
    and a batch reads the keys of the buckets that its own fall in.  Returns the ``StreamingQuery``."""
    several = not isinstance(contract, Contract)
    # only the names are selected, so the contents are not read here
    reader = (spark.readStream.format("binaryFile").option("pathGlobFilter", glob)
              .schema("path string, modificationTime timestamp, length long, content binary")
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    write = _batch_writer(spark, list(contract) if several else [contract], several, master.rstrip("/"), quarantine.rstrip("/"),
                          dedup_key, counts.rstrip("/") if counts else None, buckets)
    writer = reader.load(inbox).select("path").writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_available(spark: SparkSession, *args, **kwargs) -> None:
    """Run ``ingest_stream`` over what is in the inbox now and wait for it."""
    q = ingest_stream(spark, *args, available_now=True, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
