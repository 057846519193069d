"""Ordered scans: running values over a total order with one data-sized shuffle.

``in_order`` range-partitions a table on its order (Spark samples the bounds, so a hot key or a burst is cut by
rows) and writes it once to the shared folder, each range as a bucket of its own.  Windows over ``SLOT`` then run
inside the ranges without a further exchange, and lost executors read the written table again.  What a range starts
with is carried over its border from one summary row per range: an associative scan, in which a range that lies
within one group passes on what it got.  The summary has one row per range, so its broadcast is bounded by the
number of ranges, whatever the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roaskit.session import delete_at_exit, ensure_checkpoint_dir

#: The range's place in the order, and the bucket that holds it.
RANGE, SLOT = "_range", "_slot"

_SLOTS: dict[int, list[int]] = {}


def _slots(spark: SparkSession, n: int) -> list[int]:
    """For each of n buckets the least number that Spark puts into it, so no two ranges share a bucket."""
    if n not in _SLOTS:
        tried, found = 8 * n, {}
        while len(found) < n:
            tried *= 4
            number = F.col("id").cast("int")
            rows = spark.range(tried).groupBy(F.pmod(F.hash(number), F.lit(n)).alias("bucket")).agg(F.min(number).alias("slot")).collect()
            found = {r["bucket"]: r["slot"] for r in rows}
        _SLOTS[n] = [found[b] for b in range(n)]
    return _SLOTS[n]


def in_order(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """``df`` in ranges of ``order``, written once, with the columns ``RANGE`` and ``SLOT``.

    Rows that are equal in ``order`` stay in one range: end it with a unique column where there may be many.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slot = F.element_at(F.array(*[F.lit(s) for s in _slots(spark, n)]), F.col(RANGE) + 1)
    placed = df.repartitionByRange(n, *order).withColumn(RANGE, F.spark_partition_id()).withColumn(SLOT, slot)
    names = [f"c{k}" for k in range(len(df.columns))]  # any column name may be stored
    table = f"roaskit_scan_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}"
    delete_at_exit(spark, path)
    placed.toDF(*names, RANGE, SLOT).write.format("parquet").bucketBy(n, SLOT).option("path", path).saveAsTable(table)
    stored = spark.table(table).toDF(*df.columns, RANGE, SLOT)
    spark.sql(f"drop table {table}")  # the entry only; the frame goes on reading its files
    return stored


def carried(probes: DataFrame, known: DataFrame, carry: dict[str, str]) -> DataFrame:
    """What each range's first group takes over from earlier ranges: (SLOT, ``_key``, the columns of ``carry``).

    ``probes`` has (RANGE, SLOT, ``_key``): the first group of each range.  ``known`` has (RANGE, ``_key``, values):
    the last group of each range and what it ends with.  ``carry`` names for each value the aggregate that joins
    ranges: ``sum``, or ``last`` for the last that is not null.  As groups stand in order, the earlier ranges that
    end with a group are all that hold rows of it.
    """
    rows = probes.withColumn("_probe", F.lit(0)).unionByName(known.withColumn("_probe", F.lit(1)), allowMissingColumns=True)
    before = Window.partitionBy("_key").orderBy(RANGE, "_probe").rowsBetween(Window.unboundedPreceding, -1)
    joined = {c: F.sum(c).over(before) if how == "sum" else F.last(c, ignorenulls=True).over(before) for c, how in carry.items()}
    return rows.withColumns(joined).where("_probe = 0").select(SLOT, "_key", *carry)
