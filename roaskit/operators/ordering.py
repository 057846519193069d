"""Global order operators without a single-partition window.

1. Range-partition on the order keys (Spark samples the bounds; a unique
   tie-break key lets a hot value be split) and sort inside each partition.
2. Number the rows with ``monotonically_increasing_id`` and ``checkpoint()``
   into the reliable folder: both passes then see the same partitions, and a
   lost executor recomputes nothing inconsistent.
3. One summary row per partition (a bound fixed by the partition count) gives
   each partition its offset, applied as one array literal.

All steps are built-in expressions, so other columns pass through untouched.
Global rank (W3 / M2), chronological splits and folds use it; running totals,
AUC and ROC the scan over written ranges of ``operators/scan.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roaskit.operators.scan import RANGE, SLOT, carried, in_order
from roaskit.session import ensure_checkpoint_dir

#: ``monotonically_increasing_id`` holds the partition above these bits and the row's place below them.
PLACE_BITS = 33


def _order_exprs(order_cols):
    return [F.col(c) if isinstance(c, str) else c for c in order_cols]


def _in_order(df: DataFrame, order: list[Column], partitions: int | None) -> tuple[DataFrame, int]:
    """``df`` in range partitions with ``_at`` (place in the total order), checkpointed; and the partition count."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .withColumn("_at", F.monotonically_increasing_id()))
    return placed.checkpoint(eager=True), parts


def _pid() -> Column:
    return F.shiftright("_at", PLACE_BITS).cast("int")


def _per_partition(values: list, kind: str) -> Column:
    """The row's partition's value, from one SQL array literal (repr() round-trips doubles)."""
    table = F.expr("array(" + ", ".join(f"{v!r}{kind}" for v in values) + ")")
    return F.element_at(table, _pid() + 1)


def running_totals(df: DataFrame, order_cols, value_cols: list[str], prefix: str = "cum_",
                   partitions: int | None = None, group_cols: list[str] | None = None) -> tuple[DataFrame, dict]:
    """Exact inclusive prefix sums of ``value_cols`` in ``order_cols`` order,
    restarting at every new value of ``group_cols`` when given; NULL counts as
    0, and NaN and infinities add up as doubles do.

    One shuffle: the table is written once in ranges of ``group_cols + order_cols``
    (``scan.in_order``), so one group that holds a third of all rows is split over
    many tasks; windows sum inside the ranges, and runs that cross a border take
    over the sums of the ranges before.  ``order_cols`` should end with a unique
    key when ties matter.  Returns the frame with ``prefix + col`` columns and,
    without groups, the grand totals (a dict of Python numbers).
    """
    group_cols, order = list(group_cols or []), _order_exprs(order_cols)
    groups = [F.col(g) for g in group_cols]
    placed = in_order(df, groups + order, partitions)
    key = F.struct(*groups) if groups else F.struct(F.lit(0).alias("_k"))
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in value_cols}
    in_run = Window.partitionBy(SLOT, *group_cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({f"_loc_{c}": F.sum(v).over(in_run) for c, v in value.items()})

    # one row per range: its first and last group, and the sums of the last
    sums = placed.groupBy(RANGE, SLOT, key.alias("_key")).agg(*[F.sum(v).alias(f"_off_{c}") for c, v in value.items()])
    offsets = [f"_off_{c}" for c in value_cols]
    ends = sums.groupBy(RANGE, SLOT).agg(F.min("_key").alias("_first"), F.max(F.struct("_key", *offsets)).alias("_last"))
    known = ends.select(RANGE, F.col("_last._key").alias("_key"), *[F.col(f"_last.{c}").alias(c) for c in offsets])
    before = carried(ends.select(RANGE, SLOT, F.col("_first").alias("_key")), known, dict.fromkeys(offsets, "sum"))
    out = local.join(F.broadcast(before), SLOT, "left")
    for c in value_cols:
        offset = F.when(F.col("_key").eqNullSafe(key), F.coalesce(f"_off_{c}", F.lit(0.0))).otherwise(F.lit(0.0))
        out = out.withColumn(prefix + c, F.col(f"_loc_{c}") + offset)
    grand = {} if groups else placed.agg(*[F.coalesce(F.sum(v), F.lit(0.0)).alias(c) for c, v in value.items()]).first().asDict()
    return out.drop(RANGE, SLOT, "_key", *offsets, *[f"_loc_{c}" for c in value_cols]), grand


def global_rank(df: DataFrame, order_cols, name: str = "rank", partitions: int | None = None) -> tuple[DataFrame, int]:
    """1-based row number over a total order; returns (frame, row count).

    A row's place in its partition plus the rows of the partitions before: one shuffle, no window.
    """
    placed, parts = _in_order(df, _order_exprs(order_cols), partitions)
    counts = {r["_pid"]: r["count"] for r in placed.groupBy(_pid().alias("_pid")).count().collect()}  # one row per partition
    before, n = [], 0
    for p in range(parts):
        before.append(n)
        n += counts.get(p, 0)
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return placed.withColumn(name, place + 1 + _per_partition(before, "L")).drop("_at"), n


def top_k(df: DataFrame, k: int, order_cols) -> DataFrame:
    """O2: best ``k`` rows (``TakeOrderedAndProject``: per-partition top-k, then merge)."""
    return df.orderBy(*_order_exprs(order_cols)).limit(k)


def seeded_sample(df: DataFrame, n: int, seed: int, id_cols: list[str]) -> DataFrame:
    """O3: deterministic sample of at most ``n`` rows: the ``n`` smallest seeded hashes (MD5 of
    the seed and the ids, joined by ``|``, so other engines can draw the same rows)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in id_cols]).cast("binary"))
    return df.withColumn("_h", h).orderBy("_h", *id_cols).limit(n).drop("_h")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values (filter choices)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)
