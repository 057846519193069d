"""Join operators: as-of join (J5), composite left join with suffixes (J3),
full alignment with fill (J6) and the duplicate-key guard (J8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roaskit.functions.scalars import micros
from roaskit.operators.scan import RANGE, SLOT, carried, in_order


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def asof_join(left: DataFrame, right: DataFrame, by, left_ts: str, right_ts: str,
              right_cols: list[str], tie_col: str, how: str = "left",
              partitions: int | None = None) -> DataFrame:
    """For each left row, the latest right row with the same ``by`` key and
    ``right_ts <= left_ts``; equal time stamps are "at or before".  Ties on
    ``right_ts`` go to the smallest ``tie_col``.

    Each side is read once and their union shuffled once, into ranges of (key,
    time) that are cut by rows (``scan.in_order``): neither a key that holds a
    third of all rows nor a burst within one instant is one task.

    1. inside each range, rows ordered by time (right before left on a tie),
       ``last(ignorenulls)`` carries the latest right row forward;
    2. one summary row per range tells the last right row of its last key, and
       an associative scan over these rows what each range starts with;
    3. each left row takes its match in the range, else the carried one.

    The ranges are written when this is called.
    """
    by = _cols(by)
    payload_fields = [right_ts] + [c for c in right_cols if c != right_ts]
    if tie_col not in payload_fields:
        payload_fields.append(tie_col)

    r = right.select(*[F.col(k) for k in by], *[F.col(c) for c in payload_fields])
    r = r.where(F.col(right_ts).isNotNull() & F.col(tie_col).isNotNull())
    for k in by:
        r = r.where(F.col(k).isNotNull())
    r = r.select(*by, micros(right_ts).alias("_t"), F.lit(0).alias("_kind"), F.col(tie_col).alias("_tie"),
                 F.lit(0).cast("long").alias("_apart"), F.struct(*payload_fields).alias("_p"))

    lcols = left.columns
    l_side = left.select(*[F.col(k) for k in by], micros(left_ts).alias("_t"), F.lit(1).alias("_kind"),
                         F.xxhash64(*lcols).alias("_apart"), F.struct(*[F.col(c) for c in lcols]).alias("_l"))
    order = [*map(F.col, by), F.col("_t"), F.col("_kind"), F.col("_tie").desc_nulls_last(), F.col("_apart")]
    rows = in_order(r.unionByName(l_side, allowMissingColumns=True), order, partitions)

    # 1: running last right row inside the range
    w_in = Window.partitionBy(SLOT, *by).orderBy(*order[len(by):]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    win = rows.withColumn("_m", F.last("_p", ignorenulls=True).over(w_in))

    # 2: the last right row of each range's last key, carried on
    key, place = F.struct(*by), F.struct((-F.col("_t")).alias("t"), F.col("_tie").alias("tie"))
    known = (rows.where("_kind = 0").groupBy(RANGE, SLOT, key.alias("_key")).agg(F.min_by("_p", place).alias("_carry"))
             .groupBy(RANGE, SLOT).agg(F.max_by("_carry", "_key").alias("_carry"), F.max("_key").alias("_key")))
    probes = rows.where("_kind = 1").groupBy(RANGE, SLOT).agg(F.min(key).alias("_key"))
    before = carried(probes, known.drop(SLOT), {"_carry": "last"})

    # 3: the match in the range, else the carried one
    out = win.where("_kind = 1").select(SLOT, key.alias("_by"), "_l", "_m").join(F.broadcast(before), SLOT, "left")
    out = out.withColumn("_best", F.coalesce("_m", F.when(F.col("_by").eqNullSafe(F.col("_key")), F.col("_carry"))))
    if how == "inner":
        out = out.where(F.col("_best").isNotNull())
    extra = [F.col("_best").getField(c).alias(c) for c in payload_fields if c in right_cols or c == right_ts]
    return out.select(*[F.col("_l").getField(c).alias(c) for c in lcols], *extra)


def join_with_suffixes(left: DataFrame, right: DataFrame, on: list[str], how: str = "left",
                       suffixes=("_left", "_right")) -> DataFrame:
    """Composite-key join; clashing non-key columns get suffixes."""
    clash = (set(left.columns) & set(right.columns)) - set(on)
    l2 = left.select(*[F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c) for c in left.columns])
    r2 = right.select(*[F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c) for c in right.columns])
    return l2.join(r2, on=on, how=how)


def full_align(left: DataFrame, right: DataFrame, on: list[str], fill: float = 0.0) -> DataFrame:
    """Full outer alignment on the key, missing values filled (``Series.add(fill_value=0)``)."""
    j = left.join(right, on=on, how="full")
    vals = [c for c in j.columns if c not in on]
    return j.select(*on, *[F.coalesce(F.col(c), F.lit(fill)).alias(c) for c in vals])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (would fan out a join)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """J8 as a guard: raises when a key repeats, else returns ``df`` unchanged."""
    bad = duplicate_keys(df, keys).limit(5).collect()
    if bad:
        raise ValueError(f"duplicate keys {keys}: {[tuple(r) for r in bad]}")
    return df
