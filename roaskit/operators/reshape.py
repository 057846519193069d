"""Set and reshape operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaskit.functions.scalars import MONTH_NAMES, clean_numeric, month_number


def tag_union(frames: dict[str, DataFrame], tag_col: str = "source") -> DataFrame:
    """UNION ALL by name with a literal tag per input."""
    tagged = [df.withColumn(tag_col, F.lit(tag)) for tag, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def duplicate_row_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows, distinct rows and duplicates (rows - distinct) in one row."""
    d = df.select(*(cols or df.columns))
    total = d.agg(F.count(F.lit(1))).scalar()
    distinct = d.distinct().agg(F.count(F.lit(1)).alias("distinct_rows")).withColumn("total_rows", total)
    return distinct.select("total_rows", "distinct_rows",
                           (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"))


def _month_cells(df: DataFrame, id_cols: list[str], year_col: str) -> DataFrame:
    """Wide month columns -> a row per cell: text, year, month and number (NULL where there is none)."""
    months = [c for c in df.columns if c.lower() in MONTH_NAMES]
    cells = df.unpivot(id_cols, months, "month", "_cell")
    cell = F.col("_cell").cast("string")
    money = F.regexp_replace(cell, r"^([^()]*)\(([^()]*)\)\s*$", "-$1$2")  # accounting negatives: one expression, no branch
    return cells.withColumns({"_cell": cell, "_y": F.col(year_col).cast("string").try_cast("int"),
                              "_m": month_number(F.col("month")), "_number": clean_numeric(F.regexp_replace(money, r"\$", ""))})


def unpivot_months(df: DataFrame, id_cols: list[str], year_col: str = "year", value_name: str = "value",
                   drop_null_values: bool = True) -> DataFrame:
    """Wide month columns -> long rows with a first-of-month ``date``.

    Only month columns present are unpivoted (a ``total`` column is not); cell
    text like ``"1,252"`` / ``"$52,392 "`` / ``"($12.00)"`` is parsed as money,
    and a percent is no amount.  Rows without a valid year or month are dropped,
    and rows without a value too unless ``drop_null_values`` is False;
    ``rejected_month_cells`` returns the cells that hold text and were dropped.
    """
    long = _month_cells(df, id_cols, year_col).where(F.col("_y").isNotNull() & F.col("_m").isNotNull())
    if drop_null_values:
        long = long.where(F.col("_number").isNotNull())
    keep = [c for c in id_cols if c != year_col]
    return long.select(*keep, F.make_date("_y", "_m", F.lit(1)).alias("date"), F.col("_number").alias(value_name))


def rejected_month_cells(df: DataFrame, id_cols: list[str], year_col: str = "year") -> DataFrame:
    """The cells with text that ``unpivot_months`` cannot place: no number in them, or no year beside them."""
    cells = _month_cells(df, id_cols, year_col).where(F.trim("_cell") != "")
    cells = cells.where(F.col("_y").isNull() | F.col("_m").isNull() | F.col("_number").isNull())
    return cells.select(*id_cols, "month", F.col("_cell").alias("cell"))


def pivot_wide(df: DataFrame, index: list[str], column: str, values: list, value_col: str,
               fill: float = 0.0) -> DataFrame:
    """Long -> wide with a fixed value list (no discovery job), missing -> ``fill``."""
    p = df.groupBy(*index).pivot(column, values).agg(F.sum(value_col))
    return p.fillna(fill, subset=[str(v) for v in values])


def one_hot(df: DataFrame, levels: dict[str, list], null_indicator: bool = True, drop: bool = True) -> DataFrame:
    """``<col>_<value>`` 0/1 columns for the given levels plus ``<col>_nan``.

    Levels are explicit (a model's feature list), so the expression is static
    and needs no distinct pass over the data.  Where two indicators would share
    a name (a level ``nan`` beside the NULL indicator, or ``a_b`` of two
    columns), the later one gets underscores at its end.
    """
    new = {}

    def add(name: str, is_level) -> None:
        while name in new:
            name += "_"
        new[name] = F.when(is_level, 1).otherwise(0)
    for col, vals in levels.items():
        for v in vals:
            add(f"{col}_{v}", F.col(col) == F.lit(v))
        if null_indicator:
            add(f"{col}_nan", F.col(col).isNull())
    out = df.withColumns(new)
    return out.drop(*levels.keys()) if drop else out


def discover_levels(df: DataFrame, cols: list[str]) -> dict[str, list]:
    """Sorted non-null values of each categorical column (as text), from one pass over the data.

    They are the feature list of a model: every one becomes a column.
    """
    from pyspark.ml.feature import StringIndexer

    found = StringIndexer(inputCols=cols, outputCols=[f"_{c}_index" for c in cols], handleInvalid="skip",
                          stringOrderType="alphabetAsc").fit(df.select(*[F.col(c).cast("string") for c in cols]))
    return dict(zip(cols, map(list, found.labelsArray)))


def align_features(df: DataFrame, features: list[str], keep: list[str] | None = None) -> DataFrame:
    """Exactly ``features`` in order; missing -> 0, extra columns dropped."""
    have = set(df.columns)
    cols = [F.col(c) if c in have else F.lit(0).alias(c) for c in features]
    return df.select(*[F.col(k) for k in (keep or [])], *cols)


def min_max_scale(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """(x - min) / (max - min); NULL when the column is constant.  The
    bounds are one scalar subquery attached as a column (no cross join)."""
    b = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    t = df.withColumn("_mm", b)
    scaled = F.try_divide(F.col(col) - F.col("_mm.lo"), F.col("_mm.hi") - F.col("_mm.lo"))
    return t.withColumn(out or f"{col}_scaled", scaled).drop("_mm")
