"""Data contracts, row-level validation with quarantine, profiling (Q1-Q10).

A contract is a declared schema (target types, required columns, aliases)
plus named boolean rules.  ``validate`` evaluates every rule for every row in
one pass and collects *all* failed rule names in an ``errors`` array, so a bad
row is quarantined with its reasons instead of failing the whole file.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roaskit.functions.scalars import sha256_id


@dataclass
class Contract:
    name: str
    types: dict[str, str]                       # column -> Spark SQL type
    required: list[str] = field(default_factory=list)      # must be non-null
    rules: dict[str, Column] = field(default_factory=dict)  # rule name -> predicate on typed columns
    aliases: dict[str, str] = field(default_factory=dict)   # alternative header -> column
    hashed: list[str] = field(default_factory=list)         # PII columns stored as SHA-256

    def header_matches(self, columns) -> bool:
        """Q1: the (alias-resolved) header holds every declared column."""
        cols = {self.aliases.get(c, c) for c in columns}
        return set(self.types) <= cols


def order_line_contract(min_qty: int = 1, max_discount: float = 1.0) -> Contract:
    """Q3: order lines -- ids required, numeric qty / price, ``qty >= min_qty``,
    ``unit_price >= 0``, ``discount <= max_discount``; a ``datetime`` header
    is accepted as ``order_datetime``."""
    return Contract(
        name="order_lines",
        types={"order_id": "string", "customer_id": "string", "order_datetime": "timestamp_ntz",
               "sku": "string", "qty": "bigint", "unit_price": "double", "discount": "double"},
        required=["order_id", "customer_id", "order_datetime", "sku", "qty", "unit_price", "discount"],
        rules={"qty:min": F.col("qty") >= min_qty,
               "unit_price:non_negative": F.col("unit_price") >= 0,
               "discount:max": F.col("discount") <= max_discount},
        aliases={"datetime": "order_datetime"})


def web_session_contract() -> Contract:
    """Q4 + Q9: web sessions -- every field required, a parseable start time;
    the user id is stored as its SHA-256."""
    return Contract(
        name="web_sessions",
        types={"user_id": "string", "session_id": "string", "session_start": "timestamp_ntz", "source": "string",
               "medium": "string", "campaign": "string"},
        required=["user_id", "session_id", "session_start", "source", "medium", "campaign"],
        hashed=["user_id"])


#: Channels whose monthly trends are reported.
TREND_CHANNELS = ["paid search", "paid social", "affiliates"]


def monthly_trends_contract() -> Contract:
    """Q5: monthly trends before they are used -- known channel, no negative spend or revenue, no gaps."""
    types = {"date": "date", "mapping_key": "string", "total_spend": "double", "net_revenue": "double",
             "monthly_roas": "double", "monthly_cac": "double"}
    return Contract("monthly_trends", types, required=list(types), rules={
        "mapping_key:known": F.col("mapping_key").isin(TREND_CHANNELS),
        "total_spend:non_negative": F.col("total_spend") >= 0,
        "net_revenue:non_negative": F.col("net_revenue") >= 0})


def channel_roas_contract() -> Contract:
    """Q5: channel ROAS -- every figure present, no negative spend."""
    types = {"marketing_channel": "string", "true_total_ad_spend": "double", "total_revenue": "double",
             "corrected_roas": "double"}
    return Contract("channel_roas", types, required=list(types), rules={
        "true_total_ad_spend:non_negative": F.col("true_total_ad_spend") >= 0})


def match_contract(columns, contracts: list[Contract]) -> str | None:
    """Q1: name of the first contract whose columns the header holds, else None."""
    for c in contracts:
        if c.header_matches(columns):
            return c.name
    return None


def check_columns(df: DataFrame, expected: list[str], strict: bool = False, ordered: bool = False) -> list[str]:
    """Q6: problems with the header (missing, unexpected when strict, out of order when ordered)."""
    problems = [f"missing column {c}" for c in expected if c not in df.columns]
    if strict:
        problems += [f"unexpected column {c}" for c in df.columns if c not in expected]
    if ordered and [c for c in df.columns if c in expected] != [c for c in expected if c in df.columns]:
        problems.append("column order differs")
    return problems


def _typed(df: DataFrame, contract: Contract) -> DataFrame:
    df = df.withColumnsRenamed({a: c for a, c in contract.aliases.items() if a in df.columns})
    exprs = {}
    for c, t in contract.types.items():
        raw = F.col(c)
        if t in ("timestamp", "timestamp_ntz"):
            typed = F.coalesce(F.try_to_timestamp(raw.cast("string")),
                               F.try_to_timestamp(raw.cast("string"), F.lit("M/d/yyyy H:mm"))).cast(t)
        elif t in ("int", "bigint"):  # "2.0" is a whole number, "2.5" is not
            number = raw.cast("string").try_cast("double")
            whole = F.when((F.abs(number) < 2.0**53) & (number == F.floor(number)), number).try_cast(t)
            typed = F.coalesce(raw.cast("string").try_cast(t), whole)
        elif t in ("double", "float"):  # NaN and infinities are no values
            number = raw.cast("string").try_cast(t)
            typed = F.when(F.abs(number) < float("inf"), number)  # NaN is larger
        else:
            typed = raw.cast("string").try_cast(t) if t != "string" else raw.cast("string")
        exprs[c] = typed
    return df.select(
        *[F.col(c) for c in df.columns if c not in contract.types],
        *[F.col(c).cast("string").alias(f"_raw_{c}") for c in contract.types],
        *[exprs[c].alias(c) for c in contract.types])


def _checks(df: DataFrame, contract: Contract):
    """Typed frame (with ``_raw_`` copies) and the (rule name, passes) list."""
    t = _typed(df, contract)
    checks = []
    for c in contract.required:
        checks.append((f"{c}:not_null", F.col(f"_raw_{c}").isNotNull() & (F.trim(F.col(f"_raw_{c}")) != "")))
    for c, ty in contract.types.items():
        if ty != "string":
            checks.append((f"{c}:type_{ty}", F.col(f"_raw_{c}").isNull() | F.col(c).isNotNull()))
    for name, pred in contract.rules.items():
        checks.append((name, F.coalesce(pred, F.lit(False))))  # a NULL fails the rule
    passes = reduce(lambda a, b: a & b, [ok for _, ok in checks]) if checks else F.lit(True)
    return t, checks, passes


def _reasons(checks) -> Column:
    return F.filter(F.array(*[F.when(~ok, F.lit(n)) for n, ok in checks]), lambda x: x.isNotNull())


def with_errors(df: DataFrame, contract: Contract) -> DataFrame:
    """Typed columns plus ``errors array<string>`` naming every failed rule
    (empty for a good row; the reasons array is built only for failing rows)."""
    t, checks, passes = _checks(df, contract)
    errs = F.when(passes, F.array().cast("array<string>")).otherwise(_reasons(checks))
    return t.withColumn("errors", errs).drop(*[f"_raw_{c}" for c in contract.types])


def validate(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Q2: split into (good rows in contract types, rejected rows with ``errors``).

    Good rows are selected by the conjunction of all rules -- a plain,
    code-generated predicate -- and get PII columns hashed (Q9); the reasons
    array is built for rejected rows only.  Both outputs come from one
    expression; persist ``df`` first when writing both.
    """
    t, checks, passes = _checks(df, contract)
    raws = [f"_raw_{c}" for c in contract.types]
    good = t.where(passes).drop(*raws)
    for c in contract.hashed:
        good = good.withColumn(c, sha256_id(c))
    bad = t.where(~passes).withColumn("errors", _reasons(checks)).drop(*raws)
    return good, bad


def validation_counts(checked: DataFrame, by: list[str]) -> DataFrame:
    """Q8: rows, accepted and rejected per group (e.g. per source file)."""
    return checked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size("errors") == 0).alias("accepted"),
        F.count_if(F.size("errors") > 0).alias("rejected"))


def assert_valid(checked: DataFrame) -> None:
    """Q5: raise with counts per failed rule when any row fails."""
    fails = (checked.select(F.explode("errors").alias("rule")).groupBy("rule").count().collect())
    if fails:
        raise ValueError("contract violated: " + ", ".join(f"{r['rule']}={r['count']}" for r in fails))


#: Size of the distinct sketch (2 ** bits cells: a standard error of 1.04 / sqrt(cells)) and of the quantile sketch
#: (about 1.3 / k of the ranks).
DISTINCT_BITS, QUANTILE_K = 12, 800


def _kind(dtype: str) -> str:
    if dtype in ("int", "bigint", "double", "float", "smallint", "tinyint") or dtype.startswith("decimal"):
        return "number"
    return "time" if dtype in ("date", "timestamp", "timestamp_ntz") else "other"


def profile_parts(df: DataFrame, cols: list[str] | None = None, by: list[str] | None = None, future_after=None) -> DataFrame:
    """Q10: the mergeable state of a profile, one row per column (and per group of ``by``, e.g. a source file).

    One aggregate pass with a bounded state per column: counts, extremes, moments, a distinct sketch and a quantile
    sketch.  Parts of several inputs can be stored and added to; ``merge_profiles`` makes a profile of any of them.
    """
    cols, types, by = cols or df.columns, dict(df.dtypes), by or []
    parts = []
    for c in cols:
        col, kind = F.col(f"`{c}`"), _kind(types[c])
        number, time = col.cast("double"), col.cast("timestamp_ntz") if kind == "time" else None
        counted = col if types[c] in ("int", "bigint", "string", "binary") else col.cast("string")
        n = F.count(col)
        parts.append(F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
            n.alias("non_null"), F.count_if(col.isNull()).alias("nulls"),
            F.hll_sketch_agg(counted, F.lit(DISTINCT_BITS)).alias("distinct_sketch"),
            *[(agg if kind == "number" else F.lit(None)).cast(t).alias(name) for name, t, agg in (
                ("min_value", "double", F.min(col) if kind == "number" else None),
                ("max_value", "double", F.max(col) if kind == "number" else None),
                ("mean", "double", F.avg(col) if kind == "number" else None),
                ("spread", "double", F.var_pop(number) * n if kind == "number" else None),
                ("negatives", "bigint", F.count_if(col < 0) if kind == "number" else None),
                ("quantile_sketch", "binary", F.kll_sketch_agg_double(number, F.lit(QUANTILE_K)) if kind == "number" else None))],
            *[(agg if kind == "time" else F.lit(None)).cast(t).alias(name) for name, t, agg in (
                ("min_time", "timestamp_ntz", F.min(time) if kind == "time" else None),
                ("max_time", "timestamp_ntz", F.max(time) if kind == "time" else None),
                ("future", "bigint", F.count_if(time > F.to_timestamp_ntz(F.lit(str(future_after))))
                 if kind == "time" and future_after is not None else F.lit(None)))]))
    one = df.groupBy(*by).agg(*[p.alias(f"_s{i}") for i, p in enumerate(parts)])
    return one.select(*by, F.explode(F.array(*[F.col(f"_s{i}") for i in range(len(cols))])).alias("s")).select(*by, "s.*")


def merge_profiles(parts: DataFrame, by: list[str] | None = None, quartiles: bool = False) -> DataFrame:
    """Q10: the profile of all inputs whose parts are given, one row per column (and group of ``by``): non-null and
    null counts, distinct count (sketched), numeric min / max / mean / stddev, negatives, time range and values after
    the parts' ``future_after``; ``quartiles`` adds the sketched 25/50/75 % points."""
    by = by or []
    n, mean = F.col("non_null"), F.col("mean")
    merged = parts.groupBy(*by, "column", "dtype").agg(
        F.sum("non_null").alias("non_null"), F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.sum(mean * n).alias("_sum"), F.sum("spread").alias("_within"), F.sum(mean * mean * n).alias("_squares"),
        F.sum("negatives").alias("negatives"), F.min("min_time").alias("min_time"), F.max("max_time").alias("max_time"),
        F.sum("future").alias("future"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))
    total = F.try_divide("_sum", "non_null")
    spread = F.col("_within") + F.greatest(F.col("_squares") - F.col("_sum") * total, F.lit(0.0))
    points = F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)])
    return merged.select(
        *by, "column", "dtype", "non_null", "nulls", F.hll_sketch_estimate("distinct_sketch").alias("distinct"), "min_value",
        "max_value", total.alias("mean"), F.when(F.col("non_null") > 1, F.sqrt(spread / (F.col("non_null") - 1))).alias("stddev"),
        "negatives", "min_time", "max_time", "future",
        *([F.when(F.col("negatives").isNotNull() & (F.col("non_null") > 0), F.kll_sketch_get_quantile_double("quantile_sketch", points))
           .alias("quartiles")] if quartiles else []))


def profile(df: DataFrame, cols: list[str] | None = None, exact_distinct: bool | list[str] = False,
            future_after=None, quartiles: bool = False) -> DataFrame:
    """Q10: the profile of one table in one scan (``profile_parts`` and ``merge_profiles``).

    Columns named in ``exact_distinct`` (all, if True) have their distinct values counted exactly, each by a scan and
    an aggregation of its own, so no row is expanded by columns."""
    cols = cols or df.columns
    out = merge_profiles(profile_parts(df, cols, future_after=future_after), quartiles=quartiles)
    exact = cols if exact_distinct is True else exact_distinct or []
    if exact:
        count = None
        for c in exact:
            own = df.agg(F.count_distinct(F.col(f"`{c}`"))).scalar()
            count = (F if count is None else count).when(F.col("column") == c, own)
        out = out.withColumn("distinct", count.otherwise(F.col("distinct")))
    return out
