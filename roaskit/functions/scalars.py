"""Scalar column functions.

All are built-in column expressions, so they stay inside whole-stage codegen;
none is a Python UDF.  Every parse is a ``try_`` form because ANSI mode is on
by default in Spark 4 and a plain cast would fail the whole job on one bad cell.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the source spreadsheets' conventions) ---------
# Month names as they appear in the monthly sheets, in calendar order.
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
# Text cells the spreadsheets use for "no value".
NULL_TOKENS = ["#ref!", "nan", ""]
# Non-breaking space found in exported cells.
NBSP = " "
# Suffixes that split a channel row into media spend and agency fee.
MEDIA_SUFFIX = " media"
AGENCY_SUFFIX = " agency"
# Channel spellings that must be merged into one key.
CHANNEL_ALIASES = {"affiliate": "affiliates"}
# Prefix of the per-channel revenue metric in the top sheet.
NET_SALES_PREFIX = "NET SALES - "
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip(c: Column) -> Column:
    """Strip leading/trailing whitespace including the no-break space."""
    return F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")


def _negate_parens(s: Column) -> Column:
    """Accounting negatives: ``(12.00)`` -> ``-12.00``."""
    return F.when(s.contains("(") & s.contains(")"),
                  F.concat(F.lit("-"), F.regexp_replace(s, r"[()]", ""))).otherwise(s)


def to_number(c) -> Column:
    """lenient number parse; anything unparseable becomes NULL."""
    return _strip(_c(c).cast("string")).try_cast("double")


def clean_currency(c) -> Column:
    """F1: ``$1,047,386.58 `` -> 1047386.58, ``($107,428.31)`` -> -107428.31."""
    s = _strip(F.regexp_replace(_c(c).cast("string"), r"[$,]", ""))
    return _negate_parens(s).try_cast("double")


def clean_percentage(c) -> Column:
    """F2: ``"3%"`` -> 0.03."""
    s = _strip(F.regexp_replace(_c(c).cast("string"), r'[%"]', ""))
    return s.try_cast("double") / F.lit(100.0)


def clean_numeric(c) -> Column:
    """``"1,252"`` -> 1252.0."""
    return _strip(F.regexp_replace(_c(c).cast("string"), ",", "")).try_cast("double")


def clean_mixed(c) -> Column:
    """a cell that may hold currency, a percentage or an error token."""
    s = _strip(F.regexp_replace(_c(c).cast("string"), NBSP, ""))
    is_null_token = F.lower(s).isin(NULL_TOKENS)
    pct = F.regexp_replace(s, "%", "").try_cast("double") / F.lit(100.0)
    money = _negate_parens(F.regexp_replace(s, r"[$,]", "")).try_cast("double")
    return (F.when(s.isNull() | is_null_token, F.lit(None).cast("double"))
             .when(s.contains("%"), pct)
             .otherwise(money))


def canonical_channel(c) -> Column:
    """one join key per channel on every side.

    lower + trim, drop a trailing `` media`` / `` agency`` and merge aliases
    (``affiliate`` -> ``affiliates``) by whole value.
    """
    s = F.trim(F.lower(_c(c)))
    s = F.trim(F.regexp_replace(s, rf"({MEDIA_SUFFIX}|{AGENCY_SUFFIX})$", ""))
    out = s
    for alias, canon in CHANNEL_ALIASES.items():
        out = F.when(s == alias, F.lit(canon)).otherwise(out)
    return out


def spend_kind(c) -> Column:
    """``agency`` when the channel name mentions an agency, else ``media``."""
    return F.when(F.coalesce(_c(c).rlike("(?i)agency"), F.lit(False)), "agency").otherwise("media")


def metric_channel(c) -> Column:
    """channel key out of ``NET SALES - Paid Search`` (NULL for other metrics)."""
    col = _c(c)
    return F.when(F.coalesce(col.startswith(NET_SALES_PREFIX), F.lit(False)),
                  canonical_channel(F.substr(col, F.lit(len(NET_SALES_PREFIX) + 1))))


def sha256_id(c) -> Column:
    """F8: SHA-256 hex digest of the UTF-8 text; NULL stays NULL."""
    return F.sha2(_c(c).cast("string"), 256)


def month_number(c) -> Column:
    """month number from a month name, short or long, any case."""
    m = F.create_map(*[x for i, n in enumerate(MONTH_NAMES) for x in (F.lit(n[:3]), F.lit(i + 1))])
    return F.element_at(m, F.substring(F.lower(F.trim(_c(c))), 1, 3))


def lenient_date(c, formats=("yyyy-MM-dd", "M/d/yyyy", "yyyy-MM-dd HH:mm:ss")) -> Column:
    """first format that parses wins; ``YYYY-Mon-DD`` takes short or long names."""
    s = F.trim(_c(c).cast("string"))
    parsed = [F.to_date(F.try_to_timestamp(s, F.lit(f))) for f in formats]
    named = F.regexp_extract(s, r"^(\d{4})-([A-Za-z]+)-(\d{1,2})$", 0) != ""
    y = F.regexp_extract(s, r"^(\d{4})-", 1).try_cast("int")
    mname = F.regexp_extract(s, r"^\d{4}-([A-Za-z]+)-", 1)
    d = F.regexp_extract(s, r"-(\d{1,2})$", 1).try_cast("int")
    by_name = F.when(named, F.try_make_timestamp(y, month_number(mname), d, F.lit(0), F.lit(0), F.lit(0)).cast("date"))
    return F.coalesce(*parsed, by_name)


def month_start(c) -> Column:
    """first day of the month as a DATE."""
    return F.trunc(F.to_date(_c(c)), "month")


def weekday_mon0(c) -> Column:
    """weekday with Monday = 0 (pandas convention)."""
    return F.weekday(_c(c))


def micros(c) -> Column:
    """Microseconds since 1970-01-01 00:00 on the wall clock of a TIMESTAMP_NTZ
    or DATE column, built from day number and time-of-day fields so it never
    depends on the session time zone (no jump at a daylight-saving change)."""
    t = _c(c).cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.date_part(F.lit("SECOND"), t) * F.lit(1_000_000)
    return (days * F.lit(86_400_000_000) + F.hour(t).cast("long") * F.lit(3_600_000_000)
            + F.minute(t).cast("long") * F.lit(60_000_000) + secs.cast("long"))


def seconds_between(later, earlier) -> Column:
    """difference in (fractional) seconds."""
    return (micros(later) - micros(earlier)) / F.lit(1_000_000.0)


def whole_days_between(later, earlier) -> Column:
    """floor of elapsed days, like ``Timedelta.days``."""
    return F.floor((micros(later) - micros(earlier)) / F.lit(86_400_000_000)).cast("long")


def year_token(c) -> Column:
    """F16: the four-digit year that opens ``2025 (Jan - May)``; NULL when malformed."""
    return F.regexp_extract(F.trim(_c(c)), r"^(\d{4})(\s|$)", 1).try_cast("int")


def exact_sum(c, scale: int = 6) -> Column:
    """Sum of money as an exact decimal, returned as a double.

    A double sum depends on the order rows arrive in, so two runs (or two
    engines) can differ in the last bit -- enough to flip a rounded ratio
    that lands on a half.  The part of each input up to ``scale`` decimals is
    summed as a decimal; what lies beyond it (tiny or huge values, not the
    noise of the binary form, under 1e-15 of the value) is summed as a double.
    """
    x = _c(c)
    exact = x.try_cast(f"decimal(38,{scale})")
    rest = x.cast("double") - F.coalesce(exact.cast("double"), F.lit(0.0))
    rest = F.when(F.abs(rest) <= F.abs(x.cast("double")) * 1e-15, F.lit(0.0)).otherwise(rest)
    return F.coalesce(F.sum(exact).cast("double"), F.lit(0.0)) + F.sum(rest)


def safe_ratio(num, den) -> Column:
    """``num / den`` when ``den > 0`` else 0 (NULL denominators give 0)."""
    return F.when(_c(den) > 0, _c(num) / _c(den)).otherwise(F.lit(0.0))


def clip(c, lower=None, upper=None) -> Column:
    """clamp to bounds."""
    out = _c(c)
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return out


def any_null(cols) -> Column:
    """TRUE when any of ``cols`` is NULL."""
    return reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols])


def null_count(cols) -> Column:
    """Number of NULL cells across ``cols`` in the row."""
    return reduce(lambda a, b: a + b, [F.when(_c(c).isNull(), 1).otherwise(0) for c in cols])
