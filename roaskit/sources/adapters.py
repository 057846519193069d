"""Adapters from the driver tables to the marketing domain schemas.

Every adapter is a lazy Spark plan over whole tables, so its work grows with
the data; nothing is synthesised.  The mapping (see README) is:

* ``events``  -> sessions (non-purchase events) and orders (purchases)
* ``part``    -> campaigns (every part is a campaign; ``events.props.k`` names it)
* ``orders``  -> channel facts: priority = channel, status = media / agency
* ``lineitem`` ⋈ ``orders`` -> net sales per channel-month, order lines
* ``lineitem`` ⋈ ``supplier`` -> wholesale retailer x sku facts
* ``customer`` -> personas, account balances as currency text, names to hash
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaskit.functions.scalars import MONTH_NAMES, exact_sum, month_start
from roaskit.sources.tables import load

# --- fixed values of the adapter mapping ------------------------------------
# order priority -> marketing channel display name
CHANNEL_OF_PRIORITY = {
    "1-URGENT": "Paid Search",
    "2-HIGH": "Paid Social",
    "3-MEDIUM": "Affiliate",
    "4-NOT SPECIFIED": "Email",
    "5-LOW": "Organic Search",
}
# event type -> utm medium
MEDIUM_OF_EVENT = {"click": "cpc", "view": "social_paid", "signup": "organic", "error": "referral"}
# order status -> email type of the monthly email sheet
EMAIL_TYPE_OF_STATUS = {"F": "Batch Marketing", "O": "Triggered", "P": "Transactional"}
MEDIA_DIVISOR = 100.0    # media spend = sum of finished order totals / 100
AGENCY_FEE_PER_ORDER = 25.0  # agency fee = 25 per open order
REVENUE_DIVISOR = 10.0   # channel-breakdown revenue = sum of order totals / 10
OVERRIDE_PER_ORDER = 10  # spend override = 10 per pending order
CAMPAIGN_EPOCH = "2024-01-01"
# ---------------------------------------------------------------------------


def _map(col, mapping: dict) -> F.Column:
    out = F.lit(None).cast("string")
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)).otherwise(out)
    return out


def channel_of(col) -> F.Column:
    return _map(col, CHANNEL_OF_PRIORITY)


# --- creative performance ---------------------------------------------------

def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").where(F.col("event_type") != "purchase")
    return e.select(
        F.col("event_id").alias("session_id"),
        F.col("user_id"),
        F.col("ts").alias("session_start"),
        F.col("event_type").alias("utm_source"),
        _map(F.col("event_type"), MEDIUM_OF_EVENT).alias("utm_medium"),
        F.get_json_object("props", "$.k").try_cast("long").alias("campaign_id"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return e.select(
        F.col("event_id").alias("order_id"),
        F.col("user_id"),
        F.col("ts").alias("order_datetime"),
        F.col("value").alias("gross_revenue"),
    )


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("campaign_id"),
        F.col("p_name").alias("campaign_name"),
        F.date_add(F.lit(CAMPAIGN_EPOCH).cast("date"), (F.col("p_size") % 10).cast("int")).alias("start_date"),
        F.col("p_retailprice").alias("spend"),
        F.col("p_type").alias("creative_format"),
        F.col("p_brand").alias("creative_theme"),
        F.when(F.col("p_size") <= 15, "Low").when(F.col("p_size") <= 35, "Medium")
         .otherwise("High").alias("effectiveness_tier"),
    )


# --- channel profitability --------------------------------------------------

def _orders_by_month_channel(spark, sf_dir) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(
        month_start("o_orderdate").alias("date"),
        channel_of(F.col("o_orderpriority")).alias("channel"),
        "o_orderstatus", "o_totalprice", "o_custkey", "o_orderkey", "o_orderdate",
    )


def media_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(channel_name, value, date): ``<Channel> Media`` and ``<Channel> Agency`` rows."""
    o = _orders_by_month_channel(spark, sf_dir)
    wide = o.groupBy("date", "channel").agg(
        (exact_sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0))
         / MEDIA_DIVISOR).alias("Media"),
        (F.count_if(F.col("o_orderstatus") == "O") * AGENCY_FEE_PER_ORDER).alias("Agency"),
    )
    long = wide.unpivot(["date", "channel"], ["Media", "Agency"], "kind", "value")
    return long.select(F.concat_ws(" ", "channel", "kind").alias("channel_name"), "value", "date")


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: month and channel of the first order.

    ``min_by`` is a partial aggregate, so a customer holding a third of all
    orders is reduced map-side before the shuffle.
    """
    o = _orders_by_month_channel(spark, sf_dir)
    first = o.groupBy("o_custkey").agg(
        F.min_by(F.struct("date", "channel"), F.struct("o_orderdate", "o_orderkey")).alias("f"))
    return first.select("o_custkey", F.col("f.date").alias("date"), F.col("f.channel").alias("channel"))


def customers_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(channel_name, value, date): customers whose first order is in that month and channel."""
    f = first_orders(spark, sf_dir)
    return (f.groupBy("date", "channel").agg(F.count(F.lit(1)).cast("double").alias("value"))
             .select(F.col("channel").alias("channel_name"), "value", "date"))


def customers_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(channel_name, value, date): repeat orders (orders that are not a first order)."""
    o = _orders_by_month_channel(spark, sf_dir)
    total = o.groupBy("date", "channel").agg(F.count(F.lit(1)).alias("n"))
    new = customers_new(spark, sf_dir).withColumnRenamed("channel_name", "channel")
    j = total.join(new, ["date", "channel"], "left")
    return j.select(F.col("channel").alias("channel_name"),
                    (F.col("n") - F.coalesce(F.col("value"), F.lit(0.0))).alias("value"), "date")


def net_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, channel, value): discounted line revenue per order month and channel.

    lineitem is pre-aggregated per order before the join; the aggregate's hash
    partitioning on the order key is reused by the join.
    """
    li = load(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum((F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(38,6)")).alias("net"))
    o = _orders_by_month_channel(spark, sf_dir)
    j = per_order.join(o, per_order.l_orderkey == o.o_orderkey)
    return j.groupBy("date", "channel").agg(F.sum("net").cast("double").alias("value"))


def topsheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, source, metric, value): ``NET SALES - <Channel>`` rows plus ``GROSS SALES``."""
    ns = net_sales(spark, sf_dir).select(
        "date", F.lit("shopify").alias("source"),
        F.concat(F.lit("NET SALES - "), F.col("channel")).alias("metric"), "value")
    o = load(spark, sf_dir, "orders")
    gross = o.groupBy(month_start("o_orderdate").alias("date")).agg(
        exact_sum("o_totalprice").alias("value"))
    gross = gross.select("date", F.lit("shopify").alias("source"), F.lit("GROSS SALES").alias("metric"), "value")
    return ns.unionByName(gross)


def channel_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly channel table: year_period, marketing_channel, ad_spend,
    gross_discount_(shopify), orders, year."""
    o = _orders_by_month_channel(spark, sf_dir)
    y = F.year("date")
    agg = o.groupBy(y.alias("year"), F.lower(F.col("channel")).alias("marketing_channel")).agg(
        (exact_sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0))
         / MEDIA_DIVISOR).alias("ad_spend"),
        (exact_sum("o_totalprice") / REVENUE_DIVISOR).alias("gross_discount_(shopify)"),
        F.count(F.lit(1)).alias("orders"),
    )
    return agg.select(F.col("year").cast("string").alias("year_period"), "marketing_channel", "ad_spend",
                      "`gross_discount_(shopify)`", "orders", "year")


def spend_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, channel, spend_override): 10 per pending order, agency-style names."""
    o = _orders_by_month_channel(spark, sf_dir)
    agg = o.groupBy("date", "channel").agg(
        (F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)) * OVERRIDE_PER_ORDER)
        .cast("long").alias("spend_override"))
    return agg.select(F.col("date").alias("month"),
                      F.concat(F.col("channel"), F.lit(" Agency")).alias("channel"), "spend_override")


def monthly_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide spreadsheet form of ``customers_new``: channel, year, january..december, total.

    Month cells are text like the exported sheets (``"1,252"``); the pivot uses
    a fixed value list, so no extra job discovers the pivot values.
    """
    c = customers_new(spark, sf_dir)
    long = c.select(F.col("channel_name").alias("channel"), F.year("date").alias("year"),
                    F.month("date").alias("m"), "value")
    wide = long.groupBy("channel", "year").pivot("m", list(range(1, 13))).agg(F.first("value"))
    cells = [F.format_number(F.col(str(i + 1)), 0).alias(n) for i, n in enumerate(MONTH_NAMES)]
    total = F.format_number(sum(F.coalesce(F.col(str(i)), F.lit(0.0)) for i in range(1, 13)), 0)
    return wide.select("channel", F.col("year").cast("string").alias("year"), *cells, total.alias("total"))


# --- modules ------------------------------------------------------------------

def personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("persona"))


def email_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(flow_name, send_date, sends, opens, clicks, revenue) per event type and day."""
    e = load(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("flow_name"), F.to_date("ts").alias("send_date")).agg(
        F.count(F.lit(1)).alias("sends"),
        F.count_if(F.col("value") >= 10).alias("opens"),
        F.count_if(F.col("value") >= 50).alias("clicks"),
        exact_sum("value").alias("revenue"),
    )


def email_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, email_type, sends, clicks) per month and type, with the sheet's ``Total`` rows."""
    o = load(spark, sf_dir, "orders")
    t = _map(F.col("o_orderstatus"), EMAIL_TYPE_OF_STATUS)
    g = o.rollup(month_start("o_orderdate").alias("date"), t.alias("email_type")).agg(
        F.count(F.lit(1)).alias("sends"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("clicks"),
        F.grouping_id().alias("gid"))
    g = g.where((F.col("gid") == 0) | ((F.col("gid") == 1) & F.col("date").isNotNull()))
    return g.select("date", F.coalesce(F.col("email_type"), F.when(F.col("gid") == 1, "Total")).alias("email_type"),
                    "sends", "clicks")


def wholesale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retailer x sku facts from lineitem (supplier = retailer, part = sku)."""
    li = load(spark, sf_dir, "lineitem")
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    g = li.groupBy("l_suppkey", "l_partkey").agg(
        F.sum(q).cast("long").alias("units_ordered"),
        F.sum(F.when(F.col("l_returnflag") == "N", q).otherwise(0.0)).cast("long").alias("units_sold"),
        F.sum(F.when(F.col("l_linestatus") == "F", q).otherwise(0.0)).cast("long").alias("units_shipped"),
        F.sum(F.when(F.col("l_returnflag") == "R", q).otherwise(0.0)).cast("long").alias("on_hand"),
        exact_sum(p).alias("wholesale_dollars"),
        exact_sum(p * F.col("l_discount")).alias("discounts"),
        exact_sum(F.when(F.col("l_returnflag") == "R", p).otherwise(0.0)).alias("returns_dollars"),
        exact_sum(p * F.col("l_tax")).alias("markdowns_dollars"),
    )
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = g.join(s, g.l_suppkey == s.s_suppkey, "left")
    return j.select(F.coalesce("s_name", F.col("l_suppkey").cast("string")).alias("retailer"),
                    F.col("l_partkey").alias("sku"), "units_ordered", "units_sold", "units_shipped", "on_hand",
                    "wholesale_dollars", "discounts", "returns_dollars", "markdowns_dollars")


def ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer_id, predicted_ltv): purchase value per user."""
    o = orders(spark, sf_dir)
    return o.groupBy(F.col("user_id").alias("customer_id")).agg(exact_sum("gross_revenue").alias("predicted_ltv"))


def order_lines(spark: SparkSession, sf_dir: str, extra: list[str] | None = None) -> DataFrame:
    """Order lines as text cells, like a dropped CSV file; ``extra`` adds columns of the line as they are."""
    li = load(spark, sf_dir, "lineitem")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_datetime"),
        F.col("l_partkey").cast("string").alias("sku"),
        F.col("l_quantity").cast("long").cast("string").alias("qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).cast("string").alias("unit_price"),
        F.col("l_discount").cast("string").alias("discount"), *(extra or []),
    )


def web_session_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web sessions as text cells, like a dropped session-level export."""
    s = sessions(spark, sf_dir)
    return s.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("session_id").cast("string").alias("session_id"),
        F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"),
        F.col("utm_source").alias("source"), F.col("utm_medium").alias("medium"),
        F.col("campaign_id").cast("string").alias("campaign"))


def currency_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account balances as accounting text: ``$1,234.50`` / ``($12.00)``."""
    c = load(spark, sf_dir, "customer")
    b = F.col("c_acctbal")
    txt = F.when(b < 0, F.concat(F.lit("($"), F.format_number(-b, 2), F.lit(")"))) \
           .otherwise(F.concat(F.lit("$"), F.format_number(b, 2), F.lit(" ")))
    return c.select("c_custkey", txt.alias("balance_text"))
