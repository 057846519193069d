"""Smaller modules (D18-D21): personas, email flows, wholesale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaskit.functions.scalars import exact_sum, safe_ratio
from roaskit.operators.filters import filter_in

# --- fixed values ------------------------------------------------------------
EMAIL_COST_PER_SEND = 0.005   # dollars per email sent
WEEKS_PER_PERIOD = 4          # sold units cover four weeks
# ---------------------------------------------------------------------------


def persona_distribution(personas: DataFrame, persona=None) -> DataFrame:
    """Customers per persona, most first; ``persona`` filters (``All`` = none)."""
    p = personas.where(F.col("persona").isNotNull())
    if persona is not None:
        p = filter_in(p, "persona", [persona] if isinstance(persona, str) else persona)
    return p.groupBy("persona").agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "persona")


def email_flow_roas(flows: DataFrame) -> DataFrame:
    """Revenue / send cost per flow."""
    g = flows.groupBy("flow_name").agg(
        exact_sum("revenue").alias("total_revenue"),
        exact_sum(F.col("sends") * EMAIL_COST_PER_SEND).alias("total_cost"))
    return g.withColumn("roas", safe_ratio("total_revenue", "total_cost"))


def email_funnel(flows: DataFrame) -> DataFrame:
    """Open rate, click rate and revenue per click per flow, as ratios of sums."""
    g = flows.groupBy("flow_name").agg(
        F.sum("sends").alias("sends"), F.sum("opens").alias("opens"),
        F.sum("clicks").alias("clicks"), exact_sum("revenue").alias("revenue"))
    return g.withColumns({
        "open_rate": safe_ratio("opens", "sends"),
        "click_rate": safe_ratio("clicks", "opens"),
        "revenue_per_click": safe_ratio("revenue", "clicks"),
    })


def exclude_subtotals(df: DataFrame, col: str = "email_type", label: str = "Total") -> DataFrame:
    """Q12: drop pre-aggregated subtotal rows."""
    return df.where(F.col(col).isNull() | (F.col(col) != label))


def wholesale_kpis(w: DataFrame) -> DataFrame:
    """Sell-through, weeks of supply, fill rate, net margin; undefined -> 0."""
    net = F.col("wholesale_dollars") - F.col("discounts") - F.col("returns_dollars") - F.col("markdowns_dollars")
    return w.withColumns({
        "sell_through_pct": safe_ratio(F.col("units_sold"), F.col("units_sold") + F.col("on_hand")),
        "weeks_of_supply": safe_ratio(F.col("on_hand"), F.col("units_sold") / WEEKS_PER_PERIOD),
        "fill_rate_pct": safe_ratio(F.col("units_shipped"), F.col("units_ordered")),
        "net_margin_pct": safe_ratio(net, F.col("wholesale_dollars")),
    })
