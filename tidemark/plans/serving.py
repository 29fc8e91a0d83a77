"""Reports over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money


def _total(c: str) -> Column:
    """Sum of amounts, exact where DECIMAL holds them; the others are added as DOUBLE."""
    exact, rest = F.sum(money(c)).cast("double"), F.sum(F.when(money(c).isNull(), F.col(c)))
    return F.coalesce(exact + rest, exact, rest)


def daily_revenue(fact_order: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue and margin per day, in date order.

    Orders are added up per date key before the calendar is joined.
    """
    per_day = fact_order.groupBy("date_key").agg(
        *(_total(c).alias(c) for c in ("gross_revenue_usd", "net_margin_usd")),
    )
    return (
        per_day.join(dim_date.select("date_key", "full_date"), "date_key")
        .select("full_date", "gross_revenue_usd", "net_margin_usd")
        .orderBy("full_date")
    )


def funnel_by_first_view(fact_customer_funnel: DataFrame) -> DataFrame:
    """Customer and product pairs by first view date, and how far they got."""
    return (
        fact_customer_funnel.groupBy("first_view_date_key")
        .agg(
            F.count("*").alias("viewed_pairs"),
            F.count("first_add_to_cart_date_key").alias("added_to_cart_pairs"),
            F.count("first_purchase_date_key").alias("purchased_pairs"),
        )
        .orderBy("first_view_date_key")
    )
