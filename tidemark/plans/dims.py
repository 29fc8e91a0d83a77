"""Gold dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dimensions import build_static_dimension
from tidemark.operators.history import build_scd2_dimension
from tidemark.operators.lookup import attach_dimension_key

# --- fixed values -----------------------------------------------------------
CALENDAR_START = "1950-01-01"
CALENDAR_END = "2050-12-31"
OLDEST_AGE = 150
# dimension: (Silver data set, source column, value column, key column)
STATIC_DIMENSIONS = {
    "dim_country": ("sessions", "country", "country_name", "country_key"),
    "dim_source": ("sessions", "source", "source_name", "source_key"),
    "dim_device": ("sessions", "device", "device_name", "device_key"),
    "dim_payment_method": (
        "orders",
        "payment_method",
        "payment_method_name",
        "payment_method_key",
    ),
    "dim_category": ("products", "category", "category_name", "category_key"),
}
CUSTOMER_ATTRIBUTES = (
    "name",
    "email",
    "country_name",
    "birth_year",
    "signup_date",
    "marketing_opt_in",
)
PRODUCT_ATTRIBUTES = ("category_key", "product_name", "base_price_usd", "cost_usd")
# dimension with history: natural key, surrogate key, tracked attributes
HISTORIES = {
    "dim_customer": ("customer_id", "customer_key", CUSTOMER_ATTRIBUTES),
    "dim_product": ("product_id", "product_key", PRODUCT_ATTRIBUTES),
}
# ----------------------------------------------------------------------------


def dim_date(spark: SparkSession) -> DataFrame:
    """The calendar: one row per day of a fixed range."""
    day = F.col("full_date")
    return (
        spark.range(1)
        .select(
            F.explode(
                F.sequence(
                    F.lit(CALENDAR_START).cast("date"),
                    F.lit(CALENDAR_END).cast("date"),
                    F.expr("interval 1 day"),
                )
            ).alias("full_date")
        )
        .select(
            (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day_of_month"),
            F.dayofweek(day).alias("day_of_week"),
        )
    )


def static_dimension(
    name: str, silver: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """One static dimension over all Silver rows, invalid ones included."""
    _, column, value_col, key_col = STATIC_DIMENSIONS[name]
    source = silver.select(F.col(column).alias(value_col))
    return build_static_dimension(source, value_col, key_col, existing)


def customer_attributes(customers: DataFrame, process_date: str) -> DataFrame:
    """Tracked attributes of customers; the birth year follows from a plausible age."""
    year = int(process_date[:4])
    return customers.where(F.isnotnull("customer_id")).select(
        "customer_id",
        "name",
        "email",
        F.col("country").alias("country_name"),
        F.when(F.col("age").between(0, OLDEST_AGE), F.lit(year) - F.col("age")).alias("birth_year"),
        "signup_date",
        "marketing_opt_in",
    )


def dim_customer(
    customers: DataFrame,
    process_date: str,
    process_ts: str,
    existing: DataFrame | None = None,
    later: DataFrame | None = None,
) -> DataFrame:
    return build_scd2_dimension(
        customer_attributes(customers, process_date),
        *HISTORIES["dim_customer"],
        process_ts,
        existing,
        later,
    )


def product_attributes(products: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Tracked attributes of products, the category replaced by its key."""
    known = products.where(F.isnotnull("product_id"))
    return attach_dimension_key(
        known, "category", dim_category, "category_name", "category_key"
    ).select(
        "product_id",
        "category_key",
        F.col("name").alias("product_name"),
        F.col("price_usd").alias("base_price_usd"),
        "cost_usd",
    )


def dim_product(
    products: DataFrame,
    dim_category: DataFrame,
    process_ts: str,
    existing: DataFrame | None = None,
    later: DataFrame | None = None,
) -> DataFrame:
    return build_scd2_dimension(
        product_attributes(products, dim_category),
        *HISTORIES["dim_product"],
        process_ts,
        existing,
        later,
    )
