"""Gold facts.

Builders take valid Silver rows (``valid_rows``) with their date alias, and a dict
of dimension tables. They return business columns and dimension keys; numbering is
a separate step (``numbered``), because a first load numbers all rows and an
incremental load only the new ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cents, format_timestamp, money, seconds_between
from tidemark.operators.history import current_rows
from tidemark.operators.keys import assign_keys
from tidemark.operators.lookup import attach_dimension, attach_dimension_key
from tidemark.operators.sequence import next_in_group
from tidemark.operators.staging import stage

Dims = Mapping[str, DataFrame]
# Valid items, at least all those of the orders whose ids are given.
ItemsOf = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Fact:
    """Output contract of a fact table.

    ``keys`` identifies a row for numbering and merging. ``extra`` columns are stored
    behind the contract because the merge key needs them. ``counterpart`` names the data set whose
    valid rows become one row each and whose columns the fact passes on.
    """

    surrogate: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    dimensions: tuple[str, ...]
    incremental: bool = True
    extra: tuple[str, ...] = ()
    counterpart: str | None = None


# --- fixed values: table contracts --------------------------------------------
FACTS = {
    "fact_order": Fact(
        "order_key",
        ("order_id",),
        (
            "order_key",
            "order_id",
            "customer_key",
            "date_key",
            "country_key",
            "source_key",
            "device_key",
            "order_time",
            "payment_method_key",
            "discount_pct",
            "gross_revenue_usd",
            "net_margin_usd",
        ),
        (
            "dim_date",
            "dim_country",
            "dim_source",
            "dim_device",
            "dim_payment_method",
            "dim_customer",
            "dim_product",
        ),
        counterpart="orders",
    ),
    "fact_order_item": Fact(
        "order_item_key",
        ("order_id", "product_id"),
        (
            "order_item_key",
            "order_id",
            "customer_key",
            "product_key",
            "date_key",
            "quantity",
            "unit_price_usd",
            "gross_revenue_usd",
            "gross_margin_usd",
        ),
        ("dim_date", "dim_customer", "dim_product"),
        extra=("product_id",),
    ),
    "fact_web_event": Fact(
        "event_key",
        ("event_id",),
        (
            "event_key",
            "event_id",
            "session_id",
            "customer_key",
            "product_key",
            "date_key",
            "event_type",
            "duration",
        ),
        ("dim_date", "dim_customer", "dim_product"),
    ),
    "fact_review": Fact(
        "review_key",
        ("review_id",),
        (
            "review_key",
            "review_id",
            "order_id",
            "product_key",
            "rating",
            "review_text",
            "review_date",
        ),
        ("dim_product",),
    ),
    "fact_session": Fact(
        "session_key",
        ("session_id",),
        (
            "session_key",
            "session_id",
            "customer_key",
            "start_time",
            "date_key",
            "device_key",
            "source_key",
            "country_key",
        ),
        ("dim_date", "dim_country", "dim_source", "dim_device", "dim_customer"),
    ),
    "fact_customer_funnel": Fact(
        "funnel_key",
        ("customer_key", "product_key"),
        (
            "funnel_key",
            "customer_key",
            "product_key",
            "first_view_date_key",
            "first_add_to_cart_date_key",
            "first_purchase_date_key",
        ),
        ("dim_date", "dim_customer", "dim_product"),
        incremental=False,
    ),
}
# ----------------------------------------------------------------------------


def numbered(name: str, rows: DataFrame) -> DataFrame:
    """Number the rows of a full load densely, in business-key order."""
    fact = FACTS[name]
    return assign_keys(rows, fact.surrogate, fact.keys).select(*fact.columns, *fact.extra)


def numbered_first(name: str, build: Callable, usable: Callable[..., DataFrame], dims: Dims) -> DataFrame:
    """``numbered`` over stored Silver tables: where a fact has a counterpart, its keys are numbered alone.

    Spreading rows by range computes them twice, once to find the ranges. A scan of keys is cheap, and
    the numbers meet the counterpart by key, as its other lookups do.
    """
    fact = FACTS[name]
    if fact.counterpart is None:
        return numbered(name, build(usable, dims))
    numbers = assign_keys(usable(fact.counterpart).select(*fact.keys), fact.surrogate, fact.keys)

    def keyed(table: str, *within: DataFrame) -> DataFrame:
        rows = usable(table, *within)
        return rows.join(numbers, list(fact.keys)) if table == fact.counterpart else rows

    return build(keyed, dims).select(*fact.columns, *fact.extra)


def contract(name: str, table: DataFrame) -> DataFrame:
    """The agreed columns of a stored fact table."""
    return table.select(*FACTS[name].columns)


def _customer_keys(dims: Dims) -> DataFrame:
    return current_rows(dims["dim_customer"]).select("customer_id", "customer_key")


def _products(dims: Dims, *columns: str | Column) -> DataFrame:
    return current_rows(dims["dim_product"]).select("product_id", *columns)


def _date_key(df: DataFrame, dims: Dims, column: str, output: str = "date_key") -> DataFrame:
    return attach_dimension_key(df, column, dims["dim_date"], "full_date", "date_key", output)


def _member_key(df: DataFrame, dims: Dims, column: str, member: str) -> DataFrame:
    return attach_dimension_key(
        df, column, dims[f"dim_{member}"], f"{member}_name", f"{member}_key"
    )


def _unit_costs(dims: Dims, *columns: str) -> DataFrame:
    """Unit cost of products, exact or else as DOUBLE: taken once per product instead of once per item."""
    exact = money("cost_usd")
    return _products(
        dims, *columns, exact.alias("_unit_cost"), F.when(exact.isNull(), F.col("cost_usd")).alias("_inexact_unit")
    )


def _item_cost():
    return F.coalesce("_unit_cost", F.lit(0)) * F.col("quantity")


def _inexact_cost():
    """Cost of items whose unit cost DECIMAL cannot hold, 0 for all others."""
    return F.coalesce(F.col("_inexact_unit") * F.col("quantity"), F.lit(0.0))


def events_with_customer(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events of known sessions, with the session's customer."""
    return events.join(sessions.select("session_id", "customer_id"), "session_id")


def order_costs(order_items: DataFrame, dims: Dims) -> DataFrame:
    """Cost of each order's items at current product cost; unknown cost counts as 0."""
    return (
        order_items.select("order_id", "product_id", "quantity")
        .transform(attach_dimension, _unit_costs(dims), "product_id")
        .groupBy("order_id")
        .agg(
            F.sum(_item_cost()).alias("order_cost_usd"),
            F.sum(_inexact_cost()).alias("inexact_cost_usd"),
        )
    )


def fact_order(orders: DataFrame, order_items: DataFrame, dims: Dims) -> DataFrame:
    """One row per order. Orders without items keep their whole total as margin.

    Dimensions that ``dims`` lacks are not looked up, and their keys left out: an outer join cannot be
    dropped by the optimizer, which does not know that it finds one row at most. ``dim_product`` is needed.
    """
    rows = orders.join(order_costs(order_items, dims), "order_id", "left")
    if "dim_customer" in dims:
        rows = attach_dimension(rows, _customer_keys(dims), "customer_id")
    if "dim_date" in dims:
        rows = _date_key(rows, dims, "order_date")
    for member in ("country", "source", "device", "payment_method"):
        if f"dim_{member}" in dims:
            rows = _member_key(rows, dims, member, member)
    rest = F.coalesce(F.col("inexact_cost_usd"), F.lit(0.0))
    cost = F.coalesce(F.col("order_cost_usd"), F.lit(0))
    margin = F.when(rest == 0, money("computed_total") - cost)
    plain = F.col("computed_total") - cost.cast("double") - rest
    built = {
        "order_time": format_timestamp("order_time"),
        "gross_revenue_usd": F.col("subtotal_usd"),
        "net_margin_usd": cents(margin, plain),
    }
    wanted = [c for c in FACTS["fact_order"].columns if c in built or c in rows.columns]
    return rows.select(*(built.get(c, F.col(c)).alias(c) for c in wanted))


def fact_order_item(orders: DataFrame, order_items: DataFrame, dims: Dims) -> DataFrame:
    """One row per order and product, for items of valid orders."""
    # Orders take their keys along: items, several times as many, meet products and orders only.
    placed = attach_dimension(orders.select("order_id", "customer_id", "order_date"), _customer_keys(dims), "customer_id")
    placed = _date_key(placed, dims, "order_date").select("order_id", "customer_key", "date_key")
    rows = attach_dimension(order_items, _unit_costs(dims, "product_key"), "product_id").join(placed, "order_id")
    rest = _inexact_cost()
    margin = F.when(rest == 0, money("computed_line_total") - _item_cost())
    plain = F.col("computed_line_total") - _item_cost().cast("double") - rest
    return rows.select(
        "order_id",
        "product_id",
        "customer_key",
        "product_key",
        "date_key",
        "quantity",
        "unit_price_usd",
        F.col("computed_line_total").alias("gross_revenue_usd"),
        cents(margin, plain).alias("gross_margin_usd"),
    )


def event_duration(events: DataFrame) -> DataFrame:
    """Add ``duration``: seconds until the session's next event, 0 for the last one."""
    timed = next_in_group(events, "session_id", ["timestamp", "event_id"], "timestamp", "_next")
    dwell = F.greatest(seconds_between("timestamp", "_next"), F.lit(0))
    return timed.withColumn("duration", F.coalesce(dwell, F.lit(0)).cast("double")).drop("_next")


def fact_web_event(events: DataFrame, sessions: DataFrame, dims: Dims) -> DataFrame:
    """One row per event of a valid session, with its dwell time."""
    needed = events.select(
        "event_id", "session_id", "timestamp", "event_type", "product_id", "event_date"
    )
    timed = events_with_customer(event_duration(needed), sessions)
    # Checkouts and purchases have no product.
    rows = timed.transform(attach_dimension, _customer_keys(dims), "customer_id").transform(
        attach_dimension, _products(dims, "product_key"), "product_id"
    )
    return _date_key(rows, dims, "event_date").select(
        "event_id",
        "session_id",
        "customer_key",
        "product_key",
        "date_key",
        "event_type",
        "duration",
    )


def fact_review(reviews: DataFrame, dims: Dims) -> DataFrame:
    """One row per review."""
    return attach_dimension(reviews, _products(dims, "product_key"), "product_id").select(
        "review_id", "order_id", "product_key", "rating", "review_text", "review_date"
    )


def fact_session(sessions: DataFrame, dims: Dims) -> DataFrame:
    """One row per session."""
    rows = attach_dimension(sessions, _customer_keys(dims), "customer_id")
    rows = _date_key(rows, dims, "session_date")
    for member in ("device", "source", "country"):
        rows = _member_key(rows, dims, member, member)
    return rows.select(
        "session_id",
        "customer_key",
        format_timestamp("start_time").alias("start_time"),
        "date_key",
        "device_key",
        "source_key",
        "country_key",
    )


def session_order_map(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders placed by a session's customer at the exact time of a purchase event.

    ``events`` are events with their customer. One row per session and order.
    """
    purchases = (
        events.where("event_type = 'purchase'")
        .select("session_id", "customer_id", F.col("timestamp").alias("order_time"))
        .distinct()
    )
    placed = orders.select("order_id", "customer_id", "order_time", "order_date")
    return (
        purchases.join(placed, ["customer_id", "order_time"])
        .select("session_id", "customer_id", "order_id", "order_date")
        .dropDuplicates(["session_id", "order_id"])
    )


def first_touches(events: DataFrame) -> DataFrame:
    """First view and first cart date per customer and product, in one aggregation."""
    kind = F.col("event_type")
    return (
        events.where(kind.isin("page_view", "add_to_cart") & F.isnotnull("product_id"))
        .groupBy("customer_id", "product_id")
        .agg(
            F.min(F.when(kind == "page_view", F.col("event_date"))).alias("first_view_date"),
            F.min(F.when(kind == "add_to_cart", F.col("event_date"))).alias(
                "first_add_to_cart_date"
            ),
        )
    )


def first_purchases(events: DataFrame, orders: DataFrame, items_of: ItemsOf) -> DataFrame:
    """First purchase date per customer and product, by way of matched orders.

    Which session bought does not matter here, so orders are only tested for a match
    (semi join): no session and order pairs are produced. The distinct step shares the
    join's partitioning and folds a busy customer's events before they move.
    """
    instants = events.where("event_type = 'purchase'").select("customer_id", F.col("timestamp").alias("order_time"))
    return purchase_dates(instants.distinct(), orders, items_of)


def purchase_dates(instants: DataFrame, orders: DataFrame, items_of: ItemsOf) -> DataFrame:
    """First purchase date per customer and product, from the instants at which customers bought.

    Few orders match, so these are written, and ``items_of`` need give no items of others.
    """
    bought = orders.select("order_id", "customer_id", "order_time", "order_date").join(
        instants, ["customer_id", "order_time"], "left_semi"
    )
    bought = stage(bought.drop("order_time"), "bought-orders")
    items = items_of(bought.select("order_id")).select("order_id", "product_id")
    return (
        bought.join(items, "order_id")
        .groupBy("customer_id", "product_id")
        .agg(F.min("order_date").alias("first_purchase_date"))
    )


def funnel_steps(events: DataFrame) -> DataFrame:
    """First views and carts per customer and product, and purchase instants per customer, in one aggregation.

    Views and carts are rows with ``product_id``, purchases rows with ``order_time``.
    """
    kind = F.col("event_type")
    bought = (kind == "purchase") & F.isnotnull("timestamp")
    touched = kind.isin("page_view", "add_to_cart") & F.isnotnull("product_id")
    return (
        events.where(bought | touched)
        .groupBy(
            "customer_id",
            F.when(touched, F.col("product_id")).alias("product_id"),
            F.when(bought, F.col("timestamp")).alias("order_time"),
        )
        .agg(
            F.min(F.when(kind == "page_view", F.col("event_date"))).alias("first_view_date"),
            F.min(F.when(kind == "add_to_cart", F.col("event_date"))).alias("first_add_to_cart_date"),
        )
    )


def funnel_pairs(touches: DataFrame, purchases: DataFrame) -> DataFrame:
    """Customer and product pairs that reached any step."""
    pair = ["customer_id", "product_id"]
    return touches.select(*pair).unionByName(purchases.select(*pair)).distinct()


def fact_customer_funnel(
    events: DataFrame, sessions: DataFrame, orders: DataFrame, items_of: ItemsOf, dims: Dims
) -> DataFrame:
    """First view, cart and purchase per customer and product, both known.

    Events are read and joined to their sessions once; their steps, far fewer, are written and read by kind.
    """
    steps = stage(funnel_steps(events_with_customer(events, sessions)), "funnel-steps")
    touches = steps.where(F.isnotnull("product_id")).drop("order_time")
    instants = steps.where(F.isnotnull("order_time")).select("customer_id", "order_time")
    rows = (
        touches.join(purchase_dates(instants, orders, items_of), ["customer_id", "product_id"], "full_outer")
        .join(_customer_keys(dims), "customer_id")
        .join(_products(dims, "product_key"), "product_id")
    )
    for step in ("view", "add_to_cart", "purchase"):
        rows = _date_key(rows, dims, f"first_{step}_date", f"first_{step}_date_key")
    return rows.select(
        "customer_key",
        "product_key",
        "first_view_date_key",
        "first_add_to_cart_date_key",
        "first_purchase_date_key",
    )
