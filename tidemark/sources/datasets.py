"""The seven source data sets: schemas, keys and write modes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Dataset:
    """What the layers need to know about one source.

    ``schema`` is DDL in file order, all columns nullable. ``keys`` is the business
    key, ``event_time`` the column that decides which of two rows is newer, and
    ``snapshot`` says that every delivery holds the whole data set.
    """

    name: str
    schema: str
    keys: tuple[str, ...]
    event_time: str | None = None
    date_alias: str | None = None
    snapshot: bool = False
    trimmed: tuple[str, ...] = ()
    unknown: tuple[str, ...] = ()

    @property
    def struct(self) -> StructType:
        return StructType.fromDDL(self.schema)

    @property
    def priority(self) -> tuple[str, ...]:
        newest = (self.event_time,) if self.event_time else ()
        return (*newest, "ingestion_timestamp")


# --- fixed values: source columns, business keys and cleaned columns ---------
DATASETS = {
    d.name: d
    for d in (
        Dataset(
            "events",
            "event_id bigint, session_id bigint, timestamp string, event_type string,"
            " product_id double, qty double, cart_size double, payment string,"
            " discount_pct double, amount_usd double",
            keys=("event_id",),
            event_time="timestamp",
            date_alias="event_date",
            trimmed=("event_type", "payment"),
        ),
        Dataset(
            "customers",
            "customer_id bigint, name string, email string, country string, age int,"
            " signup_date string, marketing_opt_in string",
            keys=("customer_id",),
            snapshot=True,
            trimmed=("name", "email", "country", "marketing_opt_in"),
            unknown=("name",),
        ),
        Dataset(
            "orders",
            "order_id bigint, customer_id bigint, order_time string, payment_method string,"
            " discount_pct double, subtotal_usd double, total_usd double, country string,"
            " device string, source string",
            keys=("order_id",),
            event_time="order_time",
            date_alias="order_date",
            trimmed=("payment_method", "country", "device", "source"),
            unknown=("country", "source", "device"),
        ),
        Dataset(
            "products",
            "product_id bigint, category string, name string, price_usd double,"
            " cost_usd double, margin_usd double",
            keys=("product_id",),
            snapshot=True,
            trimmed=("category", "name"),
        ),
        Dataset(
            "reviews",
            "review_id bigint, order_id bigint, product_id bigint, rating int,"
            " review_text string, review_time string",
            keys=("review_id",),
            event_time="review_time",
            date_alias="review_date",
            trimmed=("review_text",),
        ),
        Dataset(
            "sessions",
            "session_id bigint, customer_id bigint, start_time string, device string,"
            " source string, country string",
            keys=("session_id",),
            event_time="start_time",
            date_alias="session_date",
            trimmed=("device", "source", "country"),
            unknown=("country", "source", "device"),
        ),
        Dataset(
            "order_items",
            "order_id bigint, product_id bigint, unit_price_usd double, quantity int,"
            " line_total_usd double",
            keys=("order_id", "product_id"),
        ),
    )
}
# ----------------------------------------------------------------------------


def dataset(name: str) -> Dataset:
    """Look a data set up, with an error that lists the choices."""
    if name not in DATASETS:
        raise ValueError(f"unknown data set {name!r}; known: {', '.join(sorted(DATASETS))}")
    return DATASETS[name]
