"""Silver: typed, validated rows, one per business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cents, iso_timestamp, money, parse_flag
from tidemark.operators.columns import fill_unknown, safe_trim
from tidemark.operators.dedupe import dedupe_latest
from tidemark.operators.rules import RuleSet, add_status, rules, validate
from tidemark.plans.bronze import BRONZE_METADATA, RECORD_COLUMNS, valid_records
from tidemark.sources.datasets import dataset

# What a row lacked before it was filled in.
GAPS = "_gaps"

# Amounts differ when they are more than one cent apart, compared exactly.
_OFF = (
    "coalesce(abs(try_cast({a} as decimal(30,10)) - try_cast({b} as decimal(30,10))) > 0.01,"
    " abs({a} - {b}) > 0.01)"
)


def _differs(a: str, b: str) -> str:
    return _OFF.format(a=a, b=b)


# --- fixed values: validation codes, in reporting order -----------------------
RULES = {
    "customers": RuleSet(
        errors=rules(
            ("NULL_CUSTOMER_ID", "customer_id is null"),
            ("INVALID_CUSTOMER_ID", "customer_id <= 0"),
            ("NULL_EMAIL", "email is null"),
            ("INVALID_EMAIL_FORMAT", r"not email rlike r'^[A-Za-z0-9+_.-]+@(.+)$'"),
            ("NULL_SIGNUP_DATE", "signup_date is null"),
            ("FUTURE_SIGNUP_DATE", "signup_date > {process_date}"),
            ("NULL_AGE", "age is null"),
            ("INVALID_AGE", "age not between 0 and 150"),
        ),
        warnings=rules(
            ("NULL_NAME", "name is null"),
            ("NULL_COUNTRY", "country is null"),
            ("NULL_MARKETING_OPT_IN", "marketing_opt_in is null"),
        ),
    ),
    "products": RuleSet(
        errors=rules(
            ("NULL_PRODUCT_ID", "product_id is null"),
            ("INVALID_PRODUCT_ID", "product_id <= 0"),
            ("NULL_CATEGORY", "category is null"),
            ("NULL_PRODUCT_NAME", "name is null"),
            ("NULL_PRICE", "price_usd is null"),
            ("NEGATIVE_PRICE", "price_usd < 0"),
            ("NULL_COST", "cost_usd is null"),
            ("NEGATIVE_COST", "cost_usd < 0"),
            ("COST_EXCEEDS_PRICE", "cost_usd > price_usd"),
        ),
        warnings=rules(
            ("INVALID_MARGIN", "margin_usd <= 0"),
            ("MARGIN_MISMATCH", _differs("margin_usd", "computed_margin")),
        ),
    ),
    "orders": RuleSet(
        errors=rules(
            ("NULL_ORDER_ID", "order_id is null"),
            ("INVALID_ORDER_ID", "order_id <= 0"),
            ("NULL_CUSTOMER_ID", "customer_id is null"),
            ("INVALID_CUSTOMER_ID", "customer_id <= 0"),
            ("NULL_ORDER_TIME", "order_time is null"),
            ("FUTURE_ORDER_TIMESTAMP", "cast(order_time as date) > {process_date}"),
            ("NULL_DISCOUNT_PCT", "discount_pct is null"),
            ("INVALID_DISCOUNT_PCT", "discount_pct not between 0 and 100"),
            ("NULL_SUBTOTAL", "subtotal_usd is null"),
            ("NEGATIVE_SUBTOTAL", "subtotal_usd < 0"),
        ),
        warnings=rules(
            ("NULL_TOTAL", "total_usd is null"),
            ("NEGATIVE_TOTAL", "total_usd < 0"),
            ("TOTAL_MISMATCH", _differs("total_usd", "computed_total")),
            ("NULL_COUNTRY", "country is null"),
            ("NULL_DEVICE", "device is null"),
            ("NULL_SOURCE", "source is null"),
        ),
    ),
    "order_items": RuleSet(
        errors=rules(
            ("NULL_ORDER_ID", "order_id is null"),
            ("INVALID_ORDER_ID", "order_id <= 0"),
            ("NULL_PRODUCT_ID", "product_id is null"),
            ("INVALID_PRODUCT_ID", "product_id <= 0"),
            ("NULL_UNIT_PRICE", "unit_price_usd is null"),
            ("NEGATIVE_UNIT_PRICE", "unit_price_usd < 0"),
            ("NULL_QUANTITY", "quantity is null"),
            ("NON_INTEGER_QUANTITY", "quantity <> try_cast(quantity as int)"),
            ("INVALID_QUANTITY", "quantity <= 0"),
        ),
        warnings=rules(
            ("NULL_LINE_TOTAL", "line_total_usd is null"),
            ("NEGATIVE_LINE_TOTAL", "line_total_usd < 0"),
            ("LINE_TOTAL_MISMATCH", _differs("line_total_usd", "computed_line_total")),
        ),
    ),
    "sessions": RuleSet(
        errors=rules(
            ("NULL_SESSION_ID", "session_id is null"),
            ("INVALID_SESSION_ID", "session_id <= 0"),
            ("NULL_CUSTOMER_ID", "customer_id is null"),
            ("INVALID_CUSTOMER_ID", "customer_id <= 0"),
            ("NULL_START_TIMESTAMP", "start_time is null"),
            ("FUTURE_START_TIMESTAMP", "cast(start_time as date) > {process_date}"),
        ),
        warnings=rules(
            ("NULL_COUNTRY", "country is null"),
            ("NULL_DEVICE", "device is null"),
            ("NULL_SOURCE", "source is null"),
        ),
    ),
    "events": RuleSet(
        errors=rules(
            ("NULL_EVENT_ID", "event_id is null"),
            ("INVALID_EVENT_ID", "event_id <= 0"),
            ("NULL_SESSION_ID", "session_id is null"),
            ("INVALID_SESSION_ID", "session_id <= 0"),
            ("NULL_EVENT_TIMESTAMP", "timestamp is null"),
            ("FUTURE_EVENT_TIMESTAMP", "cast(timestamp as date) > {process_date}"),
            ("NULL_EVENT_TYPE", "event_type is null"),
            (
                "INVALID_EVENT_TYPE",
                "event_type not in ('page_view', 'add_to_cart', 'checkout', 'purchase')",
            ),
            ("ADD_TO_CART_MISSING_QTY", "event_type = 'add_to_cart' and qty is null"),
            ("CHECKOUT_MISSING_CART_SIZE", "event_type = 'checkout' and cart_size is null"),
            ("PURCHASE_MISSING_AMOUNT", "event_type = 'purchase' and amount_usd is null"),
            ("PURCHASE_MISSING_PAYMENT", "event_type = 'purchase' and payment is null"),
            (
                "MISSING_PRODUCT_ID",
                "event_type in ('page_view', 'add_to_cart') and product_id is null",
            ),
            ("NEGATIVE_QTY", "event_type = 'add_to_cart' and qty < 0"),
            ("NEGATIVE_CART_SIZE", "event_type = 'checkout' and cart_size < 0"),
            (
                "INVALID_DISCOUNT_PCT",
                "event_type = 'purchase' and discount_pct not between 0 and 100",
            ),
            ("NEGATIVE_AMOUNT", "event_type = 'purchase' and amount_usd < 0"),
        ),
    ),
    "reviews": RuleSet(
        errors=rules(
            ("NULL_REVIEW_ID", "review_id is null"),
            ("INVALID_REVIEW_ID", "review_id <= 0"),
            ("NULL_ORDER_ID", "order_id is null"),
            ("INVALID_ORDER_ID", "order_id <= 0"),
            ("NULL_PRODUCT_ID", "product_id is null"),
            ("INVALID_PRODUCT_ID", "product_id <= 0"),
            ("NULL_RATING", "rating is null"),
            ("INVALID_RATING", "rating not between 1 and 5"),
            ("NULL_REVIEW_TIMESTAMP", "review_time is null"),
            ("FUTURE_REVIEW_TIMESTAMP", "cast(review_time as date) > {process_date}"),
        ),
    ),
}
# ----------------------------------------------------------------------------


def _parsed(name: str) -> dict[str, Column]:
    """Columns read from text or narrowed, after trimming."""
    spec = dataset(name)
    columns = {}
    if spec.event_time:
        columns[spec.event_time] = iso_timestamp(spec.event_time)
    if name == "customers":
        columns["signup_date"] = F.col("signup_date").try_cast("date")
        columns["marketing_opt_in"] = parse_flag("marketing_opt_in")
    if name == "events":
        columns["qty"] = F.col("qty").try_cast("int")
        columns["cart_size"] = F.col("cart_size").try_cast("int")
        columns["product_id"] = F.col("product_id").try_cast("bigint")
    return columns


def _computed(name: str) -> dict[str, Column]:
    """Amounts worked out again from their parts, exact to the cent."""
    if name == "products":
        exact = money("price_usd") - money("cost_usd")
        return {"computed_margin": cents(exact, F.col("price_usd") - F.col("cost_usd"))}
    if name == "orders":
        discount = F.col("discount_pct").try_cast("decimal(10,4)")
        payable = F.when(discount.cast("double") == F.col("discount_pct"), F.lit(100) - discount)
        exact = money("subtotal_usd") * (payable * F.lit(0.01).cast("decimal(2,2)"))
        return {"computed_total": cents(exact, F.col("subtotal_usd") * (100 - F.col("discount_pct")) / 100)}
    if name == "order_items":
        exact = money("unit_price_usd") * F.col("quantity").try_cast("decimal(12,2)")
        return {"computed_line_total": cents(exact, F.col("unit_price_usd") * F.col("quantity"))}
    return {}


def clean(df: DataFrame, name: str, process_date: str) -> DataFrame:
    """Trim, parse, compute, validate and default one data set, row by row.

    Rules see NULL for missing values; "Unknown" is filled in afterwards.
    """
    return _checked(_typed(df, name), name, process_date)


def _typed(df: DataFrame, name: str) -> DataFrame:
    trimmed, parsed = safe_trim(df, dataset(name).trimmed), _parsed(name)
    return trimmed.withColumns(parsed) if parsed else trimmed


def _checked(df: DataFrame, name: str, process_date: str) -> DataFrame:
    computed = _computed(name)
    whole = df.withColumns(computed) if computed else df
    return fill_unknown(validate(whole, RULES[name], process_date), dataset(name).unknown)


def _gap_codes(name: str) -> dict[str, str]:
    """Columns that "Unknown" is filled into, and the warning each raises when missing, in reporting order."""
    missing = {f"{c} is null": c for c in dataset(name).unknown}
    return {missing[r.predicate]: r.code for r in RULES[name].warnings if r.predicate in missing}


def _gaps(name: str) -> Column:
    """Warnings about the columns to fill in, NULL when none is missing."""
    codes = (F.when(F.isnull(c), code) for c, code in _gap_codes(name).items())
    return F.nullif(F.concat_ws(",", *codes), F.lit(""))


def to_silver(bronze: DataFrame, name: str, process_date: str) -> DataFrame:
    """Bronze rows of one delivery as Silver rows, the latest per business key."""
    spec = dataset(name)
    # A record id follows from the key, the rest is one value per delivery: neither says which row is latest.
    rows = _typed(valid_records(bronze).drop(*RECORD_COLUMNS), name)
    if spec.unknown:
        # Rows rank as they leave, filled in; what was missing tells them apart last, as their warnings would.
        rows = fill_unknown(rows.withColumn(GAPS, _gaps(name)), spec.unknown)
    latest = dedupe_latest(rows, spec.keys, spec.priority)
    if spec.unknown:
        gap = {c: F.coalesce(F.contains(GAPS, F.lit(code)), F.lit(False)) for c, code in _gap_codes(name).items()}
        latest = latest.withColumns({c: F.when(~missing, F.col(c)) for c, missing in gap.items()}).drop(GAPS)
    # Amounts and codes follow from the other columns, so they need not move, and go where nobody reads them.
    latest = _checked(latest, name, process_date)
    stamped = latest.drop(*BRONZE_METADATA).withColumns(
        {
            "processed_at": F.current_timestamp(),
            "processed_date": F.lit(process_date).cast("date"),
        }
    )
    return add_status(stamped)
