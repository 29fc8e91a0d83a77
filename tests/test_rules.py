"""Every validation code: a row that fires it and a boundary row that does not."""

from __future__ import annotations

import pytest

from tidemark.operators.rules import add_status, valid_rows, violation_counts
from tidemark.plans.silver import RULES, clean
from tidemark.sources.datasets import DATASETS

DAY = "2024-01-31"
GOOD = {
    "customers": dict(
        customer_id=1,
        name="Ann",
        email="a@b.c",
        country="X",
        age=30,
        signup_date="2024-01-01",
        marketing_opt_in="yes",
    ),
    "products": dict(
        product_id=1, category="c", name="n", price_usd=10.0, cost_usd=4.0, margin_usd=6.0
    ),
    "orders": dict(
        order_id=1,
        customer_id=1,
        order_time="2024-01-01T10:00:00",
        payment_method="card",
        discount_pct=10.0,
        subtotal_usd=100.0,
        total_usd=90.0,
        country="X",
        device="d",
        source="s",
    ),
    "order_items": dict(
        order_id=1, product_id=1, unit_price_usd=2.5, quantity=4, line_total_usd=10.0
    ),
    "sessions": dict(
        session_id=1,
        customer_id=1,
        start_time="2024-01-01T10:00:00",
        device="d",
        source="s",
        country="X",
    ),
    "events": dict(
        event_id=1,
        session_id=1,
        timestamp="2024-01-01T10:00:00",
        event_type="page_view",
        product_id=1.0,
        qty=None,
        cart_size=None,
        payment=None,
        discount_pct=None,
        amount_usd=None,
    ),
    "reviews": dict(
        review_id=1,
        order_id=1,
        product_id=1,
        rating=3,
        review_text="t",
        review_time="2024-01-01T10:00:00",
    ),
}
CART = dict(event_type="add_to_cart", product_id=1.0, qty=1.0)
CHECKOUT = dict(event_type="checkout", product_id=None, cart_size=1.0)
BUY = dict(event_type="purchase", product_id=None, payment="card", amount_usd=5.0, discount_pct=0.0)


def _ids(column, label):
    return [
        ({column: None}, f"NULL_{label}", ""),
        ({column: 0}, f"INVALID_{label}", ""),
        ({column: -1}, f"INVALID_{label}", ""),
        ({column: 1}, "", ""),
    ]


def _times(column, null, future):
    return [
        ({column: None}, null, ""),
        ({column: "2024-01-01"}, null, ""),
        ({column: "2024-01-01 10:00:00"}, null, ""),
        ({column: "2024-01-01T10:00:00.5"}, null, ""),
        ({column: "2024-02-30T10:00:00"}, null, ""),
        ({column: "2024-02-01T00:00:00"}, future, ""),
        ({column: "2024-01-31T23:59:59"}, "", ""),
    ]


_PLACES = [
    ({"country": " "}, "", "NULL_COUNTRY"),
    ({"device": None}, "", "NULL_DEVICE"),
    ({"source": ""}, "", "NULL_SOURCE"),
    ({"source": None, "device": "  ", "country": None}, "", "NULL_COUNTRY,NULL_DEVICE,NULL_SOURCE"),
    ({"country": "\t"}, "", ""),  # only spaces are trimmed
]
# data set: (changed columns, errors, warnings)
CASES = {
    "customers": [
        *_ids("customer_id", "CUSTOMER_ID"),
        ({"email": None}, "NULL_EMAIL", ""),
        ({"email": "  "}, "NULL_EMAIL", ""),
        ({"email": "no.at.sign"}, "INVALID_EMAIL_FORMAT", ""),
        ({"email": "a b@c"}, "INVALID_EMAIL_FORMAT", ""),
        ({"email": " A+b_c.d-e@x "}, "", ""),
        ({"signup_date": None}, "NULL_SIGNUP_DATE", ""),
        ({"signup_date": "soon"}, "NULL_SIGNUP_DATE", ""),
        ({"signup_date": "2024-02-01"}, "FUTURE_SIGNUP_DATE", ""),
        ({"signup_date": DAY}, "", ""),
        ({"age": None}, "NULL_AGE", ""),
        ({"age": -1}, "INVALID_AGE", ""),
        ({"age": 151}, "INVALID_AGE", ""),
        ({"age": 0}, "", ""),
        ({"age": 150}, "", ""),
        ({"name": " "}, "", "NULL_NAME"),
        ({"country": ""}, "", "NULL_COUNTRY"),
        ({"marketing_opt_in": "maybe"}, "", "NULL_MARKETING_OPT_IN"),
        ({"marketing_opt_in": " NO "}, "", ""),
        (
            {"customer_id": None, "email": None, "age": None, "name": None},
            "NULL_CUSTOMER_ID,NULL_EMAIL,NULL_AGE",
            "NULL_NAME",
        ),
    ],
    "products": [
        *_ids("product_id", "PRODUCT_ID"),
        ({"category": " "}, "NULL_CATEGORY", ""),
        ({"name": None}, "NULL_PRODUCT_NAME", ""),
        ({"price_usd": None}, "NULL_PRICE", ""),
        ({"price_usd": -1.0}, "NEGATIVE_PRICE,COST_EXCEEDS_PRICE", "MARGIN_MISMATCH"),
        ({"price_usd": 0.0, "cost_usd": 0.0, "margin_usd": 0.0}, "", "INVALID_MARGIN"),
        ({"cost_usd": None}, "NULL_COST", ""),
        ({"cost_usd": -1.0, "margin_usd": 11.0}, "NEGATIVE_COST", ""),
        ({"cost_usd": 10.01, "margin_usd": -0.01}, "COST_EXCEEDS_PRICE", "INVALID_MARGIN"),
        ({"cost_usd": 10.0, "margin_usd": 0.01}, "", ""),
        ({"margin_usd": 6.02}, "", "MARGIN_MISMATCH"),
        ({"margin_usd": 6.01}, "", ""),
        ({"margin_usd": None}, "", ""),
    ],
    "orders": [
        *_ids("order_id", "ORDER_ID"),
        *_ids("customer_id", "CUSTOMER_ID"),
        *_times("order_time", "NULL_ORDER_TIME", "FUTURE_ORDER_TIMESTAMP"),
        ({"discount_pct": None}, "NULL_DISCOUNT_PCT", ""),
        ({"discount_pct": -0.01, "total_usd": 100.01}, "INVALID_DISCOUNT_PCT", ""),
        ({"discount_pct": 100.01, "total_usd": -0.01}, "INVALID_DISCOUNT_PCT", "NEGATIVE_TOTAL"),
        ({"discount_pct": 0.0, "total_usd": 100.0}, "", ""),
        ({"discount_pct": 100.0, "total_usd": 0.0}, "", ""),
        ({"subtotal_usd": None}, "NULL_SUBTOTAL", ""),
        ({"subtotal_usd": -10.0, "total_usd": -9.0}, "NEGATIVE_SUBTOTAL", "NEGATIVE_TOTAL"),
        ({"total_usd": None}, "", "NULL_TOTAL"),
        ({"total_usd": 90.02}, "", "TOTAL_MISMATCH"),
        ({"total_usd": 90.01}, "", ""),
        ({"payment_method": None}, "", ""),
        *_PLACES,
    ],
    "order_items": [
        *_ids("order_id", "ORDER_ID"),
        *_ids("product_id", "PRODUCT_ID"),
        ({"unit_price_usd": None}, "NULL_UNIT_PRICE", ""),
        (
            {"unit_price_usd": -2.5, "line_total_usd": -10.0},
            "NEGATIVE_UNIT_PRICE",
            "NEGATIVE_LINE_TOTAL",
        ),
        ({"unit_price_usd": 0.0, "line_total_usd": 0.0}, "", ""),
        ({"quantity": None}, "NULL_QUANTITY", ""),
        ({"quantity": 0, "line_total_usd": 0.0}, "INVALID_QUANTITY", ""),
        ({"line_total_usd": None}, "", "NULL_LINE_TOTAL"),
        ({"line_total_usd": 10.02}, "", "LINE_TOTAL_MISMATCH"),
        ({"line_total_usd": 9.99}, "", ""),
    ],
    "sessions": [
        *_ids("session_id", "SESSION_ID"),
        *_ids("customer_id", "CUSTOMER_ID"),
        *_times("start_time", "NULL_START_TIMESTAMP", "FUTURE_START_TIMESTAMP"),
        *_PLACES,
    ],
    "events": [
        *_ids("event_id", "EVENT_ID"),
        *_ids("session_id", "SESSION_ID"),
        *_times("timestamp", "NULL_EVENT_TIMESTAMP", "FUTURE_EVENT_TIMESTAMP"),
        ({"event_type": " "}, "NULL_EVENT_TYPE", ""),
        ({"event_type": "Purchase"}, "INVALID_EVENT_TYPE", ""),
        ({"product_id": None}, "MISSING_PRODUCT_ID", ""),
        ({"product_id": 0.0}, "", ""),
        (CART, "", ""),
        ({**CART, "qty": None}, "ADD_TO_CART_MISSING_QTY", ""),
        ({**CART, "product_id": None}, "MISSING_PRODUCT_ID", ""),
        ({**CART, "qty": -1.0}, "NEGATIVE_QTY", ""),
        ({**CART, "qty": 0.0}, "", ""),
        (CHECKOUT, "", ""),
        ({**CHECKOUT, "cart_size": None}, "CHECKOUT_MISSING_CART_SIZE", ""),
        ({**CHECKOUT, "cart_size": -1.0}, "NEGATIVE_CART_SIZE", ""),
        ({**CHECKOUT, "cart_size": 0.0}, "", ""),
        (BUY, "", ""),
        ({**BUY, "amount_usd": None}, "PURCHASE_MISSING_AMOUNT", ""),
        ({**BUY, "payment": " "}, "PURCHASE_MISSING_PAYMENT", ""),
        ({**BUY, "discount_pct": 100.01}, "INVALID_DISCOUNT_PCT", ""),
        ({**BUY, "discount_pct": -0.01}, "INVALID_DISCOUNT_PCT", ""),
        ({**BUY, "discount_pct": 100.0}, "", ""),
        ({**BUY, "discount_pct": None}, "", ""),
        ({**BUY, "amount_usd": -0.01}, "NEGATIVE_AMOUNT", ""),
        ({**BUY, "amount_usd": 0.0}, "", ""),
        ({"qty": -1.0, "discount_pct": 500.0, "amount_usd": -1.0}, "", ""),
        ({**BUY, "payment": None, "amount_usd": None}, "PURCHASE_MISSING_AMOUNT,PURCHASE_MISSING_PAYMENT", ""),
    ],
    "reviews": [
        *_ids("review_id", "REVIEW_ID"),
        *_ids("order_id", "ORDER_ID"),
        *_ids("product_id", "PRODUCT_ID"),
        ({"rating": None}, "NULL_RATING", ""),
        ({"rating": 0}, "INVALID_RATING", ""),
        ({"rating": 6}, "INVALID_RATING", ""),
        ({"rating": 1}, "", ""),
        ({"rating": 5}, "", ""),
        *_times("review_time", "NULL_REVIEW_TIMESTAMP", "FUTURE_REVIEW_TIMESTAMP"),
        ({"review_text": " "}, "", ""),
    ],
}


@pytest.mark.parametrize("name", CASES)
def test_codes(spark, name):
    rows = [tuple({**GOOD[name], **change}.values()) for change, _, _ in CASES[name]]
    source = spark.createDataFrame(rows, DATASETS[name].struct).coalesce(1)
    cleaned = clean(source, name, DAY).collect()
    found = [(r["validation_errors"], r["validation_warnings"]) for r in cleaned]
    expected = [(errors or None, warnings or None) for _, errors, warnings in CASES[name]]
    assert [(c[0], f) for c, f in zip(CASES[name], found)] == [
        (c[0], e) for c, e in zip(CASES[name], expected)
    ]


def test_every_code_is_covered():
    for name, rule_set in RULES.items():
        fired = {c for _, e, w in CASES[name] for c in f"{e},{w}".split(",")}
        codes = {r.code for r in (*rule_set.errors, *rule_set.warnings)}
        assert codes - fired <= {"NON_INTEGER_QUANTITY"}, name
    assert sum(len(r.errors) for r in RULES.values()) == 69
    assert sum(len(r.warnings) for r in RULES.values()) == 17


def test_fractional_quantity_on_a_double_column(spark):
    items = spark.createDataFrame(
        [(1, 1, 2.0, 1.5, 3.0), (1, 2, 2.0, 2.0, 4.0)],
        "order_id bigint, product_id bigint, unit_price_usd double, quantity double,"
        " line_total_usd double",
    )
    rows = clean(items, "order_items", DAY).orderBy("product_id").collect()
    assert [r["validation_errors"] for r in rows] == ["NON_INTEGER_QUANTITY", None]
    assert rows[0]["computed_line_total"] == 3.0


def test_unknown_is_filled_in_after_the_warnings(spark):
    rows = [tuple({**GOOD["orders"], "country": " ", "device": None, "source": ""}.values())]
    row = clean(spark.createDataFrame(rows, DATASETS["orders"].struct), "orders", DAY).first()
    assert (row["country"], row["device"], row["source"]) == ("Unknown",) * 3
    assert row["validation_warnings"] == "NULL_COUNTRY,NULL_DEVICE,NULL_SOURCE"


def test_status_and_valid_rows(spark):
    df = spark.createDataFrame(
        [(1, "A", "W"), (2, None, "W,X"), (3, None, None)],
        "id int, validation_errors string, validation_warnings string",
    )
    status = [r["status"] for r in add_status(df).orderBy("id").collect()]
    assert status == ["ERROR", "WARNING", "VALID"]
    assert [r["id"] for r in valid_rows(df).orderBy("id").collect()] == [2, 3]
    assert valid_rows(df.drop("validation_errors")).count() == 3
    counts = {(r[1], r[2]): r[3] for r in violation_counts(df, "d").collect()}
    assert counts == {("error", "A"): 1, ("warning", "W"): 2, ("warning", "X"): 1}
