"""DuckDB SQL for every registered query.

``Oracle`` collects common table expressions by name; a method that needs another
table asks for it first, so definitions end up in dependency order. Only the sample
adapters and the two deliveries are shared with the Spark side: all results are
stated here a second time, in SQL.
"""

from __future__ import annotations

import re

from tidemark.sources.samples import DELIVERIES, DUCKDB, SAMPLE_SQL

DATES = {None: "2024-01-31", 1: "2024-01-15", 2: "2024-01-31", 3: "2024-01-31"}
STAMPS = {None: "2024-01-31 00:00:00", 1: "2024-01-15 00:00:00", 2: "2024-01-31 00:00:00"}
# The corrections bring no snapshots: dimensions are those of the first delivery.
SNAPSHOT = {3: 1}
SINCE = "date '2024-01-15'"
DATASETS = ("events", "customers", "orders", "products", "reviews", "sessions", "order_items")
KEYS = {
    "events": "event_id",
    "customers": "customer_id",
    "orders": "order_id",
    "products": "product_id",
    "reviews": "review_id",
    "sessions": "session_id",
    "order_items": "order_id, product_id",
}
# Newest first, then the remaining columns as tie-breakers.
RECENCY = {
    "events": "timestamp, session_id, event_type, product_id, qty, cart_size, payment,"
    " discount_pct, amount_usd",
    "customers": "name, email, country, age, signup_date, marketing_opt_in",
    "orders": "order_time, customer_id, payment_method, discount_pct, subtotal_usd, total_usd,"
    " country, device, source",
    "products": "category, name, price_usd, cost_usd, margin_usd",
    "reviews": "review_time, order_id, product_id, rating, review_text",
    "sessions": "start_time, customer_id, device, source, country",
    "order_items": "unit_price_usd, quantity, line_total_usd",
}
ISO = "try_strptime({c}, '%Y-%m-%dT%H:%M:%S')"
MONEY = "cast({c} as decimal(18,4))"


def _blank(c: str) -> str:
    return f"nullif(trim({c}), '') as {c}"


def _iso(c: str) -> str:
    return f"{ISO.format(c=c)} as {c}"


def _m(c: str) -> str:
    return MONEY.format(c=c)


def _codes(*pairs: tuple[str, str]) -> str:
    cases = ", ".join(f"case when {when} then '{code}' end" for code, when in pairs)
    return f"nullif(concat_ws(',', {cases}), '')"


def _id(column: str, label: str) -> list[tuple[str, str]]:
    return [(f"NULL_{label}", f"{column} is null"), (f"INVALID_{label}", f"{column} <= 0")]


def _when(column: str, null: str, future: str, day: str) -> list[tuple[str, str]]:
    return [(null, f"{column} is null"), (future, f"cast({column} as date) > date '{day}'")]


def _apart(a: str, b: str) -> str:
    return f"abs({_m(a)} - {_m(b)}) > 0.01"


_PLACES = [
    ("NULL_COUNTRY", "country is null"),
    ("NULL_DEVICE", "device is null"),
    ("NULL_SOURCE", "source is null"),
]
_FILL = "coalesce(country, 'Unknown') as country, coalesce(source, 'Unknown') as source," \
    " coalesce(device, 'Unknown') as device"

# data set: (parsed columns, computed columns, filled columns)
CLEANING = {
    "customers": (
        "customer_id, " + ", ".join(_blank(c) for c in ("name", "email", "country"))
        + ", age, try_cast(signup_date as date) as signup_date,"
        " case when lower(trim(marketing_opt_in)) in ('true', '1', 'yes') then true"
        " when lower(trim(marketing_opt_in)) in ('false', '0', 'no') then false end"
        " as marketing_opt_in",
        "",
        "coalesce(name, 'Unknown') as name",
    ),
    "products": (
        f"product_id, {_blank('category')}, {_blank('name')}, price_usd, cost_usd, margin_usd",
        f", cast(round({_m('price_usd')} - {_m('cost_usd')}, 2) as double) as computed_margin",
        "",
    ),
    "orders": (
        f"order_id, customer_id, {_iso('order_time')}, {_blank('payment_method')}, discount_pct,"
        f" subtotal_usd, total_usd, {_blank('country')}, {_blank('device')}, {_blank('source')}",
        f", cast(round({_m('subtotal_usd')} * (100 - cast(discount_pct as decimal(9,4))) * 0.01, 2)"
        " as double) as computed_total",
        _FILL,
    ),
    "order_items": (
        "order_id, product_id, unit_price_usd, quantity, line_total_usd",
        f", cast(round({_m('unit_price_usd')} * cast(quantity as decimal(9,0)), 2) as double)"
        " as computed_line_total",
        "",
    ),
    "sessions": (
        f"session_id, customer_id, {_iso('start_time')}, {_blank('device')}, {_blank('source')},"
        f" {_blank('country')}",
        "",
        _FILL,
    ),
    "events": (
        f"event_id, session_id, {_iso('timestamp')}, {_blank('event_type')},"
        " cast(product_id as bigint) as product_id, cast(qty as int) as qty,"
        f" cast(cart_size as int) as cart_size, {_blank('payment')}, discount_pct, amount_usd",
        "",
        "",
    ),
    "reviews": (
        f"review_id, order_id, product_id, rating, {_blank('review_text')}, {_iso('review_time')}",
        "",
        "",
    ),
}


def _checks(name: str, day: str) -> tuple[str, str]:
    """Error and warning columns of one data set."""
    none = "cast(null as varchar)"
    if name == "customers":
        return _codes(
            *_id("customer_id", "CUSTOMER_ID"),
            ("NULL_EMAIL", "email is null"),
            (
                "INVALID_EMAIL_FORMAT",
                "not regexp_matches(email, '^[A-Za-z0-9+_.-]+@(.+)$')",
            ),
            *_when("signup_date", "NULL_SIGNUP_DATE", "FUTURE_SIGNUP_DATE", day),
            ("NULL_AGE", "age is null"),
            ("INVALID_AGE", "age < 0 or age > 150"),
        ), _codes(
            ("NULL_NAME", "name is null"),
            ("NULL_COUNTRY", "country is null"),
            ("NULL_MARKETING_OPT_IN", "marketing_opt_in is null"),
        )
    if name == "products":
        return _codes(
            *_id("product_id", "PRODUCT_ID"),
            ("NULL_CATEGORY", "category is null"),
            ("NULL_PRODUCT_NAME", "name is null"),
            ("NULL_PRICE", "price_usd is null"),
            ("NEGATIVE_PRICE", "price_usd < 0"),
            ("NULL_COST", "cost_usd is null"),
            ("NEGATIVE_COST", "cost_usd < 0"),
            ("COST_EXCEEDS_PRICE", "cost_usd > price_usd"),
        ), _codes(
            ("INVALID_MARGIN", "margin_usd <= 0"),
            ("MARGIN_MISMATCH", _apart("margin_usd", "computed_margin")),
        )
    if name == "orders":
        return _codes(
            *_id("order_id", "ORDER_ID"),
            *_id("customer_id", "CUSTOMER_ID"),
            *_when("order_time", "NULL_ORDER_TIME", "FUTURE_ORDER_TIMESTAMP", day),
            ("NULL_DISCOUNT_PCT", "discount_pct is null"),
            ("INVALID_DISCOUNT_PCT", "discount_pct < 0 or discount_pct > 100"),
            ("NULL_SUBTOTAL", "subtotal_usd is null"),
            ("NEGATIVE_SUBTOTAL", "subtotal_usd < 0"),
        ), _codes(
            ("NULL_TOTAL", "total_usd is null"),
            ("NEGATIVE_TOTAL", "total_usd < 0"),
            ("TOTAL_MISMATCH", _apart("total_usd", "computed_total")),
            *_PLACES,
        )
    if name == "order_items":
        return _codes(
            *_id("order_id", "ORDER_ID"),
            *_id("product_id", "PRODUCT_ID"),
            ("NULL_UNIT_PRICE", "unit_price_usd is null"),
            ("NEGATIVE_UNIT_PRICE", "unit_price_usd < 0"),
            ("NULL_QUANTITY", "quantity is null"),
            ("INVALID_QUANTITY", "quantity <= 0"),
        ), _codes(
            ("NULL_LINE_TOTAL", "line_total_usd is null"),
            ("NEGATIVE_LINE_TOTAL", "line_total_usd < 0"),
            ("LINE_TOTAL_MISMATCH", _apart("line_total_usd", "computed_line_total")),
        )
    if name == "sessions":
        return _codes(
            *_id("session_id", "SESSION_ID"),
            *_id("customer_id", "CUSTOMER_ID"),
            *_when("start_time", "NULL_START_TIMESTAMP", "FUTURE_START_TIMESTAMP", day),
        ), _codes(*_PLACES)
    if name == "events":
        return _codes(
            *_id("event_id", "EVENT_ID"),
            *_id("session_id", "SESSION_ID"),
            *_when("timestamp", "NULL_EVENT_TIMESTAMP", "FUTURE_EVENT_TIMESTAMP", day),
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
                "event_type = 'purchase' and (discount_pct < 0 or discount_pct > 100)",
            ),
            ("NEGATIVE_AMOUNT", "event_type = 'purchase' and amount_usd < 0"),
        ), none
    return _codes(
        *_id("review_id", "REVIEW_ID"),
        *_id("order_id", "ORDER_ID"),
        *_id("product_id", "PRODUCT_ID"),
        ("NULL_RATING", "rating is null"),
        ("INVALID_RATING", "rating < 1 or rating > 5"),
        *_when("review_time", "NULL_REVIEW_TIMESTAMP", "FUTURE_REVIEW_TIMESTAMP", day),
    ), none


STATIC = {
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
HISTORY = {
    "dim_customer": (
        "customer_id",
        "customer_key",
        "name, email, country_name, birth_year, signup_date, marketing_opt_in",
    ),
    "dim_product": (
        "product_id",
        "product_key",
        "category_key, product_name, base_price_usd, cost_usd",
    ),
    "order_history": ("order_id", "order_version_key", "payment_method, subtotal_usd, country"),
}
FACT_KEYS = {
    "fact_order": ("order_key", "order_id"),
    "fact_order_item": ("order_item_key", "order_id, product_id"),
    "fact_web_event": ("event_key", "event_id"),
    "fact_review": ("review_key", "review_id"),
    "fact_session": ("session_key", "session_id"),
    "fact_customer_funnel": ("funnel_key", "customer_key, product_key"),
}
DAY_KEY = "cast(strftime({d}, '%Y%m%d') as int)"


def _same(keys: str, a: str, b: str) -> str:
    return " and ".join(f"{a}.{k.strip()} = {b}.{k.strip()}" for k in keys.split(","))


class Oracle:
    def __init__(self) -> None:
        self.ctes: dict[str, str] = {}

    def cte(self, name: str, body: str) -> str:
        self.ctes.setdefault(name, body)
        return name

    def sql(self, final: str) -> str:
        if not self.ctes:
            return final
        parts = ",\n".join(f"{name} as ({body})" for name, body in self.ctes.items())
        return f"with {parts}\n{final}"

    # --- sources and silver ---------------------------------------------------------

    def source(self, name: str, delivery: int | None = None) -> str:
        if delivery is None:
            return self.cte(f"src_{name}", SAMPLE_SQL[name](DUCKDB))
        text = DELIVERIES[delivery][name]
        body = re.sub(r"\{(\w+)\}", lambda m: self.source(m.group(1)), text)
        return self.cte(f"src{delivery}_{name}", body)

    def silver_batch(self, name: str, delivery: int | None = None) -> str:
        day = DATES[delivery]
        parsed, computed, filled = CLEANING[name]
        errors, warnings = _checks(name, day)
        source = self.source(name, delivery)
        replace = f" replace ({filled})" if filled else ""
        order = ", ".join(f"{c.strip()} desc nulls last" for c in RECENCY[name].split(","))
        return self.cte(
            f"silver{delivery or ''}_{name}",
            f"""
  select * exclude (place), date '{day}' as processed_date,
    case when validation_errors is not null then 'ERROR'
      when validation_warnings is not null then 'WARNING' else 'VALID' end as status
  from (
    select *, row_number() over (partition by {KEYS[name]} order by {order}) as place
    from (
      select *{replace} from (
        select *, {errors} as validation_errors, {warnings} as validation_warnings
        from (select *{computed} from (select {parsed} from {source}))
      )
    )
  ) where place = 1""",
        )

    def silver(self, name: str, delivery: int | None = None) -> str:
        """The Silver table after a delivery."""
        if delivery == 3 and name in ("customers", "products"):
            delivery = 1
        batch = self.silver_batch(name, delivery)
        if delivery not in (2, 3) or name in ("customers", "products"):
            return batch
        held = self.silver_batch(name, 1)
        return self.cte(
            f"merged{delivery}_{name}",
            f"""
  select * from {batch} union all by name
  select * from {held} h where not exists
    (select 1 from {batch} b where {_same(KEYS[name], 'h', 'b')})""",
        )

    def usable(self, name: str, delivery: int | None = None) -> str:
        table = self.silver(name, delivery)
        alias = {
            "orders": ", cast(order_time as date) as order_date",
            "reviews": ", cast(review_time as date) as review_date",
            "sessions": ", cast(start_time as date) as session_date",
            "events": ", cast(timestamp as date) as event_date",
        }.get(name, "")
        return self.cte(
            f"usable{delivery or ''}_{name}",
            f"select *{alias} from {table} where validation_errors is null",
        )

    def visits(self, delivery: int | None = None) -> str:
        events, sessions = self.usable("events", delivery), self.usable("sessions", delivery)
        return self.cte(
            f"visits{delivery or ''}",
            f"select e.*, s.customer_id from {events} e join {sessions} s"
            " on e.session_id = s.session_id",
        )

    # --- dimensions -------------------------------------------------------------------

    def calendar(self) -> str:
        return self.cte(
            "dim_date",
            f"""
  select {DAY_KEY.format(d='d')} as date_key, d as full_date, cast(year(d) as int) as year,
    cast(quarter(d) as int) as quarter, cast(month(d) as int) as month,
    cast(day(d) as int) as day_of_month, cast(dayofweek(d) + 1 as int) as day_of_week
  from (select cast(unnest(generate_series(date '1950-01-01', date '2050-12-31',
    interval 1 day)) as date) as d)""",
        )

    def static(self, name: str, delivery: int | None = None) -> str:
        delivery = SNAPSHOT.get(delivery, delivery)
        table, column, value, key = STATIC[name]
        members = f"""
    select distinct {column} as v from {self.silver(table, delivery)} where {column} is not null"""
        if delivery != 2:
            return self.cte(
                f"{name}{delivery or ''}",
                f"select row_number() over (order by v) as {key}, v as {value} from ({members})",
            )
        held = self.static(name, 1)
        return self.cte(
            f"{name}2",
            f"""
  select {key}, {value} from {held} union all
  select (select coalesce(max({key}), 0) from {held}) + row_number() over (order by v), v
  from ({members}) where v not in (select {value} from {held})""",
        )

    def snapshot(self, name: str, delivery: int | None = None) -> str:
        """Tracked attributes as delivered."""
        delivery = SNAPSHOT.get(delivery, delivery)
        if name == "dim_customer":
            year = DATES[delivery][:4]
            body = f"""
  select customer_id, name, email, country as country_name,
    case when age >= 0 and age <= 150 then {year} - age end as birth_year, signup_date,
    marketing_opt_in
  from {self.silver('customers', delivery)} where customer_id is not null"""
        elif name == "dim_product":
            category = self.static("dim_category", delivery)
            body = f"""
  select product_id, category_key, name as product_name, price_usd as base_price_usd, cost_usd
  from {self.silver('products', delivery)} left join {category} on category = category_name
  where product_id is not null"""
        else:
            body = f"""
  select order_id, payment_method, subtotal_usd, country
  from {self.silver_batch('orders', delivery)}"""
        return self.cte(f"snapshot{delivery or ''}_{name}", body)

    def history(self, name: str, delivery: int | None = None) -> str:
        delivery = SNAPSHOT.get(delivery, delivery)
        natural, key, attributes = HISTORY[name]
        snapshot = self.snapshot(name, delivery)
        opened = f"'{STAMPS[delivery]}' as effective_from, cast(null as varchar) as effective_to," \
            " true as is_current"
        if delivery != 2:
            return self.cte(
                f"{name}{delivery or ''}",
                f"""
  select row_number() over (order by {natural}) as {key}, {natural}, {attributes}, {opened}
  from {snapshot}""",
            )
        held = self.history(name, 1)
        differs = " or ".join(
            f"s.{a.strip()} is distinct from h.{a.strip()}" for a in attributes.split(",")
        )
        changed = self.cte(
            f"changed_{name}",
            f"select s.* from {snapshot} s join {held} h on s.{natural} = h.{natural}"
            f" where h.is_current and ({differs})",
        )
        return self.cte(
            f"{name}2",
            f"""
  select h.* replace (
    case when is_current and {natural} in (select {natural} from {changed})
      then '{STAMPS[2]}' else effective_to end as effective_to,
    is_current and {natural} not in (select {natural} from {changed}) as is_current)
  from {held} h
  union all
  select (select max({key}) from {held}) + row_number() over (order by {natural}),
    {natural}, {attributes}, {opened}
  from (select * from {changed} union all
    select * from {snapshot} where {natural} not in (select {natural} from {held}))""",
        )

    def current(self, name: str, delivery: int | None = None) -> str:
        delivery = SNAPSHOT.get(delivery, delivery)
        return self.cte(
            f"current{delivery or ''}_{name}",
            f"select * from {self.history(name, delivery)} where is_current",
        )

    # --- facts ------------------------------------------------------------------------

    def costs(self, delivery: int | None = None) -> str:
        items, products = self.usable("order_items", delivery), self.current("dim_product", delivery)
        return self.cte(
            f"costs{delivery or ''}",
            f"""
  select order_id, sum(coalesce({_m('cost_usd')}, 0) * quantity) as order_cost_usd
  from {items} i left join {products} p on i.product_id = p.product_id group by order_id""",
        )

    def durations(self, delivery: int | None = None, joined: bool = True) -> str:
        events = self.usable("events", delivery)
        known = ""
        if joined:
            known = f"where session_id in (select session_id from {self.usable('sessions', delivery)})"
        return self.cte(
            f"durations{delivery or ''}" + ("" if joined else "_all"),
            f"""
  select event_id, session_id, timestamp, cast(coalesce(greatest(datediff('second', timestamp,
    lead(timestamp) over (partition by session_id order by timestamp, event_id)), 0), 0)
    as double) as duration
  from {events} {known}""",
        )

    def fact_rows(self, name: str, delivery: int | None = None) -> str:
        """Rows of a full load, without surrogate key."""
        n = delivery

        def day(column: str) -> str:
            in_range = f"{column} between date '1950-01-01' and date '2050-12-31'"
            return f"case when {in_range} then {DAY_KEY.format(d=column)} end"

        if name == "fact_order":
            body = f"""
  select o.order_id, c.customer_key, {day('order_date')} as date_key, country_key, source_key,
    device_key, strftime(order_time, '%Y-%m-%d %H:%M:%S') as order_time, payment_method_key,
    discount_pct, subtotal_usd as gross_revenue_usd,
    cast(round({_m('computed_total')} - coalesce(order_cost_usd, 0), 2) as double)
      as net_margin_usd
  from {self.usable('orders', n)} o
    left join {self.costs(n)} k on o.order_id = k.order_id
    left join {self.current('dim_customer', n)} c on o.customer_id = c.customer_id
    left join {self.static('dim_country', n)} dc on o.country = dc.country_name
    left join {self.static('dim_source', n)} ds on o.source = ds.source_name
    left join {self.static('dim_device', n)} dd on o.device = dd.device_name
    left join {self.static('dim_payment_method', n)} dp on o.payment_method = dp.payment_method_name"""
        elif name == "fact_order_item":
            body = f"""
  select i.order_id, i.product_id, c.customer_key, p.product_key, {day('order_date')} as date_key,
    quantity, unit_price_usd, computed_line_total as gross_revenue_usd,
    cast(round({_m('computed_line_total')} - coalesce({_m('cost_usd')}, 0) * quantity, 2)
      as double) as gross_margin_usd
  from {self.usable('order_items', n)} i
    join {self.usable('orders', n)} o on i.order_id = o.order_id
    left join {self.current('dim_customer', n)} c on o.customer_id = c.customer_id
    left join {self.current('dim_product', n)} p on i.product_id = p.product_id"""
        elif name == "fact_web_event":
            body = f"""
  select e.event_id, e.session_id, c.customer_key, p.product_key, {day('event_date')} as date_key,
    event_type, duration
  from {self.usable('events', n)} e
    join {self.usable('sessions', n)} s on e.session_id = s.session_id
    join {self.durations(n)} t on e.event_id = t.event_id
    left join {self.current('dim_customer', n)} c on s.customer_id = c.customer_id
    left join {self.current('dim_product', n)} p on e.product_id = p.product_id"""
        elif name == "fact_review":
            body = f"""
  select review_id, order_id, product_key, rating, review_text, review_date
  from {self.usable('reviews', n)} r
    left join {self.current('dim_product', n)} p on r.product_id = p.product_id"""
        elif name == "fact_session":
            body = f"""
  select session_id, customer_key, strftime(start_time, '%Y-%m-%d %H:%M:%S') as start_time,
    {day('session_date')} as date_key, device_key, source_key, country_key
  from {self.usable('sessions', n)} s
    left join {self.current('dim_customer', n)} c on s.customer_id = c.customer_id
    left join {self.static('dim_country', n)} dc on s.country = dc.country_name
    left join {self.static('dim_source', n)} ds on s.source = ds.source_name
    left join {self.static('dim_device', n)} dd on s.device = dd.device_name"""
        else:
            views, carts, buys = (
                self.milestone("page_view", n),
                self.milestone("add_to_cart", n),
                self.purchases(n),
            )
            body = f"""
  select customer_key, product_key, {day('view_date')} as first_view_date_key,
    {day('cart_date')} as first_add_to_cart_date_key, {day('buy_date')} as first_purchase_date_key
  from {self.pairs(n)} k
    left join {views} v on k.customer_id = v.customer_id and k.product_id = v.product_id
    left join {carts} a on k.customer_id = a.customer_id and k.product_id = a.product_id
    left join {buys} b on k.customer_id = b.customer_id and k.product_id = b.product_id
    join {self.current('dim_customer', n)} c on k.customer_id = c.customer_id
    join {self.current('dim_product', n)} p on k.product_id = p.product_id"""
        return self.cte(f"rows{n or ''}_{name}", body)

    def fact(self, name: str, delivery: int | None = None) -> str:
        key, order = FACT_KEYS[name]
        return self.cte(
            f"{name}{delivery or ''}",
            f"select row_number() over (order by {order}) as {key}, *"
            f" from {self.fact_rows(name, delivery)}",
        )

    def fact_incremental(self, name: str) -> str:
        """The table after the first load and the increment of the second delivery."""
        key, order = FACT_KEYS[name]
        held = self.fact(name, 1)
        rows = self.fact_rows(name, 2)
        new = f"processed_date > {SINCE}"
        orders, items = self.usable("orders", 2), self.usable("order_items", 2)
        events, sessions = self.usable("events", 2), self.usable("sessions", 2)
        touched = {
            "fact_order": f"order_id in (select order_id from {orders} where {new}"
            f" union select order_id from {items} where {new})",
            "fact_order_item": f"order_id in (select order_id from {orders} where {new})"
            f" or (order_id, product_id) in (select (order_id, product_id) from {items} where {new})",
            "fact_web_event": f"session_id in (select session_id from {events} where {new}"
            f" union select session_id from {sessions} where {new})",
            "fact_review": f"review_id in (select review_id from {self.usable('reviews', 2)}"
            f" where {new})",
            "fact_session": f"session_id in (select session_id from {sessions} where {new})",
        }[name]
        delta = self.cte(f"delta_{name}", f"select * from {rows} where {touched}")
        return self.cte(
            f"{name}2",
            f"""
  select h.* from {held} h where not exists
    (select 1 from {delta} d where {_same(order, 'h', 'd')})
  union all by name
  select h.{key}, d.* from {delta} d join {held} h on {_same(order, 'h', 'd')}
  union all by name
  select (select max({key}) from {held}) + row_number() over (order by {order}) as {key}, d.*
  from {delta} d where not exists (select 1 from {held} h where {_same(order, 'h', 'd')})""",
        )

    def fact_retraction(self, name: str) -> str:
        """The table rebuilt over the corrected first delivery; known keys keep their number."""
        key, order = FACT_KEYS[name]
        held, rows = self.fact(name, 1), self.fact_rows(name, 3)
        return self.cte(
            f"{name}3",
            f"""
  select h.{key}, r.* from {rows} r join {held} h on {_same(order, 'h', 'r')}
  union all by name
  select (select max({key}) from {held}) + row_number() over (order by {order}) as {key}, r.*
  from {rows} r where not exists (select 1 from {held} h where {_same(order, 'h', 'r')})""",
        )

    # --- funnel -----------------------------------------------------------------------

    def milestone(self, kind: str, delivery: int | None = None) -> str:
        column = "view_date" if kind == "page_view" else "cart_date"
        return self.cte(
            f"first{delivery or ''}_{column}",
            f"select customer_id, product_id, min(event_date) as {column} from {self.visits(delivery)}"
            f" where event_type = '{kind}' and product_id is not null group by all",
        )

    def session_orders(self, delivery: int | None = None) -> str:
        return self.cte(
            f"session_orders{delivery or ''}",
            f"""
  select distinct v.session_id, v.customer_id, o.order_id, o.order_date
  from {self.visits(delivery)} v join {self.usable('orders', delivery)} o
    on v.customer_id = o.customer_id and v.timestamp = o.order_time
  where v.event_type = 'purchase'""",
        )

    def purchases(self, delivery: int | None = None) -> str:
        return self.cte(
            f"first{delivery or ''}_buy_date",
            f"""
  select customer_id, product_id, min(order_date) as buy_date
  from {self.session_orders(delivery)} m
    join {self.usable('order_items', delivery)} i on m.order_id = i.order_id
  group by all""",
        )

    def pairs(self, delivery: int | None = None) -> str:
        views, carts, buys = (
            self.milestone("page_view", delivery),
            self.milestone("add_to_cart", delivery),
            self.purchases(delivery),
        )
        return self.cte(
            f"pairs{delivery or ''}",
            " union ".join(f"select customer_id, product_id from {t}" for t in (views, carts, buys)),
        )


# --- one statement per registered query ---------------------------------------------


def _record(name: str) -> tuple[str, str]:
    if name == "order_items":
        return "concat_ws('_', cast(order_id as varchar), cast(product_id as varchar))", \
            "order_id_product_id"
    return f"cast({KEYS[name]} as varchar)", KEYS[name]


def _bronze(name: str) -> str:
    o = Oracle()
    record, origin = _record(name)
    return o.sql(f"""
select *, {record} as record_id, '{origin}' as record_id_source,
  case when {record} is null then 'NULL RECORD ID' when trim({record}) = '' then 'EMPTY RECORD ID'
    end as error,
  {record} is not null and trim({record}) <> '' as is_valid_record_id,
  date '2024-01-31' as ingest_date
from {o.source(name)}""")


def _record_ids() -> str:
    o = Oracle()
    return o.sql(
        " union all ".join(
            f"select '{n}' as dataset, {_record(n)[0]} as record_id, '{_record(n)[1]}'"
            f" as record_id_source from {o.source(n)}"
            for n in DATASETS
        )
    )


def _damaged(o: Oracle) -> str:
    return o.cte(
        "damaged",
        f"""
  select 'events' as dataset,
    case when event_type <> 'error' then cast(event_id as varchar) end as record_id
  from {o.source('events')} union all
  select 'order_items', case when quantity > 0
    then cast(order_id as varchar) || '_' || cast(product_id as varchar) else '' end
  from {o.source('order_items')}""",
    )


def _quality_flags() -> str:
    o = Oracle()
    table = _damaged(o)
    return o.sql(f"""
select dataset, case when record_id is null then 'NULL RECORD ID'
    when record_id = '' then 'EMPTY RECORD ID' end as error,
  coalesce(record_id, '') <> '' as is_valid_record_id, count(*) as records
from {table} group by all""")


def _valid_only() -> str:
    o = Oracle()
    return o.sql(f"select dataset, record_id from {_damaged(o)} where record_id <> ''")


def _unreadable() -> str:
    """Values of the spoilt orders that are no numbers; the CSV reader trims no text but reads '' as NULL."""
    o = Oracle()
    orders = o.source("orders")
    return o.sql(f"""
select order_id, payment_method, 'customer_id' as "column", cast(customer_id as varchar) || '.0' as "value"
from {orders} where order_id % 7 = 0 and customer_id is not null union all
select order_id, payment_method, 'subtotal_usd', 'USD ' || order_id from {orders} where order_id % 11 = 0 union all
select order_id, payment_method, 'discount_pct', 'n/a' from {orders} where order_id % 13 = 0""")


def _partition_replace() -> str:
    o = Oracle()
    return o.sql(f"""
select order_id, subtotal_usd, date '2024-01-15' as ingest_date from {o.source('orders', 1)}
union all
select order_id, subtotal_usd, date '2024-01-31' from {o.source('orders', 2)}""")


def _late_snapshots() -> str:
    """Runs of equal observations, whatever order they came in."""
    o = Oracle()
    stamps = {1: STAMPS[1], 3: "2024-01-20 00:00:00", 2: STAMPS[2]}
    columns = "order_id, payment_method, subtotal_usd, country"
    seen = " union all ".join(
        f"select {columns}, '{stamp}' as seen from {o.silver_batch('orders', d)}" for d, stamp in stamps.items()
    )
    return o.sql(f"""
select {columns}, seen as effective_from,
  lead(seen) over (partition by order_id order by seen) as effective_to,
  lead(seen) over (partition by order_id order by seen) is null as is_current
from (
  select *, row(payment_method, subtotal_usd, country) is distinct from
      lag(row(payment_method, subtotal_usd, country)) over (partition by order_id order by seen)
    or row_number() over (partition by order_id order by seen) = 1 as begins
  from ({seen})
) where begins""")


def _table(build) -> str:
    """All rows of one table, ``build`` naming it."""
    o = Oracle()
    return o.sql(f"select * from {build(o)}")


def _from(final: str, *builds) -> str:
    """A final select over ``{0}``, ``{1}``, … named by ``builds``."""
    o = Oracle()
    names = [build(o) for build in builds]
    return o.sql(final.format(*names))


def _each_silver(final: str) -> str:
    o = Oracle()
    return o.sql(" union all ".join(final.format(name=n, table=o.silver(n)) for n in DATASETS))


def _violations() -> str:
    o = Oracle()
    parts = [
        f"select '{n}' as dataset, '{severity}' as severity,"
        f" unnest(string_split({column}, ',')) as code from {o.silver(n)}"
        for n in DATASETS
        for severity, column in (("error", "validation_errors"), ("warning", "validation_warnings"))
    ]
    union = " union all ".join(parts)
    return o.sql(
        f"select dataset, severity, code, count(*) as violations from ({union}) group by all"
    )


def _distinct_values() -> str:
    o = Oracle()
    table = o.silver("sessions")
    return o.sql(
        " union all ".join(
            f"select distinct '{c}' as dimension, {c} as value from {table} where {c} is not null"
            for c in ("country", "source", "device")
        )
    )


def _preserve() -> str:
    o = Oracle()
    columns = "order_id, customer_id, subtotal_usd"
    held = o.cte(
        "held",
        f"select row_number() over (order by order_id) as order_key, {columns}"
        f" from {o.silver_batch('orders', 1)}",
    )
    sent = o.cte("sent", f"select {columns} from {o.silver_batch('orders', 2)}")
    return o.sql(f"""
select * from {held} where order_id not in (select order_id from {sent})
union all
select h.order_key, s.* from {sent} s join {held} h on s.order_id = h.order_id
union all
select (select max(order_key) from {held}) + row_number() over (order by order_id), s.*
from {sent} s where order_id not in (select order_id from {held})""")


def _latest(delivery: int) -> str:
    o = Oracle()
    dates = " union all ".join(
        f"select processed_date from {o.silver(n, delivery)}" for n in DATASETS
    )
    return o.sql(f"select max(processed_date) as latest_process_date from ({dates})")


def _marks(o: Oracle) -> str:
    first = " union all ".join(
        f"select '{n}' as pipeline_name, max(processed_date) as last_process_date"
        f" from {o.silver(n, 1)}"
        for n in DATASETS
    )
    dates = " union all ".join(f"select processed_date from {o.silver(n, 2)}" for n in DATASETS)
    sent = " union all ".join(
        f"select '{n}' as pipeline_name, max(processed_date) as last_process_date"
        f" from {o.silver_batch(n, 2)}"
        for n in ("orders", "events")
    )
    o.cte("first_marks", first)
    o.cte("sent_marks", f"{sent} union all select 'gold_star_schema', max(processed_date) from ({dates})")
    return o.cte(
        "marks",
        "select * from sent_marks union all select * from first_marks where pipeline_name"
        " not in (select pipeline_name from sent_marks)",
    )


def _pipeline_counts() -> str:
    o = Oracle()
    parts = []

    def count(layer: str, name: str, table: str) -> None:
        parts.append(f"select '{layer}' as layer, '{name}' as table_name, count(*) as row_count from {table}")

    for n in DATASETS:
        both = f"(select 1 from {o.source(n, 1)} union all select 1 from {o.source(n, 2)})"
        count("bronze", n, both)
        count("silver", n, o.silver(n, 2))
    count("gold", "dim_date", o.calendar())
    for n in STATIC:
        count("gold", n, o.static(n, 2))
    for n in ("dim_customer", "dim_product"):
        count("gold", n, o.history(n, 2))
    for n in FACT_KEYS:
        # The funnel is rebuilt from the merged Silver tables.
        rebuilt = n == "fact_customer_funnel"
        count("gold", n, o.fact_rows(n, 2) if rebuilt else o.fact_incremental(n))
    return o.sql(" union all ".join(parts))


def statements() -> dict[str, str]:
    """SQL per query name."""
    q: dict[str, str] = {f"bronze_{n}": _bronze(n) for n in DATASETS}
    q |= {f"silver_{n}": _table(lambda o, n=n: o.silver(n)) for n in DATASETS}
    q["normalize_columns"] = _table(lambda o: o.source("customers"))
    q["bronze_record_id"] = _record_ids()
    q["bronze_quality_flags"] = _quality_flags()
    q["bronze_valid_only"] = _valid_only()
    q["bronze_unreadable"] = _unreadable()
    q["bronze_partition_replace"] = _partition_replace()
    q["silver_valid_orders"] = _from(
        "select * from {0} where validation_errors is null", lambda o: o.silver("orders")
    )
    q["silver_slice_by_date"] = _from(
        f"select * from {{0}} where processed_date = {SINCE}", lambda o: o.silver("orders", 2)
    )
    q["safe_trim"] = _from(
        "select * replace ("
        + ", ".join(_blank(c) for c in ("payment_method", "country", "device", "source"))
        + ") from {0}",
        lambda o: o.source("orders"),
    )
    q["parse_opt_in"] = _from(
        "select customer_id, case lower(trim(marketing_opt_in)) when 'true' then true"
        " when '1' then true when 'yes' then true when 'false' then false when '0' then false"
        " when 'no' then false end as opt_in from {0}",
        lambda o: o.source("customers"),
    )
    q["dedupe_latest"] = _from(
        "select * exclude (place) from (select *, row_number() over (partition by session_id"
        " order by timestamp desc, event_id desc) as place from {0}) where place = 1",
        lambda o: o.source("events"),
    )
    q["rule_violation_counts"] = _violations()
    q["validation_status_counts"] = _each_silver(
        "select '{name}' as dataset, status, count(*) as records from {table} group by status"
    )
    q["events_with_customer"] = _from(
        "select event_id, session_id, customer_id, event_type, timestamp, event_date from {0}",
        lambda o: o.visits(),
    )
    q["merge_upsert_orders"] = _table(lambda o: o.silver("orders", 2))
    q["merge_preserve_surrogate"] = _preserve()
    q["merge_schema_evolution"] = _from(
        """
select coalesce(h.order_id, s.order_id) as order_id, h.country,
  case when s.order_id is not null then s.subtotal_usd else h.subtotal_usd end as subtotal_usd,
  s.device
from {0} h full join {1} s on h.order_id = s.order_id""",
        lambda o: o.silver_batch("orders", 1),
        lambda o: o.silver_batch("orders", 2),
    )
    q["surrogate_keys_dense"] = _from(
        "select row_number() over (order by order_id, product_id) as item_key, * from"
        " (select distinct order_id, product_id from {0})",
        lambda o: o.source("order_items"),
    )
    q["distinct_dimension_values"] = _distinct_values()
    q["static_dim_new_values"] = _from(
        "select distinct device as device_name from {0} where device is not null"
        " and device not in (select device_name from {1})",
        lambda o: o.silver("orders"),
        lambda o: o.static("dim_device"),
    )
    q["attach_dimension_key"] = _from(
        "select order_id, device, device_key from {0} left join {1} on device = device_name",
        lambda o: o.silver("orders"),
        lambda o: o.static("dim_device"),
    )
    q["attribute_hash"] = _from(
        "select customer_id, sha256("
        + " || '||' || ".join(
            f"coalesce(cast({c} as varchar), '__NULL__')" for c in ("name", "email", "country", "age")
        )
        + ") as hash from {0}",
        lambda o: o.silver("customers"),
    )
    q["format_timestamp"] = _from(
        "select event_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') as shown from {0}",
        lambda o: o.silver("events"),
    )
    q["scalar_functions_mix"] = _from(
        f"""
select order_id, trim(payment_method) as trimmed, lower(payment_method) as lowered,
  concat_ws('-', country, payment_method, source) as joined,
  regexp_matches(payment_method, '^ [1-3]-') as urgent_first, sha256(order_time) as digest,
  cast({ISO.format(c='order_time')} as date) as order_date,
  cast(year({ISO.format(c='order_time')}) as int) as order_year,
  cast(quarter({ISO.format(c='order_time')}) as int) as order_quarter,
  cast(month({ISO.format(c='order_time')}) as int) as order_month,
  cast(day({ISO.format(c='order_time')}) as int) as order_day,
  cast(dayofweek({ISO.format(c='order_time')}) + 1 as int) as order_weekday,
  cast(abs({_m('total_usd')} - {_m('subtotal_usd')}) as double) as gap,
  cast(round({_m('subtotal_usd')} * 0.1, 2) as double) as tenth,
  coalesce(payment_method, 'none') as payment, device in ('mobile', 'tablet') as handheld,
  case when discount_pct > 20 then 'high' else 'low' end as discount,
  cast(discount_pct as int) as whole_discount
from {{0}}""",
        lambda o: o.source("orders"),
    )
    q["dim_date"] = _from(
        "select c.*, coalesce(n, 0) as orders from {0} c left join (select order_date,"
        " count(*) as n from {1} group by order_date) on full_date = order_date",
        lambda o: o.calendar(),
        lambda o: o.usable("orders"),
    )
    q |= {n: _table(lambda o, n=n: o.static(n)) for n in STATIC}
    for n in ("dim_customer", "dim_product"):
        q[f"{n}_initial"] = _table(lambda o, n=n: o.history(n))
        q[f"{n}_scd2"] = _table(lambda o, n=n: o.history(n, 2))
    q["scd2_first_load"] = _table(lambda o: o.history("order_history", 1))
    q["scd2_second_run"] = _table(lambda o: o.history("order_history", 2))
    q["scd2_late_snapshots"] = _late_snapshots()
    q["scd2_current"] = _table(lambda o: o.current("order_history", 2))
    attributes = [a.strip() for a in HISTORY["dim_customer"][2].split(",")]
    q["scd2_change_detect"] = _from(
        "select coalesce(s.customer_id, h.customer_id) as customer_id,"
        " case when h.customer_id is null then 'new' when s.customer_id is null then 'vanished'"
        " when " + " and ".join(f"s.{a} is not distinct from h.{a}" for a in attributes)
        + " then 'unchanged' else 'changed' end as change"
        " from {0} s full join {1} h on s.customer_id = h.customer_id",
        lambda o: o.snapshot("dim_customer", 2),
        lambda o: o.current("dim_customer", 1),
    )
    q["order_costs"] = _from(
        "select order_id, cast(order_cost_usd as double) as order_cost_usd from {0}",
        lambda o: o.costs(),
    )
    for n in FACT_KEYS:
        drop = " exclude (product_id)" if n == "fact_order_item" else ""
        q[n] = _from(f"select *{drop} from {{0}}", lambda o, n=n: o.fact(n))
        if n != "fact_customer_funnel":
            q[f"{n}_incremental"] = _from(
                f"select *{drop} from {{0}}", lambda o, n=n: o.fact_incremental(n)
            )
            q[f"{n}_retraction"] = _from(
                f"select *{drop} from {{0}}", lambda o, n=n: o.fact_retraction(n)
            )
    q["event_duration"] = _table(lambda o: o.durations(joined=False))
    q["session_order_map"] = _table(lambda o: o.session_orders())
    q["funnel_first_view"] = _from(
        "select customer_id, product_id, view_date as first_view_date from {0}",
        lambda o: o.milestone("page_view"),
    )
    q["funnel_first_cart"] = _from(
        "select customer_id, product_id, cart_date as first_add_to_cart_date from {0}",
        lambda o: o.milestone("add_to_cart"),
    )
    q["funnel_purchase_dates"] = _from(
        "select customer_id, product_id, buy_date as first_purchase_date from {0}",
        lambda o: o.purchases(),
    )
    q["funnel_base_keys"] = _table(lambda o: o.pairs())
    q["incremental_read_since"] = _from(
        f"select * from {{0}} where processed_date > {SINCE}", lambda o: o.silver("events", 2)
    )
    q["latest_process_date"] = _latest(2)
    q["watermark_upsert"] = _table(_marks)
    q["watermark_read"] = _from(
        "select max(last_process_date) as last_process_date from {0}"
        " where pipeline_name = 'gold_star_schema'",
        _marks,
    )
    q["serve_daily_revenue"] = _from(
        f"""
select full_date, cast(sum({_m('gross_revenue_usd')}) as double) as gross_revenue_usd,
  cast(sum({_m('net_margin_usd')}) as double) as net_margin_usd
from {{0}} f join {{1}} d on f.date_key = d.date_key group by full_date order by full_date""",
        lambda o: o.fact_rows("fact_order"),
        lambda o: o.calendar(),
    )
    q["serve_funnel"] = _from(
        "select first_view_date_key, count(*) as viewed_pairs,"
        " count(first_add_to_cart_date_key) as added_to_cart_pairs,"
        " count(first_purchase_date_key) as purchased_pairs"
        " from {0} group by first_view_date_key order by first_view_date_key",
        lambda o: o.fact_rows("fact_customer_funnel"),
    )
    q["pipeline_row_counts"] = _pipeline_counts()
    return q
