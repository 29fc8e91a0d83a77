"""Retail data sets derived from the sample tables.

The sample tables are TPC-H-like; these queries give them the shape of the seven
source data sets, dirty values included. The text is valid in Spark SQL and in
DuckDB, apart from the two expressions of ``Dialect``, so that tests can feed both
engines the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.staging import stage

TABLES = ("nation", "customer", "part", "orders", "lineitem", "events", "documents", "labels")


@dataclass(frozen=True)
class Dialect:
    """How one engine names a table, formats a time and reads ``props.k``."""

    table: Callable[[str], str]
    iso: Callable[[str], str]
    prop_k: str


SPARK = Dialect(
    table=lambda name: "{" + name + "}",
    iso=lambda t: f"date_format({t}, \"yyyy-MM-dd'T'HH:mm:ss\")",
    prop_k="cast(get_json_object(props, '$.k') as int)",
)
DUCKDB = Dialect(
    table=lambda name: name,
    iso=lambda t: f"strftime({t}, '%Y-%m-%dT%H:%M:%S')",
    prop_k="cast(json_extract_string(props, '$.k') as int)",
)


# One session per user and calendar day, whatever period the events span.
_SESSION = "(user_id * 100000000 + year(ts) * 10000 + month(ts) * 100 + day(ts))"


def customers_sql(d: Dialect) -> str:
    return f"""
select c_custkey as customer_id,
  case when c_custkey % 41 = 0 then '  ' else ' ' || c_name || ' ' end as name,
  case when c_custkey % 37 = 0 then null when c_custkey % 29 = 0 then 'bad.address'
    else concat('c', c_custkey, '@example.com') end as email,
  case when c_custkey % 23 = 0 then '' else n_name end as country,
  cast(c_custkey % 160 - 4 as int) as age,
  case when c_custkey % 53 = 0 then 'not-a-date' when c_custkey % 47 = 0 then '2030-01-01'
    else concat('2001-0', 1 + c_custkey % 9, '-15') end as signup_date,
  case c_custkey % 6 when 0 then 'true' when 1 then '0' when 2 then 'YES' when 3 then 'No'
    when 4 then 'maybe' else '' end as marketing_opt_in
from {d.table('customer')} join {d.table('nation')} on c_nationkey = n_nationkey"""


def products_sql(d: Dialect) -> str:
    return f"""
select product_id, category, name, price_usd, cast(cost as double) as cost_usd,
  cast(retail - cost + surplus as double) as margin_usd
from (
  select p_partkey as product_id,
    case when p_partkey % 61 = 0 then '' else ' ' || p_type end as category,
    case when p_partkey % 71 = 0 then null else p_name end as name,
    case when p_partkey % 83 = 0 then -p_retailprice else p_retailprice end as price_usd,
    cast(p_retailprice as decimal(18,2)) as retail,
    round(cast(p_retailprice as decimal(18,2)) * (case when p_partkey % 67 = 0
      then cast(1.20 as decimal(4,2))
      else cast(0.40 as decimal(4,2)) + cast(p_size as decimal(4,0)) * cast(0.01 as decimal(4,2))
      end), 2) as cost,
    case when p_partkey % 43 = 0 then 1 else 0 end as surplus
  from {d.table('part')}
) priced"""


def orders_sql(d: Dialect) -> str:
    return f"""
select 2 * o_orderkey as order_id, o_custkey as customer_id, {d.iso('o_orderdate')} as order_time,
  case when o_orderkey % 19 = 0 then null else concat(' ', o_orderpriority) end as payment_method,
  case when o_orderkey % 199 = 0 then null when o_orderkey % 211 = 0 then cast(150 as double)
    else cast(o_orderkey % 26 as double) end as discount_pct,
  o_totalprice as subtotal_usd,
  cast(round(cast(o_totalprice as decimal(18,2)) * (100 - cast(o_orderkey % 26 as decimal(5,2)))
    * 0.01, 2) + (case when o_orderkey % 31 = 0 then 1 else 0 end) as double) as total_usd,
  case when o_orderkey % 13 = 0 then '' else n_name end as country,
  case when o_orderkey % 17 = 0 then null when o_orderstatus = 'O' then 'mobile'
    when o_orderstatus = 'F' then 'desktop' else 'tablet' end as device,
  case when o_orderkey % 29 = 0 then ' ' else case o_orderkey % 4 when 0 then 'direct'
    when 1 then 'ads' when 2 then 'email' else 'organic' end end as source
from {d.table('orders')} join {d.table('customer')} on o_custkey = c_custkey
  join {d.table('nation')} on c_nationkey = n_nationkey
union all
select 2 * event_id + 1, user_id, {d.iso('ts')}, 'card', cast(0 as double), value, value,
  'Unknown', 'mobile', 'direct'
from {d.table('events')} where event_type = 'purchase'"""


def order_items_sql(d: Dialect) -> str:
    return f"""
select 2 * l_orderkey as order_id, l_partkey as product_id, p_retailprice as unit_price_usd,
  cast(case when l_orderkey % 50 = 0 and l_linenumber = 7 then -l_quantity else l_quantity end
    as int) as quantity,
  cast(cast(p_retailprice as decimal(18,2)) * cast(l_quantity as decimal(9,0))
    + (case when l_orderkey % 37 = 0 then 5 else 0 end) as double) as line_total_usd
from {d.table('lineitem')} join {d.table('part')} on l_partkey = p_partkey
union all
select 2 * event_id + 1, cast(1 + {d.prop_k} as bigint), value, 1, value
from {d.table('events')} where event_type = 'purchase'
union all
select 2 * event_id + 1, cast(1 + ({d.prop_k} + 7) % 100 as bigint), value, 2, value * 2
from {d.table('events')} where event_type = 'purchase'"""


def sessions_sql(d: Dialect) -> str:
    return f"""
select session_id, customer_id, {d.iso('started')} as start_time,
  case session_id % 3 when 0 then 'mobile' when 1 then 'desktop' else '' end as device,
  case session_id % 4 when 0 then 'direct' when 1 then 'ads' when 2 then 'email'
    else 'organic' end as source,
  case when session_id % 13 = 0 then ' ' else nation end as country
from (
  select {_SESSION} as session_id, min(user_id) as customer_id,
    min(ts) as started, min(n_name) as nation
  from {d.table('events')} join {d.table('customer')} on user_id = c_custkey
    join {d.table('nation')} on c_nationkey = n_nationkey
  group by {_SESSION}
) grouped"""


def events_sql(d: Dialect) -> str:
    return f"""
select event_id, {_SESSION} as session_id, {d.iso('ts')} as timestamp,
  case event_type when 'view' then 'page_view' when 'click' then 'add_to_cart'
    when 'signup' then 'checkout' else event_type end as event_type,
  case when event_type in ('view', 'click') and event_id % 89 <> 0
    then cast(1 + {d.prop_k} as double) end as product_id,
  case when event_type = 'click' and event_id % 97 <> 0
    then cast(1 + {d.prop_k} % 5 as double) end as qty,
  case when event_type = 'signup' then cast(1 + {d.prop_k} % 7 as double) end as cart_size,
  case when event_type = 'purchase' and event_id % 101 <> 0 then 'card' end as payment,
  case when event_type = 'purchase' then cast({d.prop_k} % 30 as double) end as discount_pct,
  case when event_type = 'purchase' then value end as amount_usd
from {d.table('events')}"""


def reviews_sql(d: Dialect) -> str:
    return f"""
select d.doc_id as review_id, d.doc_id * 14 as order_id, 1 + d.doc_id as product_id,
  cast(quality * 3 + toxic + d.doc_id % 2 as int) as rating,
  case when d.doc_id % 25 = 0 then '  ' else text end as review_text,
  case when d.doc_id % 33 = 0 then '2024/01/01'
    else concat('2024-01-', lpad(cast(1 + d.doc_id % 28 as string), 2, '0'), 'T08:00:00')
    end as review_time
from {d.table('documents')} d left join {d.table('labels')} l on d.doc_id = l.doc_id"""


SAMPLE_SQL = {
    "customers": customers_sql,
    "products": products_sql,
    "orders": orders_sql,
    "order_items": order_items_sql,
    "sessions": sessions_sql,
    "events": events_sql,
    "reviews": reviews_sql,
}


# Two deliveries of the same data sets, for incremental loads and history. Both
# deliveries together hold every row. Placeholders name the data sets themselves.
FIRST_DELIVERY = {
    "orders": "select * from {orders} where order_time < '2024-01-16'",
    "order_items": """
        select i.* from {order_items} i
        semi join (select order_id from {orders} where order_time < '2024-01-16') o
        on i.order_id = o.order_id""",
    "events": "select * from {events} where timestamp < '2024-01-16'",
    "sessions": "select * from {sessions} where start_time < '2024-01-16'",
    # Reviews with an unreadable time come with the first delivery.
    "reviews": "select * from {reviews} where review_time < '2024-01-16' or review_time like '%/%'",
    # One market has not opened yet.
    "customers": "select * from {customers} where country <> 'NATION_7'",
    "products": "select * from {products}",
}
SECOND_DELIVERY = {
    # New orders, and a correction of all earlier urgent ones.
    "orders": """
        select order_id, customer_id, order_time, payment_method, discount_pct,
          case when order_time < '2024-01-16' then subtotal_usd + 1 else subtotal_usd end
            as subtotal_usd,
          total_usd, country, device, source
        from {orders} where order_time >= '2024-01-16' or payment_method = ' 1-URGENT'""",
    "order_items": """
        select i.* from {order_items} i
        semi join (select order_id from {orders}
          where order_time >= '2024-01-16' or payment_method = ' 1-URGENT') o
        on i.order_id = o.order_id""",
    "events": "select * from {events} where timestamp >= '2024-01-16'",
    "sessions": "select * from {sessions} where start_time >= '2024-01-16'",
    "reviews": "select * from {reviews} where review_time >= '2024-01-16' and review_time not like '%/%'",
    # One market has closed; the customers of another got new addresses.
    "customers": """
        select customer_id, name,
          case when country = 'NATION_11' then concat('n', customer_id, '@example.com')
            else email end as email,
          country, age, signup_date, marketing_opt_in
        from {customers} where country <> 'NATION_3'""",
    # One category has become dearer to buy.
    "products": """
        select product_id, category, name, price_usd,
          case when trim(category) = 'ECONOMY' then cost_usd + 1 else cost_usd end as cost_usd,
          margin_usd
        from {products}""",
}
# Corrections of the first delivery: valid rows become invalid, invalid ones valid, events change sessions.
CORRECTIONS = {
    "orders": """
        select order_id,
          case when order_id % 20 = 2 then 0 when customer_id = 0 then 1 else customer_id end as customer_id,
          order_time, payment_method,
          case when discount_pct = 150 then 0 else discount_pct end as discount_pct,
          subtotal_usd, total_usd, country, device, source
        from {orders}
        where order_time < '2024-01-16' and (order_id % 20 = 2 or customer_id = 0 or discount_pct = 150)""",
    "order_items": """
        select i.order_id, i.product_id, i.unit_price_usd, -i.quantity as quantity, i.line_total_usd
        from {order_items} i
        semi join (select order_id from {orders} where order_time < '2024-01-16') o
        on i.order_id = o.order_id
        where i.product_id % 15 = 4 or i.quantity < 0""",
    "events": """
        select e.event_id,
          case when e.event_id % 23 = 5 then n.session_id else e.session_id end as session_id,
          e.timestamp, case when e.event_id % 29 = 3 then 'error' else e.event_type end as event_type,
          e.product_id, e.qty, e.cart_size,
          case when e.event_type = 'purchase' then coalesce(e.payment, 'card') else e.payment end as payment,
          e.discount_pct, e.amount_usd
        from {events} e join {events} n on n.event_id = e.event_id + 1
        where e.timestamp < '2024-01-16' and n.timestamp < '2024-01-16'
          and (e.event_id % 23 = 5 or e.event_id % 29 = 3 or e.event_id % 101 = 0)""",
    "sessions": """
        select session_id, case when customer_id = 0 then 2 else 0 end as customer_id,
          start_time, device, source, country
        from {sessions} where start_time < '2024-01-16' and (session_id % 17 = 3 or customer_id = 0)""",
    "reviews": """
        select review_id, order_id, product_id, case when review_id % 19 = 4 then 9 else 1 end as rating,
          review_text, review_time
        from {reviews}
        where (review_time < '2024-01-16' or review_time like '%/%') and (review_id % 19 = 4 or rating = 0)""",
}
DELIVERIES = {1: FIRST_DELIVERY, 2: SECOND_DELIVERY, 3: CORRECTIONS}


class Samples:
    """The sample tables of one folder and the data sets derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}
        self._sources: dict[tuple[str, int | None], DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def keep(self, name: str) -> None:
        """Write a data set, which several deliveries and data sets are taken from, instead of deriving it each time."""
        self._sources[name, None] = stage(self.source(name), f"source-{name}")

    def source(self, name: str, delivery: int | None = None) -> DataFrame:
        """One data set: all of it, or what one of the deliveries holds."""
        if (name, delivery) not in self._sources:
            if delivery is None:
                text = SAMPLE_SQL[name](SPARK)
                frames = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
            else:
                text = DELIVERIES[delivery][name]
                frames = {n: self.source(n) for n in SAMPLE_SQL if "{" + n + "}" in text}
            self._sources[name, delivery] = self.spark.sql(text, **frames)
        return self._sources[name, delivery]
