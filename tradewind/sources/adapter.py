"""The driver's TPC-H-like tables seen as raw retail extracts, defects included.

Every extract is a deterministic, row-local projection of one table (the spend
extract adds one aggregation), so the adapter adds no join to any query. The
texts are plain SQL that other engines also read: ``{orders}`` and friends stand
for the input tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

VALID_CODES = tuple(f"NATION_{k}" for k in range(25))
CATEGORY_NAMES = ("Economy", "Large", "Medium", "Promo", "Small", "Standard")


def _currency(key: str) -> str:
    return (f"case {key} % 5 when 0 then 'EUR' when 1 then 'GBP' when 2 then 'SEK' "
            f"when 3 then 'USD' else 'CHF' end")


def _messy_code(nation: str, key: str) -> str:
    code = f"concat('NATION_', cast({nation} as string))"
    return (f"case {key} % 20 when 0 then concat('  ', lower({code}), ' ') when 1 then lower({code}) "
            f"when 2 then concat({code}, '  ') else {code} end")


COUNTRY = f"""
select n_name as country_code, concat('Country ', cast(n_nationkey as string)) as country_name,
       {_currency('n_regionkey')} as currency_code, r_name as region
from {{nation}} join {{region}} on n_regionkey = r_regionkey
"""

_CUSTOMER_COLUMNS = f"""
       concat('C', cast(c_custkey as string)) as customer_id,
       case when c_custkey % 50 = 0 then concat('  ', c_name) else c_name end as first_name,
       concat('L', cast(c_custkey % 97 as string)) as last_name,
       case when c_custkey % 33 = 0 then null
            else concat('c', cast(c_custkey as string), '@example.com') end as email,
       case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
       case when c_custkey % 211 = 7 then 'unknown'
            else cast(cast('1960-01-01' as date) + cast(c_custkey % 9000 as int) as string) end as birth_date,
       cast(cast('1994-01-01' as date) + cast(c_custkey % 365 as int) as string) as signup_date,
       case when c_custkey % 89 = 11 then 'nowhere' else {_messy_code('c_nationkey', 'c_custkey')} end as country_code,
"""
_CUSTOMER_TAIL = """
       c_mktsegment as acquisition_channel,
       case when c_custkey % 2 = 0 then 'True' else 'False' end as marketing_opt_in
from {customer}
"""
CUSTOMERS = f"""
select c_custkey as ingest_seq, {_CUSTOMER_COLUMNS}
       concat('City ', cast(c_custkey % 200 as string)) as city, {_CUSTOMER_TAIL}
union all
select c_custkey + 1000000000 as ingest_seq, {_CUSTOMER_COLUMNS}
       concat('Moved ', cast(c_custkey % 200 as string)) as city, {_CUSTOMER_TAIL}
where c_custkey % 100 = 0
"""

PRODUCTS = """
select concat('P', cast(p_partkey as string)) as product_id, p_name as product_name,
       case when p_partkey % 400 = 3 then 'mystery'
            when p_partkey % 10 = 0 then concat(' ', upper(p_type), ' ')
            when p_partkey % 10 = 1 then lower(p_type)
            when p_partkey % 10 = 2 then concat(p_type, '  ') else p_type end as category,
       p_brand as brand,
       case when p_partkey % 50 = 0 then null
            else cast(round(cast(p_retailprice as decimal(10,2)) * cast(35 + p_partkey % 31 as int) * 0.01, 2)
                      as decimal(10,2)) end as unit_cost_eur,
       cast(p_retailprice as decimal(10,2)) as unit_price_eur,
       cast(cast('1993-01-01' as date) + cast(p_partkey % 700 as int) as string) as launch_date
from {part}
"""

_ISO = "cast(cast(o_orderdate as date) as string)"
_ORDER_TAIL = f"""
       concat('C', cast(o_custkey as string)) as customer_id,
       case when o_orderkey % 12 = 0
            then concat(substr({_ISO}, 9, 2), '/', substr({_ISO}, 6, 2), '/', substr({_ISO}, 1, 4))
            else {_ISO} end as order_date,
       {_messy_code('o_custkey % 25', 'o_orderkey')} as country_code,
       o_orderpriority as channel,
       case when o_orderstatus = 'P' then 'cancelled' else 'completed' end as status,
       case when o_orderkey % 10 = 3 then lower({_currency('o_custkey')})
            else {_currency('o_custkey')} end as currency_code,
       cast(o_totalprice as decimal(12,2)) as gross_amount_local,
       cast(round(cast(o_totalprice as decimal(12,2)) * cast(o_orderkey % 4 as int) * 0.05, 2)
            as decimal(12,2)) as discount_amount_eur,
       cast(case when o_orderkey % 7 = 0 then 4.99 else 0 end as decimal(12,2)) as shipping_fee_eur,
       cast(case when o_orderkey % 300 = 0 then -cast(o_totalprice as decimal(12,2))
                 else cast(o_totalprice as decimal(12,2)) end as decimal(12,2)) as net_amount_eur
"""
_ORDER_ID = "concat('O', cast(o_orderkey as string)) as order_id"
ORDERS = f"""
select o_orderkey as ingest_seq, {_ORDER_ID}, {_ORDER_TAIL} from {{orders}}
union all
select o_orderkey + 1000000000 as ingest_seq, {_ORDER_ID}, {_ORDER_TAIL} from {{orders}}
where o_orderkey % 100 = 0
"""

# Planted incidents: four days almost without orders, two days with five times as many.
_OUTAGE = "cast(o_orderdate as date) between cast('1997-09-15' as date) and cast('1997-09-18' as date)"
_SPIKE = "cast(o_orderdate as date) between cast('1998-05-18' as date) and cast('1998-05-19' as date)"
_COPIES = "\n".join(
    f"""union all
select o_orderkey + {k}000000000000 as ingest_seq,
       concat('O', cast(o_orderkey as string), 'x{k}') as order_id, {_ORDER_TAIL}
from {{orders}} where {_SPIKE}""" for k in range(1, 5))
ORDERS_WITH_INCIDENTS = f"""
select o_orderkey as ingest_seq, {_ORDER_ID}, {_ORDER_TAIL} from {{orders}}
where not ({_OUTAGE}) or o_orderkey % 12 = 0
{_COPIES}
"""
INCIDENTS = (("doubled import", "1998-05-18", "1998-05-19"), ("lost feed", "1997-09-15", "1997-09-18"))

ORDER_ITEMS = """
select concat('O', cast(l_orderkey as string)) as order_id, concat('P', cast(l_partkey as string)) as product_id,
       cast(l_quantity as int) as quantity,
       cast(round(cast(l_extendedprice as decimal(12,2)) * 0.02, 2) as decimal(10,2)) as unit_price_eur,
       cast(l_extendedprice as decimal(12,2)) as line_total_eur
from {lineitem}
union all
select concat('O', cast(l_orderkey as string)) as order_id, concat('P', cast(l_partkey as string)) as product_id,
       cast(l_quantity as int) as quantity,
       cast(round(cast(l_extendedprice as decimal(12,2)) * 0.02, 2) as decimal(10,2)) as unit_price_eur,
       cast(l_extendedprice as decimal(12,2)) as line_total_eur
from {lineitem} where l_orderkey % 150 = 0
"""

PAYMENTS = """
select o_orderkey as ingest_seq, concat('O', cast(o_orderkey as string)) as order_id,
       case when o_orderkey % 10 = 0 then concat(' ', upper(o_orderpriority), ' ')
            else o_orderpriority end as payment_method,
       case when o_orderstatus = 'P' then 'refunded' else 'paid' end as payment_status
from {orders}
union all
select o_orderkey + 1000000000 as ingest_seq, concat('O', cast(o_orderkey as string)) as order_id,
       'retry' as payment_method, 'failed' as payment_status
from {orders} where o_orderkey % 90 = 0
"""

_RETURN_ISO = "cast(cast(o_orderdate as date) + cast(2 + o_orderkey % 20 as int) as string)"


def _returns(prefix: str, step: int) -> str:
    return f"""
select concat('{prefix}', cast(o_orderkey as string)) as return_id,
       concat('O', cast(o_orderkey as string)) as order_id,
       case when o_orderkey % 5 = 0
            then concat(substr({_RETURN_ISO}, 9, 2), '-', substr({_RETURN_ISO}, 6, 2), '-',
                        substr({_RETURN_ISO}, 1, 4))
            else {_RETURN_ISO} end as return_date,
       case when o_orderkey % 25 = 0 then null
            else concat('reason_', cast(o_orderkey % 6 as string)) end as return_reason,
       cast(round(cast(o_totalprice as decimal(12,2)) * cast(40 + o_orderkey % 61 as int) * 0.01, 2)
            as decimal(12,2)) as refund_amount_eur
from {{orders}} where o_orderstatus <> 'P' and o_orderkey % {step} = 0
"""


# A second return on some orders exposes the fan-out of order-level return joins.
RETURNS = f"{_returns('R', 14)} union all {_returns('S', 98)}"

MARKETING_SPEND = """
select cast(cast(l_shipdate as date) as string) as date,
       concat('NATION_', cast(l_suppkey % 25 as string)) as country_code,
       concat(l_linestatus, l_returnflag) as channel,
       cast(round(sum(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))), 2)
            * case when l_suppkey % 25 = 7 and extract(day from cast(l_shipdate as date)) = 1 then -1 else 1 end
            as decimal(18,2)) as spend_eur,
       cast(sum(cast(l_quantity as int)) * 100 as bigint) as impressions,
       cast(sum(cast(l_quantity as int)) as bigint) as clicks,
       cast(count(*) - 1 as bigint) as conversions
from {lineitem}
group by cast(l_shipdate as date), l_suppkey % 25, l_linestatus, l_returnflag
"""


# Days whose day of month is a multiple of seven have no fixing, as weekends do.
BASE_RATES = {"GBP": "0.80", "SEK": "11.00", "USD": "1.05", "CHF": "0.95"}
EXCHANGE_RATES = f"""
select cast(fixing as string) as date, currency_code,
       cast(case currency_code {' '.join(f"when '{c}' then {r}" for c, r in BASE_RATES.items())} end
            + (extract(day from fixing) % 10) / 100.0 as decimal(10,4)) as rate_to_eur
from (select fixing, {{each}} as currency_code
      from (select distinct cast(o_orderdate as date) as fixing from {{orders}}) d) r
where extract(day from fixing) % 7 <> 0
"""
# One row per currency: the only spot where the engines' words for it differ.
EACH_CURRENCY = f"explode(array({', '.join(repr(c) for c in BASE_RATES)}))"

EXTRACT_SQL = {
    "country": COUNTRY,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "payments": PAYMENTS,
    "returns": RETURNS,
    "marketing_spend": MARKETING_SPEND,
    "exchange_rates": EXCHANGE_RATES,
    "incident_orders": ORDERS_WITH_INCIDENTS,
    "documents": "select doc_id, text from {documents}",
}
EXTRACT_INPUTS = {
    "country": ("nation", "region"),
    "customers": ("customer",),
    "products": ("part",),
    "orders": ("orders",),
    "order_items": ("lineitem",),
    "payments": ("orders",),
    "returns": ("orders",),
    "marketing_spend": ("lineitem",),
    "exchange_rates": ("orders",),
    "incident_orders": ("orders",),
    "documents": ("documents",),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def extract_reader(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """A function giving one extract by name; each table is looked up once, and only if a query uses it."""

    @cache
    def table(name: str) -> DataFrame:
        return read_table(spark, sf_dir, name)

    @cache
    def read(name: str) -> DataFrame:
        tables = {t: table(t) for t in EXTRACT_INPUTS[name]}
        return spark.sql(EXTRACT_SQL[name].replace("{each}", EACH_CURRENCY), **tables)

    return read
