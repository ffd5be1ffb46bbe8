"""The SQL each query's result must equal, for an engine that shares none of the Spark code."""

from __future__ import annotations

from oracle.ctes import CODES, SPACE, _mixed, with_ctes

MONEY_O = ("cast(gross_amount_eur as double) as gross_amount_eur, "
           "cast(discount_amount_eur as double) as discount_amount_eur, "
           "cast(shipping_fee_eur as double) as shipping_fee_eur, cast(net_amount_eur as double) as net_amount_eur")
RAW_PRODUCT = ("product_id, product_name, {c} as category, brand, cast(unit_cost_eur as double) as unit_cost_eur, "
               "cast(unit_price_eur as double) as unit_price_eur, launch_date")
ITEM = ("order_id, product_id, cast(quantity as bigint) as quantity, cast(unit_price_eur as double) as unit_price_eur, "
        "cast(line_total_eur as double) as line_total_eur")
RETURN = ("return_id, order_id, return_date, return_reason, "
          "cast(refund_amount_eur as double) as refund_amount_eur")
SPEND = "date, country_code, channel, cast(spend_eur as double) as spend_eur, impressions, clicks, conversions"
RATE = "date, currency_code, cast(rate_to_eur as double) as rate_to_eur"
STAGED_ORDER = (f"order_id, customer_id, order_date, country_code, channel, status, currency_code, {MONEY_O}, "
                "data_quality_flag")

CLEAN = {
    "customers": "select * from c_customers",
    "products": f"select {RAW_PRODUCT.format(c='category')} from c_products",
    "orders": f"select {STAGED_ORDER} from c_orders",
    "order_items": f"select {ITEM} from c_items",
    "payments": "select * from c_payments",
    "returns": f"select {RETURN} from c_returns",
    "marketing_spend": f"select {SPEND} from c_spend",
    "exchange_rates": f"select {RATE} from c_rates",
}
CLEAN_KEYS = {"customers": "customers", "products": "products", "orders": "orders", "items": "order_items",
              "payments": "payments", "returns": "returns", "spend": "marketing_spend", "fx": "exchange_rates"}
CTE_OF = {"customers": "c_customers", "products": "c_products", "orders": "c_orders", "order_items": "c_items",
          "payments": "c_payments", "returns": "c_returns", "marketing_spend": "c_spend",
          "exchange_rates": "c_rates"}
EXPORT_OF = {
    "dim_customer": "d_customer", "dim_product": "d_product", "dim_country": "r_country", "dim_date": "d_date",
    "fct_orders": "f_orders", "fct_order_items": "f_items", "fct_returns": "f_returns",
    "fct_marketing_spend": "f_spend", "monthly_revenue_kpis": "m_kpis", "customer_ltv": "m_ltv",
    "cohort_retention": "m_cohort", "product_performance": "m_products", "marketing_roi": "m_roi",
    "returns_analysis": "m_returns",
}


def _count_all(tables: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{n}' as table_name, count(*) as row_count from {c}" for n, c in tables.items())


FIRST_CUSTOMERS = ("(select * from r_customers qualify row_number() over "
                   "(partition by customer_id order by ingest_seq) = 1) t")
FIRST_ORDERS = "(select * from r_orders qualify row_number() over (partition by order_id order by ingest_seq) = 1) t"


def _dq() -> str:
    rules = [
        ("customers", "duplicates_dropped", "(select count(*) from r_customers) - count(*)", FIRST_CUSTOMERS),
        ("customers", "unknown_country",
         f"count_if(coalesce(upper(regexp_replace(country_code, {SPACE})) not in ({CODES}), true))", FIRST_CUSTOMERS),
        ("customers", "missing_email", "count_if(email is null)", FIRST_CUSTOMERS),
        ("products", "cost_imputed", "count_if(unit_cost_eur is null)", "r_products"),
        ("orders", "duplicates_dropped", "(select count(*) from r_orders) - count(*)", FIRST_ORDERS),
        ("orders", "slash_dates", "count_if(contains(order_date, '/'))", FIRST_ORDERS),
        ("orders", "sign_corrected", "count_if(net_amount_eur < 0)", FIRST_ORDERS),
        ("order_items", "duplicates_dropped", "(select count(*) from r_order_items) - count(*)", "c_items"),
        ("returns", "dashed_dates",
         "count_if(contains(return_date, '-') and not regexp_matches(return_date, '^[0-9]{4}-'))", "r_returns"),
        ("returns", "reason_filled", "count_if(return_reason is null)", "r_returns"),
        ("marketing_spend", "spend_clipped", "count_if(spend_eur < 0)", "r_marketing_spend"),
        ("exchange_rates", "base_rows_added", "count_if(currency_code = 'EUR')", "c_rates"),
    ] + [(n, "rows_written", "count(*)", c) for n, c in CTE_OF.items()]
    return " union all ".join(
        f"select '{t}' as table_name, '{r}' as rule, cast({e} as bigint) as rows_affected, "
        f"cast({e} as double) / nullif(count(*), 0) as share from {s}" for t, r, e, s in rules)


DQ_TEXT = """
select table_name, label || ': ' || format('{:,}', rows_affected) || format(' ({:.1f}%)', share * 100) as message,
       cast(rows_affected as varchar) as number
from dq_rows join (values ('duplicates_dropped', 'repeated rows left out'), ('missing_email', 'no email given'),
  ('cost_imputed', 'unit cost estimated'), ('slash_dates', 'date written with slashes'), ('sign_corrected', 'amount below zero'),
  ('reason_filled', 'no reason given')) as names(rule, label) using (rule)
where rows_affected > 0
"""


def _tests(kind: str) -> str:
    keys = [("stg_customers", "c_customers", "customer_id"), ("stg_products", "c_products", "product_id"),
            ("stg_orders", "c_orders", "order_id"), ("dim_country", "r_country", "country_code"),
            ("dim_customer", "d_customer", "customer_id"), ("dim_product", "d_product", "product_id"),
            ("dim_date", "d_date", "date_day"), ("fct_orders", "f_orders", "order_id"),
            ("fct_returns", "f_returns", "return_id")]
    links = [("dim_customer", "d_customer", "country_code", "r_country", "country_code"),
             ("fct_orders", "f_orders", "customer_id", "d_customer", "customer_id"),
             ("fct_returns", "f_returns", "order_id", "f_orders", "order_id"),
             ("fct_marketing_spend", "f_spend", "country_code", "r_country", "country_code")]

    def row(test, table, column, value, source):
        return (f"select '{test}' as test_name, '{table}' as table_name, '{column}' as column_name, "
                f"cast({value} as bigint) as failures from {source}")

    made = {
        "unique": [row("unique", t, k, "count(*)", f"(select {k} from {s} where {k} is not null group by {k} "
                                                   f"having count(*) > 1) u") for t, s, k in keys],
        "not_null": [row("not_null", t, k, f"count_if({k} is null)", s) for t, s, k in keys],
        "relationships": [row("relationships", t, c, "count(*)",
                              f"{s} x where x.{c} is not null and not exists "
                              f"(select 1 from {p} y where y.{k} = x.{c})") for t, s, c, p, k in links],
        "accepted_values": [row("accepted_values", "fct_orders", "status",
                                "count_if(status not in ('completed', 'cancelled'))", "f_orders")],
        "integrity": [
            row("no_duplicates", "fct_orders", "order_id", "count(*) - count(distinct order_id)", "f_orders"),
            row("not_negative", "fct_orders", "net_amount_eur", "count_if(net_amount_eur < 0)", "f_orders"),
            row("no_orphans", "fct_orders", "customer_id", "count_if(c.customer_id is null)",
                "f_orders o left join d_customer c on o.customer_id = c.customer_id")],
    }
    return " union all ".join(x for name, xs in made.items() if kind in (name, "all") for x in xs)


def _score(key: str, flags: str) -> str:
    """Scores per ``key`` from SQL text ``flags`` giving (key, date, flagged)."""
    return f"""
select {key}, cast(flagged as bigint) as flagged, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
       cast(fn as bigint) as fn, precision, recall,
       coalesce(precision * recall * 2 / nullif(precision + recall, 0), 0) as f1, incidents_caught
from (select *, coalesce(cast(tp as double) / nullif(flagged, 0), 0) as precision,
             coalesce(cast(tp as double) / nullif(tp + fn, 0), 0) as recall
      from (select f.{key}, count_if(f.flagged) as flagged, count_if(f.flagged and t.date is not null) as tp,
                   count_if(f.flagged and t.date is null) as fp,
                   (select count(distinct date) from truth) - count_if(f.flagged and t.date is not null) as fn,
                   'doubled import: ' || case when bool_or(f.flagged and coalesce(t.incident, '') = 'doubled import')
                                               then 'yes' else 'no' end ||
                   ', lost feed: ' || case when bool_or(f.flagged and coalesce(t.incident, '') = 'lost feed')
                                               then 'yes' else 'no' end as incidents_caught
            from ({flags}) f left join truth t on f.date = t.date group by f.{key}) a) b"""


def _prior(months: int, prior: str, change: str, period: str = "month") -> str:
    return f"""
select n.country_code, n.{period}, n.net_revenue_eur, p.net_revenue_eur as {prior},
       round((n.net_revenue_eur - p.net_revenue_eur) / nullif(p.net_revenue_eur, 0), 6) as {change}
from x_periods n left join x_periods p
  on n.country_code = p.country_code and n.{period} = cast(p.{period} + interval {months} month as date)"""


def _periods(period: str) -> str:
    return f"""x_periods as (
select country_code, cast(date_trunc('{period}', order_date) as date) as {period},
       cast(sum(net_amount_eur) as double) as net_revenue_eur from c_orders group by 1, 2)"""

SQL: dict[str, str] = {
    "scan_csv_roundtrip": f"select {RAW_PRODUCT.format(c='category')} from r_products",
    "scan_csv_reordered": f"select {RAW_PRODUCT.format(c='category')} from r_products",
    "load_counts": _count_all(CTE_OF),
    "export_counts": _count_all(EXPORT_OF),
    "fx_flatten": """select date, currency_code, cast(rate_to_eur as double) as rate_to_eur
                     from r_exchange_rates where currency_code in ('GBP', 'SEK')""",
    "dq_report": _dq(),
    "dedupe_customers": f"select customer_id, ingest_seq, city from {FIRST_CUSTOMERS}",
    "dedupe_orders": f"select order_id, ingest_seq from {FIRST_ORDERS}",
    "dedupe_payments": "select * from c_payments",
    "dedupe_items": f"select distinct {ITEM} from r_order_items",
    "normalize_country": f"select ingest_seq, upper(regexp_replace(country_code, {SPACE})) as country_code from r_orders",
    "country_domain_check": f"""
select case when upper(regexp_replace(country_code, {SPACE})) in ({CODES})
            then upper(regexp_replace(country_code, {SPACE})) else 'UNK' end as country_code, count(*) as customers
from r_customers group by 1""",
    "canonical_category": "select product_id, category from c_products_named",
    "parse_mixed_date": f"""
select ingest_seq, {_mixed('order_date')} as order_date from r_orders
union all select cast(substr(return_id, 2) as bigint), {_mixed('return_date')} from r_returns""",
    "nonstandard_date_counts": """
select 'orders' as table_name, count(*) as nonstandard_rows from r_orders where contains(order_date, '/')
union all select 'returns', count(*) from r_returns
where contains(return_date, '-') and not regexp_matches(return_date, '^[0-9]{4}-')""",
    "null_audit": """
select 'customers' as table_name, 'email' as column_name, cast(count_if(email is null) as bigint) as null_rows,
       cast(count_if(email is null) as double) / nullif(count(*), 0) as null_share from r_customers
union all select 'customers', 'birth_date', cast(count_if(birth_date is null) as bigint),
       cast(count_if(birth_date is null) as double) / nullif(count(*), 0) from r_customers
union all select 'returns', 'return_reason', cast(count_if(return_reason is null) as bigint),
       cast(count_if(return_reason is null) as double) / nullif(count(*), 0) from r_returns""",
    "impute_cost": """
select c.product_id, c.category, cast(c.unit_price_eur as double) as unit_price_eur,
       cast(c.unit_cost_eur as double) as unit_cost_eur
from c_products c join r_products r on c.product_id = r.product_id where r.unit_cost_eur is null""",
    "fix_negative_amounts": """
select order_id, cast(abs(net_amount_eur) as double) as net_amount_eur,
       cast(abs(gross_amount_local) as double) as gross_amount_eur,
       'corrected_negative_amount' as data_quality_flag from """ + FIRST_ORDERS + " where net_amount_eur < 0",
    "fill_return_reason": 'select coalesce(return_reason, \'unspecified\') as return_reason, count(*) as "rows" '
                          "from r_returns group by 1",
    "clip_spend": """select cast(date as date) as date, country_code, channel,
                     cast(greatest(spend_eur, 0) as double) as spend_eur from r_marketing_spend where spend_eur <= 0""",
    "fx_add_base": """
select date, currency_code, cast(rate_to_eur as double) as rate_to_eur from r_exchange_rates
union all select distinct date, 'EUR', 1.0::double from r_exchange_rates""",
    "fx_fill_calendar": """
select s.date, s.currency_code, cast(coalesce(
         last_value(r.rate_to_eur ignore nulls) over (partition by s.currency_code order by s.date
           rows between unbounded preceding and current row),
         first_value(r.rate_to_eur ignore nulls) over (partition by s.currency_code order by s.date
           rows between current row and unbounded following)) as double) as rate_to_eur
from (select k.currency_code, cast(unnest(generate_series(b.lo - 3, b.hi + 3, interval 1 day)) as date) as date
      from (select distinct currency_code from r_exchange_rates) k,
           (select min(cast(date as date)) as lo, max(cast(date as date)) as hi from r_exchange_rates) b) s
left join r_exchange_rates r on s.date = cast(r.date as date) and s.currency_code = r.currency_code""",
    "typed_completed_orders": f"select {STAGED_ORDER} from c_orders where status = 'completed'",
    "dim_country": "select * from r_country",
    "dim_customer": "select * from d_customer",
    "dim_product": """select product_id, product_name, category, brand, cast(unit_cost_eur as double) as unit_cost_eur,
                      cast(unit_price_eur as double) as unit_price_eur,
                      cast(unit_margin_eur as double) as unit_margin_eur, unit_margin_pct, launch_date
                      from d_product""",
    "dim_date": "select * from d_date",
    "fct_orders": f"""select order_id, customer_id, order_date, country_code, channel, status, currency_code,
                      cast(fx_rate_to_eur as double) as fx_rate_to_eur, {MONEY_O},
                      cast(net_amount_local_currency as double) as net_amount_local_currency, payment_method,
                      order_item_count, data_quality_flag from f_orders""",
    "fct_order_items": f"""select {ITEM}, cast(line_cost_eur as double) as line_cost_eur,
                           cast(line_margin_eur as double) as line_margin_eur from f_items""",
    "fct_returns": f"select {RETURN}, order_date, days_to_return from f_returns",
    "fct_marketing_spend": f"select {SPEND}, ctr, click_to_conversion_rate, cost_per_conversion_eur from f_spend",
    "monthly_revenue_kpis": "select * from m_kpis",
    "customer_ltv": "select * from m_ltv",
    "cohort_retention": "select * from m_cohort",
    "product_performance": "select * from m_products",
    "product_performance_nofanout": """
select p.product_id, p.product_name, p.category, p.brand, count(distinct i.order_id) as orders_count,
       cast(sum(i.quantity) as bigint) as units_sold, cast(sum(i.line_total_eur) as double) as gross_revenue_eur,
       cast(sum(i.line_margin_eur) as double) as gross_margin_eur,
       round(cast(sum(i.line_margin_eur) as double) / nullif(cast(sum(i.line_total_eur) as double), 0) * 100, 2)
         as margin_pct,
       coalesce(any_value(b.n), 0) as returns_count,
       round(cast(coalesce(any_value(b.n), 0) as double) / nullif(count(distinct i.order_id), 0) * 100, 2)
         as return_rate_pct
from d_product p left join f_items i on p.product_id = i.product_id
left join (select i.product_id, count(distinct r.return_id) as n
           from f_items i join f_returns r on i.order_id = r.order_id group by 1) b on p.product_id = b.product_id
group by 1, 2, 3, 4""",
    "marketing_roi": "select * from m_roi",
    "returns_analysis": "select * from m_returns",
    "daily_revenue": "select * from m_daily",
    "revenue_by_country": """select country_code, cast(sum(cast(net_revenue_eur as decimal(38,2))) as double)
                             as net_revenue_eur from m_kpis group by 1""",
    "top_countries": "select * from t_country",
    "latest_month_snapshot": "select * from m_kpis where month = (select max(month) from m_kpis)",
    "top_return_reasons": "select * from t_reason",
    "top_products": "select * from t_product",
    "monthly_total": """select month, cast(sum(cast(net_revenue_eur as decimal(38,2))) as double) as net_revenue_eur
                        from m_kpis group by 1""",
    "channel_cpc": """
select channel, cast(sum(cast(spend_eur as decimal(38,2))) as double) as spend_eur,
       cast(sum(conversions) as bigint) as conversions,
       cast(sum(cast(spend_eur as decimal(38,2))) as double) / nullif(cast(sum(conversions) as double), 0)
         as cost_per_conversion_eur
from m_roi group by channel""",
    "returns_by_reason": """
select return_reason, cast(sum(returns_count) as bigint) as returns_count,
       cast(sum(cast(total_refund_eur as decimal(38,2))) as double) as total_refund_eur
from m_returns group by 1""",
    "headline_kpis": """
select (select cast(sum(net_amount_eur) as double) from done) as net_revenue_eur,
       (select count(*) from done) as completed_orders, count(distinct country_code) as markets,
       count(*) as customers from m_ltv""",
    "weekday_anomalies": """
select date, net_revenue_eur, orders_count, dow, round(seasonal_baseline, 4) as seasonal_baseline,
       round(residual, 4) as residual, round(seasonal_zscore, 4) as seasonal_zscore, iqr_anomaly, zscore_anomaly, is_anomaly, direction
from m_weekday""",
    "iqr_outliers": """
select date, net_revenue_eur, orders_count, round(q1, 4) as q1, round(q3, 4) as q3, true as iqr_anomaly
from m_dense, (select quantile_cont(net_revenue_eur, 0.25) as q1, quantile_cont(net_revenue_eur, 0.75) as q3
               from m_dense) e
where not (net_revenue_eur between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))""",
    "top_anomalies": """select date, net_revenue_eur, round(seasonal_zscore, 4) as seasonal_zscore, direction
                        from t_anomaly""",
    "anomaly_feed": """
select date_diff('day', (select min(date) from m_weekday), date) as idx, date, net_revenue_eur as value,
       round(seasonal_zscore, 4) as z, case when seasonal_zscore < 0 then 'drop' else 'spike' end as direction
from m_weekday where is_anomaly""",
    "rfm_scores": "select * from m_scores",
    "rfm_segments": "select customer_id, rfm_score, segment from m_segments",
    "rfm_summary": "select * from m_rfm_summary",
    "rfm_caption": """
select string_agg(segment || ' ' || format('{:,}', customers), ' · ' order by total_revenue_eur desc, segment)
       || ' customers' as caption from m_rfm_summary""",
    "roas_zscores": "select * replace (round(z_roas, 6) as z_roas) from m_roas_z",
    "low_roas_scan": "select * replace (round(z_roas, 6) as z_roas) from m_low_roas",
    "worst_marketing": "select * replace (round(z_roas, 6) as z_roas) from t_worst",
    "detector_scores": _score("detector", "select 'weekday baseline' as detector, date, is_anomaly as flagged "
                                          "from i_weekday"),
    "threshold_sweep": _score("threshold", """
select cast(t as double) as threshold, date, coalesce(abs(seasonal_zscore) > t, false) as flagged
from i_weekday, (select unnest([3.0::double, 3.5, 4.0, 4.5, 5.0]) as t) s"""),
    "evidence": "select * from evidence",
    "extract_claims": "select doc_id, claim_no, token, value, cast(decimals as bigint) as decimals from doc_claims",
    "evidence_numbers": "select * from pool",
    "grounded_claims": """select doc_id, claim_no, token, value, cast(decimals as bigint) as decimals, grounded
                          from doc_judged""",
    "grounded_claims_large_pool": """
select doc_id, claim_no, token, value, cast(decimals as bigint) as decimals, abs(value) in (2.5, 1.5) or exists (
         select 1 from (select distinct abs(cast(unit_price_eur as double)) as e from r_products
                        union select distinct abs(cast(net_amount_eur as double)) from r_orders) n
         where abs(abs(c.value) - n.e) <= 0.5 * pow(10.0, -c.decimals) + 1e-9) as grounded
from doc_claims c""",
    "groundedness_score": "select * from doc_scored",
    "red_team_rate": "select * from doc_dated",
    "report_lines": "select cast(section_no as bigint) as section_no, cast(line_no as bigint) as line_no, line from lines",
    "report_groundedness": "select * from rep_scored",
    "red_team_report": "select * from rep_team",
    "red_team_report_with_dates": "select * from rep_dated",
    "groundedness_lines": """
select report_id, cast(unnest(range(5)) as bigint) as line_no, unnest([
  '# ' || report_id,
  'claims read: ' || numbers_checked,
  'claims backed: ' || grounded || format(' ({:.1f}%)', groundedness_rate * 100),
  'not backed: ' || case when ungrounded = '' then 'none' else replace(ungrounded, ' ', ', ') end,
  'altered figures noticed: ' || caught || ' of ' || trials || format(' ({:.1f}%)', detection_rate * 100)]) as line
from all_scored join all_dated using (report_id)""",
    "eval_headline_extract": """
select numbers_checked as checked, grounded, caught, trials from rep_scored join rep_dated using (report_id)""",
    "measures_orders": """
select country_code, channel, cast(sum(net_amount_eur) as double) as net_revenue_eur,
       count(distinct order_id) as orders,
       cast(sum(net_amount_eur) as double) / nullif(count(distinct order_id), 0) as avg_order_value_eur
from c_orders group by 1, 2""",
    "cancel_rate": """
select country_code, count(distinct case when status = 'cancelled' then order_id end) as cancelled_orders,
       count(distinct order_id) as orders,
       cast(count(distinct case when status = 'cancelled' then order_id end) as double)
         / nullif(count(distinct order_id), 0) as cancelled_order_rate
from c_orders group by 1""",
    "measures_customers": """
select coalesce(a.country_code, v.country_code) as country_code, a.active_customers, v.customers, v.purchasers,
       v.mean_ltv_eur, v.repeat_purchase_rate, v.churn_rate
from (select country_code, count(distinct customer_id) as active_customers from c_orders group by 1) a
full join (
  select country_code, count(*) as customers, cast(count_if(total_orders > 0) as bigint) as purchasers,
         cast(sum(cast(total_net_revenue_eur as decimal(38,2))) as double) / count(*) as mean_ltv_eur,
         cast(count_if(total_orders > 1) as double) / nullif(count_if(total_orders > 0), 0) as repeat_purchase_rate,
         cast(count_if(lifecycle_stage = 'churned') as double) / nullif(count_if(total_orders > 0), 0) as churn_rate
  from m_ltv group by 1) v on a.country_code is not distinct from v.country_code""",
    "new_customers": """
select cast(date_trunc('month', signup_date) as date) as month, count(distinct customer_id) as new_customers
from c_customers where signup_date is not null group by 1""",
    "measures_products": """
select p.category, cast(sum(line_margin_eur) as double) as gross_margin_eur,
       cast(sum(line_margin_eur) as double) / nullif(cast(sum(line_total_eur) as double), 0) as gross_margin_share
from f_items i left join d_product p on i.product_id = p.product_id group by 1""",
    "measures_returns": """
select coalesce(s.month, b.month) as month, s.orders, coalesce(b.returned_orders, 0) as returned_orders,
       b.total_refunded_eur, cast(coalesce(b.returned_orders, 0) as double) / nullif(s.orders, 0) as return_rate
from (select cast(date_trunc('month', order_date) as date) as month, count(distinct order_id) as orders
      from c_orders group by 1) s
full join (select cast(date_trunc('month', return_date) as date) as month,
                  count(distinct order_id) as returned_orders,
                  cast(sum(refund_amount_eur) as double) as total_refunded_eur
           from c_returns group by 1) b on s.month is not distinct from b.month""",
    "measures_marketing": """
select coalesce(s.country_code, r.country_code) as country_code, coalesce(s.month, r.month) as month,
       s.spend as marketing_spend_eur, r.net_revenue_eur, r.net_revenue_eur / nullif(s.spend, 0) as blended_roas,
       s.spend / nullif(s.c, 0) as cost_per_conversion_eur, s.k / nullif(s.i, 0) as click_through_rate
from (select country_code, cast(date_trunc('month', date) as date) as month, cast(sum(spend_eur) as double) as spend,
             cast(sum(impressions) as double) as i, cast(sum(clicks) as double) as k,
             cast(sum(conversions) as double) as c from c_spend group by 1, 2) s
full join (select country_code, cast(date_trunc('month', order_date) as date) as month,
                  cast(sum(net_amount_eur) as double) as net_revenue_eur from c_orders group by 1, 2) r
  on s.country_code is not distinct from r.country_code and s.month is not distinct from r.month""",
    "measures_returns_quarterly": """
select k.quarter, q.orders, coalesce(b.returned_orders, 0) as returned_orders, b.total_refunded_eur,
       cast(coalesce(b.returned_orders, 0) as double) / nullif(q.orders, 0) as return_rate
from (select distinct cast(date_trunc('quarter', d) as date) as quarter from (
        select order_date as d from c_orders union all select return_date from c_returns) u) k
left join (select cast(date_trunc('quarter', order_date) as date) as quarter, count(*) as orders
           from c_orders group by 1) q on q.quarter is not distinct from k.quarter
left join (select cast(date_trunc('quarter', return_date) as date) as quarter, count(distinct order_id) as returned_orders,
                  cast(sum(refund_amount_eur) as double) as total_refunded_eur
           from c_returns group by 1) b on b.quarter is not distinct from k.quarter""",
    "measures_returns_total": """
select (select count(*) from c_orders) as orders, count(distinct order_id) as returned_orders,
       cast(sum(refund_amount_eur) as double) as total_refunded_eur,
       cast(count(distinct order_id) as double) / (select count(*) from c_orders) as return_rate
from c_returns""",
    "measures_marketing_yearly": """
select coalesce(s.year, r.year) as year, s.spend as marketing_spend_eur, r.net_revenue_eur,
       r.net_revenue_eur / nullif(s.spend, 0) as blended_roas, s.spend / nullif(s.c, 0) as cost_per_conversion_eur,
       s.k / nullif(s.i, 0) as click_through_rate
from (select cast(date_trunc('year', date) as date) as year, cast(sum(spend_eur) as double) as spend,
             cast(sum(impressions) as double) as i, cast(sum(clicks) as double) as k,
             cast(sum(conversions) as double) as c from c_spend group by 1) s
full join (select cast(date_trunc('year', order_date) as date) as year, cast(sum(net_amount_eur) as double) as net_revenue_eur
           from c_orders group by 1) r on s.year is not distinct from r.year""",
    "cancel_rate_filtered": """
select channel, count_if(status = 'cancelled') as cancelled_orders, count(*) as orders,
       count_if(status = 'cancelled') / cast(count(*) as double) as cancelled_order_rate
from c_orders where country_code in ('NATION_1', 'NATION_2', 'NATION_3') group by 1""",
    "scan_csv_quarantine": """
select '' as column_name, 'kept' as reason, count(*) as records, cast(sum(net_amount_eur) as double) as net_amount_eur
from r_orders where ingest_seq % 50 <> 0
union all
select 'net_amount_eur', 'does not fit its type', count(*), null from r_orders where ingest_seq % 50 = 0""",
    "scan_csv_rejects": """
select 'orders' as table_name, c as column_name, (select count(*) from r_orders) as rows_read,
       case c when 'net_amount_eur' then (select count(*) from r_orders where ingest_seq % 50 = 0) else 0 end as rejected
from (select unnest(['gross_amount_local', 'discount_amount_eur', 'shipping_fee_eur', 'net_amount_eur']) as c) t""",
    "anomaly_overlay": """
select d.date_day, a.net_revenue_eur as anomaly_revenue_eur
from d_date d left join (select * from m_weekday where is_anomaly) a on d.date_day = a.date""",
    "test_unique": _tests("unique"),
    "test_not_null": _tests("not_null"),
    "test_relationships": _tests("relationships"),
    "test_accepted_values": _tests("accepted_values"),
    "test_integrity": _tests("integrity"),
    "data_test_report": _tests("all"),
}
SQL |= {f"clean_{k}": CLEAN[t] for k, t in CLEAN_KEYS.items()}
SQL |= {f"stg_{t}": sql for t, sql in CLEAN.items()}
SQL["stg_exchange_rates"] = f"select {RATE} from s_rates"

ORACLE = {name: with_ctes(sql) for name, sql in SQL.items()}
_YEARLY = {"revenue_yoy": ("month", 12, "net_revenue_ly_eur", "revenue_yoy"),
           "revenue_yoy_quarterly": ("quarter", 12, "net_revenue_ly_eur", "revenue_yoy"),
           "revenue_yoy_yearly": ("year", 12, "net_revenue_ly_eur", "revenue_yoy"),
           "revenue_mom_calendar": ("month", 1, "net_revenue_pm_eur", "revenue_mom")}


def _splice(block: str, sql: str, uses: str) -> str:
    """Put one more named block after the ones ``uses`` needs."""
    head = with_ctes(f"select * from ({uses}) z")
    return head[:head.rindex("\nselect * from (")] + ",\n" + block + "\n" + sql


for _name, (_period, _months, _then, _change) in _YEARLY.items():
    ORACLE[_name] = _splice(_periods(_period), _prior(_months, _then, _change, _period), "select 1 from c_orders")
ORACLE["dq_feed"] = _splice(f"dq_rows as ({_dq()})", DQ_TEXT, _dq())
