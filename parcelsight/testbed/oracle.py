"""DuckDB SQL that answers every registered query on its own.

``round(x, 0) + 0`` turns a negative zero into zero. Each answer is prefixed with the derived raw tables it needs (RAW), the clean
tables built on them (CLEAN), and nothing of the Spark code.
"""

from __future__ import annotations

import re

RAW = {
    "raw_orders": """
with t as (select o_orderkey as k, o_custkey, o_orderstatus, o_orderdate as p, r_name='AMERICA' and o_orderdate >= '1997-10-01' and o_orderdate < '1998-04-01' as episode, i.k2 is not null as shipped, o_orderkey*7%30 as x, 24 + o_orderkey*13%240 as ch from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey left join (select distinct l_orderkey as k2 from lineitem) i on i.k2=o_orderkey),
  u as (select *, case when x=0 then 20 when x=1 then 10 when x=2 then 2 when episode and x<12 then 5 else -x end as late_days from t),
  v as (select *, ch + case when k%61=0 then -72 when late_days>0 then 288 + k*11%600 else 48 + k*11%600 end as dh from u)
  select k as order_id, o_custkey as customer_id, case when o_orderstatus='P' then 'shipped' else 'delivered' end as order_status, p as order_purchase_timestamp,
  case when k%97<>0 then p + interval '1' hour * cast(k%72 as int) end as order_approved_at,
  case when shipped then p + interval '1' hour * cast(ch as int) end as order_delivered_carrier_date,
  case when shipped then p + interval '1' hour * cast(dh as int) end as order_delivered_customer_date,
  case when shipped then p + interval '1' day * cast(floor(dh/24) - late_days as int) else p + interval '1' day * 20 end as order_estimated_delivery_date from v
""",
    "raw_items": """
select l_orderkey as order_id, cast(row_number() over (partition by l_orderkey order by l_linenumber,l_partkey,l_suppkey,l_shipdate) as integer) as order_item_id, l_partkey as product_id, l_suppkey as seller_id, o_orderdate + interval '1' day * (4 + cast(l_quantity as int)%8) as shipping_limit_date, l_extendedprice as price, l_extendedprice*l_tax as freight_value, l_shipdate as item_ship_ts, l_discount as src_discount from lineitem join orders on l_orderkey=o_orderkey
""",
    "raw_customers": """
select c_custkey as customer_id, c_name as customer_unique_id, cast(c_custkey%53 as int) as customer_zip_code_prefix, c_mktsegment as customer_city, n_name as customer_state, r_name as customer_region from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey
""",
    "raw_sellers": """
select s_suppkey as seller_id, cast(s_suppkey%59 as int) as seller_zip_code_prefix, s_name as seller_city, n_name as seller_state from supplier join nation on s_nationkey=n_nationkey
""",
    "raw_products": """
select p_partkey as product_id, case when p_partkey%50=0 then null else lower(p_type) end as product_category_name, p_size as product_weight_g from part
""",
    "raw_translation": """
select distinct lower(p_type) as product_category_name, concat(lower(p_type),'_goods') as product_category_name_english from part where p_type not in ('PROMO','SMALL')
""",
    "raw_geolocation": """
with g as (select c_custkey as k, cast(c_custkey%53 as int) as z from customer) select z as geolocation_zip_code_prefix, case when z=52 or k%40=0 then 45.0 else -25 + cast(z*37%53 as double)*0.25 + cast(k%7 as double)*0.01 end as geolocation_lat, case when z=52 or k%40=0 then 121.0 else -55 + cast(z*29%53 as double)*0.3 + cast(k%5 as double)*0.01 end as geolocation_lng from g
""",
    "raw_reviews": """
select order_id*100+order_item_id as review_id, order_id, 1 + cast(round(src_discount*100) as int)%5 as review_score, item_ship_ts as review_answer_timestamp from raw_items
""",
}

CLEAN = {
    "c_orders": """
select order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
  order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
  delay_days, delay_days > 0 as is_late,
  case when ah >= 0 then ah end as approval_hours,
  case when ph >= 0 then ph end as preparation_hours,
  case when th >= 0 then th end as transit_hours,
  order_delivered_carrier_date < order_approved_at as carrier_before_approved,
  order_delivered_customer_date < order_delivered_carrier_date as delivered_before_carrier
from (
  select *,
    cast(date_diff('day', cast(order_estimated_delivery_date as date), cast(order_delivered_customer_date as date)) as integer) as delay_days,
    date_diff('microsecond', order_purchase_timestamp, order_approved_at) / 3.6e9 as ah,
    date_diff('microsecond', order_approved_at, order_delivered_carrier_date) / 3.6e9 as ph,
    date_diff('microsecond', order_delivered_carrier_date, order_delivered_customer_date) / 3.6e9 as th
  from raw_orders)
""",
    "scoped": """
select *, cast(date_trunc('month', order_purchase_timestamp) as date) as month
from c_orders where order_status = 'delivered' and is_late is not null
""",
    "c_geo": """
select geolocation_zip_code_prefix, median(geolocation_lat) as geolocation_lat, median(geolocation_lng) as geolocation_lng
from raw_geolocation
where geolocation_lat between -34 and 6 and geolocation_lng between -75 and -28
group by geolocation_zip_code_prefix
""",
    "c_customers": """
select c.*, geolocation_lat as customer_lat, geolocation_lng as customer_lng
from raw_customers c left join c_geo on customer_zip_code_prefix = geolocation_zip_code_prefix
""",
    "c_sellers": """
select s.*, geolocation_lat as seller_lat, geolocation_lng as seller_lng
from raw_sellers s left join c_geo on seller_zip_code_prefix = geolocation_zip_code_prefix
""",
    "c_distances": """
select order_id, order_item_id,
  2 * 6371 * asin(sqrt(
    pow(sin((radians(customer_lat) - radians(seller_lat)) / 2), 2)
    + cos(radians(seller_lat)) * cos(radians(customer_lat))
      * pow(sin((radians(customer_lng) - radians(seller_lng)) / 2), 2))) as distance_km
from raw_items i
left join raw_orders o using (order_id)
left join c_customers c on c.customer_id = o.customer_id
left join c_sellers s on s.seller_id = i.seller_id
""",
    "c_items": """
select i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price, i.freight_value,
  o.order_delivered_carrier_date > i.shipping_limit_date as missed_shipping_deadline
from raw_items i left join raw_orders o using (order_id)
""",
    "c_products": """
select product_id,
  case product_category_name when 'promo' then 'promo_goods' when 'small' then 'small_goods'
    else product_category_name_english end as product_category
from raw_products left join raw_translation using (product_category_name)
""",
    "c_reviews": """
select order_id, review_score from (
  select *, row_number() over (partition by order_id order by review_answer_timestamp desc nulls first, review_id desc) as n
  from raw_reviews) where n = 1
""",
    "order_distance": """
select order_id, max(distance_km) as distance_km from c_distances group by order_id
""",
    "seller_counts": """
select seller_id, count(distinct order_id) as orders,
  count(distinct order_id) filter (where is_late) as late_orders,
  round(count(distinct order_id) filter (where is_late) / count(distinct order_id) * 100, 2) as late_pct
from scoped join raw_items using (order_id) group by seller_id
""",
    "place_month": """
select month, customer_region as place, count(*) as orders, count(*) filter (where is_late) as late_orders
from scoped join raw_customers using (customer_id)
where order_purchase_timestamp >= timestamp '1995-01-01'
group by month, customer_region
""",
    "compared": """
select month, place, orders, late_orders, late_orders / orders as rate,
  (all_late - late_orders) / nullif(all_orders - orders, 0) as rest_rate
from place_month
join (select month, sum(orders) as all_orders, sum(late_orders) as all_late from place_month group by month) using (month)
where orders >= 20
""",
    "focal_month": """
select month,
  count(*) filter (where customer_region = 'AMERICA') as america_orders,
  count(*) filter (where customer_region = 'AMERICA' and is_late) as america_late,
  count(*) filter (where customer_region = 'AMERICA')
    * (count(*) filter (where customer_region <> 'AMERICA' and is_late)
       / nullif(count(*) filter (where customer_region <> 'AMERICA'), 0)) as expected
from scoped join raw_customers using (customer_id)
where order_purchase_timestamp >= timestamp '1995-01-01'
group by month
""",
    "episode_month": """
select * from focal_month where month >= date '1997-10-01' and month < date '1998-04-01'
""",
    "focal_scores": """
select is_late, review_score
from scoped join raw_customers using (customer_id) join c_reviews using (order_id)
where customer_region = 'AMERICA'
  and order_purchase_timestamp >= timestamp '1997-10-01' and order_purchase_timestamp < timestamp '1998-04-01'
""",
    "relative_month": """
select *, year(month) * 12 + month(month)
    - row_number() over (partition by place order by month) as island
from compared where rate >= 2 * rest_rate and late_orders > 0
""",
    "run_month": """
select place, month,
  cast(row_number() over (partition by place, island order by month) as integer) as run_month
from relative_month
""",
    "episodes": """
select month, place, orders, late_orders, rate, rest_rate,
  coalesce(run_month, 0) as run_month,
  coalesce(run_month, 0) >= 2 as fired_relative,
  rate >= 0.15 and rate >= 1.5 * rest_rate as fired_absolute
from compared left join run_month using (month, place)
where run_month is not null or (rate >= 0.15 and rate >= 1.5 * rest_rate)
""",
    "runs": """
select place, month - to_months(run_month - 1) as first_month, month, run_month
from episodes where run_month > 0
""",
}


def _distance_band(column: str) -> str:
    return (
        f"case when {column} < 100 then 'under 100 km' when {column} < 300 then '100-300 km' "
        f"when {column} < 700 then '300-700 km' when {column} < 1500 then '700-1500 km' "
        f"when {column} is not null then 'over 1500 km' end"
    )


def _delay_band(column: str) -> str:
    return (
        f"case when {column} <= 0 then 'on time or early' when {column} <= 3 then '1-3 days late' "
        f"when {column} <= 7 then '4-7 days late' when {column} <= 14 then '8-14 days late' "
        f"when {column} is not null then '15+ days late' end"
    )


def _stage_median(stage: str, late: str, name: str) -> str:
    return f"round(median({stage}_hours) filter (where {late}), 1) as {stage}_{name}"


def _region_rate(region: str) -> str:
    return (
        f"round(count(*) filter (where customer_region = '{region}' and is_late) "
        f"/ nullif(count(*) filter (where customer_region = '{region}'), 0) * 100, 1) as {region.lower()}"
    )


def _summary(source: str, column: str) -> str:
    parts = {
        "count": f"cast(count({column}) as double)",
        "mean": f"avg({column})",
        "std": f"stddev_samp({column})",
        "min": f"min({column})",
        "25%": f"quantile_cont({column}, 0.25)",
        "50%": f"quantile_cont({column}, 0.5)",
        "75%": f"quantile_cont({column}, 0.75)",
        "max": f"max({column})",
    }
    return " union all ".join(
        f"select '{name}' as statistic, round({value}, 6) as value from {source}"
        for name, value in parts.items()
    )


def _profile(source: str, columns: dict[str, str]) -> str:
    return " union all ".join(
        f"select {i} as position, '{c}' as column_name, '{kind}' as data_type, count(*) as rows, "
        f"count({c}) as known, count(*) - count({c}) as unknown, count(distinct {c}) as distinct_values from {source}"
        for i, (c, kind) in enumerate(columns.items(), 1)
    )


def _nulls(check: str, source: str, condition: str) -> str:
    return f"select '{check}' as check_name, count(*) as violations from {source} where {condition}"


def _bad_key(table: str, source: str, keys: str) -> str:
    unknown = " or ".join(f"{k} is null" for k in keys.split(", "))
    return (
        f"select '{table}: key {keys}' as check_name, count(*) as violations from "
        f"(select {keys}, count(*) as n from {source} group by {keys}) where n > 1 or {unknown}"
    )


def _orphans(check: str, child: str, key: str, parent: str) -> str:
    return (
        f"select '{check}' as check_name, count(distinct {key}) as violations from {child} "
        f"where {key} is not null and {key} not in (select {key} from {parent} where {key} is not null)"
    )


def _coverage(points: str) -> str:
    return " union all ".join(
        f"""select '{side}' as side, count(distinct {key}) as keys,
  count(distinct {key}) filter (where {key} not in (select geolocation_zip_code_prefix from {points})) as uncovered,
  round(count(distinct {key}) filter (where {key} not in (select geolocation_zip_code_prefix from {points}))
    / count(distinct {key}) * 100, 1) as uncovered_pct
from raw_{side}"""
        for side, key in (
            ("customers", "customer_zip_code_prefix"),
            ("sellers", "seller_zip_code_prefix"),
        )
    )


def _required(table: str, source: str, columns: list[str]) -> list[str]:
    return [_nulls(f"{table}: {c} is known", source, f"{c} is null") for c in columns]


VIOLATIONS = " union all ".join(
    [
        _bad_key("customers", "raw_customers", "customer_id"),
        *_required("customers", "raw_customers", [
            "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]),
        _bad_key("sellers", "raw_sellers", "seller_id"),
        *_required("sellers", "raw_sellers", [
            "seller_zip_code_prefix", "seller_city", "seller_state"]),
        _bad_key("products", "c_products", "product_id"),
        _bad_key("geolocation", "c_geo", "geolocation_zip_code_prefix"),
        *_required("geolocation", "c_geo", ["geolocation_lat", "geolocation_lng"]),
        _bad_key("orders", "c_orders", "order_id"),
        *_required("orders", "c_orders", [
            "customer_id", "order_status", "order_purchase_timestamp", "order_estimated_delivery_date"]),
        *[
            _nulls(f"orders: {s}_hours in range", "c_orders", f"{s}_hours < 0")
            for s in ("approval", "preparation", "transit")
        ],
        _bad_key("reviews", "c_reviews", "order_id"),
        *_required("reviews", "c_reviews", ["review_score"]),
        _nulls("reviews: review_score in range", "c_reviews", "review_score not between 1 and 5"),
        _bad_key("order_items", "c_items", "order_id, order_item_id"),
        *_required("order_items", "c_items", [
            "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]),
        _orphans("orders: customer_id in customers", "c_orders", "customer_id", "raw_customers"),
        _orphans("reviews: order_id in orders", "c_reviews", "order_id", "c_orders"),
        _orphans("order_items: order_id in orders", "c_items", "order_id", "c_orders"),
        _orphans("order_items: product_id in products", "c_items", "product_id", "c_products"),
        _orphans("order_items: seller_id in sellers", "c_items", "seller_id", "raw_sellers"),
        _bad_key("lineitem", "lineitem", "l_orderkey, l_linenumber"),
        _nulls("raw reviews: review_answer_timestamp is known", "raw_reviews", "review_answer_timestamp is null"),
        """select 'fact_orders: one row per order' as check_name, count(*) as violations from (
  select order_id from scoped join raw_customers using (customer_id)
  left join order_distance using (order_id) left join c_reviews using (order_id)
  group by order_id having count(*) > 1)""",
        """select 'order_items: rows kept by enrichment' as check_name, abs(
  (select count(*) from c_items left join c_distances using (order_id, order_item_id))
  - (select count(*) from raw_items)) as violations""",
    ]
)

ANSWERS = {
    "late_rate_baseline": """
select count(*) as orders, count(*) filter (where is_late) as late_orders,
  round(count(*) filter (where is_late) / nullif(count(*), 0) * 100, 2) as late_rate_pct
from scoped
""",
    "stage_medians": "select "
    + ", ".join(
        _stage_median(stage, condition, name)
        for stage in ("approval", "preparation", "transit")
        for condition, name in (("is_late", "late"), ("not is_late", "ontime"))
    )
    + " from scoped",
    "late_by_state": """
select customer_state as state, count(*) as orders, count(*) filter (where is_late) as late_orders,
  round(count(*) filter (where is_late) / count(*) * 100, 2) as late_rate_pct,
  round(count(*) filter (where is_late) / sum(count(*) filter (where is_late)) over () * 100, 2) as share_of_late_pct
from scoped join raw_customers using (customer_id) group by customer_state
""",
    "late_by_seller_volume": """
select * from seller_counts order by late_orders desc, seller_id limit 20
""",
    "late_by_seller_rate": """
select * from seller_counts where orders >= 100 order by late_pct desc, seller_id limit 15
""",
    "late_by_category": """
select product_category as category, count(distinct order_id) as orders,
  count(distinct order_id) filter (where is_late) as late_orders,
  round(count(distinct order_id) filter (where is_late) / count(distinct order_id) * 100, 2) as late_pct
from scoped join raw_items using (order_id) join c_products using (product_id)
group by product_category order by late_orders desc, category asc nulls last limit 15
""",
    "late_by_distance_band": f"""
select {_distance_band('distance_km')} as distance_bucket, count(*) as orders,
  count(*) filter (where is_late) as late_orders,
  round(count(*) filter (where is_late) / count(*) * 100, 1) as late_pct
from scoped join order_distance using (order_id) where distance_km is not null group by 1
""",
    "median_distance_by_state": """
select customer_state, count(*) as orders, round(median(distance_km), 0) as median_distance_km
from scoped join raw_customers using (customer_id) join order_distance using (order_id)
where distance_km is not null group by customer_state order by orders desc, customer_state limit 10
""",
    "late_by_month": """
select month, count(*) as orders, count(*) filter (where is_late) as late_orders,
  round(count(*) filter (where is_late) / count(*) * 100, 2) as late_rate_pct
from scoped group by month
""",
    "promised_vs_actual_by_month": """
select *, round(promised_days - actual_days, 1) as gap_days from (
  select month,
    round(median(date_diff('hour', order_purchase_timestamp, order_delivered_customer_date) / 24.0), 1) as actual_days,
    round(median(date_diff('hour', order_purchase_timestamp, order_estimated_delivery_date) / 24.0), 1) as promised_days
  from scoped where order_purchase_timestamp >= timestamp '1995-01-01' group by month)
""",
    "late_rate_by_month_pivot": "select month, "
    + ", ".join(_region_rate(r) for r in ("AMERICA", "ASIA", "EUROPE", "AFRICA"))
    + """ from scoped join raw_customers using (customer_id)
where order_purchase_timestamp >= timestamp '1995-01-01' group by month""",
    "entity_vs_rest_by_month": """
select *, round(america_late_pct / nullif(rest_late_pct, 0), 1) as america_vs_rest from (
  select month,
    count(*) filter (where customer_region = 'AMERICA') as america_orders,
    round(count(*) filter (where customer_region = 'AMERICA' and is_late)
      / nullif(count(*) filter (where customer_region = 'AMERICA'), 0) * 100, 2) as america_late_pct,
    count(*) filter (where customer_region <> 'AMERICA') as rest_orders,
    round(count(*) filter (where customer_region <> 'AMERICA' and is_late)
      / nullif(count(*) filter (where customer_region <> 'AMERICA'), 0) * 100, 2) as rest_late_pct
  from scoped join raw_customers using (customer_id)
  where order_purchase_timestamp >= timestamp '1995-01-01' group by month)
""",
    "states_at_same_distance": """
select customer_state, count(*) as orders, count(*) filter (where is_late) as late_orders,
  round(count(*) filter (where is_late) / count(*) * 100, 2) as late_rate_pct,
  round(median(distance_km), 0) as median_distance_km
from scoped join raw_customers using (customer_id) join order_distance using (order_id)
where distance_km between 200 and 600 group by customer_state
""",
    "episode_size": """
select cast(sum(america_orders) as bigint) as america_orders, cast(sum(america_late) as bigint) as america_late,
  round(sum(expected), 0) as expected_late, round(sum(america_late) - sum(expected), 0) + 0 as excess_late,
  round((sum(america_late) - sum(expected))
    / (select nullif(count(*) filter (where is_late), 0) from scoped) * 100, 1) as pct_of_all_late
from episode_month
""",
    "review_by_delay_band": f"""
select {_delay_band('delay_days')} as delay_bucket, count(*) as orders,
  round(avg(review_score), 2) as avg_score,
  round(count(*) filter (where review_score = 1) / count(*) * 100, 1) as one_star_pct
from scoped join c_reviews using (order_id) group by 1
""",
    "review_cost_of_lateness": """
select is_late, count(*) as orders, round(avg(review_score), 2) as avg_score from focal_scores group by is_late
""",
    "excess_by_month": """
select month, america_orders, america_late, round(expected, 0) as expected_late,
  round(america_late - expected, 0) + 0 as excess_late
from episode_month
""",
    "alerts": """
select month, place as state, orders, round(rate * 100, 1) as state_pct, round(rest_rate * 100, 1) as rest_pct,
  round(rate / nullif(rest_rate, 0), 1) as ratio,
  case when rate >= 0.15 and rate >= 2 * rest_rate then 'both' when rate >= 0.15 then 'absolute'
    else 'relative' end as triggered_by
from compared where rate >= 2 * rest_rate or (rate >= 0.15 and rate >= 1.5 * rest_rate)
""",
    "alert_episodes": """
select month, place, orders, late_orders, round(rate * 100, 1) as rate_pct,
  round(rest_rate * 100, 1) as rest_pct, run_month, fired_relative, fired_absolute,
  fired_relative or fired_absolute as fired
from episodes
""",
    "alert_runs": """
select place, cast(first_month as date) as first_month, max(month) as last_month, max(run_month) as months,
  min(month) filter (where run_month = 2) as fired_month
from runs group by place, first_month
""",
    "excess_after_alert": """
select 'AMERICA' as place, fired_month, round(excess, 0) as excess_late,
  round(after, 0) as excess_after_alert, round(after / nullif(excess, 0) * 100, 0) as after_alert_pct,
  round(loss, 2) as score_loss, round(after * loss, 0) as review_points
from (
  select f.fired_month, sum(america_late - expected) as excess,
    sum(america_late - expected) filter (where month > f.fired_month) as after,
    (select avg(review_score) filter (where not is_late) - avg(review_score) filter (where is_late)
     from focal_scores) as loss
  from episode_month, (
    select min(month) as fired_month from episodes
    where place = 'AMERICA' and fired_relative and month >= date '1997-10-01' and month < date '1998-04-01') f
  group by f.fired_month)
""",
    "fact_orders": f"""
select order_id, cast(order_purchase_timestamp as date) as order_date, customer_state, is_late, delay_days,
  approval_hours, preparation_hours, transit_hours,
  date_diff('hour', order_purchase_timestamp, order_delivered_customer_date) / 24.0 as actual_days,
  date_diff('hour', order_purchase_timestamp, order_estimated_delivery_date) / 24.0 as promised_days,
  round(distance_km, 6) as distance_km,
  {_distance_band('distance_km')} as distance_bucket,
  case when distance_km < 100 then 1 when distance_km < 300 then 2 when distance_km < 700 then 3
    when distance_km < 1500 then 4 when distance_km is not null then 5 end as distance_bucket_order,
  {_delay_band('delay_days')} as delay_bucket,
  case when delay_days <= 0 then 1 when delay_days <= 3 then 2 when delay_days <= 7 then 3
    when delay_days <= 14 then 4 when delay_days is not null then 5 end as delay_bucket_order,
  review_score
from scoped join raw_customers using (customer_id)
left join order_distance using (order_id) left join c_reviews using (order_id)
""",
    "fact_stage_hours": " union all ".join(
        f"""select order_id, cast(order_purchase_timestamp as date) as order_date, customer_state, is_late,
  '{label}' as stage, {n} as stage_order, {c}_hours as hours
from scoped join raw_customers using (customer_id) where {c}_hours is not null"""
        for n, (c, label) in enumerate(
            [("approval", "Payment approval"), ("preparation", "Preparation"), ("transit", "Transit")], 1
        )
    ),
    "dim_date": """
select cast(d as date) as date, cast(year(d) as integer) as year, cast(month(d) as integer) as month_number,
  strftime(d, '%b %Y') as month_label, cast(year(d) * 100 + month(d) as integer) as month_sort
from (select unnest(generate_series(cast(min(order_purchase_timestamp) as date),
  cast(max(order_purchase_timestamp) as date), interval 1 day)) as d from scoped)
""",
    "dim_state": """
select lpad(cast(n_nationkey as varchar), 2, '0') as state_code, n_name as state_name, r_name as region
from nation join region on n_regionkey = r_regionkey
""",
    "seller_rates": "select * from seller_counts where orders >= 100",
    "entity_excess": """
select month, america_orders, america_late, round(expected, 0) as expected_late,
  round(america_late - expected, 0) + 0 as excess_late
from focal_month
""",
    "clean_orders": "select * from c_orders",
    "clean_order_items": "select * from c_items",
    "clean_products": "select * from c_products",
    "clean_reviews": "select * from c_reviews",
    "geo_by_prefix": """
select geolocation_zip_code_prefix, round(geolocation_lat, 6) as geolocation_lat,
  round(geolocation_lng, 6) as geolocation_lng from c_geo
""",
    "customers_located": """
select * replace (round(customer_lat, 6) as customer_lat, round(customer_lng, 6) as customer_lng) from c_customers
""",
    "sellers_located": """
select * replace (round(seller_lat, 6) as seller_lat, round(seller_lng, 6) as seller_lng) from c_sellers
""",
    "item_distances": """
select order_id, order_item_id, round(distance_km, 6) as distance_km from c_distances
""",
    "items_with_attached_distance": """
select order_id, order_item_id, seller_id, round(distance_km, 6) as distance_km
from raw_items left join c_distances using (order_id, order_item_id)
""",
    "order_items_model": """
select c_items.*, round(distance_km, 6) as distance_km
from c_items left join c_distances using (order_id, order_item_id)
""",
    "table_counts": " union all ".join(
        f"select '{name}' as table_name, count(*) as rows from {source}"
        for name, source in {
            "customers": "raw_customers",
            "sellers": "raw_sellers",
            "products": "c_products",
            "geolocation": "c_geo",
            "orders": "c_orders",
            "reviews": "c_reviews",
            "order_items": "c_items",
        }.items()
    ),
    "violations": VIOLATIONS,
    "csv_orders": "select * from raw_orders",
    "csv_reviews": r"""
select raw_reviews.*, case review_id % 4
  when 0 then 'Said "' || review_id || '", then' || chr(10) || chr(10) || 'left, "quietly"'
  when 1 then 'two lines' || chr(10) || review_id
  when 2 then 'plain, with a comma' end as review_comment_message
from raw_reviews
""",
    "csv_rejects": """
select 'price' as "column", 'n/k' as text, count(*) as rejects from raw_items where (order_id + order_item_id) % 50 = 0 having count(*) > 0
union all
select 'shipping_limit_date', '31/31/1999', count(*) from raw_items where (order_id + order_item_id) % 70 = 0 having count(*) > 0
""",
    "catalog_counts": " union all ".join(
        f"select '{name.removeprefix('raw_') if name != 'raw_items' else 'order_items'}' as table_name, count(*) as rows from {name}"
        for name in RAW
    ),
    "category_preview": """
select product_category, count(*) as rows from c_products where product_category is not null
group by product_category order by rows desc, product_category limit 3
""",
    "out_of_order_rows": " union all ".join(
        _nulls(name, "raw_orders", f"{earlier} > {later}")
        for name, earlier, later in [
            ("approved before purchased", "order_purchase_timestamp", "order_approved_at"),
            ("carrier before approved", "order_approved_at", "order_delivered_carrier_date"),
            ("delivered before carrier", "order_delivered_carrier_date", "order_delivered_customer_date"),
        ]
    ),
    "orphan_orders": """
select order_id from raw_orders except select order_id from raw_items
""",
    "orphan_status": """
select order_status, count(*) as rows from raw_orders
where order_id not in (select order_id from raw_items) group by order_status
""",
    "referential_integrity": " union all ".join(
        [
            _orphans("items to products", "raw_items", "product_id", "raw_products"),
            _orphans("items to sellers", "raw_items", "seller_id", "raw_sellers"),
            _orphans("reviews to orders", "raw_reviews", "order_id", "raw_orders"),
            _orphans("categories to translation", "raw_products", "product_category_name", "raw_translation"),
        ]
    ),
    "zip_coverage": _coverage("raw_geolocation"),
    "coordinate_coverage": _coverage("c_geo"),
    "cleaning_report": " union all ".join(
        f"select '{table}' as table_name, '{name}' as measure, {value} as rows from {source}"
        for table, source, name, value in [
            ("orders", "c_orders", "rows", "count(*)"),
            ("orders", "c_orders", "carrier_before_approved", "count(*) filter (where carrier_before_approved)"),
            ("orders", "c_orders", "delivered_before_carrier", "count(*) filter (where delivered_before_carrier)"),
            ("orders", "c_orders", "carrier_before_approved_unknown", "count(*) filter (where carrier_before_approved is null)"),
            ("orders", "c_orders", "delivered_before_carrier_unknown", "count(*) filter (where delivered_before_carrier is null)"),
            ("order_items", "c_items", "rows", "count(*)"),
            ("order_items", "c_items", "missed_shipping_deadline", "count(*) filter (where missed_shipping_deadline)"),
            ("order_items", "c_items", "missed_shipping_deadline_unknown", "count(*) filter (where missed_shipping_deadline is null)"),
        ]
    ),
    "profile_orders": _profile(
        "c_orders",
        {
            "order_id": "bigint",
            "customer_id": "bigint",
            "order_status": "string",
            "order_purchase_timestamp": "timestamp_ntz",
            "order_approved_at": "timestamp_ntz",
            "order_delivered_carrier_date": "timestamp_ntz",
            "order_delivered_customer_date": "timestamp_ntz",
            "order_estimated_delivery_date": "timestamp_ntz",
            "delay_days": "int",
            "is_late": "boolean",
            "approval_hours": "double",
            "preparation_hours": "double",
            "transit_hours": "double",
            "carrier_before_approved": "boolean",
            "delivered_before_carrier": "boolean",
        },
    ),
    "status_counts": "select order_status, count(*) as rows from raw_orders group by order_status",
    "score_counts": "select review_score, count(*) as rows from c_reviews group by review_score",
    "nulls_by_status": """
select order_status,
  count(*) filter (where order_delivered_carrier_date is null) as order_delivered_carrier_date,
  count(*) filter (where order_approved_at is null) as order_approved_at,
  count(*) filter (where order_delivered_customer_date is null) as order_delivered_customer_date
from raw_orders group by order_status
""",
    "product_nulls": """
select count(*) filter (where product_id is null) as product_id,
  count(*) filter (where product_category_name is null) as product_category_name,
  count(*) filter (where product_weight_g is null) as product_weight_g
from raw_products
""",
    "category_count": "select count(distinct product_category) as categories from c_products",
    "describe_price": _summary("raw_items", "price"),
    "describe_distance": _summary("c_distances", "distance_km"),
    "rows_per_prefix": """
select count(*) as rows, count(distinct geolocation_zip_code_prefix) as keys,
  count(*) / count(distinct geolocation_zip_code_prefix) as rows_per_key
from raw_geolocation
""",
    "duplicate_points": """
select cast(sum(n - 1) as bigint) as duplicate_rows
from (select count(*) as n from raw_geolocation
  group by geolocation_zip_code_prefix, geolocation_lat, geolocation_lng)
""",
    "duplicate_reviews": """
select cast(sum(n - 1) as bigint) as duplicate_rows
from (select count(*) as n from raw_reviews group by order_id, review_answer_timestamp)
""",
}

# The same rows by another way through the library.
ANSWERS |= {
    "clean_order_items_checked": ANSWERS["clean_order_items"],
    "model_round_trip": ANSWERS["table_counts"],
    "star_round_trip": ANSWERS["fact_orders"],
    "geography_job": ANSWERS["item_distances"],
    "star_export": " union all ".join(
        f"select '{name}' as table_name, count(*) as rows from ({ANSWERS[answer]})"
        for name, answer in {
            "fact_orders": "fact_orders",
            "fact_stage_hours": "fact_stage_hours",
            "dim_date": "dim_date",
            "dim_state": "dim_state",
            "seller_rates": "seller_rates",
            "alerts": "alerts",
            "rio_excess": "excess_by_month",
        }.items()
    ),
}


def sql(name: str) -> str:
    """The answer with the CTEs it reaches, in dependency order."""
    answer = ANSWERS[name]
    ctes = RAW | CLEAN
    needed: set[str] = set()

    def reach(text: str) -> None:
        for word in set(re.findall(r"\w+", text)) & ctes.keys():
            if word not in needed:
                needed.add(word)
                reach(ctes[word])

    reach(answer)
    if not needed:
        return answer.strip()
    prefix = ",\n".join(f"{n} as ({ctes[n].strip()})" for n in ctes if n in needed)
    return f"with {prefix}\n{answer.strip()}"
