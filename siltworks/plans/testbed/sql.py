"""What the queries should return, as SQL over the same tables."""

from __future__ import annotations

_TRIPS = """
trips as (
  select l_orderkey as order_key, l_linenumber as line_number, l_partkey as part_key, l_suppkey as vendor_id,
         l_returnflag as service_type, o_orderdate as pickup_datetime, l_shipdate as dropoff_datetime,
         l_quantity as trip_distance, nullif(l_quantity, 2) as passenger_count, l_extendedprice as fare_amount,
         case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as total_amount,
         'trips_' || strftime(o_orderdate + interval 3 day, '%Y-%m') || '.parquet' as _source_file,
         cast(date_trunc('month', o_orderdate + interval 3 day) as date) as _file_period
  from lineitem join orders on l_orderkey = o_orderkey
)"""

_OUTSIDE = "(pickup_datetime < _file_period or pickup_datetime >= _file_period + interval 1 month)"

_CLASSIFIED = f"""{_TRIPS},
classified as (
  select *, passenger_count is null as passenger_count_missing, total_amount < 0 as is_reversal,
         case when fare_amount < 2000 then 'cheap_line'
              when trip_distance <= 1 then 'single_unit'
              when dropoff_datetime <= pickup_datetime then 'shipped_before_order'
              when {_OUTSIDE} then 'order_outside_file_month' end as _quarantine_reason
  from trips
)"""

_VERSIONS = """
changes as (
  select user_id, event_type, case when value >= 100 then 'Premium' else 'Standard' end as contract_tier, ts
  from events where event_type in ('signup', 'error')
),
versions as (
  select sha256(user_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) as version_key, user_id, contract_tier,
         ts as effective_start_date,
         coalesce(lead(ts) over (partition by user_id order by ts), timestamp '9999-12-31') as effective_end_date,
         lead(ts) over (partition by user_id order by ts) is null as is_current
  from changes
)"""

_FACT = f"""{_VERSIONS},
fact as (
  select event_id, e.user_id, ts, value as amount, version_key
  from events e left join versions v
    on e.user_id = v.user_id and ts >= effective_start_date and ts < effective_end_date
  where event_type = 'purchase'
)"""

_STRETCHED = f"""{_VERSIONS},
stretched as (
  select user_id, version_key, effective_start_date as s, case when contract_tier = 'Premium' and not is_current
    then effective_end_date + interval 1 day else effective_end_date end as e from versions
)"""

_MATRIX = f"""{_FACT},
matrix as (
  select c.contract_tier as type1, v.contract_tier as type2, cast(amount as decimal(18,2)) as amount
  from fact f
  left join versions v on f.version_key = v.version_key
  left join versions c on f.user_id = c.user_id and c.is_current
)"""

_SIGNED = """
signed as (
  select *, round(case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end / 50000) * 10 as amount
  from lineitem
)"""

_DATES = """
dates as (
  select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as full_date
  from (select date_trunc('day', min(o_orderdate)) as lo, date_trunc('day', max(o_orderdate)) as hi from orders)
)"""

_TRIP_FACT = f"""{_CLASSIFIED},
fact_trips as (
  select cast(strftime(pickup_datetime, '%Y%m%d') as int) as pickup_date_key,
         coalesce(nullif(vendor_id, 5), -1) as pu_location_key, vendor_id as vendor_key,
         pickup_datetime, dropoff_datetime,
         round((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60.0, 2) as trip_duration_minutes,
         order_key, line_number, service_type, trip_distance, fare_amount, total_amount, is_reversal
  from classified
)"""

_LOCATIONS = """select cast(s_suppkey as int) as location_key, n_name as borough, s_name as zone_name
  from supplier join nation on s_nationkey = n_nationkey union all select -1, 'Unknown', 'Unknown'"""

_DAYS = "days as (select *, cast(strftime(o_orderdate, '%Y%m%d') as int) as pickup_date_key from orders)"


def _money(expression: str) -> str:
    return f"cast(sum(cast({expression} as decimal(18,2))) as double)"


def _audit(name: str, keys: str) -> str:
    return f"""select {name} cast(sum(n) as bigint) as rows_total, count(*) as distinct_keys,
        cast(sum(n) - count(*) as bigint) as excess_rows, count(*) filter (n > 1) as duplicate_groups
        from (select count(*) as n from lineitem group by {keys})"""


def _reasons(where: str) -> str:
    return f"with {_CLASSIFIED} select {where}"


_METRICS = """select service_type, count(*) filter (_quarantine_reason is null) as rows_clean,
  count(*) filter (_quarantine_reason is null and passenger_count_missing) as passenger_count_missing,
  count(*) filter (_quarantine_reason is null and is_reversal) as reversal_rows,
  count(*) filter (_quarantine_reason is not null) as rows_quarantined, count(*) as rows_total,
  round(count(*) filter (_quarantine_reason is not null) / count(*) * 100, 3) as quarantine_pct
  from classified group by service_type"""

_PROFILE = {
    "whole_price": "fare_amount = floor(fare_amount)",
    "bulk_quantity": "trip_distance >= 40",
    "first_line": "line_number = 1",
    "returned": "total_amount < 0",
    "weekend_order": "isodow(pickup_datetime) >= 6",
    "shipped_within_week": "dropoff_datetime - interval 7 days <= pickup_datetime",
    "missing_quantity": "passenger_count is null",
}
_RULES = {
    "cheap_line": "fare_amount < 2000",
    "single_unit": "trip_distance <= 1",
    "shipped_before_order": "dropoff_datetime <= pickup_datetime",
    "order_outside_file_month": _OUTSIDE,
}

_ROW = "order_key, line_number, part_key, vendor_id, service_type, total_amount"

_RANGE_SUM = (
    f"with {_DAYS} select count(*) as trips, coalesce({_money('o_totalprice')}, 0) as revenue from days where pickup_date_key "
)

_SEEDS = """with changes as (
          select user_id, case when value >= 100 then 'Premium' else 'Standard' end as contract_tier, ts
          from events where event_type in ('signup', 'error')),
        latest as (
          select cut, user_id, max((ts, contract_tier)) as last
          from changes, (values (timestamp '2024-01-08'), (timestamp '2024-01-15'), (timestamp '2024-01-31')) as c(cut)
          where ts < cut and user_id is not null group by cut, user_id),
        looks as (select cut, user_id, last[2] as contract_tier, last[1] as updated_at from latest),
        seen as (select distinct user_id, contract_tier, updated_at from looks)"""

SQL: dict[str, str] = {
    "profile_checks": f"with {_TRIPS} "
    + " union all ".join(
        f"""select service_type, '{name}' as "check", count(*) filter ({test}) as rows_failed, count(*) as rows_total,
            round(count(*) filter ({test}) / count(*) * 100, 3) as pct from trips group by service_type"""
        for name, test in _PROFILE.items()
    ),
    "fatal_totals": f"""with {_CLASSIFIED} select service_type, count(*) as rows_total,
        count(_quarantine_reason) as rows_quarantined, count(*) - count(_quarantine_reason) as rows_clean,
        round(count(_quarantine_reason) / count(*) * 100, 3) as quarantine_pct from classified group by service_type""",
    "quarantine_reason_counts": f"""with {_CLASSIFIED} select service_type, _quarantine_reason, count(*) as rows_quarantined
        from classified where _quarantine_reason is not null group by 1, 2""",
    "failed_rule_counts": f"with {_TRIPS} "
    + " union all ".join(
        f"select service_type, '{name}' as rule, count(*) as rows_failed from trips where {test} group by 1"
        for name, test in _RULES.items()
    ),
    "stored_quality_metrics": f"""with {_CLASSIFIED} select count(_quarantine_reason)::bigint as rows_quarantined,
          (count(*) - count(_quarantine_reason))::bigint as rows_clean, 1::bigint as n_instants,
          count(_quarantine_reason)::bigint as by_reason, count(distinct _quarantine_reason)::bigint as n_reasons from classified""",
    "quality_metrics": f"with {_CLASSIFIED} {_METRICS}",
    "quality_metrics_one_pass": f"with {_CLASSIFIED} {_METRICS}",
    "clean_rows": f"""with {_CLASSIFIED} select {_ROW}, passenger_count_missing, is_reversal, _file_period
        from classified where _quarantine_reason is null""",
    "quarantine_rows": f"with {_CLASSIFIED} select {_ROW}, _quarantine_reason from classified where _quarantine_reason is not null",
    "conservation_check": f"""with {_CLASSIFIED} select service_type, _source_file, count(*) as rows_source,
        count(*) filter (_quarantine_reason is null) as rows_clean, count(_quarantine_reason) as rows_quarantine,
        cast(0 as bigint) as rows_lost, true as same_content from classified group by 1, 2""",
    "unaccounted_rows": f"""with {_CLASSIFIED} select order_key, line_number, count(_quarantine_reason) as surplus
        from classified group by 1, 2 having count(_quarantine_reason) > 0""",
    "missing_rate_by_month": f"""with {_TRIPS} select strftime(pickup_datetime, '%Y-%m') as month, service_type,
        count(*) as rows_total, count(*) - count(passenger_count) as rows_missing,
        round((count(*) - count(passenger_count)) / count(*) * 100, 1) as pct_missing, count(passenger_count) = 0 as all_missing
        from trips group by 1, 2""",
    "service_summary": f"""with {_CLASSIFIED}, accepted as (select * from classified where _quarantine_reason is null)
        select service_type, count(distinct order_key) as n_orders, count(distinct vendor_id) as n_suppliers,
          max(fare_amount) as largest_line, {_money("total_amount")} as balance from accepted group by service_type""",
    "feeds_union_by_name": """
        select 'urgent' as service, o_orderkey as order_id, o_orderdate as placed_at, o_totalprice as amount,
               o_custkey / 100 as surcharge, cast(null as varchar) as status
        from orders where o_orderpriority in ('1-URGENT', '2-HIGH')
        union all
        select 'normal', o_orderkey, o_orderdate, o_totalprice, null, o_orderstatus
        from orders where o_orderpriority is null or o_orderpriority not in ('1-URGENT', '2-HIGH')""",
    "feed_row_counts": """
        select 'orders' as feed, (select count(*) from orders) as n_rows, 6 as n_columns
        union all select 'lineitem', (select count(*) from lineitem), 11
        union all select 'events', (select count(*) from events), 6""",
    "bronze_after_refresh": "select 'again' as run_id, count(*) as n_rows from orders",
    "bronze_after_failed_refresh": "select 'first' as run_id, count(*) as n_rows from orders",
    "ingest_instants": """with months as (select strftime(o_orderdate, '%Y-%m') as month from orders)
        select case when month = (select min(month) from months) then 'first' else 'second' end as run_id, count(*) as n_rows, 1::bigint as n_instants
        from months group by 1""",
    "bronze_empty_feed": """select 'orders' as feed, count(*) as n_rows, count(o_orderkey) as n_keys from orders
        union all select 'returns', 0, 0""",
    "catalog_round_trip": "select o_orderkey, o_custkey, o_totalprice as price from orders",
    "nulled_values": """select o_orderkey, case when o_totalprice = floor(o_totalprice) then cast(o_totalprice as bigint) end as o_totalprice,
        case when o_orderdate = date_trunc('day', o_orderdate) then cast(o_orderdate as date) end as o_orderdate from orders""",
    "strict_values": "select o_orderkey, o_orderstatus from orders",
    "inferred_reference": """select s_suppkey as suppkey, s_name as name, s_nationkey as nation,
        'suppkey:int,name:string,nation:int' as kinds from supplier""",
    "period_window_violations": f"""with {_TRIPS} select _source_file, _file_period, count(*) as rows_outside
        from trips where {_OUTSIDE} group by 1, 2""",
    "rescue_recovery": """select event_id, event_type,
        coalesce(case when value >= 50 then value end, cast(json_extract_string(props, '$.k') as double)) as value,
        cast(json_extract_string(props, '$.k') as bigint) as code from events""",
    "rescued_values": """select cast(o_orderkey as int) as o_orderkey,
        case when o_totalprice = floor(o_totalprice) then cast(o_totalprice as bigint) end as o_totalprice,
        cast(null as int) as o_orderpriority,
        case when o_orderdate = date_trunc('day', o_orderdate) then cast(o_orderdate as date) end as o_orderdate,
        case when o_totalprice <> floor(o_totalprice) then o_totalprice end as rescued_price,
        o_orderpriority as rescued_priority, o_custkey as rescued_custkey from orders""",
    "duplicate_key_audit": _audit("", "l_orderkey, l_linenumber"),
    "duplicate_key_comparison": " union all ".join(
        _audit(f"'{name}' as candidate,", keys)
        for name, keys in (
            ("order", "l_orderkey"),
            ("order_line", "l_orderkey, l_linenumber"),
            ("order_line_part", "l_orderkey, l_linenumber, l_partkey, l_suppkey"),
        )
    ),
    "duplicate_key_comparison_unrelated": " union all ".join(
        _audit(f"'{name}' as candidate,", keys)
        for name, keys in (("order_line", "l_orderkey, l_linenumber"), ("order_part", "l_orderkey, l_partkey"))
    ),
    "duplicate_group_classes": f"""with {_SIGNED}, sums as (
          select sum(amount) as net, count(distinct amount) as kinds from signed group by l_orderkey, l_linenumber having count(*) > 1)
        select count(*) as groups_total, count(*) filter (abs(net) < 0.01) as groups_net_zero,
          count(*) filter (kinds = 1) as groups_same_amount,
          count(*) filter (abs(net) >= 0.01 and kinds <> 1) as groups_other from sums""",
    "duplicate_groups": f"""with {_SIGNED} select l_orderkey, l_linenumber, count(*) as n, sum(amount) as net,
        count(distinct amount) as distinct_amounts from signed group by 1, 2 having count(*) > 1""",
    "top_duplicate_groups": """select l_orderkey, l_linenumber, count(*) as n from lineitem
        group by 1, 2 having count(*) > 1 order by n desc, l_orderkey, l_linenumber limit 10""",
    "duplicate_rows": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, n
        from lineitem join (select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1)
        using (l_orderkey, l_linenumber)""",
    "rows_like_top_group": """with top as (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1
          order by count(*) desc, l_orderkey, l_linenumber limit 1)
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem
        where (l_orderkey, l_linenumber) in (select (l_orderkey, l_linenumber) from top)""",
    "dedup_guard": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate from lineitem
        qualify row_number() over (partition by l_orderkey, l_linenumber
          order by l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "dedup_guard_none_expected": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
        from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber, l_partkey, l_suppkey
          order by l_shipdate, l_extendedprice) = 1""",
    "dim_date": f"""with {_DATES} select cast(strftime(full_date, '%Y%m%d') as int) as date_key, full_date,
        cast(year(full_date) as int) as year, cast(quarter(full_date) as int) as quarter, cast(month(full_date) as int) as month,
        strftime(full_date, '%B') as month_name, cast(day(full_date) as int) as day_of_month,
        cast(dayofweek(full_date) + 1 as int) as day_of_week, strftime(full_date, '%A') as day_name,
        cast(weekofyear(full_date) as int) as week_of_year, dayofweek(full_date) in (0, 6) as is_weekend from dates""",
    "dim_location_unknown": _LOCATIONS,
    "dim_code_table": """select distinct o_orderstatus as state_key,
        case o_orderstatus when 'O' then 'Open' when 'F' then 'Filled' else 'Unknown state' end as state_name from orders""",
    "scd2_versions": f"""with {_VERSIONS} select version_key, user_id, contract_tier, effective_start_date,
        effective_end_date, is_current from versions""",
    "snapshot_apply": """with changes as (
          select user_id, case when value >= 100 then 'Premium' else 'Standard' end as contract_tier, ts
          from events where event_type in ('signup', 'error')),
        looks as (
          select cut, user_id, max((ts, contract_tier)) as last
          from changes, (values (timestamp '2024-01-08'), (timestamp '2024-01-15'), (timestamp '2024-01-31')) as c(cut)
          where ts < cut group by cut, user_id),
        seen as (select distinct user_id, last[2] as contract_tier, last[1] as updated_at from looks)
        select user_id, contract_tier, updated_at, updated_at as valid_from,
          lead(updated_at) over (partition by user_id order by updated_at) as valid_to from seen""",
    "seed_snapshot_dimension": f"""{_SEEDS}
        select user_id, contract_tier, updated_at as effective_start_date,
          coalesce(lead(updated_at) over w, timestamp '9999-12-31') as effective_end_date, lead(updated_at) over w is null as is_current
        from seen window w as (partition by user_id order by updated_at)""",
    "seed_snapshot_runs": f"""{_SEEDS}, first as (select user_id, updated_at, min(cut) as cut from looks group by 1, 2),
        runs as (select *, row_number() over (order by cut) - 1 as version from (select distinct cut from looks))
        select cast(version as int) as version,
          (select count(distinct user_id) from first f where f.cut <= r.cut) as user_tiers_open,
          (select count(*) from (select cut, row_number() over (partition by user_id order by updated_at) as place from first) f
           where f.cut = r.cut and place > 1) as user_tiers_closed
        from runs r""",
    "fact_point_in_time": f"with {_FACT} select event_id, user_id, ts, amount, version_key from fact",
    "fact_point_in_time_merge": f"with {_FACT} select event_id, user_id, ts, amount, version_key from fact",
    "version_coverage": f"with {_FACT} select count(*) as rows_total, count(*) - count(version_key) as rows_unmatched from fact",
    "missing_version_keys": f"""with {_VERSIONS} select user_id, count(*) as rows_fact from events
        where event_type = 'purchase' and user_id not in (select user_id from versions where contract_tier = 'Premium')
        group by user_id""",
    "fact_trips": f"with {_TRIP_FACT} select * from fact_trips",
    "unknown_member_usage": f"""with {_TRIP_FACT}
        select 'pu_location_key' as key_column, count(*) filter (pu_location_key = -1) as rows_unknown from fact_trips
        union all select 'vendor_key', count(*) filter (vendor_key = -1) from fact_trips""",
    "gross_net_measures": f"""with {_TRIPS} select vendor_id, count(*) as rows_total,
        count(*) filter (total_amount < 0) as rows_reversed,
        coalesce(cast(sum(cast(total_amount as decimal(18,2))) filter (not total_amount < 0) as double), 0) as gross,
        {_money("total_amount")} as net from trips group by vendor_id""",
    "attribution_type1_type2": f"""with {_MATRIX}, sides as (
          select type1 as attribute, amount as a1, 0 as a2 from matrix union all select type2, 0, amount from matrix)
        select attribute, cast(sum(a1) as double) as amount_type1, cast(sum(a2) as double) as amount_type2
        from sides group by attribute""",
    "misattributed_amount": f"""with {_MATRIX}, totals as (
          select coalesce(cast(sum(amount) filter (type1 is distinct from type2) as double), 0) as amount_misattributed,
            cast(sum(amount) as double) as amount_total,
            count(*) filter (type1 is distinct from type2) as rows_misattributed, count(*) as rows_total from matrix)
        select *, round(amount_misattributed / amount_total * 100, 2) as pct_misattributed from totals""",
    "fact_star_join": f"""with {_FACT} select event_id, amount, contract_tier as tier
        from fact left join versions using (version_key)""",
    "fact_current_join": f"""with {_VERSIONS} select event_id, value as amount, contract_tier as tier
        from events e left join versions v on e.user_id = v.user_id and v.is_current where e.event_type = 'purchase'""",
    "fact_location_join": f"""with {_TRIP_FACT}, places as (
          {_LOCATIONS})
        select borough, count(*) as n_rows, {_money("total_amount")} as revenue
        from fact_trips left join places on pu_location_key = location_key group by borough""",
    "check_not_null": f"with {_TRIPS} select order_key, line_number, part_key from trips where passenger_count is null",
    "check_unique": "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
    "check_relationships": """select o_custkey as key, count(*) as n from orders
        where o_custkey not in (select c_custkey from customer where c_acctbal > 0) group by 1""",
    "check_accepted_values": """select o_orderstatus as value, count(*) as n from orders
        where o_orderstatus not in ('O', 'F') group by 1""",
    "check_accepted_range": "select l_orderkey, l_linenumber, l_discount from lineitem where not l_discount > 0",
    "check_no_overlap": f"""with {_STRETCHED},
        reached as (select *, max(e) over (partition by user_id order by s, e, version_key
            rows between unbounded preceding and 1 preceding) as before from stretched)
        select user_id, version_key as later_version, s as later_start, before as earlier_end from reached where s < before""",
    "check_overlapping_pairs": f"""with {_STRETCHED}, placed as (
          select *, row_number() over (partition by user_id order by s, version_key) as place from stretched)
        select user_id, early.version_key as earlier_version, late.version_key as later_version,
          early.e as earlier_end, late.s as later_start
        from placed early join placed late using (user_id) where late.place > early.place and late.s < early.e and early.s < late.e""",
    **{
        f"fact_point_in_time_overlapping_{strategy}": f"""with {_STRETCHED} select event_id, p.user_id, p.ts, p.value as amount, version_key
          from events p left join stretched v on p.user_id = v.user_id and p.ts >= s and p.ts < e where event_type = 'purchase'"""
        for strategy in ("broadcast", "merge")
    },
    "scd2_same_day": """with days as (
          select user_id, date_trunc('day', ts) as day, max(case when value >= 100 then 'Premium' else 'Standard' end) as contract_tier
          from events where event_type in ('signup', 'error') group by 1, 2)
        select user_id, contract_tier, cast(day as timestamp) as effective_start_date,
          coalesce(cast(lead(day) over (partition by user_id order by day) as timestamp), timestamp '9999-12-31') as effective_end_date
        from days""",
    "check_overlap_sensitivity": f"""with {_VERSIONS} select * from (
          select user_id, lag(version_key) over w as earlier_version, version_key as later_version,
            effective_start_date as later_start from versions
          window w as (partition by user_id order by effective_start_date)) where earlier_version is not null""",
    "check_suite_report": f"""with {_TRIP_FACT}
        select 'dim_date' as "table", 'not_null' as "check", 'date_key' as "column", cast(0 as bigint) as failures
        union all select 'dim_date', 'not_null', 'full_date', 0
        union all select 'dim_date', 'accepted_values', 'is_weekend', 0
        union all select 'dim_date', 'unique', 'date_key', 0
        union all select 'dim_state', 'not_null', 'state_key', 0
        union all select 'dim_state', 'not_null', 'state_name', 0
        union all select 'dim_state', 'unique', 'state_key', 0
        union all select 'fct_trips', 'not_null', 'pickup_date_key', 0
        union all select 'fct_trips', 'not_null', 'total_amount', 0
        union all select 'fct_trips', 'accepted_values', 'service_type', count(*) from fact_trips where service_type not in ('A', 'N')
        union all select 'fct_trips', 'accepted_range', 'total_amount', count(*) from fact_trips where not total_amount > 0
        union all select 'fct_trips', 'relationships', 'pickup_date_key', 0
        union all select 'fct_trips', 'relationships', 'pu_location_key', count(*) from fact_trips
          where pu_location_key not in (select s_suppkey from supplier)""",
    "bronze_stream_counts": f"""select strftime(o_orderdate, '%Y-%m') as period, count(*) as rows_total,
        {_money("o_totalprice")} as revenue from orders group by 1""",
    "rescue_audit": """select strftime(o_orderdate, '%Y-%m') as period, count(*) as rows_total,
        count(*) filter (month(o_orderdate) >= 9) as rows_rescued,
        count(*) filter (month(o_orderdate) >= 9 and o_custkey < 50) as null_o_custkey from orders group by 1""",
    "bronze_recovered": """select o_orderkey as order_key, o_totalprice as total_price, o_orderdate as order_date,
        case when month(o_orderdate) < 9 or o_custkey >= 50 then o_custkey end as customer_key,
        case when month(o_orderdate) >= 9 and o_custkey < 50 then 'C-' || o_custkey end as rescued_customer,
        case when month(o_orderdate) >= 9 then lower(o_orderpriority) end as channel from orders""",
    "bronze_uniform_counts": "select o_orderstatus, count(*) as n_rows, cast(1 as bigint) as runs from orders group by 1",
    "inferred_feed_schema": """select * from (values ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
        ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string'), ('channel', 'string'))
        as t("column", "type")""",
    "version_history": """select 'orders' as name, version, operation, (select count(*) from orders) as rows
        from (values (0, 'REPLACE'), (1, 'CLUSTER'), (2, 'CLUSTER')) as t(version, operation)""",
    "published_split": f"""with {_CLASSIFIED} select service_type, count(*) filter (_quarantine_reason is null) as rows_clean,
        cast(sum(cast(total_amount as decimal(18,2))) filter (_quarantine_reason is null) as double) as revenue,
        count(_quarantine_reason) as rows_quarantined from classified group by 1""",
    "reference_csv": _LOCATIONS,
    "bronze_second_run": "select 'first' as run_id, count(*) as n_rows from orders",
    "schema_drift_report": """with files as (
          select distinct strftime(o_orderdate, '%Y-%m') as period,
            case when month(o_orderdate) <= 4 then 'early' when month(o_orderdate) <= 8 then 'middle' else 'late' end as kind from orders),
        kinds as (select distinct kind from files),
        described as (select * from (values
          ('early', 'o_orderkey', 'bigint'), ('early', 'o_custkey', 'bigint'), ('early', 'o_orderstatus', 'string'),
          ('early', 'o_totalprice', 'double'), ('early', 'o_orderdate', 'timestamp_ntz'), ('early', 'o_orderpriority', 'string'),
          ('middle', 'o_orderkey', 'bigint'), ('middle', 'o_custkey', 'int'), ('middle', 'o_orderstatus', 'string'),
          ('middle', 'o_totalprice', 'decimal(15,2)'), ('middle', 'o_orderdate', 'timestamp_ntz'), ('middle', 'o_orderpriority', 'string'),
          ('late', 'o_orderkey', 'bigint'), ('late', 'o_custkey', 'string'), ('late', 'o_orderstatus', 'string'),
          ('late', 'O_TotalPrice', 'double'), ('late', 'o_orderdate', 'timestamp_ntz'), ('late', 'o_orderpriority', 'string'),
          ('late', 'channel', 'string')) as d(kind, "column", "type")),
        seen as (select distinct "column", "type" from described join kinds using (kind))
        select "column", "type", count(*) over (partition by lower("column")) as n_variants from seen""",
    "schema_mismatches": """with kinds as (
          select distinct case when month(o_orderdate) <= 4 then 'early' when month(o_orderdate) <= 8 then 'middle' else 'late' end as kind from orders)
        select "column", "type", declared, problem from kinds join (values
          ('middle', 'o_totalprice', 'decimal(15,2)', 'double', 'type differs'),
          ('late', 'o_custkey', 'string', 'bigint', 'type differs'),
          ('late', 'channel', 'string', null, 'not in contract')) as d(kind, "column", "type", declared, problem) using (kind)""",
    "table_description": f"""with {_TRIPS} select position, "column", "type", (select count(*) from trips) as n_rows,
          case when "column" = 'passenger_count' then (select count(*) - count(passenger_count) from trips) else 0 end as n_null
        from (values
        (0, 'order_key', 'bigint'), (1, 'line_number', 'int'), (2, 'part_key', 'bigint'), (3, 'vendor_id', 'bigint'),
        (4, 'service_type', 'string'), (5, 'pickup_datetime', 'timestamp_ntz'), (6, 'dropoff_datetime', 'timestamp_ntz'),
        (7, 'trip_distance', 'double'), (8, 'passenger_count', 'double'), (9, 'fare_amount', 'double'),
        (10, 'total_amount', 'double'), (11, '_source_file', 'string')) as t(position, "column", "type")""",
    "manifest_completeness": """with months as (
          select strftime(unnest(generate_series(lo, hi, interval 1 month)), 'period=%Y-%m') as folder
          from (select date_trunc('year', min(o_orderdate)) as lo, date_trunc('month', max(o_orderdate)) as hi from orders)),
        present as (select distinct strftime(o_orderdate, 'period=%Y-%m') as folder from orders)
        select folder, case when p.folder is null then 'missing' when m.folder is null then 'unexpected' else 'present' end as status
        from months m full outer join present p using (folder)""",
    "clustered_day_query": f"{_RANGE_SUM} = 19970301",
    "clustered_range_query": f"{_RANGE_SUM} between 19970301 and 19970307",
    "unclustered_range_query": f"{_RANGE_SUM} between 19970301 and 19970307",
    "file_stats_summary": f"""with {_DAYS} select layout, count(*) as n_rows, min(pickup_date_key) as first_day,
        max(pickup_date_key) as last_day, min(o_orderkey) as first_order, max(o_orderkey) as last_order
        from days cross join (values ('plain'), ('clustered'), ('morton')) as t(layout) group by layout""",
    "clustered_opens_fewer": "select true as fewer",
    "landing_folders": "select distinct strftime(o_orderdate, 'period=%Y-%m') as folder, true as has_files from orders",
    "morton_rows": f"with {_DAYS} select o_orderkey, o_custkey, pickup_date_key, o_totalprice from days",
    "version_compare": """with spans as (
          select 0 as version, user_id, min(ts) as first_change from events where event_type = 'signup' group by user_id
          union all
          select 1, user_id, min(ts) from events where event_type in ('signup', 'error') group by user_id)
        select v.version, count(*) as rows_total, count(*) - count(first_change) as rows_unmatched
        from events e cross join (values (0), (1)) as v(version)
        left join spans s on e.user_id = s.user_id and s.version = v.version and e.ts >= first_change
        where event_type = 'purchase' group by v.version""",
    "preview_rows": "select o_orderkey, o_orderstatus, o_totalprice from orders order by o_orderkey limit 5",
    "mean_distance_by_service": """select l_returnflag as service_type, count(*) as n_rows,
        round(avg(l_quantity), 2) as mean_distance from lineitem group by 1""",
    "counts_by_status": "select o_orderstatus, count(*) as n_rows from orders group by 1",
}
