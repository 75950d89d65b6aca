"""DuckDB SQL with the results the registered queries must give."""

from __future__ import annotations

_AS_OF = "timestamp '2000-06-30 00:00:00'"

# Order lines as raw trips, then in the clean table's names and types.
_LINES = """lines as (
    select * replace (nullif(l_linenumber, 7) as l_quantity) from lineitem
),
typed as (
    select cast(l_orderkey as int) as order_id,
           cast(l_partkey as int) as part_id,
           cast(l_suppkey as int) as supplier_id,
           cast(l_linenumber as int) as line_number,
           cast(l_quantity as int) as quantity,
           cast(l_extendedprice as decimal(10,2)) as price,
           cast(l_discount as decimal(10,2)) as discount,
           cast(l_tax as decimal(10,2)) as tax,
           l_returnflag as return_flag,
           l_linestatus as line_status,
           l_shipdate as shipped_at,
           cast(l_shipdate as date) as ship_date,
           cast(year(l_shipdate) as int) as ship_year,
           cast(month(l_shipdate) as int) as ship_month
    from lines
)"""

_TIP = """* replace (cast(cast(price as decimal(12,2)) * cast(tax as decimal(4,2))
    as decimal(10,2)) as tax)"""

_TRIPS = f"{_LINES}, trips as (select {_TIP} from typed)"

_MASK = f"""(supplier_id is null or shipped_at is null or discount <= 0 or price < 0
    or tax < 0 or quantity <= 0 or shipped_at > {_AS_OF})"""

_MASK_ANY_TIME = _MASK.replace(f" or shipped_at > {_AS_OF}", "")

_ROUTED = f"{_TRIPS}, routed as (select *, {_MASK} as bad from trips)"

_TRIP_COLUMNS = """order_id, part_id, supplier_id, line_number, quantity,
    cast(price as double) as price, cast(discount as double) as discount,
    cast(tax as double) as tax, return_flag, line_status,
    cast(shipped_at as varchar) as shipped_at, cast(ship_date as varchar) as ship_date,
    ship_year, ship_month"""

_FIRST_PER_KEY = """qualify row_number() over (
    partition by order_id, line_number
    order by part_id nulls first, supplier_id nulls first, quantity nulls first,
             price nulls first, discount nulls first, tax nulls first,
             return_flag nulls first, line_status nulls first, shipped_at nulls first) = 1"""

_CHECKED = f"{_LINES}, routed as (select *, {_MASK} as bad from typed)"

_SILVER = f"{_CHECKED}, silver as (select * from routed where not bad {_FIRST_PER_KEY})"

_TIPPED = f"{_SILVER}, tipped as (select {_TIP} from silver)"


def _mean(column: str) -> str:
    """Mean of a non-negative 2-decimal column, half up at 6 places, then at 2.

    Integer arithmetic throughout; the engine's own avg works in doubles.
    """
    six = f"((cast(sum({column} * 100) as hugeint) * 20000 + count(*)) // (2 * count(*)))"
    return f"cast(({six} + 5000) // 10000 as double) / 100"


def _daily(source: str, key: str, amount: str, distance: str, tip: str) -> str:
    return f"""
select cast({key} as varchar) as {key},
       count(*) as trip_count,
       cast(sum({amount}) as double) as total_revenue,
       {_mean(amount)} as avg_revenue,
       {_mean(distance)} as avg_distance,
       {_mean(tip)} as avg_tip,
       cast(count(*) filter (where {tip} > 0) as bigint) as tipped_trips,
       count(*) as total_trips,
       round(cast(count(*) filter (where {tip} > 0) as double) / count(*) * 100, 1)
           as tip_percentage
from {source} group by {key}"""


def _location(source: str) -> str:
    return f"""
select *,
       cast(dense_rank() over (order by trip_count desc) as int) as rank_by_trips,
       cast(dense_rank() over (order by total_revenue desc) as int) as rank_by_revenue
from (
    select supplier_id, count(*) as trip_count,
           cast(sum(price) as double) as total_revenue,
           {_mean("price")} as avg_revenue, {_mean("discount")} as avg_distance
    from {source} group by supplier_id)"""


def _monthly(source: str, year: str, month: str, amount: str, people: str) -> str:
    growth = "(total_revenue - prev_month_revenue) / nullif(prev_month_revenue, 0) * 100"
    return f"""
select *, round({growth}, 1) as revenue_growth_pct
from (
    select *, lag(total_revenue) over (order by {year}, {month}) as prev_month_revenue
    from (
        select {year}, {month}, count(*) as trip_count,
               cast(sum({amount}) as double) as total_revenue,
               {_mean(amount)} as avg_revenue,
               round(avg({people}), 1) as avg_passengers
        from {source} group by {year}, {month}))"""


def _category(source: str) -> str:
    return f"""
select line_number, count(*) as trip_count,
       cast(sum(price) as double) as total_revenue, {_mean("tax")} as avg_tip,
       {_LABEL.format(code="line_number")} as payment_label
from {source} group by line_number"""


_LABEL = """case {code} when 1 then 'Credit card' when 2 then 'Cash'
    when 3 then 'No charge' when 4 then 'Dispute' when 5 then 'Unknown'
    when 6 then 'Voided' else 'Other' end"""

_RAW_LINES = """cast(l_orderkey as bigint) as l_orderkey,
    cast(l_partkey as bigint) as l_partkey, cast(l_suppkey as bigint) as l_suppkey,
    cast(l_linenumber as bigint) as l_linenumber,
    cast(l_quantity as double) as l_quantity,
    cast(l_extendedprice as double) as l_extendedprice,
    cast(l_discount as double) as l_discount,
    cast({tax} as double) as l_tax,
    l_returnflag, l_linestatus, cast(l_shipdate as varchar) as l_shipdate"""

_NO_LATE_TAX = "case when l_linenumber <= 5 then l_tax end"


def _check(source: str, name: str, column: str, observed: str, expected: str, ok: str):
    return f"""select '{name}' as "check", '{column}' as "column",
    cast({observed} as bigint) as observed, '{expected}' as expected, {ok} as passed
    from {source}"""


def _none(source: str, name: str, column: str, condition: str) -> str:
    count = f"count(*) filter (where {condition})"
    return _check(source, name, column, count, "= 0", f"{count} = 0")


def _at_least(source: str, name: str, rows: int) -> str:
    return _check(source, name, "", "count(*)", f">= {rows}", f"count(*) >= {rows}")


def _unique(source: str, *keys: str) -> str:
    per_key = f"(select count(*) as n from {source} group by {', '.join(keys)})"
    extra = "coalesce(sum(n - 1), 0)"
    return _check(per_key, "no_duplicates", ",".join(keys), extra, "= 0", f"{extra} = 0")


def _has(column: str, present: bool) -> str:
    return f"""select 'has_column' as "check", '{column}' as "column",
    cast({int(present)} as bigint) as observed, '= 1' as expected, {present} as passed"""


def _with(ctes: str, body: str) -> str:
    return f"with {ctes.strip()} {body}"


def oracle_sql() -> dict[str, str]:
    union = " union all ".join
    silver_columns = f"select {_TRIP_COLUMNS} from"
    return {
        # The id's fraction is cut; a quarter of the ids are not numbers.
        "standardize_columns": f"""select * replace (
            case when l_partkey % 4 <> 2 then l_orderkey end as l_orderkey)
            from (select {_RAW_LINES.format(tax='l_tax')} from lineitem)""",
        "lowercase_columns": "select * from customer",
        "cast_out_of_range": """
select o_orderkey,
       case when o_orderkey * 1000000 <= 2147483647
            then cast(o_orderkey * 1000000 as int) end as big_id,
       case when round(o_totalprice * 1000, 2) < 100000000
            then round(o_totalprice * 1000, 2) end as big_amount,
       cast(trunc(o_totalprice / 4) as int) as quarter
from orders""",
        "rename_cast_silver": """
select cast(l_orderkey as int) as order_id, cast(l_partkey as int) as part_id,
       cast(l_suppkey as int) as supplier_id, cast(l_linenumber as int) as line_number,
       cast(trunc(l_quantity) as int) as quantity, l_extendedprice as price,
       l_discount as discount, l_tax as tax, l_returnflag as return_flag,
       l_linestatus as line_status, cast(l_shipdate as varchar) as shipped_at
from lineitem""",
        "date_parts": """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       cast(o_orderdate as varchar) as o_orderdate, o_orderpriority,
       cast(cast(o_orderdate as date) as varchar) as order_date,
       cast(year(o_orderdate) as int) as order_year,
       cast(month(o_orderdate) as int) as order_month
from orders""",
        "union_by_name_drift": """
select c_custkey as partykey, c_name as name, c_nationkey as nationkey,
       c_acctbal as acctbal, c_mktsegment as mktsegment from customer
union all
select s_suppkey, s_name, s_nationkey, s_acctbal, null from supplier""",
        "new_files_anti_join": """
select page_id, file_name
from (select page_id, split_part(url, '/', -1) as file_name from pages)
where file_name not in (select cast(doc_id as varchar) from documents)""",
        "ledger_file_names": """
select distinct event_type || ' +' || user_id || '.parquet' as file_name
from events where event_type <> 'error'""",
        "split_valid": _with(_ROUTED, f"{silver_columns} routed where not bad"),
        "split_quarantine": _with(_ROUTED, f"{silver_columns} routed where bad"),
        "split_unroutable": _with(_ROUTED, f"{silver_columns} routed where bad is null"),
        "route_counts": _with(
            _ROUTED,
            """select case when bad then 'quarantine' when not bad then 'valid'
            else 'unroutable' end as route, count(*) as rows from routed group by 1""",
        ),
        "dedup_composite_key": _with(_TRIPS, f"{silver_columns} trips {_FIRST_PER_KEY}"),
        "duplicate_keys": _with(
            _TRIPS,
            """select order_id, line_number, count(*) as copies
            from trips group by 1, 2 having count(*) > 1""",
        ),
        "quality_results": _with(
            _TRIPS,
            union(
                [
                    _at_least("trips", "not_empty", 1),
                    _at_least("trips", "min_rows", 1),
                    *[
                        _none("trips", "no_nulls", c, f"{c} is null")
                        for c in ("order_id", "line_number", "supplier_id", "shipped_at")
                    ],
                    _unique("trips", "order_id", "line_number"),
                    *[
                        _none("trips", "non_negative", c, f"{c} < 0")
                        for c in ("price", "discount", "tax")
                    ],
                    *[
                        _has(c, True)
                        for c in (
                            "order_id",
                            "line_number",
                            "ship_date",
                            "ship_year",
                            "ship_month",
                        )
                    ],
                    _has("_silver_processed_at", False),
                ]
            ),
        ),
        "quality_customers": union(
            [
                _at_least("customer", "not_empty", 1),
                _at_least("customer", "min_rows", 1_000_000_000),
                _none("customer", "no_nulls", "c_custkey", "c_custkey is null"),
                _none("customer", "no_nulls", "c_name", "c_name is null"),
                _none("customer", "non_negative", "c_acctbal", "c_acctbal < 0"),
                _unique("customer", "c_custkey"),
                _unique("customer", "c_nationkey", "c_mktsegment"),
                _has("c_acctbal", True),
                _has("C_ACCTBAL", False),
            ]
        ),
        "daily_summary": _with(
            _TRIPS, _daily("trips", "ship_date", "price", "discount", "tax")
        ),
        "location_summary": _with(_TRIPS, _location("trips")),
        "monthly_trends": _with(
            _TRIPS, _monthly("trips", "ship_year", "ship_month", "price", "quantity")
        ),
        "category_summary": _with(_TRIPS, _category("trips")),
        "top_k_locations": _with(
            _TRIPS, f"select * from ({_location('trips')}) where rank_by_revenue <= 10"
        ),
        "preview_days": _with(
            _TRIPS,
            f"""{_daily("trips", "ship_date", "price", "discount", "tax")}
            order by 1 limit 10""",
        ),
        "label_codes": f"""
select l_orderkey, nullif(l_linenumber, 2) as code,
       {_LABEL.format(code="nullif(l_linenumber, 2)")} as label
from lineitem""",
        "global_rank_scaled": _with(
            _TRIPS,
            """select *,
               cast(dense_rank() over (order by trip_count desc) as int) as rank_by_trips,
               cast(dense_rank() over (order by total_revenue desc) as int)
                   as rank_by_revenue
            from (select part_id, count(*) as trip_count,
                         cast(sum(price) as double) as total_revenue
                  from trips group by part_id)""",
        ),
        "order_month_trends": _with(
            """o as (select year(o_orderdate)::int as order_year,
                     month(o_orderdate)::int as order_month,
                     cast(o_totalprice as decimal(10,2)) as amount, o_custkey from orders)""",
            _monthly("o", "order_year", "order_month", "amount", "o_custkey"),
        ),
        "event_day_summary": _with(
            """e as (select cast(ts as date) as event_date,
                     cast(value as decimal(10,2)) as value from events)""",
            _daily("e", "event_date", "value", "value", "value"),
        ),
        "silver_end_to_end": _with(_SILVER, f"{silver_columns} silver"),
        "gold_daily_from_silver": _with(
            _TIPPED, _daily("tipped", "ship_date", "price", "discount", "tax")
        ),
        "gold_location_from_silver": _with(_TIPPED, _location("tipped")),
        "gold_monthly_from_silver": _with(
            _TIPPED, _monthly("tipped", "ship_year", "ship_month", "price", "quantity")
        ),
        "gold_category_from_silver": _with(_TIPPED, _category("tipped")),
        "ingest_batch": _with(
            _LINES,
            f"""select {_RAW_LINES.format(tax=_NO_LATE_TAX)}, 'batch_1' as _batch_id
            from lines""",
        ),
        "ingest_many_batches": _with(
            _LINES,
            f"""select {_RAW_LINES.format(tax=_NO_LATE_TAX)}, 'batch_1' as _batch_id
            from lines""",
        ),
        "ingest_metadata": """
select case when l_linenumber <= 2 then 'early' when l_linenumber <= 5 then 'middle'
            else 'late' end as kind,
       count(*) as rows, true as source_listed, true as time_in_run,
       cast(1 as bigint) as times, true as id_from_clock
from lineitem group by 1""",
        "silver_metadata": _with(
            f"""{_late_tax(_LINES)}, routed as (select *, {_MASK_ANY_TIME} as bad from typed),
            silver as (select * from routed where not bad {_FIRST_PER_KEY})""",
            """select count(*) as rows, cast(0 as int) as metadata_left,
            cast(1 as bigint) as times, true as time_in_run from silver""",
        ),
        "order_of_months": """
select cast(year(l_shipdate) as int) as ship_year,
       cast(month(l_shipdate) as int) as ship_month,
       cast(row_number() over (order by year(l_shipdate), month(l_shipdate)) as int) as place
from lineitem group by year(l_shipdate), month(l_shipdate)""",
        "order_of_categories": """
select cast(l_linenumber as int) as line_number, count(*) as trip_count,
       cast(row_number() over (order by count(*) desc, l_linenumber) as int) as place
from lineitem group by l_linenumber""",
        "ingest_ledger": """
select 'batch_1' as _batch_id, count(*) as rows from lineitem
union all select 'batch_2', count(*) from lineitem""",
        "ledger_compacted": """
select 'batch_' || n as _batch_id, count(*) as rows, true as once
from lineitem cross join range(1, 4) t(n) group by n""",
        "ingest_reconciled": """
select case when l_linenumber <= 2 then 'early' when l_linenumber <= 5 then 'middle'
            else 'late' end as kind,
       count(*) as footer_rows, count(*) as rows, count(*) as stored_rows
from lineitem group by 1""",
        "ingest_file_sizes": """
select raw, count(*) as rows, true as few_files, true as none_large
from lineitem cross join (values ('small'), ('large')) r(raw) group by raw""",
        "ingest_stream": _with(
            _LINES,
            f"select {_RAW_LINES.format(tax='l_tax')}, 'batch_1' as _batch_id from lines",
        ),
        "ingest_stream_drift": _with(
            _LINES,
            f"""select {_RAW_LINES.format(tax=_NO_LATE_TAX)},
            'batch_1-00000000' as _batch_id from lines""",
        ),
        "gold_snapshot": _with(
            _late_tax(_SILVER),
            """
select "table", count(*) as rows, cast(sum(trips) as bigint) as trips from (
    select 'daily_summary' as "table", count(*) as trips from silver group by ship_date
    union all select 'location_summary', count(*) from silver group by supplier_id
    union all select 'monthly_trends', count(*) from silver group by ship_year, ship_month
    union all select 'payment_type_summary', count(*) from silver group by line_number)
group by "table\"""",
        ),
        "rejected_rows": _with(
            _late_tax(_CHECKED),
            f"{silver_columns.replace(' from', '')}, 'batch_1' as _batch_id"
            " from routed where bad",
        ),
        "run_report": _with(
            f"""{_late_tax(_SILVER)},
            counts as (select count(*) filter (where bad) as q,
                              count(*) filter (where bad is null) as u,
                              count(*) as n from routed)""",
            """
select 'ingest' as stage, 'batch_1' as "table", null as rows_in, n as rows_out from counts
union all select 'clean', 'quarantine', n, q from counts
union all select 'clean', 'unroutable', n, u from counts
union all select 'clean', 'silver', n - q - u, (select count(*) from silver) from counts
union all select 'validate', 'silver', null, 16
union all select 'aggregate', 'daily_summary', null, count(distinct ship_date) from silver
union all select 'aggregate', 'location_summary', null, count(distinct supplier_id) from silver
union all select 'aggregate', 'monthly_trends', null,
    count(distinct (ship_year, ship_month)) from silver
union all select 'aggregate', 'payment_type_summary', null,
    count(distinct line_number) from silver""",
        ),
    }


def _late_tax(ctes: str) -> str:
    """The drifting files lack the tax of lines 6 and 7."""
    return ctes.replace("cast(l_tax as", f"cast({_NO_LATE_TAX} as")
