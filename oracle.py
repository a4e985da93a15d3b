"""DuckDB SQL for every query, written rule by rule and apart from the Spark code.

``BASE`` holds the adapter tables and the cleaning, one step per name; each query of
``QUERIES`` selects from those names.
"""

from __future__ import annotations


def _date_text(day: str, key: str) -> str:
    return (
        f"case {key} % 8 when 0 then strftime({day}, '%m/%d/%Y') "
        f"when 1 then strftime({day}, '%Y/%m/%d') when 2 then strftime({day}, '%d-%b-%Y') "
        f"else strftime({day}, '%Y-%m-%d') end"
    )


def _date(text: str) -> str:
    tries = ", ".join(
        f"try_strptime(trim({text}), '{f}')" for f in ("%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d", "%d-%b-%Y")
    )
    return f"cast(coalesce({tries}) as date)"


def _number(text: str) -> str:
    """Whole numbers however they are written; a cast alone would round 2.5."""
    digits = rf"regexp_full_match(trim({text}), '[+-]?\d+')"
    real = f"try_cast(trim({text}) as double)"
    whole = f"{real} = floor({real}) and abs({real}) < 9e18"
    return (
        f"case when {digits} then try_cast(trim({text}) as bigint) "
        f"when {whole} then try_cast({real} as bigint) end"
    )


def _tidy(text: str) -> str:
    return rf"nullif(trim(regexp_replace({text}, '\s+', ' ', 'g')), '')"


def _title(text: str) -> str:
    words = f"string_split(lower({text}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _carrier(text: str) -> str:
    spelling = f"lower({_tidy(text)})"
    return (
        f"case {spelling} when 'ups' then 'UPS' when 'usps' then 'USPS' when 'fedex' then 'FedEx' "
        f"when 'dhl' then 'DHL' when 'ontrac' then 'OnTrac' else {_title(_tidy(text))} end"
    )


def _unparsed(*columns: tuple[str, str]) -> str:
    """(raw column, typed expression) pairs to 'column=text, …' of the lost ones."""
    lost = ", ".join(
        f"case when {typed} is null and trim({raw}) <> '' then '{raw}=' || trim({raw}) end"
        for raw, typed in columns
    )
    return f"nullif(concat_ws(', ', {lost}), '')"


def _pct(part: str, whole: str) -> str:
    n, d = f"cast({part} as bigint)", f"nullif(cast({whole} as bigint), 0)"
    return f"cast((2000 * {n} + {d}) // (2 * {d}) as double) / 10"


def _mean(total: str, count: str) -> str:
    s, n = f"cast({total} as bigint)", f"nullif(cast({count} as bigint), 0)"
    size = f"((200 * abs({s}) + {n}) // (2 * {n}))"
    return f"cast(case when {s} < 0 then -{size} else {size} end as double) / 100"


def _distinct(source: str, columns: str, order: str) -> str:
    """First copy of each row; every group is one row of values, so only ordinals order it."""
    first = ", ".join(f"{c} nulls first" for c in (*order.split(", "), "unparsed"))
    return f"""select *, count(*) over (partition by {columns}) copies from {source}
        qualify row_number() over (partition by {columns} order by {first}) = 1"""


def _numbered(source: str, key: str, columns: str, order: str) -> str:
    order = ", ".join(f"{c} nulls first" for c in f"{order}, {columns}".split(", "))
    return f"select *, row_number() over (partition by {key} order by {order}) rn from {source}"


W = "warehouse_id, name, region, city, state"
O = "order_id, warehouse_id, order_date, customer_id, quantity, product_category"
S = (
    "shipment_id, order_id, carrier, ship_date, expected_delivery_date, "
    "actual_delivery_date, delay_reason"
)

BASE = f"""
with w_raw as (
  select cast(n_nationkey as varchar) warehouse_id, concat(' ', n_name, ' DC') name,
    case n_nationkey % 4 when 0 then upper(r_name) when 1 then concat(' ', lower(r_name))
      when 2 then concat(lower(r_name), '  ') else r_name end region,
    lower(n_name) city, lower(substr(r_name, 1, 2)) state
  from nation join region on n_regionkey = r_regionkey),
o_base as (
  select o_orderkey k, o_custkey ck, cast(o_orderdate as date) d, o_orderpriority pr,
    case when o_custkey % 50 = 0 then 99 when c_nationkey = 24 then 23 else c_nationkey end wid
  from orders join customer on o_custkey = c_custkey),
o_copies as (
  select k, ck, pr, wid, {_date_text('d', 'k')} od, 0 q, 0 ord from o_base
  union all select k, ck, pr, wid, strftime(d, '%Y-%m-%d'), 0, 0 from o_base where k % 50 = 7
  union all select k, ck, pr, wid, strftime(d, '%Y-%m-%d'), 1, 1 from o_base where k % 101 = 0),
o_raw as (
  select case when k % 211 = 0 then concat('x', cast(k as varchar))
      when k % 10 = 3 then lpad(cast(k as varchar), 10, '0') else cast(k as varchar) end order_id,
    cast(wid as varchar) warehouse_id,
    case when k % 307 = 0 then 'not-a-date' when k % 311 = 0 then '9999-12-31'
      when k % 313 = 0 then '01/01/1500' else od end order_date,
    case when k % 31 = 0 then null when k % 173 = 0 then 'oops'
      else cast(ck as varchar) end customer_id,
    case when k % 149 = 0 then '0' when k % 151 = 0 then '-3' when k % 401 = 0 then 'lots'
      when k % 403 = 0 then '2.5' when k % 407 = 0 then '12345678901234567890'
      when k % 409 = 0 then '7.0' when k % 419 = 0 then '1e3'
      else cast(1 + k % 12 + q as varchar) end quantity,
    case when k % 33 = 0 then '  ' when k % 4 = 0 then upper(pr)
      when k % 4 = 1 then concat(' ', lower(pr)) else pr end product_category,
    ord
  from o_copies),
s_base as (
  select l_orderkey * 10 + l_linenumber id, l_orderkey ok, l_partkey p, l_suppkey s, l_quantity q,
    l_linenumber ln, l_linestatus ls, cast(l_shipdate as date) ship,
    (l_partkey * 7 + l_suppkey * 3 + l_linenumber) % 13 h
  from lineitem),
s_planned as (
  select *, case when p % 127 = 0 then ship - 3 else ship + 2 + cast(ln % 4 as integer) end expd,
    case h when 9 then 1 when 10 then 2 when 11 then 6 when 12 then 14 when 0 then -1
      else 0 end slip,
    case (s + p) % 6 when 0 then 'FedEx' when 1 then 'UPS' when 2 then 'DHL' when 3 then 'USPS'
      when 4 then 'OnTrac' else 'LaserShip' end car
  from s_base),
s_done as (
  select *, case when ls = 'O' and h = 7 then null when p % 131 = 0 then ship - 1
    when p % 127 = 0 then ship else expd + slip end act
  from s_planned),
s_raw as (
  select cast(id as varchar) shipment_id, cast(ok as varchar) order_id,
    case when p % 40 = 0 then null when p % 5 = 0 then upper(car) when p % 5 = 1 then lower(car)
      when p % 5 = 2 then concat('  ', car, ' ') else car end carrier,
    case when p % 409 = 0 then '' else {_date_text('ship', 'p')} end ship_date,
    {_date_text('expd', 'p')} expected_delivery_date,
    {_date_text('act', 'p')} actual_delivery_date,
    case when act > expd and p % 11 <> 0 then case p % 5 when 0 then 'Weather'
      when 1 then 'carrier_delay ' when 2 then 'INVENTORY_SHORTAGE' when 3 then 'address_issue'
      else 'customs' end end delay_reason,
    p ord1, s ord2, q ord3
  from s_done),

w_typed as (
  select {_number('warehouse_id')} warehouse_id, {_tidy('name')} name,
    {_title(_tidy('region'))} region, {_title(_tidy('city'))} city, upper({_tidy('state')}) state,
    {_unparsed(('warehouse_id', _number('warehouse_id')))} unparsed,
    warehouse_id raw_id, region raw_region
  from w_raw),
o_parsed as (
  select {_number('order_id')} order_id, {_number('warehouse_id')} warehouse_id,
    {_date('order_date')} order_date, {_number('customer_id')} customer_id,
    {_number('quantity')} quantity, lower({_tidy('product_category')}) product_category,
    ord,
    {_unparsed(*[(c, _number(c)) for c in ('order_id', 'warehouse_id', 'customer_id', 'quantity')],
               ('order_date', _date('order_date')))} unparsed,
    order_id raw_id, customer_id raw_customer, product_category raw_category, order_date raw_date
  from o_raw),
o_typed as (
  select order_id, warehouse_id, order_date, coalesce(customer_id, 0) customer_id, quantity,
    coalesce(product_category, 'unknown') product_category, ord, unparsed, raw_id
  from o_parsed),
s_parsed as (
  select {_number('shipment_id')} shipment_id, {_number('order_id')} order_id,
    {_carrier('carrier')} carrier, {_date('ship_date')} ship_date,
    {_date('expected_delivery_date')} expected_delivery_date,
    {_date('actual_delivery_date')} actual_delivery_date,
    lower({_tidy('delay_reason')}) delay_reason, ord1, ord2, ord3,
    {_unparsed(('shipment_id', _number('shipment_id')), ('order_id', _number('order_id')),
               *[(c, _date(c)) for c in
                 ('ship_date', 'expected_delivery_date', 'actual_delivery_date')])} unparsed,
    shipment_id raw_id, carrier raw_carrier, delay_reason raw_reason, ship_date raw_ship,
    expected_delivery_date raw_expected, actual_delivery_date raw_actual
  from s_raw),
s_typed as (select * replace (coalesce(carrier, 'Unknown') as carrier) from s_parsed),

w_dist as ({_distinct('w_typed', W, 'warehouse_id')}),
o_dist as ({_distinct('o_typed', O, 'ord')}),
s_dist as ({_distinct('s_typed', S, 'ord1, ord2, ord3')}),

w_loaded as (select {W} from w_dist),

o_bad_number as (
  select *, 'not numeric: ' || concat_ws(', ', case when order_id is null then 'order_id' end,
      case when warehouse_id is null then 'warehouse_id' end,
      case when quantity is null then 'quantity' end) detail
  from o_dist where order_id is null or warehouse_id is null or quantity is null),
o1 as (
  select * from o_dist
  where order_id is not null and warehouse_id is not null and quantity is not null),
o1_numbered as ({_numbered('o1', 'order_id', O, 'ord')}),
o_conflict as (
  select *, 'order_id=' || order_id || ' already seen with different values' detail
  from o1_numbered where rn > 1),
o2 as (select * from o1_numbered where rn = 1),
o_no_date as (select *, 'NaT: order_date' detail from o2 where order_date is null),
o3 as (select * from o2 where order_date is not null),
o_quantity as (select *, 'quantity=' || quantity detail from o3 where quantity <= 0),
o4 as (select * from o3 where quantity > 0),
o_orphan as (
  select *, 'warehouse_id=' || warehouse_id detail
  from o4 where warehouse_id not in (select warehouse_id from w_loaded)),
o_loaded as (
  select {O} from o4 where warehouse_id in (select warehouse_id from w_loaded)),

s1_numbered as ({_numbered('s_dist', 'shipment_id', S, 'ord1, ord2, ord3')}),
s_conflict as (
  select *, 'shipment_id=' || shipment_id || ' already seen with different values' detail
  from s1_numbered where rn > 1),
s2 as (select * from s1_numbered where rn = 1),
s_no_date as (
  select *, 'NaT: ' || concat_ws(', ', case when ship_date is null then 'ship_date' end,
      case when expected_delivery_date is null then 'expected_delivery_date' end) detail
  from s2 where ship_date is null or expected_delivery_date is null),
s3 as (select * from s2 where ship_date is not null and expected_delivery_date is not null),
s_actual as (
  select *, concat('actual ', strftime(actual_delivery_date, '%Y-%m-%d'), ' < ship ',
      strftime(ship_date, '%Y-%m-%d')) detail
  from s3 where actual_delivery_date < ship_date),
s4 as (
  select * from s3 where actual_delivery_date is null or actual_delivery_date >= ship_date),
s_expected as (
  select *, concat('expected ', strftime(expected_delivery_date, '%Y-%m-%d'), ' < ship ',
      strftime(ship_date, '%Y-%m-%d')) detail
  from s4 where expected_delivery_date < ship_date),
s5 as (
  select * replace (case when actual_delivery_date > expected_delivery_date
      then coalesce(delay_reason, 'unknown') else delay_reason end as delay_reason),
    cast(actual_delivery_date - expected_delivery_date as integer) days_late,
    cast(actual_delivery_date <= expected_delivery_date as integer) on_time
  from s4 where expected_delivery_date >= ship_date),
s_orphan as (
  select *, 'order_id=' || order_id detail
  from s5 where order_id not in (select order_id from o_loaded)),
s_loaded as (
  select {S}, days_late, on_time from s5 where order_id in (select order_id from o_loaded)),

refused as (
  select 'orders' source_table, order_id as key, 'required numeric column unparseable' reason,
    detail, unparsed from o_bad_number
  union all select 'orders', order_id, 'duplicate primary key with conflicting values',
    detail, unparsed from o_conflict
  union all select 'orders', order_id, 'required date missing or unparseable',
    detail, unparsed from o_no_date
  union all select 'orders', order_id, 'quantity is not positive', detail, unparsed from o_quantity
  union all select 'orders', order_id, 'warehouse_id not found in warehouses',
    detail, unparsed from o_orphan
  union all select 'shipments', shipment_id, 'duplicate primary key with conflicting values',
    detail, unparsed from s_conflict
  union all select 'shipments', shipment_id, 'required date missing or unparseable',
    detail, unparsed from s_no_date
  union all select 'shipments', shipment_id, 'actual_delivery_date before ship_date',
    detail, unparsed from s_actual
  union all select 'shipments', shipment_id, 'expected_delivery_date before ship_date',
    detail, unparsed from s_expected
  union all select 'shipments', shipment_id, 'order_id not found in orders',
    detail, unparsed from s_orphan),

order_deliveries as (
  select order_id, count(*) shipped, count(on_time) arrived, sum(on_time) punctual
  from s_loaded group by order_id),
site_deliveries as (
  select warehouse_id, sum(shipped) shipped, sum(arrived) arrived, sum(punctual) punctual
  from order_deliveries join o_loaded using (order_id) group by warehouse_id),
on_time_by_warehouse as (
  select name warehouse, region, cast(coalesce(shipped, 0) as bigint) shipments,
    cast(coalesce(arrived, 0) as bigint) delivered,
    cast(coalesce(shipped - arrived, 0) as bigint) in_transit,
    {_pct('punctual', 'arrived')} on_time_pct
  from w_loaded left join site_deliveries using (warehouse_id)),
month_orders as (
  select strftime(order_date, '%Y-%m') as month, quantity, coalesce(shipped, 1) lines,
    coalesce(arrived, 0) arrived, coalesce(punctual, 0) punctual
  from o_loaded left join order_deliveries using (order_id)),
monthly_trend as (
  select month, cast(sum(lines) as bigint) orders, cast(sum(quantity * lines) as bigint) units,
    cast(sum(arrived) as bigint) delivered, cast(sum(lines) - sum(arrived) as bigint) in_transit,
    {_pct('sum(punctual)', 'sum(arrived)')} on_time_pct
  from month_orders group by month),
delay_reason_frequency as (
  select delay_reason, count(*) shipments,
    {_pct('count(*)', '(select count(*) from s_loaded where days_late > 0)')} share_pct,
    {_mean('sum(days_late)', 'count(days_late)')} avg_days_late, max(days_late) worst_days
  from s_loaded where delay_reason is not null group by delay_reason),
placed as (
  select o.warehouse_id, s.days_late, s.delay_reason
  from s_loaded s join o_loaded o on o.order_id = s.order_id),
votes as (
  select warehouse_id, delay_reason, count(*) n from placed
  where delay_reason is not null group by 1, 2)
"""


def _refused(reason: str) -> str:
    return f"select * from refused where reason = '{reason}'"


def _rejects_part(table: str, reason: str, source: str, columns: str, derived: str) -> str:
    return f"select '{table}' source_table, '{reason}' reason, detail, {columns}, {derived} from {source}"


_NO_W = "null::bigint warehouse_id, null::varchar name, null::varchar region, null::varchar city, null::varchar state"
_NO_O = "null::date order_date, null::bigint customer_id, null::bigint quantity, null::varchar product_category"
_NO_S = (
    "null::bigint shipment_id, null::varchar carrier, null::date ship_date, "
    "null::date expected_delivery_date, null::date actual_delivery_date, null::varchar delay_reason"
)
_NO_DERIVED = "null::integer days_late, null::integer on_time"
_O_WIDE = (
    f"warehouse_id, {_NO_W.split(', ', 1)[1]}, order_id, order_date, customer_id, quantity, "
    f"product_category, {_NO_S}"
)
_S_WIDE = f"{_NO_W}, order_id, {_NO_O}, " + S.replace("order_id, ", "")

_REJECTS = " union all ".join(
    [
        _rejects_part("orders", reason, source, _O_WIDE, f"{_NO_DERIVED}, unparsed")
        for reason, source in (
            ("required numeric column unparseable", "o_bad_number"),
            ("duplicate primary key with conflicting values", "o_conflict"),
            ("required date missing or unparseable", "o_no_date"),
            ("quantity is not positive", "o_quantity"),
            ("warehouse_id not found in warehouses", "o_orphan"),
        )
    ]
    + [
        _rejects_part("shipments", reason, source, _S_WIDE, f"{_NO_DERIVED}, unparsed")
        for reason, source in (
            ("duplicate primary key with conflicting values", "s_conflict"),
            ("required date missing or unparseable", "s_no_date"),
            ("actual_delivery_date before ship_date", "s_actual"),
            ("expected_delivery_date before ship_date", "s_expected"),
        )
    ]
    + [
        _rejects_part(
            "shipments",
            "order_id not found in orders",
            "s_orphan",
            _S_WIDE,
            "days_late, on_time, unparsed",
        )
    ]
)


def _profile_line(table: str, column: str, source: str, raw: str) -> str:
    def hits(fmt: str) -> str:
        return f"count(*) filter (where try_strptime(trim({raw}), '{fmt}') is not null)"

    return f"""select '{table}' source_table, '{column}' date_column, {hits('%Y-%m-%d')} iso,
      {hits('%m/%d/%Y')} us_slash, {hits('%Y/%m/%d')} iso_slash, {hits('%d-%b-%Y')} abbrev_month,
      count(*) filter (where coalesce(trim({raw}), '') = '') blank,
      count(*) filter (where trim({raw}) <> '' and {column} is null) unparseable from {source}"""


def _odd(raw: str, day: str) -> str:
    return f"({day} is not null and try_strptime(trim({raw}), '%Y-%m-%d') is null)"


def _stages(table: str, raw: str, dist: str, rejects: list[tuple[str, str | None]]) -> str:
    """Row counts step by step; each reject set shrinks the table by its own size."""
    lines = [
        f"select '{table}' source_table, 1 step, 'drop duplicate rows' as label, "
        f"(select count(*) from {raw}) rows_before, (select count(*) from {dist}) rows_after"
    ]
    before = f"(select count(*) from {dist})"
    for i, (reason, source) in enumerate(rejects):
        gone = f"(select count(*) from {source})" if source else "0"
        after = f"{before} - {gone}"
        lines.append(f"select '{table}', {i + 2}, 'reject: {reason}', {before}, {after}")
        before = after
    return " union all ".join(lines)


_BAD, _CONFLICT, _DATE = (
    "required numeric column unparseable",
    "duplicate primary key with conflicting values",
    "required date missing or unparseable",
)


def _split(population: str, source: str) -> str:
    return f"""select '{population}' population, count(*) filter (where days_late < 0) early,
      count(*) filter (where days_late = 0) on_the_day, count(*) filter (where days_late > 0) late,
      count(*) filter (where days_late is null) in_transit, count(delay_reason) reason_set,
      count(*) filter (where delay_reason is null) reason_null from {source}"""


def _violations(population: str, w: str, o: str, s: str) -> str:
    def rows(table: str, source: str, rule: str, broken: str) -> str:
        return (
            f"select '{population}' population, '{table}' source_table, '{rule}' as rule, "
            f"(select count(*) from {source} where {broken}) violations"
        )

    def unique(table: str, source: str, key: str) -> str:
        extra = f"(select count({key}) - count(distinct {key}) from {source})"
        return f"select '{population}', '{table}', '{key} unique', {extra}"

    lines = []
    for table, source, columns in (
        ("warehouses", w, W.split(", ")),
        ("orders", o, O.split(", ")),
        ("shipments", s, S.split(", ")[:5]),
    ):
        lines += [rows(table, source, f"{c} not null", f"{c} is null") for c in columns]
        lines.append(unique(table, source, columns[0]))
    reasons = "'weather', 'carrier_delay', 'inventory_shortage', 'address_issue', 'customs', 'unknown'"
    lines += [
        rows("orders", o, "quantity > 0", "quantity <= 0"),
        rows(
            "shipments", s, "expected_delivery_date >= ship_date", "expected_delivery_date < ship_date"
        ),
        rows("shipments", s, "actual_delivery_date >= ship_date", "actual_delivery_date < ship_date"),
        rows("shipments", s, "delay_reason in vocabulary", f"delay_reason not in ({reasons})"),
        rows("shipments", s, "on_time in (0, 1)", "on_time not in (0, 1)"),
        rows(
            "shipments",
            s,
            "days_late and on_time both known or neither",
            "(days_late is null) <> (on_time is null)",
        ),
        rows(
            "orders",
            f"{o} c",
            "warehouse_id in warehouses",
            f"c.warehouse_id is not null and not exists "
            f"(select 1 from {w} p where p.warehouse_id = c.warehouse_id)",
        ),
        rows(
            "shipments",
            f"{s} c",
            "order_id in orders",
            f"c.order_id is not null and not exists "
            f"(select 1 from {o} p where p.order_id = c.order_id)",
        ),
    ]
    return " union all ".join(lines)


def _violating_rows(w: str, o: str, s: str) -> str:
    reasons = "'weather', 'carrier_delay', 'inventory_shortage', 'address_issue', 'customs', 'unknown'"
    rules = [
        (table, source, columns[0], f"{c} not null", f"{c} is null")
        for table, source, columns in (
            ("warehouses", w, W.split(", ")),
            ("orders", o, O.split(", ")),
            ("shipments", s, S.split(", ")[:5]),
        )
        for c in columns
    ]
    rules += [("orders", o, "order_id", "quantity > 0", "quantity <= 0")]
    rules += [
        ("shipments", s, "shipment_id", rule, broken)
        for rule, broken in (
            ("expected_delivery_date >= ship_date", "expected_delivery_date < ship_date"),
            ("actual_delivery_date >= ship_date", "actual_delivery_date < ship_date"),
            ("delay_reason in vocabulary", f"delay_reason not in ({reasons})"),
            ("on_time in (0, 1)", "on_time not in (0, 1)"),
            (
                "days_late and on_time both known or neither",
                "(days_late is null) <> (on_time is null)",
            ),
        )
    ]
    lines = [
        f"select distinct '{table}' source_table, '{rule}' as rule, {key} as key from {source} where {broken}"
        for table, source, key, rule, broken in rules
    ]
    lines += [
        f"select '{table}', '{key} unique', {key} from {source} where {key} is not null "
        f"group by {key} having count(*) > 1"
        for table, source, key in (
            ("warehouses", w, "warehouse_id"), ("orders", o, "order_id"), ("shipments", s, "shipment_id")
        )
    ]
    lines += [
        f"select distinct '{table}', '{key} in {parent}', c.{key} from {source} c where c.{key} is not null "
        f"and not exists (select 1 from {above} p where p.{key} = c.{key})"
        for table, source, key, parent, above in (
            ("orders", o, "warehouse_id", "warehouses", w), ("shipments", s, "order_id", "orders", o)
        )
    ]
    return " union all ".join(lines)


_S_DIST_DERIVED = """(select *, cast(actual_delivery_date - expected_delivery_date as integer) days_late,
  cast(actual_delivery_date <= expected_delivery_date as integer) on_time from s_dist)"""

_LATE_DAYS = "case when s.days_late > 0 then s.days_late end"


def _rates(group: str, source: str, having: str, extra: str = "") -> str:
    """Lateness columns shared by the reports by region, carrier and pair."""
    return f"""select {group}, count(s.days_late) delivered,
      cast(coalesce(sum(cast(s.days_late > 0 as integer)), 0) as bigint) late{extra},
      {_mean('sum(s.days_late)', 'count(s.days_late)')} avg_net_days,
      {_mean(f'sum({_LATE_DAYS})', f'count({_LATE_DAYS})')} avg_when_late {having} {source}"""


_LATE_PCT = ", " + _pct("sum(cast(s.days_late > 0 as integer))", "count(s.days_late)") + " late_pct"
_ON_TIME_PCT = ", " + _pct("sum(s.on_time)", "count(s.on_time)") + " on_time_pct"

QUERIES = {
    "extract_warehouses": f"select {W} from w_raw",
    "extract_orders": f"select {O} from o_raw",
    "extract_shipments": f"select * exclude (ord1, ord2, ord3) replace (nullif(ship_date, '') as ship_date) from s_raw",
    "source_order": """
  select cast(o_custkey % 25 as varchar) warehouse_id, count(*) as rows,
    cast(arg_min(o_orderkey, place) as varchar) first_order,
    cast(arg_max(o_orderkey, place) as varchar) last_order
  from (
    select *, -o_orderkey + 1000000000000 * case
      when o_orderkey % 8 = 0 then 1 when o_orderkey % 8 = 1 then 2
      when o_orderkey % 8 < 4 then 3 else 4 end place
    from orders)
  group by 1""",
    "extract_line_breaks": """
  select cast(o_orderkey as varchar) order_id, cast(o_custkey as varchar) customer_id,
    case when o_orderkey % 3 = 0 then o_orderpriority || chr(10) || 'second, line' || chr(10) || o_orderkey
      when o_orderkey % 5 = 0 then 'say "' || o_orderpriority || '"' || chr(10)
      else o_orderpriority end product_category
  from orders
  union all select null, null, o_orderkey || ',a,b,c,d,e,f,g' from orders where o_orderkey % 97 = 0""",
    "reject_malformed": " union all ".join(
        f"""select '{table}' source_table, 'line does not have the table''s fields' reason,
          {key} || '{rest}' unparsed
        from {source} where regexp_full_match({key}, '[0-9]+') and cast({key} as bigint) % {every} = 0"""
        for table, source, key in (
            ("warehouses", "w_raw", "warehouse_id"),
            ("orders", "o_raw", "order_id"),
            ("shipments", "s_raw", "shipment_id"),
        )
        for every, rest in ((89, ',"half'), (97, ",a,b,c,d,e,f,g"))
    ),
    "clean_dates": """
      select 'orders' source_table, raw_id, order_date, null::date ship_date,
        null::date expected_delivery_date, null::date actual_delivery_date from o_parsed
      union all select 'shipments', raw_id, null, ship_date, expected_delivery_date,
        actual_delivery_date from s_parsed""",
    "clean_text": """
      select 'warehouses' source_table, raw_id, name, region, city, state,
        null::varchar product_category, null::varchar delay_reason from w_typed
      union all select 'orders', raw_id, null, null, null, null, product_category, null from o_parsed
      union all select 'shipments', raw_id, null, null, null, null, null, delay_reason from s_parsed""",
    "clean_carrier": "select raw_id, raw_carrier, carrier from s_parsed",
    "clean_numbers": """
      select 'warehouses' source_table, raw_id, warehouse_id, null::bigint order_id,
        null::bigint customer_id, null::bigint quantity, null::bigint shipment_id from w_typed
      union all select 'orders', raw_id, warehouse_id, order_id, customer_id, quantity, null
        from o_parsed
      union all select 'shipments', raw_id, null, order_id, null, null, shipment_id from s_parsed""",
    "clean_fill": """
      select 'orders' source_table, raw_id, customer_id, product_category, null::varchar carrier
        from o_typed
      union all select 'shipments', raw_id, null, null, carrier from s_typed""",
    "clean_dedup": f"""
      select 'warehouses' source_table, {W}, null::bigint order_id, {_NO_O}, {_NO_S}, copies
        from w_dist
      union all select 'orders', {_O_WIDE}, copies from o_dist
      union all select 'shipments', {_S_WIDE}, copies from s_dist""",
    "date_format_profile": " union all ".join(
        [
            _profile_line("orders", "order_date", "o_parsed", "raw_date"),
            _profile_line("shipments", "ship_date", "s_parsed", "raw_ship"),
            _profile_line("shipments", "expected_delivery_date", "s_parsed", "raw_expected"),
            _profile_line("shipments", "actual_delivery_date", "s_parsed", "raw_actual"),
        ]
    ),
    "unmapped_carriers": f"""
      select spelling, rows, cast(sum(rows) over () as bigint) total_rows,
        count(*) over () total_spellings
      from (select lower({_tidy('raw_carrier')}) spelling, count(*) as rows from s_parsed
        where lower({_tidy('raw_carrier')}) not in ('ups', 'usps', 'fedex', 'dhl', 'ontrac')
        group by 1)
      order by spelling limit 5""",
    "mess_profile": f"""
      select 'order_rows_folded' mess,
        (select count(*) from o_raw) - (select count(*) from o_dist) as rows
      union all select 'category_blank', count(*) from o_parsed where product_category is null
      union all select 'customer_blank', count(*) from o_parsed
        where coalesce(trim(raw_customer), '') = ''
      union all select 'orders_not_iso', count(*) from o_parsed where {_odd('raw_date', 'order_date')}
      union all select 'carrier_blank', count(*) from s_parsed where carrier is null
      union all select 'late_without_reason', count(*) from s_parsed
        where actual_delivery_date > expected_delivery_date and delay_reason is null
      union all select 'shipments_not_iso', count(*) from s_parsed
        where {_odd('raw_ship', 'ship_date')} or {_odd('raw_expected', 'expected_delivery_date')}
          or {_odd('raw_actual', 'actual_delivery_date')}
      union all select 'carrier_respelled', count(*) from s_parsed where raw_carrier <> carrier
      union all select 'region_respelled', count(*) from w_typed where raw_region <> region""",
    "reject_numeric": _refused(_BAD),
    "reject_pk": _refused(_CONFLICT),
    "reject_required_date": _refused(_DATE),
    "reject_actual_before_ship": _refused("actual_delivery_date before ship_date"),
    "reject_quantity": _refused("quantity is not positive"),
    "reject_expected_before_ship": _refused("expected_delivery_date before ship_date"),
    "reject_orphan_order": _refused("warehouse_id not found in warehouses"),
    "reject_orphan_shipment": _refused("order_id not found in orders"),
    "rejects_all": _REJECTS,
    "rejects_csv_roundtrip": f"""
  select * replace (
    case length(detail) % 4
      when 0 then 'say "' || detail || '",' || chr(10) || '\\n' || chr(13) || ' next '
      when 1 then ' ' when 2 then '' end as unparsed)
  from ({_REJECTS})""",
    "rejects_summary": "select source_table, reason, count(*) as rows from refused group by 1, 2",
    "stage_counts": " union all ".join(
        [
            _stages("warehouses", "w_raw", "w_dist", [(_BAD, None), (_CONFLICT, None)]),
            _stages(
                "orders",
                "o_raw",
                "o_dist",
                [
                    (_BAD, "o_bad_number"),
                    (_CONFLICT, "o_conflict"),
                    (_DATE, "o_no_date"),
                    ("quantity is not positive", "o_quantity"),
                    ("warehouse_id not found in warehouses", "o_orphan"),
                ],
            ),
            _stages(
                "shipments",
                "s_raw",
                "s_dist",
                [
                    (_BAD, None),
                    (_CONFLICT, "s_conflict"),
                    (_DATE, "s_no_date"),
                    ("actual_delivery_date before ship_date", "s_actual"),
                    ("expected_delivery_date before ship_date", "s_expected"),
                    ("order_id not found in orders", "s_orphan"),
                ],
            ),
        ]
    ),
    "derive_delivery": """select shipment_id, expected_delivery_date, actual_delivery_date,
      delay_reason, days_late, on_time from s5""",
    "delivery_split": _split("validated", "s5") + " union all " + _split("loaded", "s_loaded"),
    "loaded_warehouses": "select * from w_loaded",
    "loaded_orders": "select * from o_loaded",
    "loaded_shipments": "select * from s_loaded",
    "dates_as_text": """select shipment_id, strftime(ship_date, '%Y-%m-%d') ship_date,
      strftime(expected_delivery_date, '%Y-%m-%d') expected_delivery_date,
      strftime(actual_delivery_date, '%Y-%m-%d') actual_delivery_date from s_loaded""",
    "load_counts": """select 'warehouses' source_table, count(*) as rows from w_loaded
      union all select 'orders', count(*) from o_loaded
      union all select 'shipments', count(*) from s_loaded""",
    "fk_check": """select 'orders' source_table, 'warehouse_id in warehouses' as rule,
        count(*) violations from o_loaded o
        where not exists (select 1 from w_loaded w where w.warehouse_id = o.warehouse_id)
      union all select 'shipments', 'order_id in orders', count(*) from s_loaded s
        where not exists (select 1 from o_loaded o where o.order_id = s.order_id)""",
    "contract_violations": _violations("loaded", "w_loaded", "o_loaded", "s_loaded")
    + " union all "
    + _violations("unrefused", "w_dist", "o_dist", _S_DIST_DERIVED),
    "restrict_delete": """select w.warehouse_id, count(o.order_id) orders_held,
        cast(count(o.order_id) > 0 as integer) refused
      from w_loaded w left join o_loaded o on o.warehouse_id = w.warehouse_id group by 1""",
    "restrict_delete_applied": """
      with held as (select distinct warehouse_id from o_loaded)
      select 'without orders' attempt, 0 refused, warehouse_id from w_loaded
        where warehouse_id in (select warehouse_id from held)
      union all select 'all', cast(exists (select * from w_loaded
          where warehouse_id in (select warehouse_id from held)) as integer), warehouse_id
        from w_loaded
        where exists (select * from w_loaded where warehouse_id in (select warehouse_id from held))""",
    "cascade_delete": """select 'parent' side, order_id id, order_id from o_loaded
        where year(order_date) <> 1995
      union all select 'child', shipment_id, order_id from s_loaded
        where order_id in (select order_id from o_loaded where year(order_date) <> 1995)""",
    "violating_rows": _violating_rows("w_dist", "o_dist", _S_DIST_DERIVED),
    "publish_twice": " union all ".join(
        f"select '{table}' source_table, count(*) as old, count(*) as new, 0::bigint differing from {source}"
        for table, source in (
            ("warehouses", "w_loaded"), ("orders", "o_loaded"), ("shipments", "s_loaded")
        )
    ),
    "cascade_update": """
      select 'warehouses' source_table,
        case when region = 'Asia' then warehouse_id + 1000 else warehouse_id end warehouse_id,
        null::bigint order_id, null::bigint shipment_id from w_loaded
      union all select 'orders',
        case when region = 'Asia' then o.warehouse_id + 1000 else o.warehouse_id end,
        case when product_category = 'unknown' then -order_id else order_id end, null
        from o_loaded o join w_loaded w on o.warehouse_id = w.warehouse_id
      union all select 'shipments',
        case when region = 'Asia' then o.warehouse_id + 1000 else o.warehouse_id end,
        case when product_category = 'unknown' then -s.order_id else s.order_id end, shipment_id
        from s_loaded s join o_loaded o on o.order_id = s.order_id
        join w_loaded w on o.warehouse_id = w.warehouse_id""",
    "on_time_by_warehouse": "select * from on_time_by_warehouse",
    "days_late_by_region": _rates(
        "w.region",
        """from w_loaded w left join o_loaded o on o.warehouse_id = w.warehouse_id
           left join s_loaded s on s.order_id = o.order_id group by w.region""",
        ", max(s.days_late) worst_days",
        _LATE_PCT,
    ),
    "top_delay_reason_by_warehouse": f"""
      with sites as (
        select w.name,
          (select v.delay_reason from votes v where v.warehouse_id = w.warehouse_id
            order by v.n desc, v.delay_reason limit 1) reason,
          (select max(v.n) from votes v where v.warehouse_id = w.warehouse_id) most,
          (select count(*) from placed p
            where p.warehouse_id = w.warehouse_id and p.days_late > 0) late,
          (select count(*) from placed p
            where p.warehouse_id = w.warehouse_id and p.delay_reason = 'unknown') unknown
        from w_loaded w)
      select name warehouse, coalesce(reason, 'no delays recorded') top_reason,
        coalesce(most, 0) occurrences, late late_total, unknown unknown_cause,
        {_pct('most', 'late')} share_pct
      from sites""",
    "carrier_ranking": _rates(
        "s.carrier",
        "from s_loaded s group by s.carrier having count(s.on_time) > 0",
        ", max(s.days_late) worst_days",
        _ON_TIME_PCT,
    ),
    "monthly_trend": "select * from monthly_trend",
    "worst_warehouse_carrier_pairs": "select * exclude (warehouse_id) from ("
    + _rates(
        "w.warehouse_id, w.name warehouse, s.carrier",
        """from s_loaded s join o_loaded o on o.order_id = s.order_id
           join w_loaded w on w.warehouse_id = o.warehouse_id where s.carrier <> 'Unknown'
           group by w.warehouse_id, w.name, s.carrier having count(s.on_time) >= 30
           order by late_pct desc nulls last, w.warehouse_id, s.carrier limit 15""",
        "",
        _LATE_PCT,
    )
    + ")",
    "delay_reason_frequency": "select * from delay_reason_frequency",
    "monthly_trend_by_order": """
      with demand as (select strftime(order_date, '%Y-%m') as month, count(*) orders,
        cast(sum(quantity) as bigint) units from o_loaded group by 1)
      select month, d.orders, d.units, t.delivered, t.in_transit, t.on_time_pct
      from demand d join monthly_trend t using (month)""",
    "orders_per_month": """select strftime(order_date, '%Y-%m') as month, count(*) orders
      from o_loaded group by 1""",
    "delivery_totals": f"""select count(*) shipments, count(actual_delivery_date) delivered,
      count(*) filter (where actual_delivery_date is null) in_transit, count(delay_reason) late,
      {_pct('count(delay_reason)', 'count(*)')} late_pct from s_loaded""",
    "late_rate_by_carrier": f"""select carrier, {_pct('count(delay_reason)', 'count(*)')} late_pct,
      count(*) shipments from s_loaded group by 1""",
    "late_rate_by_warehouse": f"""select w.name warehouse, w.warehouse_id,
        {_pct('count(s.delay_reason)', 'count(*)')} late_pct, count(*) shipments
      from s_loaded s join o_loaded o on o.order_id = s.order_id
      join w_loaded w on w.warehouse_id = o.warehouse_id group by 1, 2""",
    "delay_reason_share": f"""select delay_reason, count(*) shipments,
        {_pct('count(*)', '(select count(*) from s_loaded where delay_reason is not null)')} share_pct
      from s_loaded where delay_reason is not null group by 1""",
    "delay_reason_by_warehouse": """
      select v.warehouse_id, v.delay_reason, v.n occurrences,
        cast((select count(*) from votes b where b.warehouse_id = v.warehouse_id
          and (b.n > v.n or (b.n = v.n and b.delay_reason <= v.delay_reason))) as integer)
          rank_in_warehouse,
        cast((select sum(b.n) from votes b where b.warehouse_id = v.warehouse_id) as bigint) explained
      from votes v""",
    "warehouse_vs_network": """
      with sites as (select *, cast(round(on_time_pct * 10) as bigint) tenths
        from on_time_by_warehouse where on_time_pct is not null),
      network as (select cast(sum(tenths * delivered) as bigint) t, cast(sum(delivered) as bigint) n
        from sites)
      select warehouse, on_time_pct, delivered, cast((2 * t + n) // (2 * n) as double) / 10 network_pct,
        tenths * n < t below_network from sites, network""",
    "trailing_month": """select month, in_transit, on_time_pct, in_transit > 0 incomplete
      from monthly_trend order by month desc limit 1""",
    "delay_reason_chart": """select replace(delay_reason, '_', ' ') as label, shipments, share_pct,
        delay_reason = 'unknown' muted,
        (select cast(sum(shipments) as bigint) from delay_reason_frequency) total,
        (select max(shipments) from delay_reason_frequency) longest
      from delay_reason_frequency""",
}


def oracle_sql() -> dict[str, str]:
    def whole(body: str) -> str:
        body = body.strip()
        if body.startswith("with "):
            return f"{BASE}, {body[5:]}"
        return f"{BASE} {body}"

    return {name: whole(body) for name, body in QUERIES.items()}
