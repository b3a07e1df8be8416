"""For each registered query the same result in SQL for DuckDB.

Written against the definitions, not against the Spark code: one common set of CTEs for the
lines, the star and the models, then one statement per query.
"""

from __future__ import annotations

from tidelane import params as fixed


def rnd(x: str, digits: int) -> str:
    return f"round(cast({x} as decimal(38,10)), {digits})"


def out(x: str, digits: int = 2) -> str:
    """Rounded, as double."""
    return f"cast({rnd(x, digits)} as double)"


def pct(a: str, b: str) -> str:
    return f"(100e0 * cast({a} as double) / nullif(cast({b} as double), 0e0))"


def avg(total: str, n: str) -> str:
    return f"(cast({total} as double) / nullif(cast({n} as double), 0e0))"


def count_if(condition: str) -> str:
    return f"cast(sum(case when {condition} then 1 else 0 end) as bigint)"


def dbl(x: str) -> str:
    return f"cast({x} as double)"


def big(x: str) -> str:
    return f"cast({x} as bigint)"


def money(x: str) -> str:
    """Sum of amounts rounded to cents, exact."""
    return f"round({x}, 2)"


def sigma(n: str, total: str, squares: str, sample: bool) -> str:
    cells = f"{dbl(n)} * {dbl(f'({n} - 1)' if sample else n)}"
    spread = f"cast(cast({n} as hugeint) * cast({squares} as hugeint) - cast({total} as hugeint) * cast({total} as hugeint) as double)"
    return f"coalesce(sqrt({spread} / nullif({cells}, 0e0)), 0e0)"


def var_pop(n: str, total: str, squares: str) -> str:
    spread = f"cast(cast({n} as hugeint) * cast({squares} as hugeint) - cast({total} as hugeint) * cast({total} as hugeint) as double)"
    return f"({spread} / ({dbl(n)} * {dbl(n)}))"


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


MODE = "case o_orderpriority when '1-URGENT' then 'Same Day' when '2-HIGH' then 'First Class' when '3-MEDIUM' then 'Second Class' else 'Standard Class' end"
PROMISE = "case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 when '3-MEDIUM' then 2 else 4 end"
DAYS = "cast(((date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) % 7) + 7) % 7 as integer)"
PRICE = "cast(l_extendedprice as decimal(18,2))"
RATE = "cast(l_discount as decimal(18,2))"
MARGIN = f"cast(cast(0.30 as decimal(18,2)) - 2 * {RATE} - case when l_returnflag = 'R' then cast(0.45 as decimal(18,2)) else cast(0 as decimal(18,2)) end as decimal(18,2))"
SALES = f"cast({PRICE} * (1 - {RATE}) as decimal(18,4))"
PROFIT = f"cast({PRICE} * {MARGIN} as decimal(18,4))"

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: list[str], sql: str) -> None:
    CTES[name] = (needs, sql)


cte("staged", [], f"""
  select l_orderkey * 10 + l_linenumber as order_item_id, o_orderkey as order_id, o_orderdate as order_date,
    l_shipdate as shipping_date, l_partkey as product_id, o_custkey as customer_id, r_name as market,
    n_name as order_region, cast(null as varchar) as order_city, n_name as order_country,
    {MODE} as shipping_mode, o_orderstatus as order_status, cast(l_quantity as integer) as quantity_ordered,
    cast(p_retailprice as decimal(18,4)) as product_price, cast({RATE} as decimal(9,4)) as discount_rate,
    cast({PRICE} * {RATE} as decimal(18,4)) as discount_amount, {SALES} as sales_amount,
    {PROFIT} as profit_per_order,
    cast({PROFIT} as double) / nullif(cast({SALES} as double), 0e0) as profit_ratio,
    cast({PROMISE} as integer) as days_scheduled, {DAYS} as days_real,
    case when {DAYS} > {PROMISE} then 'Late delivery' when {DAYS} = {PROMISE} then 'Shipping on time'
      else 'Advance shipping' end as delivery_status,
    cast(case when {DAYS} > {PROMISE} then 1 else 0 end as integer) as late_delivery_risk,
    c_mktsegment as customer_segment, n_name as customer_country, p_name as product_name,
    p_type as category_name, p_brand as department_name, c_name, c_acctbal, c_nationkey,
    cast(l_tax as decimal(4,2)) as tax, cast(l_quantity as integer) as qty, l_returnflag, l_linestatus,
    row_number() over (partition by l_orderkey * 10 + l_linenumber
      order by l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) as copy_no,
    l_suppkey, l_extendedprice
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    join part on l_partkey = p_partkey""")

FACT_HEAD = """order_item_id, order_id, order_date, shipping_date, product_id, customer_id, market, order_region,
    order_city, order_country, shipping_mode, order_status, quantity_ordered, product_price, discount_rate,
    discount_amount, sales_amount, profit_per_order, profit_ratio"""

cte("fact", ["staged"], f"""
  select {FACT_HEAD}, greatest(1, days_scheduled) as days_scheduled, days_real,
    days_real - greatest(1, days_scheduled) as delay_days, delivery_status, late_delivery_risk
  from staged where copy_no = 1""")

cte("products", [], """
  select p_partkey as product_id, p_name as product_name, p_type as category_name, p_brand as department_name,
    cast(p_retailprice as decimal(18,4)) as product_price from part""")

cte("customers", [], """
  select c_custkey as customer_id, c_mktsegment as customer_segment, n_name as customer_country
  from customer join nation on c_nationkey = n_nationkey""")

# typed lines with their faults, copies included
cte("typed", ["staged"], """
  select order_item_id, order_id,
    case when tax = 0.07 and l_returnflag = 'R' then null else order_date end as order_date,
    case when tax = 0.07 and l_returnflag = 'A' then null else shipping_date end as shipping_date,
    product_id, customer_id,
    case when tax = 0.01 then null else market end as market,
    case when qty = 3 then null else order_region end as order_region,
    order_city, order_country,
    case when tax = 0.02 then null else shipping_mode end as shipping_mode,
    case when qty = 2 then null else order_status end as order_status,
    case when tax = 0.04 then -1 else quantity_ordered end as quantity_ordered,
    case when tax = 0.08 then null else product_price end as product_price,
    case when tax = 0.03 then null else discount_rate end as discount_rate,
    case when tax = 0.03 then null else discount_amount end as discount_amount,
    case when qty = 5 then cast(-5 as decimal(18,4)) when qty = 6 then null else sales_amount end as sales_amount,
    case when qty = 4 then null else profit_per_order end as profit_per_order,
    case when qty = 7 then null else days_scheduled end as days_scheduled,
    case when tax = 0.06 then -2 else days_real end as days_real,
    case when qty = 1 then null else delivery_status end as delivery_status,
    cast(case when qty = 8 then 1 when qty in (9, 10) then 0 else late_delivery_risk end as integer)
      as late_delivery_risk,
    case when c_acctbal < 0 then null else lpad(cast(c_nationkey as varchar), 5, '0') end as customer_zipcode,
    customer_segment, customer_country, product_name, category_name, department_name,
    copy_no, shipping_date as pos1, l_suppkey as pos2, quantity_ordered as pos3, l_extendedprice as pos4
  from staged""")

cte("clean", ["typed"], """
  select order_item_id, order_id, order_date, shipping_date, product_id, customer_id,
    coalesce(market, 'UNKNOWN') as market, coalesce(order_region, 'UNKNOWN') as order_region, order_city,
    order_country, coalesce(shipping_mode, 'Standard Class') as shipping_mode,
    coalesce(order_status, 'UNKNOWN') as order_status,
    greatest(1, coalesce(quantity_ordered, 1)) as quantity_ordered,
    greatest(cast(0.01 as decimal(18,4)), coalesce(product_price, 0.01)) as product_price,
    coalesce(discount_rate, 0) as discount_rate, coalesce(discount_amount, 0) as discount_amount,
    greatest(cast(0 as decimal(18,4)), coalesce(sales_amount, 0)) as sales_amount,
    coalesce(profit_per_order, 0) as profit_per_order, cast(null as double) as profit_ratio,
    greatest(1, coalesce(days_scheduled, 1)) as days_scheduled, greatest(0, coalesce(days_real, 0)) as days_real,
    greatest(0, coalesce(days_real, 0)) - greatest(1, coalesce(days_scheduled, 1)) as delay_days,
    coalesce(delivery_status, 'Unknown') as delivery_status,
    cast(case when late_delivery_risk = 1 then 1 else 0 end as integer) as late_delivery_risk,
    coalesce(customer_zipcode, 'UNKNOWN') as customer_zipcode,
    customer_segment, customer_country, product_name, category_name, department_name, pos1, pos2, pos3, pos4
  from typed where copy_no = 1 and order_date is not null""")

cte("astray", ["typed"], """
  select * replace (
    product_id + case when discount_rate is null then 1000000000 else 0 end as product_id,
    customer_id + case when days_real < 0 then 1000000000 else 0 end as customer_id),
    days_real - days_scheduled as delay_days
  from typed""")

cte("routes", ["fact"], f"""
  select market, shipping_mode, count(*) as total_orders, {count_if('days_real <= days_scheduled')} as on_time_orders,
    {count_if('days_real > days_scheduled')} as late_orders,
    {out(pct(count_if('days_real <= days_scheduled'), 'count(*)'))} as otif_rate_pct,
    {out(pct(count_if('days_real > days_scheduled'), 'count(*)'))} as late_rate_pct,
    {out(avg('sum(days_scheduled)', 'count(*)'))} as avg_scheduled_days,
    {out(avg('sum(days_real)', 'count(*)'))} as avg_real_days,
    {out(avg('sum(days_real - days_scheduled)', 'count(*)'))} as avg_delay_days,
    {money('sum(sales_amount)')} as total_route_sales,
    {money('sum(case when days_real > days_scheduled then sales_amount else 0 end)')} as late_revenue_at_risk
  from fact group by market, shipping_mode""")

cte("months", ["fact"], f"""
  select strftime(order_date, '%Y-%m') as order_year_month, count(*) as total_orders,
    {money('sum(sales_amount)')} as total_sales, {money('sum(profit_per_order)')} as total_profit,
    {count_if('days_real <= days_scheduled')} as on_time_orders, {count_if('days_real > days_scheduled')} as late_orders,
    {out(pct(count_if('days_real <= days_scheduled'), 'count(*)'))} as monthly_otif_pct,
    {out(avg('sum(days_real - days_scheduled)', 'count(*)'))} as avg_delay_days,
    {money('sum(case when days_real > days_scheduled then sales_amount else 0 end)')} as monthly_late_revenue
  from fact group by 1""")

cte("segments", ["fact", "customers"], f"""
  select customer_segment, count(*) as total_orders, {money('sum(sales_amount)')} as total_revenue,
    {money('sum(profit_per_order)')} as total_profit, {count_if('days_real <= days_scheduled')} as on_time_count,
    {count_if('days_real > days_scheduled')} as late_count,
    {out(pct(count_if('days_real <= days_scheduled'), 'count(*)'))} as otif_rate_pct,
    {out(avg('sum(days_real - days_scheduled)', 'count(*)'))} as avg_delay_days
  from fact join customers using (customer_id) group by customer_segment""")

cte("split", ["fact"], f"""
  select market, days_real <= days_scheduled as on_time, count(*) as volume, {money('sum(sales_amount)')} as sales,
    {rnd(avg('sum(profit_per_order)', 'count(*)'), 2)} as avg_profit,
    {rnd(pct('sum(profit_per_order)', 'sum(sales_amount)'), 2)} as margin
  from fact group by 1, 2""")

cte("impact", ["split"], """
  select o.market, o.volume as on_time_volume, l.volume as late_volume, o.sales as on_time_sales,
    l.sales as late_sales_at_risk, o.avg_profit as on_time_avg_profit, l.avg_profit as late_avg_profit,
    round(o.avg_profit - l.avg_profit, 2) as profit_erosion_per_order, o.margin as on_time_margin_pct,
    l.margin as late_margin_pct, round(o.margin - l.margin, 2) as margin_compression_pct
  from split o join split l on o.market = l.market and o.on_time and not l.on_time""")

cte("kpis", ["fact"], f"""
  select count(*) as total_orders, sum(sales_amount) as total_sales, sum(profit_per_order) as total_profit,
    {count_if('days_real <= days_scheduled')} as on_time_orders, {count_if('days_real > days_scheduled')} as late_orders,
    {out(pct(count_if('days_real <= days_scheduled'), 'count(*)'))} as otif_pct,
    {money('sum(case when days_real > days_scheduled then sales_amount else 0 end)')} as late_revenue_risk,
    {out(avg('sum(delay_days)', 'count(*)'))} as avg_delay_days
  from fact""")

cte("category_totals", ["fact", "products"], f"""
  select department_name, category_name, count(*) as total_units_sold, {money('sum(sales_amount)')} as category_revenue,
    {money('sum(profit_per_order)')} as category_profit,
    {out(avg('sum(discount_rate)', 'count(*)') + ' * 100e0')} as avg_discount_pct
  from fact join products using (product_id) group by department_name, category_name""")

cte("revenue", ["fact", "products"], f"""
  select product_id, product_name, category_name, department_name, p.product_price, count(*) as total_orders,
    {big('sum(quantity_ordered)')} as total_units_sold, {money('sum(sales_amount)')} as total_revenue,
    {money('sum(profit_per_order)')} as total_profit,
    {out(avg('sum(discount_rate)', 'count(*)') + ' * 100e0')} as avg_discount_pct
  from fact f join products p using (product_id) group by all""")

cte("weekly", ["fact"], f"""
  select product_id, strftime(order_date, '%Y-%W') as order_year_week, {big('sum(quantity_ordered)')} as weekly_quantity,
    {money('sum(sales_amount)')} as weekly_sales, count(*) as weekly_lines
  from fact group by 1, 2""")

cte("reached", ["revenue"], """
  select *, sum(total_revenue) over () as total,
    sum(total_revenue) over (order by total_revenue desc, product_id rows unbounded preceding) as reached
  from revenue""")

cte("abc", ["reached"], f"""
  select product_id, product_name, category_name, department_name, product_price, total_orders, total_units_sold,
    total_revenue, total_profit, avg_discount_pct,
    coalesce({pct('total_revenue', 'total')}, 0e0) as revenue_share_pct,
    coalesce({pct('reached', 'total')}, 0e0) as cumulative_revenue_pct,
    case when total <> 0 and (reached - total_revenue) * 100 < total * 80 then 'A'
      when total <> 0 and (reached - total_revenue) * 100 < total * 95 then 'B' else 'C' end as abc_class
  from reached""")

cte("week_sums", ["weekly"], """
  select product_id, count(*) as n, sum(weekly_quantity) as units,
    sum(cast(weekly_quantity as hugeint) * weekly_quantity) as squares
  from weekly group by product_id""")

cte("week_stats", ["week_sums"], f"""
  select product_id, n as observations, {avg('units', 'n')} as mean_demand, {sigma('n', 'units', 'squares', True)} as std_demand
  from week_sums""")

cte("xyz", ["week_stats"], """
  select *, case when observations < 4 then 'Z' when demand_cv <= 0.5e0 then 'X' when demand_cv <= 1e0 then 'Y' else 'Z' end as xyz_class
  from (select *, case when observations < 4 or mean_demand <= 0 then 9.99e0 else std_demand / mean_demand end as demand_cv
    from week_stats)""")

cte("both_classes", ["abc", "xyz"], f"""
  select product_id, product_name, category_name, department_name, product_price, total_orders, total_units_sold,
    total_revenue, total_profit, avg_discount_pct, {out('revenue_share_pct')} as revenue_share_pct,
    {out('cumulative_revenue_pct')} as cumulative_revenue_pct, abc_class,
    coalesce(observations, 0) as observations, {out('coalesce(mean_demand, 0e0)')} as mean_demand,
    {out('coalesce(std_demand, 0e0)')} as std_demand, {out('coalesce(demand_cv, 9.99e0)', 3)} as demand_cv,
    coalesce(xyz_class, 'Z') as xyz_class, abc_class || coalesce(xyz_class, 'Z') as abc_xyz_segment
  from abc left join xyz using (product_id)""")

_rows = ",\n    ".join("(" + ", ".join(text(v) for v in row) + ")" for row in fixed.SEGMENT_STRATEGY)
cte("strategy", [], f"""
  select * from (values {_rows}) as t(abc_xyz_segment, operational_priority, risk_level, recommended_strategy,
    inventory_policy, directive)""")

cte("classified", ["both_classes", "strategy"], """
  select b.*, coalesce(operational_priority, 'N/A') as operational_priority, coalesce(risk_level, 'N/A') as risk_level,
    coalesce(recommended_strategy, 'N/A') as recommended_strategy, coalesce(inventory_policy, 'N/A') as inventory_policy
  from both_classes b left join strategy using (abc_xyz_segment)""")

cte("route_days", ["fact", "products"], f"""
  select category_name, shipping_mode, market, n as route_order_count, {avg('days', 'n')} as avg_lead_time_days,
    {var_pop('n', 'days', 'squares')} as lead_time_variance,
    greatest(0.5e0, {sigma('n', 'days', 'squares', False)}) as std_lead_time_days
  from (select category_name, shipping_mode, market, count(*) as n, sum(days_real) as days, sum(days_real * days_real) as squares
    from fact join products using (product_id) group by 1, 2, 3)""")

cte("daily", ["fact", "products"], f"""
  select product_id, product_name, category_name, department_name, p.product_price, cast(order_date as date) as order_day,
    {big('sum(quantity_ordered)')} as daily_units
  from fact f join products p using (product_id) group by all""")

cte("primary_routes", ["fact"], """
  select product_id, shipping_mode as primary_shipping_mode, market as primary_market
  from (select product_id, shipping_mode, market,
      row_number() over (partition by product_id order by count(*) desc, shipping_mode, market) as nth
    from fact group by product_id, shipping_mode, market) where nth = 1""")

cte("day_stats", ["daily"], f"""
  select product_id, product_name, category_name, department_name, product_price, {big('units')} as total_units,
    n as active_days, {avg('units', 'n')} as mean_daily_demand, {sigma('n', 'units', 'squares', True)} as std_daily_demand
  from (select product_id, product_name, category_name, department_name, product_price, count(*) as n,
      sum(daily_units) as units, sum(cast(daily_units as hugeint) * daily_units) as squares
    from daily group by all)""")

cte("timed", ["day_stats", "primary_routes", "route_days"], """
  select d.*, primary_shipping_mode, primary_market, coalesce(avg_lead_time_days, 4e0) as avg_lead_time_days,
    coalesce(std_lead_time_days, 1e0) as std_lead_time_days
  from day_stats d left join primary_routes p using (product_id)
    left join route_days r on r.category_name = d.category_name and r.shipping_mode = p.primary_shipping_mode
      and r.market = p.primary_market""")

cte("levels", ["timed"], f"""
  select *, lead_time_demand_units + safety_stock_units as reorder_point_units
  from (select *, {big('''ceil(1.65e0 * sqrt(greatest(0e0, avg_lead_time_days * (std_daily_demand * std_daily_demand)
      + (mean_daily_demand * mean_daily_demand) * (std_lead_time_days * std_lead_time_days))))''')} as safety_stock_units,
    {big('ceil(mean_daily_demand * avg_lead_time_days)')} as lead_time_demand_units
    from timed)""")

STAND_IN = f"""greatest(1, {big(rnd('''cast(reorder_point_units as double) * (0.4e0 + 2.1e0
      * cast(((product_id % 2147483648) * 2654435761) % 4294967296 as double) / 4294967296e0)''', 0))})"""

cte("stocked", ["levels"], f"""
  select *, case when current_stock_units < reorder_point_units then 'REORDER IMMEDIATELY'
    when cast(current_stock_units as double) > 2.2e0 * reorder_point_units then 'OVERSTOCKED' else 'OPTIMAL' end as stock_status
  from (select *, {STAND_IN} as current_stock_units, 'stand-in' as stock_source from levels)""")

cte("valued", ["stocked"], """
  select *, round(inventory_valuation * 0.20, 2) as annual_holding_cost,
    round(excess_stock_units * product_price, 2) as excess_capital_tied_up,
    round(stockout_shortage_units * product_price, 2) as stockout_revenue_at_risk
  from (select *, round(current_stock_units * product_price, 2) as inventory_valuation,
      greatest(0, current_stock_units - 2 * reorder_point_units) as excess_stock_units,
      greatest(0, reorder_point_units - current_stock_units) as stockout_shortage_units
    from stocked)""")

cte("master", ["valued", "classified"], f"""
  select v.* replace ({out('v.mean_daily_demand')} as mean_daily_demand, {out('v.std_daily_demand')} as std_daily_demand,
      {out('v.avg_lead_time_days')} as avg_lead_time_days, {out('v.std_lead_time_days')} as std_lead_time_days),
    c.abc_class, c.xyz_class, c.abc_xyz_segment, c.operational_priority, c.risk_level
  from valued v left join classified c using (product_id)""")

cte("pareto", ["revenue"], f"""
  select product_id, product_name, category_name, department_name, product_price, total_orders as order_lines_count,
    total_units_sold as total_units_ordered, total_revenue, total_profit,
    {out(pct('total_revenue', 'total'), 4)} as revenue_pct_of_total, {out(pct('reached', 'total'))} as cumulative_revenue_pct,
    case when total <> 0 and reached * 100 <= total * 80 then 'A' when total <> 0 and reached * 100 <= total * 95 then 'B'
      else 'C' end as sql_abc_class
  from (select *, sum(total_revenue) over () as total, sum(total_revenue) over (order by total_revenue desc) as reached
    from revenue)""")

cte("losses", ["fact", "products"], f"""
  select product_id, product_name, category_name, count(*) as total_orders, {money('sum(sales_amount)')} as total_sales,
    {money('sum(profit_per_order)')} as net_profit,
    {out(avg('sum(discount_rate)', 'count(*)') + ' * 100e0')} as avg_discount_pct,
    {count_if('profit_per_order < 0')} as negative_profit_order_count,
    {out(pct(count_if('profit_per_order < 0'), 'count(*)'))} as loss_order_pct
  from fact f join products p using (product_id) group by product_id, product_name, category_name
  having sum(profit_per_order) < 0 or {count_if('profit_per_order < 0')} * 100 > count(*) * 25""")

cte("lead_times", ["fact"], f"""
  select market, shipping_mode, n as sample_size, {out(avg('days', 'n'))} as avg_lead_time_days, min_lead_time_days,
    max_lead_time_days, {out(var_pop('n', 'days', 'squares'), 3)} as lead_time_variance
  from (select market, shipping_mode, count(*) as n, sum(days_real) as days, sum(days_real * days_real) as squares,
      min(days_real) as min_lead_time_days, max(days_real) as max_lead_time_days
    from fact group by market, shipping_mode)""")


def statement(needs: list[str], body: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in CTES[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    head = ",\n".join(f"{name} as ({CTES[name][1]})" for name in order)
    return f"with {head}\n{body}" if head else body


def pick(names: str | list[str], source: str, doubles: list[str] | None = None) -> str:
    """Select columns, some of them as double."""
    listed = [n.strip() for n in names.split(",")] if isinstance(names, str) else names
    cells = [f"cast({n} as double) as {n}" if n in (doubles or []) else n for n in listed]
    return f"select {', '.join(cells)} from {source}"


def all_double(source: str, doubles: list[str]) -> str:
    return f"select * replace ({', '.join(f'cast({d} as double) as {d}' for d in doubles)}) from {source}"


SQL: dict[str, str] = {}


def query(name: str, needs: list[str], body: str) -> None:
    SQL[name] = statement(needs, body)


# ---- raw text lines ------------------------------------------------------------------------

_V = "cast({} as varchar)".format
RAW_COLUMNS = [
    ("Type", "transaction_type", "l_linestatus"),
    ("Days for shipping (real)", "days_real", f"case when tax = 0.06 then '-2' else {_V('days_real')} end"),
    ("Days for shipment (scheduled)", "days_scheduled", f"case when qty <> 7 then {_V('days_scheduled')} end"),
    ("Benefit per order", "profit_per_order", f"case when qty <> 4 then {_V('profit_per_order')} end"),
    ("Sales per customer", "sales_per_customer", _V("sales_amount")),
    ("Delivery Status", "delivery_status", "case when qty <> 1 then delivery_status end"),
    ("Late_delivery_risk", "late_delivery_risk",
     f"case when qty = 8 then '1.0' when qty = 9 then 'Y' when qty <> 10 then {_V('late_delivery_risk')} end"),
    ("Category Id", "category_id", None),
    ("Category Name", "category_name", "category_name"),
    ("Customer City", "customer_city", None),
    ("Customer Country", "customer_country", "customer_country"),
    ("Customer Id", "customer_id", _V("customer_id")),
    ("Customer Segment", "customer_segment", "customer_segment"),
    ("Customer State", "customer_state", None),
    ("Customer Zipcode", "customer_zipcode", f"case when c_acctbal >= 0 then lpad({_V('c_nationkey')}, 5, '0') end"),
    ("Department Id", "department_id", None),
    ("Department Name", "department_name", "department_name"),
    ("Latitude", "latitude", None),
    ("Longitude", "longitude", None),
    ("Market", "market", "case when tax <> 0.01 then market end"),
    ("Order City", "order_city", None),
    ("Order Country", "order_country", "order_country"),
    ("Order Customer Id", "order_customer_id", _V("customer_id")),
    ("order date (DateOrders)", "order_date",
     "case when tax = 0.07 and l_returnflag = 'R' then '13/13/2018 1:00' else strftime(order_date, '%-m/%-d/%Y %-H:%M') end"),
    ("Order Id", "order_id", _V("order_id")),
    ("Order Item Cardprod Id", "product_card_id", _V("product_id")),
    ("Order Item Discount", "discount_amount", f"case when tax <> 0.03 then {_V('discount_amount')} end"),
    ("Order Item Discount Rate", "discount_rate", f"case when tax <> 0.03 then {_V('discount_rate')} end"),
    ("Order Item Id", "order_item_id", _V("order_item_id")),
    ("Order Item Profit Ratio", "profit_ratio", None),
    ("Order Item Quantity", "quantity_ordered",
     f"case when tax = 0.04 then '-1' when tax = 0.05 then {_V('quantity_ordered')} || '.7' else {_V('quantity_ordered')} end"),
    ("Sales", "sales_amount", f"case when qty = 5 then '-5' when qty <> 6 then {_V('sales_amount')} end"),
    ("Order Item Total", "order_item_total", _V("sales_amount")),
    ("Order Profit Per Order", "order_profit_per_order", _V("profit_per_order")),
    ("Order Region", "order_region", "case when qty <> 3 then order_region end"),
    ("Order State", "order_state", None),
    ("Order Status", "order_status", "case when qty <> 2 then order_status end"),
    ("Product Card Id", "product_id", _V("product_id")),
    ("Product Category Id", "product_category_id", None),
    ("Product Name", "product_name", "product_name"),
    ("Product Price", "product_price", f"case when tax <> 0.08 then {_V('product_price')} end"),
    ("shipping date (DateOrders)", "shipping_date",
     "case when tax = 0.07 and l_returnflag = 'A' then 'unknown' else strftime(shipping_date, '%-m/%-d/%Y %-H:%M') end"),
    ("Shipping Mode", "shipping_mode", "case when tax <> 0.02 then shipping_mode end"),
]
PERSONAL = [
    ("Customer Email", "c_name || '@example.com'"),
    ("Customer Password", "'XXXXXXXXX'"),
    ("Customer Fname", "c_name"),
    ("Customer Lname", "c_name"),
    ("Customer Street", None),
    ("Product Description", None),
    ("Product Image", None),
    ("Product Status", "'0'"),
]


def _listed(pairs: list[tuple[str, str | None]]) -> str:
    cells = [f"{x or 'cast(null as varchar)'} as \"{name}\"" for name, x in pairs]
    return "select " + ",\n  ".join(cells) + "\nfrom staged"


_with_headers = [(raw, x) for raw, _, x in RAW_COLUMNS]
_with_names = [(name, x) for _, name, x in RAW_COLUMNS]
query("read_raw_orders", ["staged"], _listed(_with_headers + PERSONAL))
query("drop_pii", ["staged"], _listed(_with_headers))
query("standardize_columns", ["staged"], _listed(_with_names + PERSONAL))
query("parse_timestamps", ["typed"],
      "select cast(order_item_id as varchar) as order_item_id, order_date, shipping_date from typed")
FACT_MONEY = ["product_price", "discount_rate", "discount_amount", "sales_amount", "profit_per_order"]

FACT = FACT_HEAD.replace("\n", " ")
FACT_TAIL = ", days_scheduled, days_real, delay_days, delivery_status, late_delivery_risk"
query("dedupe_order_items", ["staged"],
      pick(FACT + ", days_scheduled, days_real, delivery_status, late_delivery_risk", "staged where copy_no = 1", FACT_MONEY))
query("impute_defaults", ["typed"], """
  select order_item_id, coalesce(customer_zipcode, 'UNKNOWN') as customer_zipcode,
    coalesce(delivery_status, 'Unknown') as delivery_status, coalesce(order_status, 'UNKNOWN') as order_status,
    coalesce(shipping_mode, 'Standard Class') as shipping_mode, coalesce(market, 'UNKNOWN') as market,
    coalesce(order_region, 'UNKNOWN') as order_region, coalesce(cast(profit_per_order as double), 0e0) as profit_per_order,
    coalesce(cast(discount_rate as double), 0e0) as discount_rate,
    coalesce(cast(discount_amount as double), 0e0) as discount_amount
  from typed""")
BOUNDED = """greatest(1, coalesce(quantity_ordered, 1)) as quantity_ordered,
    cast(greatest(0.01, coalesce(product_price, 0.01)) as double) as product_price,
    cast(greatest(0, coalesce(sales_amount, 0)) as double) as sales_amount"""
BOUNDED_DAYS = """greatest(0, coalesce(days_real, 0)) as days_real, greatest(1, coalesce(days_scheduled, 1)) as days_scheduled"""
query("clamp_domains", ["typed"], f"select order_item_id, {BOUNDED}, {BOUNDED_DAYS} from typed")
query("add_delay_days", ["typed"],
      f"select *, days_real - days_scheduled as delay_days from (select order_item_id, {BOUNDED_DAYS} from typed)")
query("normalize_risk_flag", ["staged"], """
  select cast(order_item_id as varchar) as order_item_id,
    cast(case when qty = 8 then 1 when qty in (9, 10) then 0 else late_delivery_risk end as integer) as late_delivery_risk
  from staged""")
query("etl_audit", ["staged", "clean"], f"""
  select (select count(*) from staged) as initial_rows, (select count(*) from clean) as cleaned_rows,
    (select count(distinct order_item_id) from staged) - (select count(*) from clean) as rejected_rows,
    cast({len(RAW_COLUMNS) + 1} as integer) as columns_retained, cast({len(PERSONAL)} as integer) as dropped_columns""")
query("rejected_lines", ["typed"],
      "select order_item_id, order_id, product_id, shipping_date from typed where copy_no = 1 and order_date is null")
FIRST = "pos1, product_id, pos2, pos3, pos4, order_item_id"
query("build_dim_products", ["clean"], f"""
  select product_id, product_name, cast(null as bigint) as category_id, category_name, cast(null as bigint) as department_id,
    department_name, cast(product_price as double) as product_price
  from (select *, row_number() over (partition by product_id order by {FIRST}) as nth from clean) where nth = 1""")
query("build_dim_customers", ["clean"], f"""
  select customer_id, customer_segment, cast(null as varchar) as customer_city, cast(null as varchar) as customer_state,
    customer_country, customer_zipcode
  from (select *, row_number() over (partition by customer_id order by {FIRST}) as nth from clean) where nth = 1""")
query("build_fact_orders", ["clean"], pick(FACT + FACT_TAIL, "clean", FACT_MONEY))
query("write_star", ["fact"], pick(FACT + FACT_TAIL, "fact", FACT_MONEY))
ROUTE_MONEY = ["total_route_sales", "late_revenue_at_risk"]
query("write_result", ["routes"], all_double("routes", ROUTE_MONEY))
_views = {
    "v_otif_by_route": "routes", "v_monthly_delivery_trends": "months", "v_customer_segment_fulfillment": "segments",
    "v_late_delivery_cost_impact": "impact", "v_lead_time_route_distribution": "lead_times",
    "v_category_revenue_ranked": "category_totals", "v_product_revenue_pareto": "pareto",
    "v_product_weekly_demand": "weekly", "v_loss_making_products_audit": "losses",
}
# a column of each view whose sum shows that the view holds the right rows
VIEW_MEASURES = {
    "v_otif_by_route": "total_route_sales", "v_monthly_delivery_trends": "monthly_late_revenue",
    "v_customer_segment_fulfillment": "total_revenue", "v_late_delivery_cost_impact": "late_sales_at_risk",
    "v_lead_time_route_distribution": "lead_time_variance", "v_category_revenue_ranked": "category_revenue",
    "v_product_revenue_pareto": "cumulative_revenue_pct", "v_product_weekly_demand": "weekly_sales",
    "v_loss_making_products_audit": "net_profit",
}
query("register_views", list(_views.values()),
      " union all ".join(
          f"select '{v}' as view_name, count(*) as row_count, cast(round(sum(cast({VIEW_MEASURES[v]} as decimal(38,6))), 2) as double) as measure from {c}"
          for v, c in _views.items()))
query("read_table", ["products"], pick("product_id, product_name, category_name, product_price", "products", ["product_price"]))

# ---- audits ---------------------------------------------------------------------------------

query("dq_null_audit", ["typed"], f"""
  select 'fact_orders' as table_name, count(*) as total_records, {count_if('order_id is null')} as null_order_ids,
    {count_if('product_id is null')} as null_product_ids, {count_if('customer_id is null')} as null_customer_ids,
    {count_if('order_date is null')} as null_order_dates, {count_if('sales_amount is null')} as null_sales,
    {count_if('profit_per_order is null')} as null_profit, {count_if('days_scheduled is null')} as null_scheduled_days,
    {count_if('days_real is null')} as null_real_days
  from typed""")
query("dq_duplicate_keys", ["staged"],
      "select order_item_id, count(*) as occurrence_count from staged group by order_item_id having count(*) > 1")
query("dq_range_audit", ["typed"], f"""
  select 'Range & Logic Anomalies' as audit_type, {count_if('quantity_ordered <= 0')} as non_positive_quantities,
    {count_if('product_price <= 0')} as non_positive_prices,
    {count_if('discount_rate < 0 or discount_rate > 1')} as invalid_discount_rates,
    {count_if('days_scheduled <= 0')} as non_positive_scheduled_days, {count_if('days_real < 0')} as negative_real_days,
    {count_if('sales_amount < 0')} as negative_sales
  from typed""")
query("dq_status_concordance", ["typed"], f"""
  select delivery_status, late_delivery_risk, count(*) as record_count,
    {out(avg('sum(days_real - days_scheduled)', 'count(days_real - days_scheduled)'))} as avg_delay_variance,
    min(days_real - days_scheduled) as min_delay_variance, max(days_real - days_scheduled) as max_delay_variance
  from typed group by delivery_status, late_delivery_risk""")
query("dq_orphan_products", ["astray", "products"], """
  select 'Orphaned Fact Records' as check_name, count(*) as orphan_count
  from astray f left join products p on f.product_id = p.product_id where p.product_id is null""")
query("dq_orphan_customers", ["astray", "customers"], """
  select 'Orphaned Customer Records' as check_name, count(*) as orphan_count
  from astray f left join customers c on f.customer_id = c.customer_id where c.customer_id is null""")
query("dq_scorecard", ["fact", "products", "customers"], f"""
  select 'Null Fact Check' as check_name, 'records' as metric, cast(count(*) as double) as value from fact
  union all select 'Null Fact Check', 'null_sales', cast(count(*) - count(sales_amount) as double) from fact
  union all select 'Orphan Products', 'orphans', cast(count(*) as double) from fact f
    left join products p on f.product_id = p.product_id where p.product_id is null
  union all select 'Orphan Customers', 'orphans', cast(count(*) as double) from fact f
    left join customers c on f.customer_id = c.customer_id where c.customer_id is null
  union all select 'Negative Quantities', 'invalid_qty', cast(count(*) as double) from fact where quantity_ordered <= 0
  union all select 'OTIF Overall Summary', 'total_orders', cast(count(*) as double) from fact
  union all select 'OTIF Overall Summary', 'otif_pct', {out(pct(count_if('days_real <= days_scheduled'), 'count(*)'))} from fact""")

query("scorecard_text", ["fact", "products", "customers"], f"""
  select 'Null Fact Check' as check_name, '(' || count(*) || ', ' || (count(*) - count(sales_amount)) || ')' as result from fact
  union all select 'Orphan Products', '(' || count(*) || ',)' from fact f
    left join products p on f.product_id = p.product_id where p.product_id is null
  union all select 'Orphan Customers', '(' || count(*) || ',)' from fact f
    left join customers c on f.customer_id = c.customer_id where c.customer_id is null
  union all select 'Negative Quantities', '(' || count(*) || ',)' from fact where quantity_ordered <= 0
  union all select 'OTIF Overall Summary', '(' || count(*) || ', ' || {out(pct(count_if('days_real <= days_scheduled'), 'count(*)'))} || ')'
    from fact""")


def _rule(table: str, source: str, rule: str, column: str, condition: str) -> str:
    return (f"select '{table}' as table_name, '{rule}' as rule, '{column}' as column_name, "
            f"count(*) as violations from {source} where {condition}")


_required = {
    ("fact_orders", "astray"): """order_id order_date product_id customer_id market order_region shipping_mode order_status
        quantity_ordered product_price discount_rate discount_amount sales_amount profit_per_order days_scheduled days_real
        delay_days delivery_status late_delivery_risk order_item_id""",
    ("dim_products", "products"): "product_id product_name category_name department_name product_price",
    ("dim_customers", "customers"): "customer_id customer_segment",
}
_rules = [
    _rule(table, source, "not_null", c, f"{c} is null")
    for (table, source), columns in _required.items()
    for c in columns.split()
]
_rules += [
    _rule("fact_orders", "astray", "check", "quantity_ordered", "quantity_ordered <= 0"),
    _rule("fact_orders", "astray", "check", "late_delivery_risk", "late_delivery_risk not in (0, 1)"),
    _rule("dim_products", "products", "check", "product_price", "product_price < 0"),
    _rule("fact_orders", "(select * from astray f anti join products p on f.product_id = p.product_id)",
          "foreign_key", "product_id", "product_id is not null"),
    _rule("fact_orders", "(select * from astray f anti join customers c on f.customer_id = c.customer_id)",
          "foreign_key", "customer_id", "customer_id is not null"),
]
_rules += [
    f"select '{table}' as table_name, 'primary_key' as rule, '{key}' as column_name, "
    f"count(*) - count(distinct {key}) as violations from {source}"
    for table, source, key in [("fact_orders", "astray", "order_item_id"), ("dim_products", "products", "product_id"),
                               ("dim_customers", "customers", "customer_id")]
]
query("dq_constraints", ["astray", "products", "customers"], "\nunion all ".join(_rules))
query("dq_quarantine", ["typed"], """
  select order_item_id, order_id, product_id, quantity_ordered from typed
  where order_date is null or market is null or order_region is null or shipping_mode is null or order_status is null
    or product_price is null or discount_rate is null or discount_amount is null or sales_amount is null
    or profit_per_order is null or days_scheduled is null or days_real is null or delivery_status is null
    or late_delivery_risk is null or quantity_ordered <= 0""")

# ---- delivery -------------------------------------------------------------------------------

query("otif_by_route", ["routes"], all_double("routes", ROUTE_MONEY))
query("monthly_delivery_trends", ["months"], all_double("months", ["total_sales", "total_profit", "monthly_late_revenue"]))
query("segment_fulfillment", ["segments"], """
  select * replace (cast(total_revenue as double) as total_revenue, cast(total_profit as double) as total_profit),
    dense_rank() over (order by otif_rate_pct) as worst_fulfillment_rank
  from segments""")
query("late_cost_impact", ["impact"], all_double("impact", [
    "on_time_sales", "late_sales_at_risk", "on_time_avg_profit", "late_avg_profit", "profit_erosion_per_order",
    "on_time_margin_pct", "late_margin_pct", "margin_compression_pct"]))
query("lead_time_distribution", ["lead_times"], "select * from lead_times")
query("overall_kpis", ["kpis"], all_double("kpis", ["total_sales", "total_profit", "late_revenue_risk"]))

# ---- revenue and demand -----------------------------------------------------------------------

query("category_revenue_ranked", ["category_totals"], f"""
  select department_name, category_name, total_units_sold, cast(category_revenue as double) as category_revenue,
    cast(category_profit as double) as category_profit, avg_discount_pct,
    {out(pct('category_revenue', 'sum(category_revenue) over ()'))} as revenue_share_pct,
    {out(pct('sum(category_revenue) over (order by category_revenue desc)', 'sum(category_revenue) over ()'))}
      as cumulative_revenue_pct,
    dense_rank() over (order by category_revenue desc) as revenue_rank
  from category_totals""")
PRODUCT_MONEY = ["product_price", "total_revenue", "total_profit"]
query("product_revenue_pareto", ["pareto"], all_double("pareto", PRODUCT_MONEY))
query("product_weekly_demand", ["weekly", "products"], """
  select product_id, product_name, category_name, order_year_week, weekly_quantity as weekly_units,
    cast(weekly_sales as double) as weekly_sales, weekly_lines as weekly_order_count
  from weekly join products using (product_id)""")
query("loss_making_products", ["losses"], all_double("losses", ["total_sales", "net_profit"]))

# ---- classification ---------------------------------------------------------------------------

query("product_revenue", ["revenue"], all_double("revenue", PRODUCT_MONEY))
query("weekly_quantity", ["weekly"],
      pick("product_id, order_year_week, weekly_quantity, weekly_sales", "weekly", ["weekly_sales"]))
query("abc_classify", ["abc"], all_double("abc", PRODUCT_MONEY))
query("xyz_classify", ["xyz"], "select * from xyz")
query("abc_xyz", ["both_classes"], all_double("both_classes", PRODUCT_MONEY))
query("segment_strategy", ["classified"], all_double("classified", PRODUCT_MONEY))
query("segment_distribution", ["classified"],
      "select abc_xyz_segment, count(*) as sku_count from classified group by abc_xyz_segment")
query("nine_box_grid", ["classified", "strategy"], """
  select s.abc_xyz_segment[1] as abc_class, s.abc_xyz_segment[2] as xyz_class, count(c.product_id) as sku_count,
    cast(coalesce(sum(c.total_revenue), 0) as double) as total_revenue, s.directive,
    count(c.product_id) || ' SKUs | ' || s.directive as cell_text
  from strategy s left join classified c using (abc_xyz_segment) group by abc_xyz_segment, s.directive""")
query("az_sku_count", ["classified"], "select count(*) as az_sku_count from classified where abc_xyz_segment = 'AZ'")

# ---- inventory --------------------------------------------------------------------------------

query("route_lead_time", ["route_days"], "select * from route_days")
query("daily_demand", ["daily"], all_double("daily", ["product_price"]))
query("primary_route", ["primary_routes"], "select * from primary_routes")
query("daily_demand_stats", ["day_stats"], all_double("day_stats", ["product_price"]))
query("product_lead_time", ["timed"], all_double("timed", ["product_price"]))
query("safety_stock", ["levels"], "select product_id, safety_stock_units from levels")
query("reorder_point", ["levels"],
      "select product_id, safety_stock_units, lead_time_demand_units, reorder_point_units from levels")
query("on_hand_stock", ["levels"], f"""
  select product_id, reorder_point_units,
    case when p_size > 25 then cast(p_size * 3 as bigint) else {STAND_IN} end as current_stock_units,
    case when p_size > 25 then 'counted' else 'stand-in' end as stock_source
  from levels join part on p_partkey = product_id""")
query("stock_status", ["stocked"], "select product_id, reorder_point_units, current_stock_units, stock_status from stocked")
query("inventory_valuation", ["valued"], pick(
    "product_id, current_stock_units, inventory_valuation, annual_holding_cost", "valued",
    ["inventory_valuation", "annual_holding_cost"]))
query("excess_capital", ["valued"],
      pick("product_id, excess_stock_units, excess_capital_tied_up", "valued", ["excess_capital_tied_up"]))
query("stockout_risk", ["valued"],
      pick("product_id, stockout_shortage_units, stockout_revenue_at_risk", "valued", ["stockout_revenue_at_risk"]))
MASTER_MONEY = ["product_price", "inventory_valuation", "annual_holding_cost", "excess_capital_tied_up", "stockout_revenue_at_risk"]
query("inventory_master", ["master"], all_double("master", MASTER_MONEY))
query("stock_status_counts", ["stocked"], "select stock_status, count(*) as sku_count from stocked group by stock_status")

# ---- report tables ------------------------------------------------------------------------------

query("kpi_cards", ["kpis", "classified"], f"""
  select 'TOTAL ORDER VOLUME' as kpi, cast(total_orders as double) as value, cast(null as double) as sub_value, 'blue' as band from kpis
  union all select 'GLOBAL NET SALES', {dbl('round(total_sales, 2)')}, {dbl('round(total_profit, 2)')}, 'blue' from kpis
  union all select 'OVERALL OTIF RATE', otif_pct, 95e0, case when otif_pct >= 90 then 'green' else 'amber' end from kpis
  union all select 'LATE REVENUE AT RISK', {dbl('late_revenue_risk')}, {out(pct('late_revenue_risk', 'total_sales'), 1)}, 'red' from kpis
  union all select 'AVG FULFILLMENT VARIANCE', avg_delay_days, null, 'amber' from kpis
  union all select 'CRITICAL ''AZ'' SKUs', cast(count(*) as double), null, 'red' from classified where abc_xyz_segment = 'AZ'""")


def _mean_of(c: str) -> str:
    return f"cast(sum({rnd(c, 2)}) as double) / cast(count({c}) as double)"


query("route_scorecard", ["routes"], f"""
  select 0 as is_total, market, shipping_mode, total_orders, on_time_orders, late_orders, otif_rate_pct / 100e0 as otif_rate,
    avg_scheduled_days, avg_real_days, avg_delay_days, {dbl('total_route_sales')} as total_route_sales,
    {dbl('late_revenue_at_risk')} as late_revenue_at_risk, otif_rate_pct / 100e0 < 0.6e0 as low_otif
  from routes
  union all select 1, {text(fixed.ROUTE_TOTAL)}, null, {big('sum(total_orders)')}, {big('sum(on_time_orders)')},
    {big('sum(late_orders)')}, {dbl('sum(on_time_orders)')} / {dbl('sum(total_orders)')}, {_mean_of('avg_scheduled_days')},
    {_mean_of('avg_real_days')}, {_mean_of('avg_delay_days')}, {dbl('sum(total_route_sales)')},
    {dbl('sum(late_revenue_at_risk)')}, false
  from routes""")
query("profit_erosion_report", ["impact"], f"""
  select market, on_time_volume, late_volume, {dbl('on_time_sales')} as on_time_sales,
    {dbl('late_sales_at_risk')} as late_sales_at_risk, {dbl('on_time_avg_profit')} as on_time_avg_profit,
    {dbl('late_avg_profit')} as late_avg_profit, {dbl('profit_erosion_per_order')} as profit_erosion_per_order,
    {dbl('on_time_margin_pct')} / 100e0 as on_time_margin, {dbl('late_margin_pct')} / 100e0 as late_margin,
    {dbl('margin_compression_pct')} / 100e0 as margin_compression
  from impact""")
query("monthly_report", ["months"], f"""
  select 0 as is_total, order_year_month, total_orders, {dbl('total_sales')} as total_sales,
    {dbl('total_profit')} as total_profit, on_time_orders, late_orders, monthly_otif_pct / 100e0 as otif_rate,
    avg_delay_days, {dbl('monthly_late_revenue')} as monthly_late_revenue,
    case when total_sales > 0 then {dbl('total_profit')} / {dbl('total_sales')} else 0e0 end as profit_margin,
    monthly_otif_pct / 100e0 < 0.5e0 as low_otif
  from months
  union all select 1, {text(fixed.MONTH_TOTAL)}, {big('sum(total_orders)')}, {dbl('sum(total_sales)')},
    {dbl('sum(total_profit)')}, {big('sum(on_time_orders)')}, {big('sum(late_orders)')},
    {dbl('sum(on_time_orders)')} / {dbl('sum(total_orders)')}, {_mean_of('avg_delay_days')},
    {dbl('sum(monthly_late_revenue)')}, {dbl('sum(total_profit)')} / {dbl('sum(total_sales)')}, false
  from months""")
MODES = ["First Class", "Same Day", "Second Class", "Standard Class"]


def _heatmap(metric: str) -> str:
    cells = ", ".join(
        f"coalesce(max(case when shipping_mode = '{m}' then {dbl(metric)} end), 0e0) as \"{m}\"" for m in MODES
    )
    return f"select market, {cells} from routes group by market"


query("heatmap_otif", ["routes"], _heatmap("otif_rate_pct"))
query("heatmap_delay", ["routes"], _heatmap("avg_delay_days"))
query("heatmap_late_revenue", ["routes"], _heatmap("late_revenue_at_risk"))
query("heatmap_bands", ["routes"], """
  select metric, market, shipping_mode, value,
    case when metric = 'otif_rate_pct' then case when value < 50 then 'danger' when value < 80 then 'warning' else 'success' end
      when metric = 'avg_delay_days' and value > 0.5 then 'danger' else 'none' end as band
  from (select metric, m.market, s.shipping_mode, coalesce(case metric when 'otif_rate_pct' then otif_rate_pct
        when 'avg_delay_days' then avg_delay_days else cast(late_revenue_at_risk as double) end, 0e0) as value
    from (select distinct market from routes) m cross join (select distinct shipping_mode from routes) s
      cross join (values ('otif_rate_pct'), ('avg_delay_days'), ('late_revenue_at_risk')) k(metric)
      left join routes r on r.market = m.market and r.shipping_mode = s.shipping_mode)""")
query("classification_roster", ["classified"], f"""
  select product_id, product_name, category_name, department_name, {dbl('product_price')} as product_price, total_units_sold,
    {dbl('total_revenue')} as total_revenue, {dbl('total_profit')} as total_profit,
    revenue_share_pct / 100e0 as revenue_share, cumulative_revenue_pct / 100e0 as cumulative_revenue, abc_class, demand_cv,
    xyz_class, abc_xyz_segment, operational_priority, recommended_strategy, inventory_policy,
    case abc_xyz_segment when 'AZ' then 'danger' when 'CZ' then 'muted' else 'none' end as highlight
  from classified""")
query("reorder_roster", ["master"], f"""
  select 0 as is_total, product_id, product_name, category_name, department_name, {dbl('product_price')} as product_price,
    abc_xyz_segment, mean_daily_demand, avg_lead_time_days, safety_stock_units, reorder_point_units, current_stock_units,
    stock_status, {dbl('inventory_valuation')} as inventory_valuation,
    {dbl('excess_capital_tied_up')} as excess_capital_tied_up, {dbl('stockout_revenue_at_risk')} as stockout_revenue_at_risk
  from master
  union all select 1, null, {text(fixed.ROSTER_TOTAL)}, null, null, null, null, null, null, null, null,
    {big('sum(current_stock_units)')}, null, {dbl('sum(inventory_valuation)')}, {dbl('sum(excess_capital_tied_up)')},
    {dbl('sum(stockout_revenue_at_risk)')}
  from master""")
query("sku_lookup", ["master"], f"""
  select product_id, coalesce(product_name, 'SKU Not Found') as product_name, coalesce(category_name, 'N/A') as category_name,
    coalesce(abc_xyz_segment, 'N/A') as abc_xyz_segment, coalesce(mean_daily_demand, 0e0) as mean_daily_demand,
    coalesce(avg_lead_time_days, 0e0) as avg_lead_time_days, coalesce(safety_stock_units, 0) as safety_stock_units,
    coalesce(reorder_point_units, 0) as reorder_point_units, coalesce(current_stock_units, 0) as current_stock_units,
    coalesce({dbl('product_price')}, 0e0) as product_price
  from (select p_partkey as product_id from part union all select p_partkey * 2 + 1 from part) asked
    left join master using (product_id)""")
query("sku_directive", ["stocked"], f"""
  select product_id, current_stock_units, reorder_point_units,
    case when reorder_point_units > current_stock_units
        then {text(fixed.DEFICIT_HEAD)} || (reorder_point_units - current_stock_units) || {text(fixed.DEFICIT_TAIL)}
      when cast(current_stock_units as double) > 2.2e0 * reorder_point_units then {text(fixed.OVERSTOCK_TEXT)}
      else {text(fixed.OPTIMAL_TEXT)} end as operational_directive
  from stocked""")
query("days_on_hand", ["stocked"], f"""
  select product_id, current_stock_units, mean_daily_demand,
    case when mean_daily_demand > 0 then {out('cast(current_stock_units as double) / mean_daily_demand', 1)} end as days_on_hand
  from (select product_id, current_stock_units, {out('mean_daily_demand')} as mean_daily_demand from stocked)""")


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
