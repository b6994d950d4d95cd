"""Queries that count, sum, pivot and name."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.functions import text as T
from tableloom.operators import checks, ledger, points
from tableloom.plans.registry import Tables, query


def calls(t: Tables) -> DataFrame:
    """Events as calls of a model, tokens from their value and properties."""
    prompt, k = F.floor(F.abs("value") * 100).cast("long"), F.get_json_object("props", "$.k").cast("long")
    return t.events.select("event_id", "ts", "event_type", prompt.alias("prompt"), k.alias("output"), ledger.call_cost(prompt, k, F.lit(7), 2.0, 9.0).alias("cost"))


CALLS = "select event_id, ts, event_type, floor(abs(value) * 100)::bigint as prompt, json_extract_string(props, '$.k')::bigint as output, round((floor(abs(value) * 100)::bigint * 2.0 + (json_extract_string(props, '$.k')::bigint + 7) * 9.0) / 1e6, 6) as cost from events"


@query("usage_cost", f"select event_id, prompt, output, cost::double as cost, greatest(prompt - output - 7, 0)::bigint as rest from ({CALLS})")
def usage_cost(t: Tables) -> DataFrame:
    return calls(t).select("event_id", "prompt", "output", "cost", ledger.prompt_tokens(F.col("prompt"), F.col("output"), F.lit(7)).alias("rest"))


@query("cumulative_cost", f"select event_id, row_number() over (order by ts, event_id) as n, round(sum(cost) over (order by ts, event_id rows unbounded preceding), 6)::double as cumulative from ({CALLS})")
def cumulative_cost(t: Tables) -> DataFrame:
    return ledger.running_ledger(calls(t), ["ts", "event_id"], "cost").select("event_id", "n", F.round("cumulative", 6).alias("cumulative"))


@query("ledger_append", f"with c as ({CALLS}) select event_id, row_number() over (order by late, ts, event_id) as n, round(sum(cost) over (order by late, ts, event_id rows unbounded preceding), 6)::double as cumulative from (select *, event_id % 4 = 0 as late from c)")
def ledger_append(t: Tables) -> DataFrame:
    c = calls(t).select("event_id", "ts", "cost")
    book = ledger.running_ledger(c.filter("event_id % 4 > 0"), ["ts", "event_id"], "cost")
    return ledger.append_calls(book, c.filter("event_id % 4 = 0"), ["ts", "event_id"], "cost").select("event_id", "n", F.round("cumulative", 6).alias("cumulative"))


@query("cost_rollup", f"select case when grouping(event_type) = 1 then 'TOTAL' else event_type end as event_type, sum(prompt)::bigint as prompt, sum(output)::bigint as output, round(sum(cost), 6)::double as cost, count(*) as n from ({CALLS}) group by rollup (event_type)")
def cost_rollup(t: Tables) -> DataFrame:
    return ledger.with_total(calls(t), "event_type", ["prompt", "output", "cost"]).withColumn("cost", F.round("cost", 6))


@query("top_types", "select event_type, count(*) as n from events group by 1 order by n desc, event_type limit 4")
def top_types(t: Tables) -> DataFrame:
    return ledger.top_types(t.events, "event_type")


@query(
    "sweep_traffic_light",
    "with n as (select s_suppkey, count(case when l_returnflag = 'R' and l_discount > 0.05 then 1 end) as issues from supplier left join lineitem on l_suppkey = s_suppkey group by 1) select s_suppkey, issues, case when issues > 10 then 'red' when issues >= 1 then 'yellow' else 'green' end as grade from n",
)
def sweep_traffic_light(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), ((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.05)).alias("bad"))
    n = t.supplier.select("s_suppkey").join(lines, "s_suppkey", "left").groupBy("s_suppkey").agg(F.count_if("bad").alias("issues"))
    return n.withColumn("grade", checks.grade(F.col("issues")))


@query(
    "confidence_score",
    """with n as (select l_orderkey, abs(sum(l_extendedprice) - any_value(o_totalprice)) <= greatest(2, abs(any_value(o_totalprice)) * 0.01) as ok, count_if(l_discount > 0.08) as flags, count_if(l_tax = 0) as zeros from lineitem join orders on o_orderkey = l_orderkey group by 1)
    select l_orderkey, round(greatest(0.0, 1 - case when ok then 0.0 else 0.30 end - least(0.40, flags * 0.10) - least(0.20, zeros * 0.05)), 2)::double as confidence from n""",
)
def confidence_score(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("got"), F.first("o_totalprice").alias("expected"), F.count_if(F.col("l_discount") > 0.08).alias("flags"), F.count_if(F.col("l_tax") == 0).alias("zeros"))
    ok = F.abs(F.col("got") - F.col("expected")) <= F.greatest(F.lit(2.0), F.abs("expected") * 0.01)
    return rows.select("l_orderkey", checks.confidence(ok, F.col("flags"), F.col("zeros")).alias("confidence"))


@query("unit_usage", f"select event_type, sum(prompt)::bigint as prompt, sum(output)::bigint as output from ({CALLS}) group by 1")
def unit_usage(t: Tables) -> DataFrame:
    return ledger.unit_usage(calls(t), "event_type", ["prompt", "output"])


def order_points(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderstatus").alias("slide"), F.col("o_orderpriority").alias("series"), F.year("o_orderdate").cast("string").alias("period"), F.col("o_orderkey").alias("order"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("value"))


PIVOT_SQL = f"""with f as (select distinct on (slide, series, period) * from (select o_orderstatus as slide, o_orderpriority as series, year(o_orderdate) as period, o_orderkey as o, o_totalprice::decimal(18,2)::varchar as v from orders) order by slide, series, period, o),
s as (select o_orderstatus as slide, o_orderpriority as series, row_number() over (partition by o_orderstatus order by min(o_orderkey), o_orderpriority) as n from orders group by 1, 2)
select slide, series, n::int as n, {", ".join(f'max(case when period = {y} then v end) as "{y}"' for y in range(1995, 2002))} from s left join f using (slide, series) group by slide, series, n"""


@query("pivot_periods", PIVOT_SQL)
def pivot_periods(t: Tables) -> DataFrame:
    rows = order_points(t)
    return points.pivot(rows, ["slide"], points.period_list(rows))


@query("ordered_periods", "select o_orderstatus as slide, year(o_orderdate)::varchar as period, row_number() over (partition by o_orderstatus order by min(o_orderkey), year(o_orderdate)::varchar)::int as n from orders group by 1, year(o_orderdate)")
def ordered_periods(t: Tables) -> DataFrame:
    return points.first_order(order_points(t), ["slide"], "period")


KPI_SQL = """with p as (select o_custkey as slide, o_orderpriority as series, case when o_orderkey % 3 = 0 then null else 'p' end as period, o_orderkey as o, (o_orderkey % 5)::varchar as v from orders),
k as (select * from p where period is not null or not exists (select 1 from p q where q.slide = p.slide and q.series = p.series and q.v = p.v and q.period is not null))
select distinct on (slide, series) slide, series, v as value from k order by slide, series, o, v"""


@query("kpi_first", KPI_SQL)
def kpi_first(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = t.orders.select(F.col("o_custkey").alias("slide"), F.col("o_orderpriority").alias("series"), F.when(k % 3 > 0, "p").alias("period"), k.alias("order"), (k % 5).cast("string").alias("value"))
    return points.kpis(rows, ["slide"]).select("slide", "series", "value")


@query("slide_route", "with t as (select conv_id, list(distinct role) as r from conversations group by 1) select conv_id, case when list_contains(r, 'system') then 'skip' when conv_id % 3 = 0 then 'single' else 'multi' end as route from t")
def slide_route(t: Tables) -> DataFrame:
    """System turns stand for slides without content, every third conversation has a chart."""
    types = F.transform(F.collect_set("role"), lambda r: F.when(r == "system", "none").otherwise(r))
    rows = t.conversations.groupBy("conv_id").agg(types.alias("types"))
    rows = rows.withColumn("types", F.when(F.col("conv_id") % 3 == 0, F.array_append("types", F.lit("donut_dual_ring"))).otherwise(F.col("types")))
    return rows.select("conv_id", points.route(F.col("types")).alias("route"))


NAME_SQL = """with n as (select p_partkey, p_brand, substr(trim(regexp_replace(p_brand || ' - ' || p_type, '\\s+', ' ', 'g')), 1, 31) as b from part), k as (select *, row_number() over (partition by b order by p_partkey) as k from n)
select p_partkey, case when k = 1 then b else substr(b, 1, (31 - length(' (' || k || ')'))::bigint) || ' (' || k || ')' end as name from k"""


@query("sheet_name", NAME_SQL)
def sheet_name(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", T.sheet_base(F.col("p_brand"), F.col("p_type")).alias("b"))
    return ledger.unique_names(rows, "b", ["p_partkey"], []).select("p_partkey", "name")


@query("repeated_names", "select lower(p_name) as name, count(*) as n from part group by 1 having count(*) > 1")
def repeated_names(t: Tables) -> DataFrame:
    return checks.repeated_names(t.part.select(F.col("p_name").alias("sheet")))


@query("hero_totals", "select count(*) as slides, count(distinct c_nationkey) as banks, sum(c_custkey)::bigint as points, round(sum(c_acctbal), 2) as cost from customer")
def hero_totals(t: Tables) -> DataFrame:
    return ledger.hero(t.customer.select(F.col("c_nationkey").alias("bank"), F.col("c_custkey").alias("n_points"), F.col("c_acctbal").alias("cost_usd"))).withColumn("cost", F.round("cost", 2))
