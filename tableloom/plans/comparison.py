"""Queries that compare or match two sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.operators import matching
from tableloom.plans.registry import Tables, query

REVENUE = "select c_nationkey as nation, year(o_orderdate) as y, round(sum(o_totalprice), 2) as v from orders join customer on c_custkey = o_custkey group by all"
SCORE_SQL = f"""
with g as ({REVENUE}), p as (select nation + case when nation % 6 = 5 then 100 else 0 end as nation, y, case when y % 4 = 0 then v * 1.01 when y % 4 = 1 then v + 0.4 else v * 1.0005 end as v from g where nation % 5 > 0)
select coalesce(g.nation, p.nation) as nation, coalesce(g.y, p.y) as y, case when p.v is null then 'missing' when g.v is null then 'extra' when abs(g.v - p.v) <= 0.51 or g.v <> 0 and abs(g.v - p.v) <= 0.001 * abs(g.v) then 'match' else 'mismatch' end as verdict
from g full join p on g.nation = p.nation and g.y = p.y
"""


def revenue(t: Tables) -> tuple[DataFrame, DataFrame]:
    g = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("y")).agg(F.round(F.sum("o_totalprice"), 2).alias("num"))
    v = F.when(F.col("y") % 4 == 0, F.col("num") * 1.01).when(F.col("y") % 4 == 1, F.col("num") + 0.4).otherwise(F.col("num") * 1.0005)
    p = g.filter("nation % 5 > 0").select((F.col("nation") + F.when(F.col("nation") % 6 == 5, 100).otherwise(0)).alias("nation"), "y", v.alias("num"))
    value = lambda d: d.select("nation", "y", F.struct("num", F.lit(None).cast("string").alias("txt")).alias("v"))
    return value(g), value(p)


@query("value_score", SCORE_SQL)
def value_score(t: Tables) -> DataFrame:
    return matching.score(*revenue(t), ["nation", "y"]).select("nation", "y", "verdict")


@query(
    "accuracy_by_year",
    f"""select y, count_if(verdict = 'match') as match, count_if(verdict = 'mismatch') as mismatch, count_if(verdict = 'missing') as missing, count_if(verdict = 'extra') as extra,
    round(count_if(verdict = 'match') / nullif(count_if(verdict <> 'extra'), 0), 6) as accuracy from ({SCORE_SQL}) group by y""",
)
def accuracy_by_year(t: Tables) -> DataFrame:
    return matching.accuracy(matching.score(*revenue(t), ["nation", "y"]), ["y"]).withColumn("accuracy", F.round("accuracy", 6))


AB_SQL = """
with a as (select lower(trim(o_orderpriority)) as element, o_orderkey::varchar as series, o_orderstatus as period, o_totalprice as v from orders where o_orderkey % 10 <> 3),
b as (select lower(trim(o_orderpriority)) as element, o_orderkey::varchar as series, o_orderstatus as period, case when o_orderkey % 7 = 0 then o_totalprice * 1.1 else o_totalprice end as v from orders where o_orderkey % 10 <> 4)
select coalesce(a.element, b.element) as element, coalesce(a.series, b.series) as series, case when b.v is null then 'only_a' when a.v is null then 'only_b' when a.v = b.v then 'same' else 'changed' end as verdict
from a full join b on a.element = b.element and a.series = b.series
"""


@query("ab_diff", AB_SQL)
def ab_diff(t: Tables) -> DataFrame:
    """Two extractions of the orders; a repeated key with another value comes first and doesn't count."""
    side = lambda d, v: d.select(F.col("o_orderpriority").alias("element"), F.col("o_orderkey").cast("string").alias("series"), F.col("o_orderstatus").alias("period"), F.lit(1).alias("ord"), F.format_number(v, 2).alias("value"))
    a = side(t.orders.filter("o_orderkey % 10 <> 3"), F.col("o_totalprice"))
    b = side(t.orders.filter("o_orderkey % 10 <> 4"), F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") * 1.1).otherwise(F.col("o_totalprice")))
    early = a.withColumn("ord", F.lit(0)).withColumn("value", F.lit("?")).withColumn("element", F.concat(F.lit("  "), F.upper("element")))
    return matching.extraction_diff(a.unionByName(early), b).select("element", "series", "verdict")


@query(
    "sheet_diff",
    """with a as (select o_orderstatus as sheet, o_orderkey as r, o_orderpriority as v from orders where o_orderkey % 8 <> 1), b as (select o_orderstatus as sheet, o_orderkey as r, case when o_orderkey % 9 = 0 then upper(o_orderpriority) || '!' else o_orderpriority end as v from orders where o_orderkey % 8 <> 2)
    select coalesce(a.sheet, b.sheet) as sheet, coalesce(a.r, b.r) as r, coalesce(trim(a.v), '') as a, coalesce(trim(b.v), '') as b from a full join b on a.sheet = b.sheet and a.r = b.r where coalesce(trim(a.v), '') <> coalesce(trim(b.v), '')""",
)
def sheet_diff(t: Tables) -> DataFrame:
    cells = lambda d, v: d.select(F.col("o_orderstatus").alias("sheet"), F.col("o_orderkey").alias("r"), v.alias("value"))
    p = F.col("o_orderpriority")
    return matching.sheet_diff(cells(t.orders.filter("o_orderkey % 8 <> 1"), p), cells(t.orders.filter("o_orderkey % 8 <> 2"), F.when(F.col("o_orderkey") % 9 == 0, F.concat(F.upper(p), F.lit("!"))).otherwise(p)), ["sheet", "r"])


@query("correction_merge", "select l_orderkey, l_linenumber, l_partkey, case when l_orderkey % 5 = 0 then 'corrected' else l_returnflag end as value from lineitem where l_orderkey % 5 > 0 or l_linenumber <= 2")
def correction_merge(t: Tables) -> DataFrame:
    base = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_returnflag").alias("value"))
    new = base.filter("l_orderkey % 5 = 0 and l_linenumber <= 2").withColumn("value", F.lit("corrected"))
    gone = base.filter("l_orderkey % 5 = 0").select("l_orderkey").distinct()  # an order all of whose lines were corrected away goes too
    return matching.replace_rows(base.join(gone, "l_orderkey", "left_anti"), new, ["l_orderkey"])


@query("index_upsert", "select o_custkey as section_id, case when m is null then 'old' else 'order ' || m end as sheet from (select o_custkey, max(case when o_orderstatus = 'F' then o_orderkey end) as m from orders group by 1)")
def index_upsert(t: Tables) -> DataFrame:
    index = t.orders.select(F.col("o_custkey").alias("section_id"), F.lit("old").alias("sheet")).distinct()
    new = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("section_id"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("sheet"), "o_orderkey")
    return matching.upsert_last(index, new, "section_id", "o_orderkey")


@query(
    "pair_by_position",
    """with t as (select o_custkey as k, o_orderkey as o, row_number() over (partition by o_custkey order by o_orderkey) as n from orders), g as (select s_suppkey * 10 % 1500 as k, s_suppkey as g, row_number() over (partition by s_suppkey * 10 % 1500 order by s_suppkey) as n from supplier), c as (select k, max(n) as m from g group by 1)
    select t.k as custkey, t.o as orderkey, g.g as grid from t left join c on c.k = t.k left join g on g.k = t.k and g.n = least(t.n, c.m)""",
)
def pair_by_position(t: Tables) -> DataFrame:
    tables = t.orders.select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"))
    grids = t.supplier.select((F.col("s_suppkey") * 10 % 1500).alias("custkey"), F.col("s_suppkey").alias("orderkey"))
    return matching.pair_by_position(tables, grids, ["custkey"], "orderkey").select("custkey", "orderkey", "grid")


@query("cached_work", "select o_orderkey from orders where not (o_orderstatus = 'F' and o_orderkey % 4 > 0)")
def cached_work(t: Tables) -> DataFrame:
    work = t.orders.select("o_orderkey", "o_custkey")
    done = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 4 == 0).alias("partial"))
    return matching.cached(work, done, ["o_orderkey", "o_custkey"]).select("o_orderkey")


WORD = "list_distinct(regexp_extract_all(lower({}), '[a-z0-9]+'))"
TITLES_SQL = f"""tb as (select page_id // 25 as page, page_id as l, case when page_id % 9 = 0 then '1.' || (page_id // 25 * 4 + page_id % 4) end as tag, {WORD.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")} as w from pages),
lf as (select item_id // 4 as page, item_id as r, '1.' || item_id as num, {WORD.format("text")} as w, row_number() over (partition by item_id // 4 order by item_id) as k from benchmark)"""


def _titles(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Texts of the benchmark as leaves, four to a shared page; titles of web pages as tables, twenty-five to one, every ninth tagged."""
    leaves = t.benchmark.select(F.expr("item_id div 4").alias("page"), F.col("item_id").alias("r_ord"), F.concat(F.lit("1."), F.col("item_id").cast("string")).alias("number"), F.col("text").alias("title"))
    tag = F.concat(F.lit("1."), F.expr("page_id div 25 * 4 + page_id % 4").cast("string"))
    tables = t.pages.select(F.expr("page_id div 25").alias("page"), F.col("page_id").alias("l_ord"), F.when(F.col("page_id") % 9 == 0, tag).alias("section_id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    return tables, leaves


ROUTE_SQL = f"""with recursive {TITLES_SQL},
tg as (select tb.*, lf.r as t from tb left join lf on lf.page = tb.page and lf.num = tb.tag),
p as (select tg.page, tg.l, lf.r, lf.k, len(list_intersect(tg.w, lf.w)) / greatest(len(lf.w), 1) as s from tg join lf on lf.page = tg.page where t is null and len(list_intersect(tg.w, lf.w)) > 0),
pl as (select page, list({{'l': l, 'r': r, 's': s}} order by s desc, l, k) as ps from p group by page), fl as (select page, list(distinct t) as f from tg where t is not null group by page),
st(page, i, placed, taken, hit) as (select pl.page, 0::bigint, []::bigint[], coalesce(f, []::bigint[]), null::struct(l bigint, r bigint, s double) from pl left join fl on fl.page = pl.page
 union all select page, i + 1, case when ok then list_append(placed, x.l) else placed end, case when ok then list_append(taken, x.r) else taken end, case when ok then x end
 from (select st.page, i, placed, taken, ps[i + 1] as x, not list_contains(placed, ps[i + 1].l) and (ps[i + 1].s >= 0.5 or not list_contains(taken, ps[i + 1].r)) as ok from st join pl on pl.page = st.page where i < len(ps)) q),
o as (select tg.page, tg.l, t, hit.r as h, hit.s as s, coalesce(t, hit.r) as own from tg left join st on st.page = tg.page and hit.l = tg.l),
b as (select *, last_value(own ignore nulls) over (partition by page order by l rows between unbounded preceding and 1 preceding) as above from o),
n as (select *, row_number() over (partition by page, coalesce(own, above) is null order by l) as n, count(*) over (partition by page) as tables from b),
fr as (select page, r, row_number() over (partition by page order by k) as n from lf where not exists (select 1 from o where o.page = lf.page and o.own = lf.r)), e as (select page, arg_max(r, k) as last, count(*) as leaves from lf group by page)
select n.page, n.l as l_ord, coalesce(own, above, fr.r, last) as r_ord, case when t is not null then 'section_id' when h is not null then 'title' when above is not null then 'overflow' else 'order' end as method,
round(case when t is not null then 1.0 else coalesce(s, 0) end::double, 6) as score, own is null or (t is null and s < 0.34) or tables <> leaves as flagged from n join e on e.page = n.page left join fr on fr.page = n.page and fr.n = n.n"""


@query("greedy_route", ROUTE_SQL)
def greedy_route(t: Tables) -> DataFrame:
    return matching.route_tables(*_titles(t)).withColumn("score", F.round("score", 6))


MATCH_SQL = f"""with recursive {TITLES_SQL}, stop as (select ['a', 'b', 'c', 'the', 'of', 'and'] as x),
x as (select tb.page, l, list_filter(w, lambda y: not list_contains(stop.x, y)) as w from tb, stop), y as (select lf.page, r, row_number() over (partition by page order by r) as i, list_filter(w, lambda y: not list_contains(stop.x, y)) as w from lf, stop),
p as (select y.page, y.r, x.l, len(list_intersect(x.w, y.w)) / least(len(x.w), len(y.w)) as s from x join y on x.page = y.page where len(list_intersect(x.w, y.w)) > 0),
g as (select page, i, r, list({{'l': l, 's': s}} order by s desc, l) filter (l is not null) as c from y left join p using (page, r) group by page, i, r),
st(page, i, used, r, hit) as (select distinct page, 0::bigint, []::bigint[], null::bigint, null::struct(l bigint, s double) from g
 union all select page, i + 1, case when b.s >= 0.34 then list_append(used, b.l) else used end, r, case when b.s >= 0.34 then b end from (select st.page, st.i, used, g.r, list_filter(g.c, lambda y: not list_contains(used, y.l))[1] as b from st join g on g.page = st.page and g.i = st.i + 1) q)
select page, r as r_ord, hit.l as l_ord, round(coalesce(hit.s, 0), 2)::double as score from st where i > 0"""


@query("greedy_tab_match", MATCH_SQL)
def greedy_tab_match(t: Tables) -> DataFrame:
    tables, leaves = _titles(t)
    return matching.match_tabs(leaves, tables, "page").select("page", "r_ord", "l_ord", "score")
