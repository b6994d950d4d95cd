"""Queries on section trees, page ranges and table structure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.operators import checks, grids, sections
from tableloom.plans.registry import Tables, query

NUMBERS_SQL = """select 'r' || r_regionkey as part, 1 as kind, r_regionkey::varchar as number, 0 as page from region union all
 select 'r' || n_regionkey, 2, n_regionkey || '.' || n_nationkey, 0 from nation union all
 select 'r' || n_regionkey, 3, n_regionkey || '.' || n_nationkey || '.' || c_custkey, c_custkey from customer join nation on n_nationkey = c_nationkey"""


def numbers(t: Tables) -> DataFrame:
    """Regions, nations and customers as dotted section numbers, a part for each region."""
    s = lambda *c: F.concat_ws(".", *(F.col(x).cast("string") for x in c))
    part = lambda c: F.concat(F.lit("r"), F.col(c).cast("string")).alias("part")
    r = t.region.select(part("r_regionkey"), s("r_regionkey").alias("number"), F.lit(0).cast("long").alias("page"))
    n = t.nation.select(part("n_regionkey"), s("n_regionkey", "n_nationkey").alias("number"), F.lit(0).cast("long").alias("page"))
    c = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select(part("n_regionkey"), s("n_regionkey", "n_nationkey", "c_custkey").alias("number"), F.col("c_custkey").alias("page"))
    return r.unionByName(n).unionByName(c).withColumn("doc_id", F.lit(1))


@query("section_tree_leaves", f"with s as ({NUMBERS_SQL}) select part, number, not exists (select 1 from s b where b.part = a.part and b.kind = a.kind + 1 and starts_with(b.number, a.number || '.')) as is_leaf from s a")
def section_tree_leaves(t: Tables) -> DataFrame:
    return sections.leaves(numbers(t)).select("part", "number", "is_leaf")


@query(
    "node_ranges",
    f"with s as ({NUMBERS_SQL}), c as (select * from s where kind = 3) select part, p as number, min(page) as start_page, max(page) as end_page from (select part, page, unnest([split_part(number, '.', 1), split_part(number, '.', 1) || '.' || split_part(number, '.', 2), number]) as p from c) group by all",
)
def node_ranges(t: Tables) -> DataFrame:
    leaves = numbers(t).filter(F.size(F.split("number", "[.]")) == 3).withColumn("start_page", F.col("page")).withColumn("end_page", F.col("page"))
    return sections.node_ranges(leaves).select("part", "number", "start_page", "end_page")


@query(
    "section_ranges",
    "select o_orderkey, d as start_page, coalesce(greatest(d, lead(d) over (partition by o_custkey order by d, o_orderkey) - 1), 99999)::bigint as end_page from (select *, datediff('day', date '1990-01-01', o_orderdate::date) as d from orders)",
)
def section_ranges(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", F.date_diff("o_orderdate", F.lit("1990-01-01")).cast("long").alias("start_page"))
    return sections.end_pages(rows, ["o_custkey"], ["o_orderkey"], F.lit(99999).cast("long")).drop("o_custkey")


@query(
    "shared_starts",
    "select o_custkey::varchar as doc_id, o_orderdate::date::varchar as start_page, count(*) as n, string_agg(o_orderkey::varchar, ', ' order by o_orderkey) as section_ids from orders group by 1, 2 having count(*) > 1",
)
def shared_starts(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").cast("string").alias("doc_id"), F.to_date("o_orderdate").cast("string").alias("start_page"), F.col("o_orderkey").cast("string").alias("number"), F.col("o_orderkey").cast("string").alias("section_id"))
    return sections.shared_starts(rows)


@query(
    "fill_forward_anchor",
    "select event_id, coalesce(last_value(case when event_type = 'signup' then value end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row), 1.0) as anchor from events",
)
def fill_forward_anchor(t: Tables) -> DataFrame:
    rows = t.events.withColumn("found", F.when(F.col("event_type") == "signup", F.col("value")))
    return sections.carry_forward(rows, "found", ["user_id"], ["ts", "event_id"], F.lit(1.0), "anchor").select("event_id", "anchor")


@query(
    "page_runs",
    "with m as (select distinct o_custkey, (year(o_orderdate) * 12 + month(o_orderdate))::bigint as m from orders) select o_custkey, min(m) as low, max(m) as high, count(*) as n from (select *, m - row_number() over (partition by o_custkey order by m) as i from m) group by o_custkey, i",
)
def page_runs(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("long").alias("m"))
    return sections.runs(rows, ["o_custkey"], "m")


UNITS_SQL = """with r as (select l_suppkey, l_orderkey, min(l_linenumber) as low, max(l_linenumber) as high from lineitem group by all), p as (select l_suppkey, unnest(range(low, high + 1)) as page from r)
select l_suppkey, page::int as page, count(*) as owners, case when count(*) > 1 then 'multiple' else 'own' end as kind from p group by all"""


@query("unit_pages", UNITS_SQL)
def unit_pages(t: Tables) -> DataFrame:
    ranges = t.lineitem.groupBy("l_suppkey", "l_orderkey").agg(F.min("l_linenumber").alias("low"), F.max("l_linenumber").alias("high"))
    return sections.page_owners(ranges, ["l_suppkey"], "low", "high")


@query(
    "page_chunks",
    "select l_orderkey, l_linenumber, case when count(*) over (partition by l_orderkey) >= 5 then 0 else (row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) - 1) // 2 end::int as chunk from (select distinct l_orderkey, l_linenumber, l_partkey from lineitem)",
)
def page_chunks(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").distinct().withColumn("at", F.struct("l_linenumber", "l_partkey"))
    return sections.chunks(rows, ["l_orderkey"], "at").select("l_orderkey", "l_linenumber", "chunk")


PARENT_SQL = """
with r as (select user_id, event_id, case when event_id % 3 = 0 then null else 'e' || event_id end as row_id, (event_id % 4)::int as level, event_id % 7 = 0 as note from events),
c as (select *, last_value(case when not note and level <= 1 then event_id * 10 + level end ignore nulls) over w as c2, last_value(case when not note and level <= 2 then event_id * 10 + level end ignore nulls) over w as c3 from r window w as (partition by user_id order by event_id rows between unbounded preceding and 1 preceding)),
u as (select *, case when note then null when level = 2 and c2 % 10 = 1 then c2 // 10 when level = 3 and c3 % 10 = 2 then c3 // 10 end as up from c),
n as (select u.user_id, u.up as event_id, min(u.event_id) as f from u where up is not null group by all),
k as (select n.user_id, n.event_id, coalesce(r.row_id, 'h' || row_number() over (partition by n.user_id, r.row_id is null order by f)) as id from n join r on r.event_id = n.event_id)
select u.event_id, u.level, coalesce(u.row_id, o.id) as row_id, case when u.note then 'kept' else p.id end as parent from u left join k p on p.event_id = u.up left join k o on o.event_id = u.event_id
"""


@query("parent_fill", PARENT_SQL)
def parent_fill(t: Tables) -> DataFrame:
    e = F.col("event_id")
    rows = t.events.select("user_id", "event_id", F.when(e % 3 == 0, None).otherwise(F.concat(F.lit("e"), e.cast("string"))).alias("row_id"), (e % 4).cast("int").alias("level"), F.when(e % 7 == 0, "note").otherwise("data").alias("row_type"), F.when(e % 7 == 0, "kept").alias("parent"))
    return grids.fill_parents(rows, ["user_id"], "event_id", 3).select("event_id", "level", "row_id", "parent")


BLOCK_SQL = """
with o as (select o_custkey, year(o_orderdate) as y, o_orderkey from orders),
h as (select distinct o_custkey, y from (select o_custkey, y from o union all select o_custkey, 1990 from o where o_custkey % 10 = 0) where o_custkey % 4 > 0 or y = 1995),
a as (select o_custkey, y, 0 as o_orderkey, true as head from h union all select o_custkey, y, o_orderkey, false from o),
b as (select *, count(case when head then 1 end) over (partition by o_custkey order by y, head desc, o_orderkey) as b from a),
f as (select *, max(case when head then 0 else 1 end) over (partition by o_custkey, b) as filled from b),
s as (select *, max(b) over (partition by o_custkey) >= 2 and min(case when b > 0 then filled end) over (partition by o_custkey) = 1 as split from f),
d as (select *, case when split then greatest(b, 1) else 1 end as block from s),
e as (select *, max(case when head then 'Dec ' || y end) over (partition by o_custkey, block) as date from d)
select o_custkey, o_orderkey, block::int as block, case when split then 'T — ' || date else 'T' end as title from e where not (split and head)
"""


@query("date_block_split", BLOCK_SQL)
def date_block_split(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderkey")
    empty = o.filter("o_custkey % 10 = 0").select("o_custkey", F.lit(1990).alias("y"))
    heads = o.select("o_custkey", "y").unionByName(empty).filter("o_custkey % 4 > 0 or y = 1995").distinct()
    rows = heads.select("o_custkey", "y", F.lit(0).cast("long").alias("o_orderkey"), F.lit("section_header").alias("row_type"), F.concat(F.lit("Dec "), F.col("y").cast("string")).alias("label"), F.lit(0).alias("n_values"))
    rows = rows.unionByName(o.select("o_custkey", "y", "o_orderkey", F.lit("data").alias("row_type"), F.lit("order").alias("label"), F.lit(2).alias("n_values")))
    rows = rows.withColumn("row_idx", F.struct("y", F.col("n_values") > 0, "o_orderkey")).withColumn("title", F.lit("T"))
    return grids.split_date_blocks(rows, ["o_custkey"]).select("o_custkey", "o_orderkey", "block", "title")


@query(
    "continuation_stitch",
    """with r as (select *, turn % 3 > 0 as cont, case when conv_id % 5 = 0 then 'T' else '' end as title, 2 + (conv_id % 7 = 0 and turn % 2 = 0)::int as n, case when role = 'system' then 'section_header' else 'data' end as f from conversations)
    select conv_id, turn, sum(case when coalesce(cont and title = '' and n = lag and f <> 'section_header', false) then 0 else 1 end) over (partition by conv_id order by turn, role, text)::bigint as head from (select *, lag(n) over (partition by conv_id order by turn, role, text) as lag from r)""",
)
def continuation_stitch(t: Tables) -> DataFrame:
    rows = t.conversations.select("conv_id", "turn", F.struct("turn", "role", "text").alias("at"), (F.col("turn") % 3 > 0).alias("continued"), F.when(F.col("conv_id") % 5 == 0, "T").otherwise("").alias("title"), (2 + ((F.col("conv_id") % 7 == 0) & (F.col("turn") % 2 == 0)).cast("int")).alias("n_cols"), F.when(F.col("role") == "system", "section_header").otherwise("data").alias("first_type"))
    return grids.stitch(rows, ["conv_id"], "at").select("conv_id", "turn", "head")


@query("duplicate_labels", "select p_brand, trim(p_type) as label, count(*) as n from part where p_size % 5 > 0 and trim(p_type) <> '' group by all having count(*) > 1")
def duplicate_labels(t: Tables) -> DataFrame:
    rows = t.part.select("p_brand", F.col("p_type").alias("label"), F.when(F.col("p_size") % 5 > 0, "data").otherwise("note").alias("row_type"))
    return checks.duplicate_labels(rows, ["p_brand"])


@query("span_mismatch", "select l_orderkey, count(*)::int as n_values, (l_orderkey % 6)::int as n_cols from lineitem group by l_orderkey having count(*) <> l_orderkey % 6")
def span_mismatch(t: Tables) -> DataFrame:
    rows = t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("values")).withColumn("n_cols", (F.col("l_orderkey") % 6).cast("int"))
    return checks.span_mismatch(rows).select("l_orderkey", "n_values", "n_cols")


SPAN_SQL = """with c as (select l_orderkey, l_linenumber, l_partkey, (1 + l_linenumber % 3)::int as span from (select distinct l_orderkey, l_linenumber, l_partkey from lineitem)),
p as (select *, (sum(span) over (partition by l_orderkey order by l_linenumber, l_partkey) - span)::int as pos from c), g as (select l_orderkey, l_partkey, pos, unnest(range(span)) as i from p)
select l_orderkey, (pos + i)::int as col, case when i = 0 then l_partkey::varchar else '' end as text from g"""


@query("span_grid", SPAN_SQL)
def span_grid(t: Tables) -> DataFrame:
    cells = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    cells = cells.select("l_orderkey", F.lit(0).alias("row"), F.concat(F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.lpad(F.col("l_partkey").cast("string"), 12, "0")).alias("ord"), F.lit(1).alias("row_span"), (1 + F.col("l_linenumber") % 3).alias("col_span"), F.col("l_partkey").cast("string").alias("text"))
    return grids.expand_spans(cells, ["l_orderkey"]).select("l_orderkey", "col", "text")


NULLS_SQL = """with r as (select user_id, event_id, case when event_type in ('click', 'view') then null else event_type end as v from events), n as (select *, greatest(count(v) over (partition by user_id order by event_id), 1) as n from r)
select user_id, min(event_id) as first_col, count(*) as span, max(v) as value from n group by user_id, n having max(v) is not null"""


@query("null_spans", NULLS_SQL)
def null_spans(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.col("event_id").alias("col_idx"), F.when(~F.col("event_type").isin("click", "view"), F.col("event_type")).alias("value"))
    return grids.null_spans(rows, ["user_id"]).drop("ord")


GROUPS_SQL = """with c as (select l_orderkey, l_linenumber, case when l_returnflag = 'N' then null else l_returnflag end as g from (select distinct on (l_orderkey, l_linenumber) * from lineitem order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag)),
n as (select *, coalesce(g = lag(g) over w, false) as same from c window w as (partition by l_orderkey order by l_linenumber)), r as (select *, sum((not same)::int) over (partition by l_orderkey order by l_linenumber) as run from n)
select l_orderkey, min(g) as "group", min(l_linenumber) as first_col, max(l_linenumber) as last_col from r group by l_orderkey, run"""


@query("header_groups", GROUPS_SQL)
def header_groups(t: Tables) -> DataFrame:
    rows = sections.keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_returnflag"])
    rows = rows.select("l_orderkey", F.col("l_linenumber").alias("col_idx"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("group"))
    return grids.header_groups(rows, ["l_orderkey"])


JSON_SQL = """with p as (select event_id, json_extract_string(props, '$.k') as k from events)
select event_id, i::int as col_idx, case i when 0 then k when 1 then '-' else '' end as value, case when i = 0 then case when k = '0' then 'zero' else 'reported' end when i = 1 then 'nil' else 'empty' end as cell_state, case when i = 0 then k::double end as num from p, range(3) t(i) where event_id % 2 = 0
union all select event_id, 0, k, case when k = '0' then 'zero' else 'grey' end, k::double from p where event_id % 2 = 1"""


@query("json_upgrade", JSON_SQL)
def json_upgrade(t: Tables) -> DataFrame:
    """Model answers made of event properties: string cells in even events, cells with an old state name in odd ones."""
    k = F.get_json_object("props", "$.k")
    table = '{"tables":[{"title":"t","columns":[{"leaf":"a"},{"leaf":"b"},{"leaf":"c"}],"rows":[{"label":"x","level":1,"row_type":"data","values":['
    old = F.concat(F.lit("```json\n" + table + '"'), k, F.lit('","—",""]}]}]}\n```'))
    new = F.concat(F.lit("Here it is: " + table + '{"value":"'), k, F.lit('","cell_state":"suppressed"}]}]}]}'))
    raw = t.events.select(F.col("event_id").alias("doc_id"), F.when(F.col("event_id") % 2 == 0, old).otherwise(new).alias("raw"))
    return grids.long_cells(grids.parse_tables(raw)).select(F.col("doc_id").alias("event_id"), "col_idx", "value", "cell_state", "num")
