"""Queries on slides: data points of answers, and the cells in which elements are shown."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.operators import points, slides
from tableloom.plans.contents import text
from tableloom.plans.registry import Tables, query

ANSWER_SQL = """with l as (select distinct l_orderkey as o, l_linenumber as n, l_partkey as p, l_quantity::int as q from lineitem), r as (select *, row_number() over (partition by o order by n, p, q) - 1 as i from l)
select o as slide, i::int as "order", case i % 5 when 0 then 'section_header' when 1 then 'note' when 2 then 'sub' when 3 then 'start' else 'data' end as row_type,
case i % 4 when 0 then '—' when 1 then '' else q::varchar end as value, case when i % 5 = 0 then 'section_header' when i % 7 = 6 then 'suppressed' when i % 4 = 0 then 'nil' when i % 4 = 1 then 'not_disclosed' else 'reported' end as status,
case when i % 5 = 0 or i % 7 = 6 then null when i % 4 = 0 then 0 when i % 4 = 1 then null else q end::double as num, 'Doc#slide' || o || ':elem3:S' || p || case when i % 2 = 0 then ':1Q25' else '' end as source_ref,
case when i % 3 = 0 then 'YoY %' end as label from r"""


@query("slide_points", ANSWER_SQL)
def slide_points(t: Tables) -> DataFrame:
    """Answers as JSON made of the lines of orders: role aliases, defaults, nested extra fields, printed dashes and blanks."""
    rows = t.lineitem.select(F.col("l_orderkey").alias("slide"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_quantity").cast("int").alias("q")).distinct()
    at = F.struct("n", "p", "q")
    one = rows.groupBy("slide").agg(F.array_sort(F.collect_list(at)).alias("a"))
    roles = F.array(*map(F.lit, ["header", "commentary", "sub_header", "opening", "data"]))

    def point(x, i):
        value = F.when(i % 4 == 0, "—").when(i % 4 == 1, "").otherwise(x["q"].cast("string"))
        period = F.when(i % 2 == 0, ',"period":"1Q25"').otherwise("")
        extra = F.when(i % 3 == 0, ',"extra_fields":{"yoy_pct":"3%","yoy_pct_label":"YoY %","deep":{"a":1}}').otherwise("")
        hidden = F.when(i % 7 == 6, ',"suppressed":true').otherwise("")
        return F.concat(F.lit('{"series":"S'), x["p"].cast("string"), F.lit('","value":"'), value, F.lit('","row_type":"'), F.get(roles, i % 5), F.lit('"'), period, extra, hidden, F.lit("}"))

    raw = F.concat(F.lit('```json\n{"slide_title":"T","elements":[{"element_idx":3,"element_type":"text_table","element_title":"E","data_points":['), F.array_join(F.transform("a", point), ","), F.lit("]}]}\n```"))
    found = points.parse_points(one.select("slide", F.lit("B").alias("bank"), F.lit("Doc").alias("doc_title"), raw.alias("raw")))
    return found.select("slide", "order", "row_type", "value", "status", F.col("value_num").alias("num"), "source_ref", F.col("extra_fields")["yoy_pct_label"].alias("label"))


POINTS_SQL = """select o_custkey as slide, (o_orderkey % 2)::int as element, o_orderpriority as series, case when o_orderkey % 11 = 0 then null else year(o_orderdate)::varchar end as period, o_orderkey as o, (floor(o_totalprice)::int)::varchar as v,
o_orderkey % 3 = 0 as has_yoy, o_orderkey % 5 = 0 as has_2030, (o_orderkey % 100)::varchar as x from orders"""


def order_points(t: Tables, kind: str = "text_table") -> DataFrame:
    """Orders as points of two elements a customer; some without a period, with an extra field or one named like a period."""
    k = F.col("o_orderkey")
    x = (k % 100).cast("string")
    none = F.create_map().cast("map<string,string>")
    extra = F.map_concat(F.when(k % 3 == 0, F.create_map(F.lit("yoy"), x)).otherwise(none), F.when(k % 5 == 0, F.create_map(F.lit("2030"), x)).otherwise(none))
    return t.orders.select(
        F.col("o_custkey").alias("slide"), (k % 2).cast("int").alias("element"), F.lit(kind).alias("element_type"), F.col("o_orderpriority").alias("series"), F.when(k % 11 > 0, F.year("o_orderdate").cast("string")).alias("period"),
        k.alias("order"), F.col("o_totalprice").cast("int").cast("string").alias("value"), F.lit("S$m").alias("unit"), (1 + k % 2).cast("int").alias("level"), extra.alias("extra_fields"), F.col("o_orderstatus").alias("row_type"), F.lit("+").alias("sign"),
    )


PIVOT_SQL = f"""with p as ({POINTS_SQL}), per as (select slide, element, period, min(o) as po from p group by all),
c as (select slide, element, period, po, 1 as rank, 0 as a0, 'value' as kind, coalesce(period, 'S$m') as header from per
 union all select p.slide, p.element, p.period, any_value(po), 2, min(o), 'yoy', 'YoY %' from p join per on per.slide = p.slide and per.element = p.element and per.period is not distinct from p.period where has_yoy group by 1, 2, 3
 union all select slide, element, null, null, 3, min(o), '2030', '2030' from p where has_2030 group by 1, 2),
n as (select *, row_number() over (partition by slide, element order by rank = 3, po, rank, a0) + 1 as col from c union all select distinct slide, element, null, null, 0, 0, 'label', '(S$m)', 1 from p),
s as (select slide, element, series, row_number() over (partition by slide, element order by min(o), series) as row, arg_min(1 + o % 2, o) as level from p group by 1, 2, 3),
f as (select distinct on (slide, element, series, period) * from p order by slide, element, series, period, o), one as (select slide, element, arg_min({{'q': period}}, o) as q from p group by 1, 2)
select n.slide, n.element, s.row::int as row, n.col::int as col, header, case kind when 'label' then repeat(' ', (4 * (level - 1))::bigint) || s.series when 'value' then coalesce(v, '') when 'yoy' then coalesce(case when has_yoy then x end, '') else coalesce(case when has_2030 then x end, '') end as text
from n join s on s.slide = n.slide and s.element = n.element join one on one.slide = n.slide and one.element = n.element
left join f on f.slide = n.slide and f.element = n.element and f.series = s.series and kind <> 'label' and f.period is not distinct from case when kind = '2030' then one.q.q else n.period end"""


@query("slide_pivot", PIVOT_SQL)
def slide_pivot(t: Tables) -> DataFrame:
    return slides.pivot_cells(order_points(t), ["slide", "element"])


BRIDGE_SQL = f"""with p as (select *, case o % 3 when 0 then 'start' when 1 then 'bridge' else 'end' end as row_type, case when o % 4 = 0 then '-' else '+' end as sign from ({POINTS_SQL})), f as (select distinct on (slide, element, series, row_type) * from p order by slide, element, series, row_type, o),
r as (select *, row_number() over (partition by slide, element order by o) as row from f), e as (select slide, element, name, min(o) as o from (select slide, element, o, unnest(case when has_yoy then ['yoy'] else [] end || case when has_2030 then ['2030'] else [] end) as name from p) group by 1, 2, 3),
g as (select *, row_number() over (partition by slide, element order by o, name = '2030') + 2 as col from e)
select slide, element, row::int as row, 1 as col, '(S$m)' as header, case when row_type = 'bridge' then '    ' else '' end || series as text from r
union all select slide, element, row::int, 2, 'S$m', case when row_type <> 'bridge' then v when sign = '-' then (-v::int)::varchar else '+' || v end from r
union all select r.slide, r.element, row::int, col::int, case name when 'yoy' then 'YoY %' else '2030' end, case when name = 'yoy' and has_yoy or name = '2030' and has_2030 then x else '' end from r join g on g.slide = r.slide and g.element = r.element"""


@query("slide_bridge", BRIDGE_SQL)
def slide_bridge(t: Tables) -> DataFrame:
    k = F.col("order")
    rows = order_points(t, "waterfall").withColumn("row_type", F.when(k % 3 == 0, "start").when(k % 3 == 1, "bridge").otherwise("end")).withColumn("sign", F.when(k % 4 == 0, "-").otherwise("+"))
    return slides.bridge_cells(rows, ["slide", "element"])


SHAPE_SQL = f"""with p as (select *, case slide % 4 when 0 then 'kpi_grid' when 1 then 'waterfall' when 2 then 'none' else 'pie' end as kind, v[1:1] as w from ({POINTS_SQL})),
m as (select slide, element, count(distinct period) > 1 as several from p where kind = 'kpi_grid' group by 1, 2)
select p.o as "order", case when kind = 'waterfall' then 'bridge' when kind = 'kpi_grid' and not several then 'kpi' else 'pivot' end as shape from p left join m on m.slide = p.slide and m.element = p.element
where kind <> 'none' and not (kind = 'kpi_grid' and period is null and exists (select 1 from p q where q.slide = p.slide and q.element = p.element and q.w = p.w and q.period is not null))"""


@query("element_shapes", SHAPE_SQL)
def element_shapes(t: Tables) -> DataFrame:
    """Elements of four types by turns; values are cut to their first digit so that some repeat."""
    kind = F.get(F.array(*map(F.lit, ["kpi_grid", "waterfall", "none", "pie"])), (F.col("slide") % 4).cast("int"))
    rows = order_points(t).withColumn("element_type", kind).withColumn("value", F.substring("value", 1, 1))
    return slides.with_shape(rows, ["slide", "element"]).select("order", "shape")


@query("kpi_list", """with p as (select distinct on (o_custkey, o_orderpriority) o_custkey as slide, o_orderpriority as series, o_orderkey as o, (floor(o_totalprice)::int)::varchar as v from orders order by o_custkey, o_orderpriority, o_orderkey), r as (select *, row_number() over (partition by slide order by o)::int as row from p)
select slide, row, 1 as col, 'Metric' as header, series as text from r union all select slide, row, 2, 'Value', v from r""")
def kpi_list(t: Tables) -> DataFrame:
    return slides.kpi_cells(order_points(t, "kpi_grid"), ["slide"])


@query("slide_width", f"""with p as ({POINTS_SQL}), e as (select slide, element, count(distinct coalesce(period, '')) as periods, count(distinct case when has_yoy then coalesce(period, '') end) as own, max(has_2030::int) as promoted, max(has_yoy::int) + max(has_2030::int) as every from p group by 1, 2)
select slide, greatest(4, max(case when slide % 3 = 0 then 2 + every when slide % 3 = 1 then 2 else 1 + periods + own + promoted end))::int as n_cols from e group by 1""")
def slide_width(t: Tables) -> DataFrame:
    kind = F.when(F.col("slide") % 3 == 0, "waterfall").when(F.col("slide") % 3 == 1, "kpi_grid").otherwise("text_table")
    return slides.width(order_points(t).withColumn("element_type", kind), ["slide", "element"], ["slide"])


@query("stacked_elements", f"""with p as ({POINTS_SQL}), s as (select slide, element, series, row_number() over (partition by slide, element order by min(o)) as row from p group by 1, 2, 3), h as (select slide, element, max(row) + 3 as h from s group by 1, 2),
b as (select slide, element, 4 + coalesce(sum(h) over (partition by slide order by element rows between unbounded preceding and 1 preceding), 0) as f from h) select s.slide, s.element, series as text, (f + 1 + row)::int as sheet_row from s join b on b.slide = s.slide and b.element = s.element""")
def stacked_elements(t: Tables) -> DataFrame:
    cells = slides.element_cells(order_points(t, "kpi_grid").withColumn("period", F.lit(None).cast("string")), ["slide", "element"]).filter("col = 1")
    return slides.stacked(cells, ["slide"], "element").select("slide", "element", "text", "sheet_row")


@query("extra_keys", f"with p as ({POINTS_SQL}), e as (select slide, name, min(o * 2 + (name = '2030')::int) as a from (select slide, o, unnest(case when has_yoy then ['yoy'] else [] end || case when has_2030 then ['2030'] else [] end) as name from p) group by 1, 2) select slide, name, row_number() over (partition by slide order by a)::int as n from e")
def extra_keys(t: Tables) -> DataFrame:
    return points.extra_keys(order_points(t), ["slide"])


@query("extra_keys_by_period", f"with p as ({POINTS_SQL}) select distinct slide, period, 'yoy' as name, 1 as n from p where has_yoy")
def extra_keys_by_period(t: Tables) -> DataFrame:
    return points.extra_keys(order_points(t), ["slide", "period"], periods=False)


@query("contract_registry", "select distinct p_brand as type, case when p_brand < 'Brand#3' then 'approved' else 'pending_review' end as status from part")
def contract_registry(t: Tables) -> DataFrame:
    """Types that the registry lacks are added for review."""
    known = t.part.select(F.col("p_brand").alias("type")).distinct().filter("type < 'Brand#3'").withColumn("status", F.lit("approved"))
    return points.derived_contracts(known, t.part.select(F.col("p_brand").alias("type")))


@query("needs_check", "select o_orderkey from orders where o_orderkey % 3 < 2 and o_orderkey % 5 > 1")
def needs_check(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    source = F.when(k % 3 == 0, "chart").when(k % 3 == 1, "unverified").otherwise("table")
    return t.orders.filter(points.needs_check(source, F.when(k % 5 == 0, "-").when(k % 5 == 1, "?").otherwise(text(k)))).select("o_orderkey")
