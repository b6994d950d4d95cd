"""Queries on page layouts: words, edges, grids, nested blocks, and what they correct in extracted tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.operators import grids
from tableloom.plans.contents import text
from tableloom.plans.registry import Tables, query

LINES = "(select distinct l_orderkey as o, l_linenumber::int as n, l_partkey as p from lineitem)"


def lines(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").cast("int").alias("n"), F.col("l_partkey").alias("p")).distinct()


EDGE_SQL = """with b as (select l_suppkey, l_quantity::int // 3 * 3 as x, count(*) as n from (select l_suppkey, l_quantity // 3 * 3 as l_quantity from lineitem) group by 1, 2 having count(*) >= 4), g as (select *, coalesce(x - lag(x) over w > 6, true)::int as new from b window w as (partition by l_suppkey order by x)),
r as (select *, sum(new) over (partition by l_suppkey order by x) as run from g) select l_suppkey, min(x)::double as x, sum(n)::bigint as n from r group by l_suppkey, run"""


@query("column_edges", EDGE_SQL)
def column_edges(t: Tables) -> DataFrame:
    """Quantities as x positions, moved to the middle of their bucket."""
    edges = t.lineitem.select("l_suppkey", (F.floor(F.col("l_quantity") / 3) * 3 + 0.4).alias("x0"))
    return grids.column_edges(edges, ["l_suppkey"], 3.0, 4, 6.0)


WORD_SQL = f"select o, n, p, (case when n * 10 + 2 >= 25 then 1 else 0 end + case when n * 10 + 2 >= 45 then 1 else 0 end)::int as col, (p % 5)::int as band from {LINES}"


@query("words_to_columns", WORD_SQL)
def words_to_columns(t: Tables) -> DataFrame:
    x = F.col("n") * 10.0
    words = lines(t).withColumn("text", F.lit("w")).withColumn("x0", x).withColumn("x1", x + 4).withColumn("top", (F.col("p") % 5) * 3 + 1.0)
    return grids.words_to_columns(words, ["o"], [25.0, 45.0]).select("o", "n", "p", "col", "band")


@query("anchored_text", f"select o, (p % 3)::int as band, string_agg('w' || p || '@' || n * 10, ' ' order by n, 'w' || p) as line from {LINES} group by all")
def anchored_text(t: Tables) -> DataFrame:
    words = lines(t).select("o", text("w", F.col("p")).alias("text"), (F.col("n") * 10.0).alias("x0"), ((F.col("p") % 3) * 3 + 1.0).alias("top"))
    return grids.anchored_text(words, ["o"])


HEAD_SQL = f"select o, (n % 3)::int as col, bool_or(p % 13 = 0) or n % 3 = 0 and bool_and(p % 4 > 0) or avg(case when p % 4 = 0 then 1.0 else 0.0 end) >= 0.6 as heads_rows from {LINES} group by o, n % 3"


@query("row_header_columns", HEAD_SQL)
def row_header_columns(t: Tables) -> DataFrame:
    cells = lines(t).select("o", (F.col("n") % 3).cast("int").alias("col"), (F.col("p") % 13 == 0).alias("is_row_header"), F.when(F.col("p") % 4 == 0, "text").otherwise(text(F.col("p"))).alias("text"))
    return grids.row_header_columns(cells, ["o"])


@query("column_map", "with c as (select l_orderkey as o, l_linenumber as col, min(l_partkey) as p from lineitem group by all) select o, col, 'c' || row_number() over (partition by o order by col) as col_id from c where p % 3 > 0")
def column_map(t: Tables) -> DataFrame:
    cols = t.lineitem.groupBy(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("col")).agg((F.min("l_partkey") % 3 == 0).alias("heads_rows"))
    return grids.column_map(cols, ["o"])


BLOCK_SQL = """with o as (select o_orderkey as d, o_custkey as c, row_number() over (order by o_orderkey) as r from orders)
select d as doc_id, 0 as table_no, 'Head ' || d as title, (d % 9)::int as page, 1 as header_rows, 2 as n_rows, c % 3 = 0 as merged from o
union all select d, 1, case when c % 2 = 0 then 'Head ' || d else '' end, 1, 0, 1, false from o"""


@query("layout_tables", BLOCK_SQL)
def layout_tables(t: Tables) -> DataFrame:
    """A table below a heading, and one in plain blocks that stand below it or beside it."""
    d, span = F.col("o_orderkey"), F.when(F.col("o_custkey") % 3 == 0, ',"colSpan":2').otherwise("")
    cell = lambda x: '{"blocks":[{"textBlock":{"text":"' + x + '"}}]'
    one = text('{"tableBlock":{"headerRows":[{"cells":[', cell("h"), span, '}]}],"bodyRows":[{"cells":[', cell("b"), '}]}]},"pageSpan":{"pageStart":', d % 9, "}}")
    two = '{"blocks":[{"blocks":[{"tableBlock":{"bodyRows":[{"cells":[' + cell("x") + "}]}]}}]}]}"
    inside, beside = F.when(F.col("o_custkey") % 2 == 0, "," + two).otherwise(""), F.when(F.col("o_custkey") % 2 == 1, "," + two).otherwise("")
    raw = text('{"document":{"documentLayout":{"blocks":[{"textBlock":{"type":"heading-1","text":"Head ', d, '","blocks":[', one, inside, "]}}", beside, "]}}}")
    return grids.header_rows(grids.flatten_blocks(t.orders.select(d.alias("doc_id"), raw.alias("raw"))))


SPAN_SQL = f"""with l as {LINES}, w as (select o, n, p, row_number() over (partition by o order by n, p) as k from l), c as (select *, unnest(range(1, 5)) as col from w), h as (select * from c where col = 1 or (p + col) % 3 > 0),
s as (select *, coalesce(lead(col) over (partition by o, k order by col), 5) - col as span from h)
select o, k::int as ord, (col - 1)::int as col_idx, case when (p + col) % 7 = 0 then '-' when (p + col) % 5 = 0 then null else (1000 + p + col)::varchar end as value, span::int as span from s"""


@query("layout_spans", SPAN_SQL)
def layout_spans(t: Tables) -> DataFrame:
    """Rows of a grid whose first column has the row's number, of which every third one prints none and goes by position."""
    from pyspark.sql import Window as W

    rows = lines(t).withColumn("k", F.row_number().over(W.partitionBy("o").orderBy("n", "p")).cast("int"))
    cells = rows.withColumn("col", F.explode(F.array(*map(F.lit, range(5))))).filter("col <= 1 or (p + col) % 3 > 0")
    n = F.col("p") + F.col("col")
    shown = F.when(F.col("col") == 0, F.when(F.col("k") % 3 == 0, "").otherwise(text("r", F.col("k")))).when(n % 7 == 0, "-").when(n % 5 == 0, "").otherwise(F.format_number(1000 + n, 0))
    grid = cells.select("o", F.col("k").alias("row"), "col", shown.alias("text"), F.lit(1).alias("col_span"), F.lit(False).alias("is_col_header"), (F.col("col") == 0).alias("is_row_header"))
    head = rows.select("o").distinct().select("o", F.lit(0).alias("row"), F.lit(1).alias("col"), F.lit("2025").alias("text"), F.lit(1).alias("col_span"), F.lit(True).alias("is_col_header"), F.lit(False).alias("is_row_header"))
    extracted = rows.select("o", F.col("k").alias("ord"), text("r", F.col("k")).alias("row_id"), F.lit("data").alias("row_type"))
    return grids.layout_spans(extracted, grid.unionByName(head), rows.select("o").distinct().withColumn("n_cols", F.lit(4)), ["o"])


BORDER_SQL = f"""with l as {LINES}, c as (select o, n, min(p) as p from l group by all), a as (select * from c where p % 4 = 0), v as (select a.o, a.n + 1 as n from a) select c.o, c.n as col_idx, case when p % 4 = 0 then 'anchor' else 'v' || p end as value, case when p % 4 = 0 then 2 else 1 end::int as span
from c where not exists (select 1 from v where v.o = c.o and v.n = c.n)"""


@query("bordered_cells", BORDER_SQL)
def bordered_cells(t: Tables) -> DataFrame:
    cells = lines(t).groupBy("o", "n").agg(F.min("p").alias("p"))
    shown = cells.select("o", F.lit("r").alias("row_id"), F.col("n").alias("col_idx"), text("v", F.col("p")).alias("value"))
    borders = cells.filter("p % 4 = 0").select("o", F.lit("r").alias("row_id"), F.col("n").alias("col_idx"), F.lit(2).alias("span"), F.lit("anchor").alias("value"))
    return grids.with_borders(shown, borders, ["o"]).select("o", "col_idx", "value", "span")


@query("reasonable_answers", "select o_orderkey as doc_id, o_orderkey % 4 < 2 as ok from orders where o_orderkey % 5 > 0 union all select o_orderkey, true from orders where o_orderkey % 5 = 0")
def reasonable_answers(t: Tables) -> DataFrame:
    """Answers with a whole table, one that lacks columns or cells or is no JSON, and answers without tables."""
    k = F.col("o_orderkey")
    whole = '{"tables":[{"title":"t","columns":[{"leaf":"a"}],"rows":[{"label":"x","level":1,"row_type":"data","values":["1"]}]}]}'
    raw = F.when(k % 5 == 0, '{"tables":[]}').when(k % 4 < 2, whole).when(k % 4 == 2, whole.replace('{"leaf":"a"}', "")).otherwise(whole.replace('["1"]', "[]"))
    return grids.reasonable(grids.parse_tables(t.orders.select(k.alias("doc_id"), raw.alias("raw"))))


@query("sheet_rows", f"with l as {LINES}, c as (select o, p % 3 as r, n, min(p) as p from l group by all) select o as doc_id, r::int as row_idx, repeat(' ', 4 * r) || 'row' as label, string_agg(p::varchar, '|' order by n) as cells from c group by o, r")
def sheet_rows(t: Tables) -> DataFrame:
    cells = lines(t).groupBy("o", (F.col("p") % 3).alias("r"), "n").agg(F.min("p").alias("p"))
    long = cells.select(F.col("o").alias("doc_id"), F.lit(0).alias("table_id"), F.col("r").cast("int").alias("row_idx"), (F.col("r") + 1).cast("int").alias("level"), F.lit("row").alias("label"), F.col("n").alias("col_idx"), text(F.col("p")).alias("value"))
    return grids.sheet_rows(long).select("doc_id", "row_idx", "label", F.array_join("cells", "|").alias("cells"))


@query("footnote_hosts", "with r as (select conv_id, turn, row_number() over (partition by conv_id order by turn, role, text) as k, turn % 3 = 0 as notes from conversations) select conv_id, k::int as k, coalesce(last_value(case when not notes then k end ignore nulls) over (partition by conv_id order by k rows unbounded preceding), k)::int as host from r")
def footnote_hosts(t: Tables) -> DataFrame:
    from pyspark.sql import Window as W

    rows = t.conversations.select("conv_id", F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("int").alias("k"), (F.col("turn") % 3 == 0).alias("all_notes"))
    rows = rows.withColumn("n_cols", F.when(F.col("all_notes"), 0).otherwise(2))
    return grids.footnotes_to_previous(rows, ["conv_id"], "k").select("conv_id", "k", "host")


PRINTED_SQL = f"""with c as (select o, n, min(p) as p from {LINES} group by all), r as (select *, sum((p % 3 > 0)::int) over (partition by o order by n) as run from c), g as (select o, run, min(n) as col_idx, count(*)::int as span, arg_min('v' || p, n) filter (p % 4 > 0) as first, arg_min(case when p % 4 > 0 then 'v' || p else '-' end, n) as own, arg_min(p, n) as t from r where run > 0 group by o, run),
m as (select *, max(span) over (partition by o) as most from g) select o, col_idx, span, case when span = 1 then own else coalesce(first, (1000 + t)::varchar) end as value from m where most > 1"""


@query("border_spans", PRINTED_SQL)
def border_spans(t: Tables) -> DataFrame:
    """Lines as columns of one row: every third is merged with its left neighbour, every fourth extracted as a dash."""
    cells = lines(t).groupBy("o", "n").agg(F.min("p").alias("p"))
    printed = cells.select("o", F.lit("r").alias("row_id"), F.col("n").alias("col_idx"), F.when(F.col("p") % 3 > 0, F.format_number(1000 + F.col("p"), 0)).alias("text"))
    extracted = cells.select("o", F.lit("r").alias("row_id"), F.col("n").alias("col_idx"), F.when(F.col("p") % 4 > 0, text("v", F.col("p"))).otherwise("-").alias("value"))
    return grids.border_spans(printed, extracted, ["o"]).select("o", "col_idx", "span", "value")


HINT_SQL = f"""with c as (select o, n % 4 as col, p % 3 as band, max(p) as p from {LINES} group by all), b as (select o, count(distinct band) as bands from c group by o), u as (select o, col from c join b using (o) group by o, col, bands having count(distinct band) >= greatest(1, bands * 0.3)),
s as (select c.o, c.band, c.col, c.p, (select coalesce(max(x.i), -1) + 1 from range(4) x(i) where x.i < c.col and (exists (select 1 from c y where y.o = c.o and y.band = c.band and y.col = x.i) or not exists (select 1 from u where u.o = c.o and u.col = x.i))) as f from c)
select o, band::int as band, f::int as first_col, (col - f + 1)::int as span, (1000 + p)::varchar as value from s where f < col"""


@query("merge_hints", HINT_SQL)
def merge_hints(t: Tables) -> DataFrame:
    cells = lines(t).groupBy("o", (F.col("n") % 4).alias("col"), (F.col("p") % 3).alias("band")).agg(F.max("p").alias("p"))
    words = cells.select("o", text(1000 + F.col("p")).alias("text"), (F.col("col") * 10.0 + 2).alias("x0"), (F.col("col") * 10.0 + 8).alias("x1"), (F.col("band") * 3.0).alias("top"))
    return grids.merge_hints(words, ["o"], [10.0, 20.0, 30.0])


REPAIR_SQL = """with r as (select o_custkey as c, o_orderkey as o, row_number() over (partition by o_custkey order by o_orderkey) as k, count(*) over (partition by o_custkey) as n from orders)
select c, o, case when n >= 2 then case when k = 1 then 'Table — Dec 2024' else 'Table — Dec 2025' end else 'Table' end as title, case when o % 2 = 0 then 'r' || o end as parent from r"""


@query("repaired_tables", REPAIR_SQL)
def repaired_tables(t: Tables) -> DataFrame:
    """A table per customer: a dated header before the first row and one before the second, a child below every second row."""
    from tableloom.plans.contents import ranked

    rows = ranked(t).select(F.col("o_custkey").alias("c"), F.col("o_orderkey").alias("o"), F.col("k").cast("int").alias("k"), F.col("n"))
    cells = lambda d, i, kind, label, level, n, row_id: d.select("c", "o", "n", (F.col("k") * 10 + i).alias("row_idx"), F.lit("Table").alias("title"), F.lit(kind).alias("row_type"), label.alias("label"), F.lit(level).alias("level"), F.lit(n).alias("n_values"), row_id.alias("row_id"), F.lit(None).cast("string").alias("parent"))
    none = F.lit(None).cast("string")
    heads = cells(rows.filter("k <= 2"), 0, "section_header", text("31 Dec ", F.col("k") + 2023), 0, 0, none)
    mains = cells(rows, 1, "data", F.lit("main"), 1, 2, text("r", F.col("o")))
    kids = cells(rows, 2, "data", F.lit("child"), 2, 2, none).withColumn("level", F.when(F.col("o") % 2 == 0, 2).otherwise(1))
    done = grids.repaired(heads.unionByName(mains).unionByName(kids), ["c"])
    return done.filter("label = 'child'").select("c", "o", F.regexp_replace("title", "31 ", "").alias("title"), "parent")
