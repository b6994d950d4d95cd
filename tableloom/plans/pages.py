"""Queries on pages and sheets as work."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.operators import matching, pages
from tableloom.plans.registry import Tables, query


@query("page_text", "select conv_id, string_agg('[PAGE ' || turn || ']' || chr(10) || text, chr(10) order by turn, '[PAGE ' || turn || ']' || chr(10) || text) as text from conversations group by 1")
def page_text(t: Tables) -> DataFrame:
    return pages.page_text(t.conversations.select("conv_id", F.col("turn").alias("page_no"), "text"), ["conv_id"], True)


@query("wanted_pages", "select conv_id as unit_id, turn as page_no, md5(text) as page from conversations where turn in (1, 2 + conv_id % 3)")
def wanted_pages(t: Tables) -> DataFrame:
    """Two pages of every conversation, whose turns are the pages."""
    units = t.conversations.select("conv_id", F.col("conv_id").alias("unit_id")).distinct().withColumn("pages", F.array(F.lit(1).cast("long"), 2 + F.col("unit_id") % 3))
    return pages.wanted(t.conversations.select("conv_id", F.col("turn").alias("page_no"), F.md5("text").alias("page")), units, ["conv_id"]).select("unit_id", "page_no", "page")


@query("table_rules", "with e as (select l_orderkey as doc_id, count_if(l_linenumber % 2 = 1 and l_quantity > 0.1 * 100) >= 2 as ruled from lineitem where l_orderkey % 3 > 0 group by 1) select o_orderkey as doc_id, coalesce(ruled, true) as ruled from orders left join e on doc_id = o_orderkey")
def table_rules(t: Tables) -> DataFrame:
    edges = t.lineitem.filter("l_orderkey % 3 > 0").select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page_no"), F.when(F.col("l_linenumber") % 2 == 1, "h").otherwise("v").alias("orientation"), F.lit(0.0).alias("x0"), F.col("l_quantity").alias("x1"), F.lit(100.0).alias("page_width"))
    return pages.has_table_rules(edges, t.orders.select(F.col("o_orderkey").alias("doc_id"), F.lit(1).alias("page_no")), 2).select("doc_id", "ruled")


@query("plausible_sections", "select o_custkey as doc_id, count(*) as n, count_if(o_orderkey % 4 = 0) as bad, case when count(*) > 12 then 'too many sections' when count_if(o_orderkey % 4 = 0) > greatest(3, count(*) / 3) then 'anchors outside' else '' end as reason from orders group by 1")
def plausible_sections(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("doc_id"), F.when(F.col("o_orderkey") % 4 > 0, 1).alias("start_page"), F.lit(9).alias("n_pages"))
    return pages.plausible(rows, 12).drop("ok")


@query("capped_tables", """with t as (select o_custkey, o_orderkey, datediff('day', date '1990-01-01', o_orderdate::date) as s from orders), l as (select *, greatest(s, least(s + 200, coalesce(lead(s) over (partition by o_custkey order by s, o_orderkey::varchar) - 1, s + 200))) as e from t)
select o_orderkey, s::int as start_page, e::int as end_page, case when e = s then 'single' else 'spanning' end as layout from l""")
def capped_tables(t: Tables) -> DataFrame:
    start = F.date_diff("o_orderdate", F.lit("1990-01-01"))
    rows = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderkey").cast("string").alias("title"), start.alias("start_page"), (start + 200).alias("end_page"), F.lit("spanning").alias("layout"))
    return pages.cap_tables(rows, ["o_custkey"]).select("o_orderkey", "start_page", "end_page", "layout")


@query("stale_sheets", "select p_partkey from part where p_size % 7 = 0 or p_size % 5 = 0 and p_size <= 30")
def stale_sheets(t: Tables) -> DataFrame:
    name = F.when(F.col("p_size") % 7 == 0, F.concat("p_name", F.lit(" (2)"))).otherwise(F.col("p_name"))
    rows = t.part.select("p_partkey", name.alias("name"), (F.col("p_size") % 5).alias("n_data"), F.col("p_size").alias("n_rows"))
    return pages.stale_sheets(rows, 30).select("p_partkey")


@query("sheet_exists", "select c_custkey::varchar as section_id from customer where c_custkey in (select o_custkey from orders where o_orderkey % 3 < 2)")
def sheet_exists(t: Tables) -> DataFrame:
    k = F.col("o_custkey").cast("string")
    sheets = t.orders.filter("o_orderkey % 3 < 2").select(F.when(F.col("o_orderkey") % 3 == 0, F.concat(k, F.lit(" - some title"))).otherwise(F.concat(k, F.lit(" Table 2"))).alias("name"))
    return pages.sheet_exists(t.customer.select(F.col("c_custkey").cast("string").alias("section_id")), sheets)


WORD = "list_distinct(regexp_extract_all(lower({}), '[a-z0-9]+'))"
NEXT_SQL = f"""with p as (select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) as own, url from pages),
s as (select *, len(list_intersect({WORD.format("title")}, {WORD.format("own")})) / greatest(len({WORD.format("own")}), 1) as a, len(list_intersect({WORD.format("title")}, {WORD.format("url")})) / greatest(len({WORD.format("url")}), 1) as b from p)
select page_id from s where not (page_id % 2 = 0 and b > a)"""


@query("next_section_tables", NEXT_SQL)
def next_section_tables(t: Tables) -> DataFrame:
    part = lambda tag: F.regexp_extract("html", f"<{tag}[^>]*>([^<]*)</{tag}>", 1)
    rows = t.pages.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), part("h1").alias("own_title"), F.col("url").alias("next_title"), (F.col("page_id") % 2).alias("next_start"), F.lit(0).alias("last_page"))
    return matching.drop_next_section(rows).select("page_id")


@query("contents_rows", "select o_custkey as section_id, o_orderstatus as title, min(o_orderkey) as page, bool_or(o_orderpriority like '1%') as has_chart from orders group by 1, 2")
def contents_rows(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("section_id"), F.col("o_orderstatus").alias("title"), F.col("o_orderkey").alias("page"), F.col("o_orderpriority").startswith("1").alias("has_chart"))
    return pages.contents_rows(rows)
