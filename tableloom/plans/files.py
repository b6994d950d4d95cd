"""Queries that write the files of the document pipeline and read them again."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.plans.contents import K, ranked, text
from tableloom.plans.registry import Tables, query
from tableloom.scratch import Scratch
from tableloom.sources import json_files


def put(t: Tables, rows: DataFrame, name: str) -> str:
    """Writes rows (value) as lines of text files in the shared folder."""
    path = Scratch(t.spark, f"files-{name}").table(name)
    rows.select("value").write.text(path)
    return path


def put_arrays(t: Tables, rows: DataFrame, key: str, name: str) -> str:
    """Writes rows (key, value), values being JSON, as sixteen files of one array each."""
    path = Scratch(t.spark, f"files-{name}").table(name)
    files = rows.groupBy(F.pmod(F.xxhash64(key), F.lit(16)).cast("string").alias("g")).agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ",\n"), F.lit("]")).alias("body"))
    json_files.save_texts(files.select(F.concat("g", F.lit(".json")).alias("path"), "body"), path)
    return path


@query("sections_file", f"with k as {K} select o_custkey::varchar as title, 'A.' || k as section_id, k::varchar as number, o_orderkey::int as start_page from k where o_orderkey % 4 > 0")
def sections_file(t: Tables) -> DataFrame:
    """Contents files of several documents each."""
    leaf = F.struct(text("A.", F.col("k")).alias("section_id"), F.lit("A").alias("part"), F.col("k").cast("string").alias("number"), F.col("o_custkey").cast("string").alias("title"), F.col("o_orderkey").cast("int").alias("start_page"))
    docs = ranked(t).filter("o_orderkey % 4 > 0").groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(leaf).alias("sections"))).alias("value"))
    return json_files.load_sections(t.spark, put_arrays(t, docs, "o_custkey", "sections")).select("title", "section_id", "number", "start_page")


@query("index_file", "select o_orderkey::varchar as section_id, 'tab ' || o_custkey as sheet, o_orderkey::int as start_page from orders")
def index_file(t: Tables) -> DataFrame:
    """Index entries, the old key in every third; a missing index is empty."""
    k = F.col("o_orderkey")
    tab = text("tab ", F.col("o_custkey"))
    one = F.to_json(F.struct(k.cast("string").alias("section_id"), F.when(k % 3 > 0, tab).alias("sheet"), F.when(k % 3 == 0, tab).alias("first_tab"), k.cast("int").alias("start_page")))
    found = json_files.load_index(t.spark, put_arrays(t, t.orders.select("o_orderkey", one.alias("value")), "o_orderkey", "index"))
    return found.unionByName(json_files.load_index(t.spark, Scratch(t.spark, "files-none").table("none"))).select("section_id", "sheet", "start_page")


@query("manifest_file", f"with k as {K} select k::int as table_no, 't' || o_orderkey as table_id, (k || '+' || k + 1) as pages from k")
def manifest_file(t: Tables) -> DataFrame:
    path = Scratch(t.spark, "files-manifest").table("manifest")
    rows = ranked(t).select(F.col("k").cast("int").alias("table_no"), text("t", F.col("o_orderkey")).alias("table_id"), *(F.lit("x, \"y\"").alias(c) for c in ("section_id", "section_title", "table_title")), F.col("k").cast("int").alias("start_page"), (F.col("k") + 1).cast("int").alias("end_page"), text(F.col("k"), "+", F.col("k") + 1).alias("pages"), F.lit(2).alias("n_pages"), F.lit("spanning").alias("layout"), F.lit("").alias("dates"), F.lit("False").alias("needs_agent_review"))
    json_files.save_csv(rows, path)
    return json_files.load_manifest(t.spark, path).select("table_no", "table_id", F.array_join(F.transform("pages", lambda p: p.cast("string")), "+").alias("pages"))


@query("ledger_file", "select 'l' || o_orderkey as label, case when o_orderkey % 5 > 0 then o_custkey end as prompt_tokens, o_orderkey % 5 = 0 as corrupt from orders where o_orderkey % 5 > 0 union all select null, null, true from orders where o_orderkey % 5 = 0")
def ledger_file(t: Tables) -> DataFrame:
    """Usage records by line, every fifth cut off."""
    one = F.to_json(F.struct(text("l", F.col("o_orderkey")).alias("label"), F.col("o_custkey").alias("prompt_tokens"), F.lit(0.5).alias("est_cost_usd")))
    cut = F.when(F.col("o_orderkey") % 5 == 0, F.lit('{"label": "l')).otherwise(one)
    return json_files.load_ledger(t.spark, put(t, t.orders.select(cut.alias("value")), "ledger")).select("label", "prompt_tokens", F.col("corrupt").isNotNull().alias("corrupt"))


@query("meta_files", "select o_orderkey::varchar as unit_id, case o_orderkey % 3 when 2 then 2 * o_custkey else o_custkey end as prompt_tokens, case when o_orderkey % 3 = 0 then 3 else 0 end as n_issues, o_orderkey % 7 = 0 as partial from orders")
def meta_files(t: Tables) -> DataFrame:
    """Audit records with nested usage, flat usage and usage of two passes."""
    k, u = F.col("o_orderkey"), F.struct(F.col("o_custkey").alias("prompt_tokens"))
    form = k % 3
    unit, partial = k.cast("string").alias("unit_id"), F.when(k % 7 == 0, True).alias("partial")
    issues = F.struct(F.array(F.lit("a"), F.lit("b")).alias("span_issues"), F.array(F.lit("c")).alias("number_issues"))
    nested = F.to_json(F.struct(unit, partial, u.alias("usage"), issues.alias("validation")))
    flat = F.to_json(F.struct(unit, partial, F.col("o_custkey").alias("prompt_tokens")))
    passes = F.to_json(F.struct(unit, partial, F.struct(u.alias("usage")).alias("pass1"), F.struct(u.alias("usage")).alias("pass2")))
    one = F.when(form == 0, nested).when(form == 1, flat).otherwise(passes)
    path = put_arrays(t, t.orders.select("o_orderkey", one.alias("value")), "o_orderkey", "meta")
    return json_files.load_meta(t.spark, path).select("unit_id", "prompt_tokens", "n_issues", "partial")


@query("contracts_file", "select distinct p_brand as type from part where p_brand < 'Brand#3'")
def contracts_file(t: Tables) -> DataFrame:
    one = F.to_json(F.struct(F.col("p_brand").alias("type"), F.when(F.col("p_brand") < "Brand#3", "approved").otherwise("pending_review").alias("status")))
    return json_files.approved_contracts(t.spark, put_arrays(t, t.part.select("p_brand", one.alias("value")).distinct(), "p_brand", "contracts")).select("type")


@query("run_summaries", "select n_name as name, n_nationkey % 3 > 0 as placeholder from nation")
def run_summaries(t: Tables) -> DataFrame:
    """Summaries of every third run; the workbooks of the others get a placeholder."""
    one = F.to_json(F.struct(F.col("n_name").alias("name"), F.lit("2025-01-01").alias("generated_at"), F.lit(3).alias("slides")))
    path = put_arrays(t, t.nation.filter("n_nationkey % 3 = 0").select("n_name", one.alias("value")), "n_name", "runs")
    return json_files.run_summaries(t.spark, path, t.nation.select(F.col("n_name").alias("name"))).select("name", F.col("slides").isNull().alias("placeholder"))


@query("last_folders", "select o_custkey::varchar as slug, max('run/' || lpad(o_orderkey::varchar, 9, '0')) as path from orders group by 1")
def last_folders(t: Tables) -> DataFrame:
    return json_files.last_per_slug(t.orders.select(F.col("o_custkey").cast("string").alias("slug"), F.concat(F.lit("run/"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("path")))


@query("first_json", "select o_orderkey, case o_orderkey % 3 when 0 then '{\"a\": ' || o_custkey || '}' when 1 then '[1, 2]' end as json from orders")
def first_json(t: Tables) -> DataFrame:
    """The first value of answers with text before and after it; null where none is whole."""
    k = F.col("o_orderkey") % 3
    raw = F.when(k == 0, text("Here: {\"a\":", F.col("o_custkey"), "} and {\"b\":1}")).when(k == 1, "```json\n[1,2] tail\n```").otherwise('{"a":')
    return json_files.first_json(t.orders.select("o_orderkey", raw.alias("raw"))).select("o_orderkey", "json")


@query("unwrapped_answers", "select o_orderkey, case when o_orderkey % 3 = 0 then 'b' else 'a' end as title from orders")
def unwrapped_answers(t: Tables) -> DataFrame:
    """Of two answers the one of the asked date, else the first."""
    dates = F.when(F.col("o_orderkey") % 3 == 0, "31 Dec 2025").otherwise("30 Jun 2025")
    answer = lambda title, date: F.struct(F.lit(title).alias("title"), date.alias("reporting_date"))
    rows = t.orders.select("o_orderkey", F.array(answer("a", F.lit("1 Jan 2024")), answer("b", dates)).alias("tables"))
    return json_files.unwrap(rows, "Dec 2025").select("o_orderkey", F.col("table.title").alias("title"))


@query("grid_extents", "with c as (select l_orderkey as page, l_suppkey as grid, l_linenumber::int as col, l_quantity as l, l_quantity + 5 as r, l_partkey as top from lineitem), g as (select page, grid, max(top) as top, row_number() over (partition by page order by max(top) desc, grid)::int as grid_no from c group by 1, 2) select c.page, c.grid, col, min(l) as x_left, max(r) as x_right, any_value(grid_no) as grid_no from c join g on g.page = c.page and g.grid = c.grid group by 1, 2, 3")
def grid_extents(t: Tables) -> DataFrame:
    cells = t.lineitem.select(F.col("l_orderkey").alias("page"), F.col("l_suppkey").alias("grid"), F.col("l_linenumber").cast("int").alias("col"), F.col("l_quantity").alias("l"), (F.col("l_quantity") + 5).alias("r"), F.col("l_partkey").alias("top"))
    return json_files.grid_words(cells).drop("top")


SLIDES_SQL = """with c as (select distinct conv_id as o from conversations) select 'b_' || o || '/slide_0' || 1 + o % 9 as slide, case when o % 3 = 0 then 'Slide ' || 1 + o % 9 else 'Title ' || o end as title, (1 + o % 2)::int as points, case when o % 4 = 0 then 'resumed' when o % 4 = 1 then 'single-pass' else 'multi-pass' end as branch from c where o % 5 > 0"""


@query("slides_folder", SLIDES_SQL)
def slides_folder(t: Tables) -> DataFrame:
    """An audit folder of one slide per conversation, three files each; some have no meta, every fifth is of no type."""
    folder = Scratch(t.spark, "files-slides").table("audit")
    rows, k = t.conversations.select("conv_id").distinct(), F.col("conv_id")
    place = text("b_", k, "/slide_0", 1 + k % 9)
    point = F.to_json(F.struct(F.when(k % 3 > 0, text("Title ", k)).alias("slide_title"), F.lit("1").alias("value")))
    points = F.concat(F.lit("["), point, F.when(k % 2 == 1, F.concat(F.lit(","), point)).otherwise(""), F.lit("]"))
    types = F.when(k % 5 == 0, '["none"]').otherwise('["pie", "none"]')
    meta = F.to_json(F.struct(F.lit(0.5).alias("cost_usd"), F.array(F.struct(F.when(k % 4 == 1, "1s").otherwise("2").alias("pass"))).alias("usages")))
    entry = lambda name, body: F.struct(F.concat(place, F.lit(f"/{name}.json")).alias("path"), body.alias("body"))
    files = rows.select(F.explode(F.array(entry("datapoints", points), entry("element_types", types), entry("meta", F.when(k % 4 > 0, meta)))).alias("f")).select("f.*").filter("body is not null")
    json_files.save_texts(files, folder)
    return json_files.load_slides(t.spark, folder).select("slide", "title", "points", "branch")


@query("raw_answers", "select o_orderkey::varchar || ' raw' as value from orders")
def raw_answers(t: Tables) -> DataFrame:
    path = Scratch(t.spark, "files-raw").table("raw")
    json_files.save_raw(t.orders.select(text(F.col("o_orderkey"), " raw").alias("raw")), path)
    return t.spark.read.text(path)


@query("tables_with_grids", "select o_orderkey::varchar as table_id, case when o_orderkey % 3 = 0 then 'g' || o_custkey end as grid from orders")
def tables_with_grids(t: Tables) -> DataFrame:
    table = F.col("o_orderkey").cast("string").alias("table_id")
    return json_files.with_grids(t.orders.select(table), t.orders.filter("o_orderkey % 3 = 0").select(table, text("g", F.col("o_custkey")).alias("grid")))


@query("file_contents", "select distinct base64(o_orderpriority::blob) as base64 from orders")
def file_contents(t: Tables) -> DataFrame:
    """Small files in base64, as a page embeds them."""
    folder = Scratch(t.spark, "files-b64").table("b64")
    json_files.save_texts(t.orders.select(F.concat(F.lit("p/"), F.substring("o_orderpriority", 1, 1), F.lit(".txt")).alias("path"), F.col("o_orderpriority").alias("body")).distinct(), folder)
    return json_files.file_base64(t.spark, f"{folder}/p").select("base64")
