"""Queries on printed contents, anchors and headings; lines and pages are made of orders, so that what must come out is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tableloom.functions import text as T, values as V
from tableloom.operators import pages, points, sections
from tableloom.plans.registry import Tables, query

K = "(select *, row_number() over (partition by o_custkey order by o_orderkey) as k, count(*) over (partition by o_custkey) as n from orders)"


def ranked(t: Tables) -> DataFrame:
    """Orders with their number k among the customer's, as sections of a document."""
    w = W.partitionBy("o_custkey")
    return t.orders.withColumn("k", F.row_number().over(w.orderBy("o_orderkey"))).withColumn("n", F.count("*").over(w)).withColumn("doc_id", F.col("o_custkey"))


def text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


CONTENTS_SQL = f"""with k as {K}, e as (select o_custkey as doc_id, case when o_custkey % 2 = 1 then 'G' end as part, k, o_orderkey % 4 as f, o_orderstatus as s from k),
r as (select doc_id, 'section' as kind, part, case f when 2 then k || '.1' else k::varchar end as number, case f when 0 then 'Title ' || s when 1 then 'Scope of the report ' || s else 'Detail ' || s end as title, case f when 0 then (k + 7)::varchar when 1 then 'B-' || k else '' end as page_ref from e where f < 3)
select doc_id, kind, part, number, coalesce(part || '.', '') || number as section_id, title, page_ref from r
union all select distinct o_custkey, 'part', 'G', null, null, 'Capital', '' from orders where o_custkey % 2 = 1"""


@query("contents_entries", CONTENTS_SQL)
def contents_entries(t: Tables) -> DataFrame:
    """Entries on one line, wrapped ones, ones without page, and lines that are no entry; strays between them."""
    k, s = F.col("k"), F.col("o_orderstatus")
    form = F.col("o_orderkey") % 4
    line = F.when(form == 0, F.array(text(k, ". Title ", s, " ........ ", k + 7), F.lit("Disclosure report"))).when(form == 1, F.array(text(k, " Scope of the"), text("report ", s, " …… B-", k), F.lit("stray"))).when(form == 2, F.array(text(k, ".1 Detail ", s))).otherwise(F.array(text(k, " Scope of Basel 3")))
    rows = ranked(t).withColumn("line", line)
    lines = rows.select("doc_id", F.posexplode("line").alias("i", "line"), "k").select("doc_id", (F.col("k") * 10 + F.col("i")).cast("int").alias("line_no"), "line")
    parts = rows.filter("k = 1 and o_custkey % 2 = 1").select("doc_id", F.lit(0).alias("line_no"), F.lit("PART G: Capital ......").alias("line"))
    return sections.parse_contents(sections.merge_wrapped(lines.unionByName(parts))).drop("entry")


TWO_SQL = f"""with k as {K} select o_custkey as doc_id, '1.' || k || case when n >= 2 then ' Title ' || o_orderstatus || case when k = n and o_custkey % 3 = 0 then ' more of it' else '' end else '' end as line from k
union all select o_custkey, 'Title ' || o_orderstatus from k where n = 1 union all select o_custkey, 'more of it' from k where n = 1 and o_custkey % 3 = 0"""


@query("two_column_contents", TWO_SQL)
def two_column_contents(t: Tables) -> DataFrame:
    """A run of bare numbers and then the titles, in every third document one line more than numbers."""
    rows = ranked(t)
    bare = rows.select("doc_id", F.col("k").alias("line_no"), text("1.", F.col("k")).alias("line"))
    titles = rows.select("doc_id", (F.col("n") + F.col("k")).alias("line_no"), text("Title ", F.col("o_orderstatus")).alias("line"))
    more = rows.filter("k = n and o_custkey % 3 = 0").select("doc_id", (F.col("n") * 2 + 1).alias("line_no"), F.lit("more of it").alias("line"))
    lines = bare.unionByName(titles).unionByName(more).withColumn("line_no", F.col("line_no").cast("int"))
    return sections.two_column_contents(lines).select("doc_id", "line")


ANCHOR_SQL = f"""with k as {K}, f as (select *, coalesce(case when o_orderkey % 10 = 0 then k + 1 end, case when o_orderkey % 7 = 0 then k + 100 end, case when o_orderkey % 11 = 0 then k + 200 end) as found from k)
select o_custkey as doc_id, k::varchar as number, coalesce(last_value(found ignore nulls) over (partition by o_custkey order by k rows unbounded preceding), 1)::bigint as start_page from f"""


@query("toc_anchor", ANCHOR_SQL)
def toc_anchor(t: Tables) -> DataFrame:
    """Anchors by printed page, by bookmark, by label and number, and inherited ones."""
    rows, k = ranked(t), F.col("k")
    tree = rows.select("doc_id", F.lit("A").alias("part"), k.cast("string").alias("number"), F.when(F.col("o_orderkey") % 5 == 0, text(k * 10)).otherwise("").alias("page_ref"))
    by_page = rows.filter("o_orderkey % 10 = 0").select("doc_id", text(k * 10).alias("token"), (k + 1).cast("long").alias("page_no"))
    by_label = rows.filter("o_orderkey % 11 = 0").select("doc_id", text("A-", k).alias("token"), (k + 200).cast("long").alias("page_no"))
    marks = rows.filter("o_orderkey % 7 = 0").select("doc_id", k.cast("string").alias("number"), (k + 100).cast("long").alias("page_no"))
    return sections.anchor(tree, by_page.unionByName(by_label), marks).select("doc_id", "number", F.col("start_page").cast("long").alias("start_page"))


HEADING_SQL = """with l as (select distinct l_orderkey as d, l_linenumber as p, l_partkey, l_returnflag as f from lineitem)
select d as doc_id, p || '-' || l_partkey || f as section_id, case l_partkey % 3 when 0 then p when 1 then (select min(p) from l x where x.d = l.d) else (select min(p) from l x where x.d = l.d and x.f = l.f) end::int as heading_page from l"""


@query("heading_pages", HEADING_SQL)
def heading_pages(t: Tables) -> DataFrame:
    """Sections found by their whole number, by the number that theirs begins with, and by the words of their title."""
    rows = t.lineitem.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("page_no"), "l_partkey", "l_returnflag").distinct()
    place = F.array_position(F.array(*map(F.lit, "ANR")), F.col("l_returnflag")).cast("int")
    lines = rows.select("doc_id", "page_no", place.alias("line_no"), text("2.", F.col("page_no"), " Heading ", F.col("l_returnflag")).alias("line")).distinct()
    form = F.col("l_partkey") % 3
    number = F.when(form == 0, text("2.", F.col("page_no"))).when(form == 1, "2").otherwise("9")
    found = rows.select("doc_id", text(F.col("page_no"), "-", F.col("l_partkey"), F.col("l_returnflag")).alias("section_id"), number.alias("number"), text("Heading ", F.col("l_returnflag")).alias("title"), F.lit(1).alias("low"), F.lit(99).alias("high"))
    return sections.heading_pages(found, lines).select("doc_id", "section_id", "heading_page")


@query("refined_ends", f"with k as {K} select o_custkey as doc_id, k::varchar as number, (k * 3 + case when o_orderkey % 4 = 2 and o_orderkey % 3 = 0 then 2 else 1 end)::int as end_page from k")
def refined_ends(t: Tables) -> DataFrame:
    """Lines with the section's number on its pages, on the one after, where only a continued one counts, and beyond."""
    rows, k = ranked(t), F.col("k").cast("int")
    tree = rows.select("doc_id", k.cast("string").alias("section_id"), k.cast("string").alias("number"), (k * 3).alias("start_page"), (k * 3 + 1).alias("end_page"))
    mark = F.when(F.col("o_orderkey") % 3 == 0, " (cont'd)").otherwise("")
    lines = rows.select("doc_id", (k * 3 + F.col("o_orderkey") % 4).cast("int").alias("page_no"), text(k, " Some title", mark).alias("line"))
    return sections.refine_ends(tree, lines).select("doc_id", "number", "end_page")


@query("part_ranges", f"with k as {K} select o_custkey as doc_id, o_orderstatus as part, min(k)::int as start_page, max(k + 2)::int as end_page from k group by all")
def part_ranges(t: Tables) -> DataFrame:
    k = F.col("k").cast("int")
    return sections.part_ranges(ranked(t).select("doc_id", F.col("o_orderstatus").alias("part"), k.alias("start_page"), (k + 2).alias("end_page")))


@query("section_units", f"with k as {K} select o_custkey as doc_id, k::varchar as number, (1 + o_orderkey % 3)::int as n_pages, case when k < n then (k + 1)::varchar end as next_leaf, 'A.' || k as group_key from k")
def section_units(t: Tables) -> DataFrame:
    k = F.col("k").cast("int")
    tree = ranked(t).select("doc_id", F.lit("A").alias("part"), k.cast("string").alias("number"), k.cast("string").alias("section_id"), F.lit("t").alias("title"), k.alias("start_page"), (k + F.col("o_orderkey") % 3).cast("int").alias("end_page"))
    return sections.units(tree).select("doc_id", "number", F.size("pages").alias("n_pages"), F.col("next_leaf.section_id").alias("next_leaf"), "group_key")


@query("footer_map", f"with k as {K} select o_custkey as doc_id, (o_orderkey % 5)::varchar as token, min(k)::int as page_no from k group by all")
def footer_map(t: Tables) -> DataFrame:
    body = text("A disclosure\nSome words\nPage ", F.col("o_orderkey") % 5)
    return sections.footer_map(ranked(t).select("doc_id", F.col("k").cast("int").alias("page_no"), body.alias("text")))


@query("outline_map", f"with k as {K} select o_custkey as doc_id, '1.' || o_orderkey % 6 as number, arg_min(k * 2, k)::int as page_no from k where o_orderkey % 5 > 0 and o_orderkey % 7 > 0 group by all")
def outline_map(t: Tables) -> DataFrame:
    """Bookmarks, some without a number and some without a page."""
    title = F.when(F.col("o_orderkey") % 7 == 0, "Annex").otherwise(text("1.", F.col("o_orderkey") % 6, " Title"))
    return sections.outline_map(ranked(t).select("doc_id", F.col("k").alias("ord"), title.alias("title"), F.when(F.col("o_orderkey") % 5 > 0, F.col("k").cast("int") * 2).alias("page_no")))


@query("contents_start", f"with k as {K} select o_custkey as doc_id, coalesce(min(case when o_orderkey % 4 = 0 and k <= 8 then k end), 2)::int as page_no from k group by 1")
def contents_start(t: Tables) -> DataFrame:
    body = F.when(F.col("o_orderkey") % 4 == 0, "Table of CONTENTS").otherwise("A page")
    return pages.contents_start(ranked(t).select("doc_id", F.col("k").cast("int").alias("page_no"), body.alias("text")))


LEADERS_SQL = f"""with k as {K}, b as (select *, sum(case when k > 1 and o_orderkey % 3 = 0 then 1 else 0 end) over (partition by o_custkey order by k) as bad from k) select o_custkey as doc_id, k::int as page_no from b where bad = 0 and k <= 8"""


@query("contents_pages", LEADERS_SQL)
def contents_pages(t: Tables) -> DataFrame:
    body = F.when(F.col("o_orderkey") % 3 > 0, "1 One ....... 3\n2 Two …….. 5").otherwise("1 One ...... 3\nprose")
    rows = ranked(t).select("doc_id", F.col("k").cast("int").alias("page_no"), body.alias("text"))
    return pages.contents_pages(rows, rows.select("doc_id").distinct().withColumn("page_no", F.lit(1))).select("doc_id", "page_no")


LOOKS = r"""select doc_id, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(trim(x), '^[0-9]+([.][0-9]+)*[.]?\s+\S')))::int as lines,
regexp_matches(text, '(?i)content') or regexp_matches(text, '(?m)^PART\s+[A-Z]') or len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(trim(x), '^[0-9]+([.][0-9]+)*[.]?\s+\S'))) >= 3 as contents from documents"""


@query("looks_like_contents", LOOKS)
def looks_like_contents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", pages.section_lines(F.col("text")).alias("lines"), pages.looks_like_contents(F.col("text")).alias("contents"))


@query("table_titles", "select p_partkey from part where p_size % 7 in (0, 3, 5, 6)")
def table_titles(t: Tables) -> DataFrame:
    titles = F.array(*map(F.lit, ["Credit risk of banks", "  Introduction to capital", "Governance", "NSFR disclosures", "Qualitative  disclosures on capital", "G-SIB indicator", "Remuneration, which has RATIO in it"]))
    return pages.table_titles(t.part.select("p_partkey", F.get(titles, (F.col("p_size") % 7).cast("int")).alias("title"))).select("p_partkey")


MANIFEST_SQL = f"""with k as {K}, d as (select *, unnest(case when o_orderkey % 3 = 0 then ['d1', 'd2'] when o_orderkey % 3 = 1 then ['d1, d2'] else [''] end) as date from k), n as (select *, row_number() over (partition by o_custkey order by k, date) as t from d)
select o_custkey as doc_id, t::int as table_no, 't' || lpad(t::varchar, 3, '0') || '_p' || k || '_' || k + 1 as table_id, date as dates, k || '+' || k + 1 as pages, 'T' || case when o_orderkey % 3 = 0 then ' - ' || date else '' end as title, o_orderkey % 5 = 0 as needs_agent_review from n"""


@query("table_manifest", MANIFEST_SQL)
def table_manifest(t: Tables) -> DataFrame:
    """Tables that stand twice on their page, ones with two dates that don't, and ones without."""
    k, form = F.col("k").cast("int"), F.col("o_orderkey") % 3
    rows = ranked(t).select("doc_id", F.array(k).alias("path"), F.lit("T").alias("title"), k.alias("start_page"), (k + 1).alias("end_page"), F.when(form == 0, "multiple_on_page").otherwise("spanning").alias("layout"), F.when(form < 2, F.array(F.lit("d1"), F.lit("d2"))).alias("dates"), F.when(F.col("o_orderkey") % 5 == 0, "look").alias("notes"))
    return pages.manifest(rows).select("doc_id", "table_no", "table_id", "dates", "pages", "title", "needs_agent_review")


@query("resume_groups", f"with k as {K} select o_custkey as doc_id, k::int as k from k where k >= 3")
def resume_groups(t: Tables) -> DataFrame:
    return pages.resume_from(ranked(t).select("doc_id", F.col("k").cast("int").alias("k"), text("s", F.col("k")).alias("section_id")), ["k"], "s3").select("doc_id", "k")


@query("plausible_documents", "select c_custkey as doc_id, count(o_orderkey) as n, case when count(o_orderkey) = 0 then 'no sections' when count(o_orderkey) > 14 then 'too many sections' else '' end as reason from customer left join orders on o_custkey = c_custkey and o_orderkey % 3 > 0 and c_custkey % 4 > 0 group by 1")
def plausible_documents(t: Tables) -> DataFrame:
    """Every fourth customer's document has no section."""
    rows = t.orders.filter("o_orderkey % 3 > 0 and o_custkey % 4 > 0").select(F.col("o_custkey").alias("doc_id"), F.lit(1).alias("start_page"), F.lit(9).alias("n_pages"))
    return pages.plausible(rows, 14, t.customer.select(F.col("c_custkey").alias("doc_id"))).select("doc_id", "n", "reason")


FLAG_SQL = """select o_orderkey, case o_orderkey % 9 when 0 then 'ILLEGIBLE' when 1 then 'CONFLICT' when 2 then 'PLACEHOLDER' when 3 then 'PLACEHOLDER' end as flag from orders"""


@query("cell_flags", FLAG_SQL)
def cell_flags(t: Tables) -> DataFrame:
    cells = F.array(*map(F.lit, [" illegible ", "conflict: 3 or 8", "xxxx", "Missing", "N/A", "12", "partly illegible", "TBDs", "-"]))
    return t.orders.select("o_orderkey", V.cell_flag(F.get(cells, (F.col("o_orderkey") % 9).cast("int"))).alias("flag"))


@query("zero_rows", "select l_orderkey, count(*) >= 3 and max(case when l_quantity < 25 then 0 else l_quantity end) = 0 as all_zero from lineitem where l_tax > 0.01 or l_tax <= 0.01 group by 1")
def zero_rows(t: Tables) -> DataFrame:
    low = F.when(F.col("l_quantity") < 25, F.lit(0.0)).otherwise(F.col("l_quantity"))
    return t.lineitem.groupBy("l_orderkey").agg(V.all_zero(F.collect_list(low)).alias("all_zero"))


@query("split_known_types", "select o_custkey, list_sort(list(distinct o_orderpriority) filter (o_orderpriority < '3')) as known, list_sort(list(distinct o_orderpriority) filter (o_orderpriority >= '3')) as unknown from orders group by 1")
def split_known_types(t: Tables) -> DataFrame:
    rows = t.orders.groupBy("o_custkey").agg(F.array_append(F.collect_set("o_orderpriority"), F.lit("none")).alias("types"), F.collect_set("o_orderpriority").alias("all"))
    s = points.split_known(F.col("types"), ["1-URGENT", "2-HIGH"])
    empty = lambda c: F.when(F.size(c) > 0, F.array_sort(c))
    return rows.select("o_custkey", empty(s["known"]).alias("known"), empty(s["unknown"]).alias("unknown"))


@query("table_sheet_names", "with n as (select o_custkey || '.1 Table ' || (1 + o_orderkey % 3) as b, o_orderkey from orders), k as (select *, row_number() over (partition by b order by o_orderkey) as k from n) select o_orderkey, b || case when k > 1 then ' (' || k || ')' else '' end as name from k")
def table_sheet_names(t: Tables) -> DataFrame:
    from tableloom.operators import ledger

    rows = t.orders.select("o_orderkey", T.table_sheet_base(text(F.col("o_custkey"), ".1"), 1 + F.col("o_orderkey") % 3).alias("b"))
    return ledger.unique_names(rows, "b", ["o_orderkey"], []).select("o_orderkey", "name")


@query("slide_tab_names", "with n as (select case when p_size < 10 then '0' else '' end || p_size || ' - ' || trim(p_type)[1:20] as b, p_partkey from part), k as (select *, row_number() over (partition by b order by p_partkey) as k from n) select p_partkey, case when k = 1 then b else b[1:(31 - length(' (' || k || ')'))] || ' (' || k || ')' end as name from k")
def slide_tab_names(t: Tables) -> DataFrame:
    from tableloom.operators import ledger

    rows = t.part.select("p_partkey", T.slide_tab_base(F.col("p_size"), F.col("p_type")).alias("b"))
    return ledger.unique_names(rows, "b", ["p_partkey"], []).select("p_partkey", "name")


@query("experiment_log", """select p_partkey as doc_id, 'E-' || i as id, 'Trial ' || i as title, case (p_partkey + i) % 5 when 0 then 'adopted' when 1 then 'partial' when 2 then 'insight' when 3 then 'implemented' else 'failed' end as status, 'worked ' || p_size as outcome, i >= 7 or p_partkey % 2 = 0 and i >= 6 as on_slides from part, range(5, 8) r(i)""")
def experiment_log(t: Tables) -> DataFrame:
    """Logs of three experiments each; in every second the chapter on slides begins before the second."""
    words = F.array(*map(F.lit, ["ADOPTED", "PARTIAL", "Insight", "implemented / later", "rejected"]))
    one = lambda i: text(f"### E-{i} — Trial {i} ● ", F.get(words, ((F.col("p_partkey") + i) % 5).cast("int")), f"\n\n| **Hypothesis** | it {i} |\n| **Outcome** | worked ", F.col("p_size"), "\n| **Learning** | x\n\n")
    body = text("# Log\n", one(5), F.when(F.col("p_partkey") % 2 == 0, "## 7. Slides\n").otherwise(""), one(6), one(7))
    return T.experiments(t.part.select(F.col("p_partkey").alias("doc_id"), body.alias("text"))).select("doc_id", "id", "title", "status", "outcome", "on_slides")


OLD_SQL = f"""with k as {K}, e as (select o_custkey as doc_id, k, o_orderkey % 3 as f from k where o_custkey % 2 = 1) select doc_id, 'section' as kind, 'B' as part, k || case when f = 2 then '.1' else '' end as number, 'B.' || k || case when f = 2 then '.1' else '' end as section_id, 'Title of it' as title, case when f = 0 then 'B-' || k end as doc_page from e
union all select distinct o_custkey, 'part', 'B', 'B', null, 'Disclosures   B-1', 'B-1' from orders where o_custkey % 2 = 1"""


@query("legacy_contents", OLD_SQL)
def legacy_contents(t: Tables) -> DataFrame:
    """Sections with and without a page; those of documents without a part don't count."""
    k, form = F.col("k"), F.col("o_orderkey") % 3
    line = F.when(form == 0, text(k, " Title of it ...... B-", k)).when(form == 1, text(k, " Title of it.")).otherwise(text(k, ".1 Title of it"))
    lines = ranked(t).select("doc_id", k.cast("int").alias("line_no"), line.alias("line"))
    heads = lines.filter("line_no = 1 and doc_id % 2 = 1").select("doc_id", F.lit(0).alias("line_no"), F.lit("Part B : Disclosures   B-1").alias("line"))
    return sections.legacy_contents(lines.unionByName(heads)).drop("entry")


PART_SQL = f"""with k as {K} select o_custkey as doc_id, case o_orderkey % 6 when 0 then 'B' when 1 then 'C' when 2 then 'D' when 3 then 'E' end as part, arg_min(k + 4, k)::int as start_page from k where o_orderkey % 6 < 4 group by 1, 2
union all select c_custkey, 'A', coalesce(min(case when o_orderkey % 6 <> 4 then k + 4 end), 5)::int from customer join k on o_custkey = c_custkey group by 1"""


@query("part_starts", PART_SQL)
def part_starts(t: Tables) -> DataFrame:
    titles = F.array(*map(F.lit, ["20 LCR", "Part C", "Attestation", "23 Words", "Contents", "Annex"]))
    return sections.part_starts(ranked(t).select("doc_id", F.col("k").alias("ord"), F.get(titles, (F.col("o_orderkey") % 6).cast("int")).alias("title"), (F.col("k") + 4).cast("int").alias("page_no")))


SPREAD_SQL = f"""with k as {K}, t as (select o_custkey as d, k, n, case when o_custkey % 2 = 0 then 2 * n else (n + 1) // 2 end as m from k), a as (select *, 10 + least(k, m) as s from t)
select d as doc_id, k::varchar as number, s::int as start_page, case when k = n then 99 else greatest(s, 10 + least(k + 1, m) - 1) end::int as end_page from a
union all select d, k || '.1', case when m = 2 * n then 10 + n + k else s end::int, case when m = 2 * n then 10 + n + k when k = n then 99 else greatest(s, 10 + least(k + 1, m) - 1) end::int from a"""


@query("spread_anchors", SPREAD_SQL)
def spread_anchors(t: Tables) -> DataFrame:
    """Every section has one below it; in every second document there are pages for all, in the others for half of the top ones."""
    rows, k, n = ranked(t), F.col("k").cast("int"), F.col("n").cast("int")
    tree = rows.select("doc_id", F.lit("A").alias("part"), F.explode(F.array(text(k), text(k, ".1"))).alias("number"), k.alias("entry"))
    parts = rows.select("doc_id", F.lit("A").alias("part"), F.lit(5).alias("start_page"), F.lit(99).alias("end_page")).distinct()
    many = F.when(F.col("o_custkey") % 2 == 0, 2 * n).otherwise(F.floor((n + 1) / 2).cast("int"))
    pages_ = rows.filter("k = 1").select("doc_id", F.explode(F.sequence(F.lit(1), many)).alias("i")).select("doc_id", (F.col("i") + 10).cast("int").alias("page_no"))
    return sections.spread_anchors(tree, parts, pages_).select("doc_id", "number", "start_page", "end_page")


@query("legacy_contents_start", f"with k as {K} select o_custkey as doc_id, coalesce(min(case when o_orderkey % 4 = 0 and k <= 6 then k end), 2)::int as page_no from k group by 1")
def legacy_contents_start(t: Tables) -> DataFrame:
    body = F.when(F.col("o_orderkey") % 4 == 0, "Contents\nPart A").when(F.col("o_orderkey") % 4 == 1, "Contents only").otherwise("A page of part A")
    return pages.legacy_contents_start(ranked(t).select("doc_id", F.col("k").cast("int").alias("page_no"), body.alias("text")))


@query("described_calls", "select o_orderkey, 'B§ ' || o_custkey as x, case o_orderkey % 4 when 0 then 'B §15.3 p47-48' when 1 then 'B §multi p7 (shared page — multiple sections)' when 2 then 'B §15.3 p47-48 chunk 2' else 'B §9 p3 +image' end as description from orders")
def described_calls(t: Tables) -> DataFrame:
    from tableloom.operators import ledger

    labels = F.array(*map(F.lit, ["15_3_p47-48", "p7_multi", "15_3_p47-48_c2", "9_p3"]))
    form = F.col("o_orderkey") % 4
    return t.orders.select("o_orderkey", text("B§ ", F.col("o_custkey")).alias("x"), ledger.describe_call(F.get(labels, form.cast("int")), F.lit("B"), form == 3).alias("description"))


@query("printed_numbers", "select o_orderkey, o_orderkey % 8 < 5 as printed from orders")
def printed_numbers(t: Tables) -> DataFrame:
    words = F.array(*map(F.lit, ["-", "1,234", " 17.5% ", "(5,000)", "12", "(5.5)", "1a", "n.m."]))
    return t.orders.select("o_orderkey", V.is_printed_number(F.get(words, (F.col("o_orderkey") % 8).cast("int"))).alias("printed"))


@query("first_dates", "select o_orderkey, case when o_orderkey % 3 = 0 then '' else strftime(o_orderdate, '%-d %B %Y') end as date from orders")
def first_dates(t: Tables) -> DataFrame:
    shown = F.concat(F.lit("Pillar 3, as at "), F.date_format("o_orderdate", "d MMMM yyyy"), F.lit("; 1 May 1999"))
    return t.orders.select("o_orderkey", T.first_date(F.when(F.col("o_orderkey") % 3 == 0, "no date in 2025").otherwise(shown)).alias("date"))
