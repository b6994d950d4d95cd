"""Queries on texts of documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.functions import text as T
from tableloom.operators import checks, matching, sections
from tableloom.plans.registry import Tables, query

TOKENS = r"list_filter(list_transform(regexp_extract_all(text, '\(?[0-9][0-9,]*(?:[.][0-9]+)?\)?%?'), lambda x: replace(trim(x, '()% '), ',', '')), lambda x: x <> '')"
WORDS = "list_distinct(regexp_extract_all(lower({}), '[a-z0-9]+'))"


@query("number_tokens", f"select token, count(*) as n from (select unnest({TOKENS}) as token from documents) group by 1")
def number_tokens(t: Tables) -> DataFrame:
    return t.documents.select(F.explode(T.number_tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


@query("narrative_filter", "select doc_id, len(regexp_extract_all(text, '[0-9][0-9,.]*'))::bigint as n_numbers, len(regexp_extract_all(text, '[0-9][0-9,.]*')) < 10 as narrative from documents")
def narrative_filter(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.regexp_count("text", F.lit("[0-9][0-9,.]*")).cast("long").alias("n_numbers"), T.is_narrative(F.col("text")).alias("narrative"))


RECALL_SQL = f"""
with j as (select doc_id as unit, unnest({TOKENS}) as token from documents),
jn as (select unit, token, count(*) as extracted from j where regexp_matches(token, '^[0-9]+([.][0-9]+)?$') group by all),
p as (select doc_id - 1 as unit, text from documents),
pn as (select unit, token, count(*) as printed from (select unit, unnest({TOKENS}) as token from p) group by all),
b as (select coalesce(jn.unit, pn.unit) as unit, coalesce(jn.token, pn.token) as token, coalesce(extracted, 0) as extracted, coalesce(printed, 0) as printed from jn full join pn on jn.unit = pn.unit and jn.token = pn.token),
k as (select b.*, case when extracted > printed then 'phantom' else 'deficit' end as kind, regexp_replace(p.text, '[\\s,]', '', 'g') as squeezed, b.unit in (select unit from jn) as numeric_cells from b left join p on p.unit = b.unit where extracted <> printed)
select unit, kind, token, extracted, printed, length(token)::int as length, abs(printed - extracted) as gap from k
where kind = 'phantom' and not coalesce(contains(squeezed, token), false) or kind = 'deficit' and length(token) > 2 and not regexp_matches(token, '^(19|20)[0-9][0-9]$') and (numeric_cells or length(token) < 7)
"""


@query("number_recall", RECALL_SQL)
def number_recall(t: Tables) -> DataFrame:
    """A document's numbers as extracted, against those that the next document prints."""
    d = t.documents
    cells = d.select("doc_id", F.explode(T.number_tokens(F.col("text"))).alias("v"))
    return checks.number_recall(checks.numeric_tokens(cells, "doc_id", "v"), d.select((F.col("doc_id") - 1).alias("unit"), "text"))


@query("keep_first_dedupe", "select doc_id, k from (select doc_id, md5(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) as k, row_number() over (partition by trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) order by doc_id) as n from documents) where n = 1")
def keep_first_dedupe(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.md5(T.squeezed(F.col("text"))).alias("k"))
    return rows.groupBy("k").agg(F.min("doc_id").alias("doc_id"))


HEADING_SQL = f"""
with p as (select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) as h1 from pages),
w as (select *, {WORDS.format("title")} as tw, {WORDS.format("h1")} as hw from p)
select page_id, len(tw)::int as title_words, round(len(list_intersect(hw, tw)) / greatest(len(tw), 1), 6) as score, len(tw) > 0 and len(list_intersect(hw, tw)) / greatest(len(tw), 1) >= 0.8 as matches from w
"""


@query("heading_match", HEADING_SQL)
def heading_match(t: Tables) -> DataFrame:
    title, h1 = F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.regexp_extract("html", "<h1[^>]*>([^<]*)</h1>", 1)
    score = T.title_score(h1, title)
    return t.pages.select("page_id", matching.words_in(title).alias("title_words"), F.round(score, 6).alias("score"), ((matching.words_in(title) > 0) & (score >= 0.8)).alias("matches"))


OVERLAP_SQL = f"""
with a as (select page_id, list_filter({WORDS.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")}, lambda x: x not in ('a', 'b', 'c', 'the', 'of', 'and')) as w from pages),
b as (select item_id, list_filter({WORDS.format("text")}, lambda x: x not in ('a', 'b', 'c', 'the', 'of', 'and')) as w from benchmark)
select page_id, item_id, len(list_intersect(a.w, b.w)) as common, round(len(list_intersect(a.w, b.w)) / least(len(a.w), len(b.w)), 6) as score from a, b where len(list_intersect(a.w, b.w)) > 0
"""


@query("title_overlap", OVERLAP_SQL)
def title_overlap(t: Tables) -> DataFrame:
    pages = t.pages.select(F.lit(1).alias("g"), F.col("page_id").alias("l_ord"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    items = t.benchmark.select(F.lit(1).alias("g"), F.col("item_id").alias("r_ord"), "text")
    found = matching.score_pairs(pages, items, ["g"], "title", "text", True, T.STOP_WORDS)
    return found.select(F.col("l_ord").alias("page_id"), F.col("r_ord").alias("item_id"), "common", F.round("score", 6).alias("score"))


@query(
    "footer_token",
    """select o_orderkey, case o_orderkey % 7 when 0 then (o_orderkey % 500)::varchar when 1 then (o_orderkey % 900)::varchar when 2 then 'B-' || (o_orderkey % 90)::varchar when 3 then (o_orderkey % 70)::varchar
    when 4 then 'C-' || (o_orderkey % 60)::varchar when 5 then (o_orderkey % 40)::varchar else '' end as token from orders""",
)
def footer_token(t: Tables) -> DataFrame:
    """Every rule of the footer by turns; the last form looks like a row of data."""
    k = F.col("o_orderkey")
    n = lambda m: (k % m).cast("string")
    join = lambda *x: F.concat_ws("\n", *x)
    head, body = F.lit("A disclosure"), F.lit("Some words of a page that has text, and more\nLines 12 and 13, of 14")
    forms = [join(F.concat(F.lit("Report December 2025 "), n(500)), body), join(head, F.concat(F.lit("Page "), n(900)), body), join(head, body, F.concat(F.lit("B - "), n(90))), join(head, body, F.concat(F.lit("See Page "), n(70), F.lit(" here"))), join(head, body, F.concat(F.lit("Annex C-"), n(60))), join(head, body, F.concat(F.lit("The bank "), n(40)))]
    text = F.when(F.lit(False), F.lit(""))
    for i, form in enumerate(forms):
        text = text.when(k % 7 == i, form)
    return t.orders.select("o_orderkey", T.footer_token(T.lines(text.otherwise(join(head, body, F.lit("Total 1,234 56 78"))))).alias("token"))


@query("detect_entity", "select doc_id, case when regexp_matches(text, '###|[*][*][*]') then 'symbols' when regexp_matches(text, '[A-Z]{4}') then 'capitals' when regexp_matches(text, '[ñóí]') then 'spanish' when regexp_matches(text, '[äöüß]') then 'german' else 'unknown' end as entity from documents")
def detect_entity(t: Tables) -> DataFrame:
    rules = [("symbols", "###|[*][*][*]"), ("capitals", "[A-Z]{4}"), ("spanish", "[ñóí]"), ("german", "[äöüß]")]
    return t.documents.select("doc_id", T.first_rule(F.col("text"), rules).alias("entity"))


@query(
    "corroborate_values",
    f"""with v as (select doc_id, {TOKENS} as k from documents where len({TOKENS}) > 0), p as (select doc_id, k, unnest([k[1], '4711' || doc_id::varchar]) as core from v)
    select doc_id, core as value, case when list_contains(k, core) then 'table' else 'unverified' end as source, case when list_contains(k, core) then 1.0 else 0.4 end::double as confidence from p""",
)
def corroborate_values(t: Tables) -> DataFrame:
    """The first number of each document, and one that isn't there, against the numbers that the document prints."""
    d = t.documents.select(F.col("doc_id").alias("page"), "text")
    first = d.withColumn("k", T.number_tokens(F.col("text"))).filter(F.size("k") > 0)
    points = first.select("page", F.explode(F.array(F.col("k")[0], F.concat(F.lit("4711"), F.col("page").cast("string")))).alias("value"), F.lit("table").alias("source"), F.lit("model").alias("extracted_by"), F.lit(0.8).alias("confidence"))
    return matching.corroborate(points, d).select(F.col("page").alias("doc_id"), "value", "source", "confidence")


@query("page_lines", "with l as (select doc_id, trim(unnest(string_split(text, chr(10)))) as line from documents) select doc_id, count(*) as n_lines, sum(length(line))::bigint as chars from l where line <> '' group by 1")
def page_lines(t: Tables) -> DataFrame:
    rows = sections.page_lines(t.documents.select("doc_id", F.lit(1).alias("page_no"), "text"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("chars"))
