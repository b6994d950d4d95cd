"""Queries on reviews, validations, sweeps, comparisons and cost summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.functions import values as V
from tableloom.operators import checks, ledger, matching
from tableloom.plans.contents import text
from tableloom.plans.registry import Tables, query

CHILD = "(select distinct l_orderkey as o, l_linenumber::int as n, l_partkey as p, l_quantity::int as q from lineitem)"
ROLL_SQL = f"""with c as {CHILD}, g as (select o, sum(q)::double as got, max(q) as most, count(*) as n, (sum(q) + case when o % 3 = 0 then 50 else 0 end)::double as expected, bool_or(o % 5 = 0 and n = 1 or o % 7 = 0 and n = 2) as subset, bool_or(o % 4 = 0 and n = 1) as income, bool_or(o % 4 = 0 and n = 2) as expense from c group by o)
select o, 'v' as col_id, expected, got from g where not subset and not (income and expense) and most <= expected * 1.5 and abs(got - expected) > greatest(2, expected / 100)"""


@query("review_rollups", ROLL_SQL)
def review_rollups(t: Tables) -> DataFrame:
    """Orders as parents of their lines; some have a subset, a note, or an income and an expense among the children."""
    child = t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").cast("int").alias("n"), F.col("l_partkey").alias("p"), F.col("l_quantity").cast("int").alias("q")).distinct()
    row_id = text(F.col("n"), "-", F.col("p"), "-", F.col("q"))
    label = F.when((F.col("o") % 5 == 0) & (F.col("n") == 1), " Of which: secured").when((F.col("o") % 4 == 0) & (F.col("n") == 1), "Net interest income").when((F.col("o") % 4 == 0) & (F.col("n") == 2), "Operating expenses").otherwise("item")
    kind = F.when((F.col("o") % 7 == 0) & (F.col("n") == 2), "note").otherwise("data")
    rows = child.select("o", row_id.alias("row_id"), F.lit("total").alias("parent"), kind.alias("row_type"), label.alias("label"))
    cells = child.select("o", row_id.alias("row_id"), F.lit("v").alias("col_id"), F.format_number("q", 0).alias("value"))
    whole = child.groupBy("o").agg((F.sum("q") + F.when(F.col("o") % 3 == 0, 50).otherwise(0)).alias("s"))
    rows = rows.unionByName(whole.select("o", F.lit("total").alias("row_id"), F.lit(None).cast("string").alias("parent"), F.lit("total").alias("row_type"), F.lit("Total").alias("label")))
    cells = cells.unionByName(whole.select("o", F.lit("total").alias("row_id"), F.lit("v").alias("col_id"), F.format_number("s", 0).alias("value")))
    return checks.rollup_tables(rows, cells, ["o"]).select("o", "col_id", "expected", "got")


RATIO_SQL = """with c as (select c_custkey as k, round(abs(c_acctbal) + 100) as a, round(abs(c_acctbal) / 2 + 90) as b from customer), r as (select *, a / b * 100 as implied, round(a / b * 100) + case when k % 3 = 0 then 40 else 0 end as stated from c)
select k, 'r3' as row_id, stated::double as stated, round(implied, 1) as implied from r where k % 5 > 0 and abs(implied - stated) > greatest(5, stated * 0.05)"""


@query("coverage_ratio", RATIO_SQL)
def coverage_ratio(t: Tables) -> DataFrame:
    """A table per customer: assets, outflow and a stated ratio, found by their labels; every fifth one lacks the outflow."""
    c = t.customer.select(F.col("c_custkey").alias("k"), F.round(F.abs("c_acctbal") + 100).alias("a"), F.round(F.abs("c_acctbal") / 2 + 90).alias("b"))
    c = c.withColumn("s", F.round(F.col("a") / F.col("b") * 100) + F.when(F.col("k") % 3 == 0, 40).otherwise(0))
    entry = lambda i, label, v: F.struct(F.lit(i).alias("ord"), F.lit(f"r{i}").alias("row_id"), F.lit(label).alias("label"), v.cast("long").cast("string").alias("value"))
    outflow = F.when(F.col("k") % 5 > 0, F.col("b"))
    rows = c.select("k", F.explode(F.array(entry(0, "High-quality liquid assets", F.lit(1)), entry(1, "Total HQLA", F.col("a")), entry(2, "Total net cash outflows", outflow), entry(3, "Liquidity Coverage Ratio (%)", F.col("s")))).alias("r")).select("k", "r.*")
    cells = rows.select("k", "row_id", F.lit(1).alias("col_idx"), "value").unionByName(rows.select("k", "row_id", F.lit(0).alias("col_idx"), F.lit("-").alias("value")))
    return checks.ratio_by_label(rows.select("k", "ord", "row_id", "label"), cells, ["k"])


@query("review_summary", "select o_orderstatus as status, count(*) as total, count_if(o_orderkey % 7 > 0 and o_orderkey % 3 > 0) as ok, count_if(o_orderkey % 3 = 0) as flagged, count_if(o_orderkey % 7 = 0) as skipped from orders group by 1")
def review_summary(t: Tables) -> DataFrame:
    tables = t.orders.select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("table_id"), F.when(F.col("o_orderkey") % 7 == 0, "no rows").alias("skipped"))
    flags = tables.filter("table_id % 3 = 0").select("status", "table_id")
    return checks.review_summary(tables, flags.unionByName(flags), ["status"])


ORDERS = "(select o_orderkey as o, o_custkey as c, o_totalprice::int as v, row_number() over (partition by o_custkey order by o_orderkey) as k from orders)"
SHEET_SQL = f"""with o as {ORDERS}, s as (select c, max(k) + 7 as rows from o group by c)
select 'ERROR' as severity, 's' || c as sheet, 'header_present' as check, 1 as r from s where c % 5 = 0 union all select 'WARNING', 's' || c, 'header_present', 3 from s where c % 7 = 0
union all select 'WARNING', 's' || c, 'merge_value', (k + 7)::int from o where o % 6 = 0 union all select 'ERROR', 's' || c, 'merge_orphan', (k + 7)::int from o where o % 10 = 0
union all select 'ERROR', 's' || c, 'no_formula', (k + 7)::int from o where o % 4 = 0 union all select 'WARNING', 's' || c, 'all_zero_row', (k + 7)::int from o where o % 9 = 0 and o % 4 > 0"""


@query("sheet_issues", SHEET_SQL)
def sheet_issues(t: Tables) -> DataFrame:
    """A sheet per customer: a title, a head and a row per order, each lacking or broken in some; and a summary sheet."""
    from tableloom.plans.contents import ranked

    rows = ranked(t).select(F.col("o_orderkey").alias("o"), text("s", F.col("o_custkey")).alias("sheet"), F.col("o_custkey").alias("c"), (F.col("k") + 7).cast("int").alias("r"))
    sheets = rows.select("sheet", F.col("c").alias("id")).distinct()
    cell = lambda d, r, c, v, number=False: d.select("sheet", (F.col(r) if isinstance(r, str) else F.lit(r)).cast("int").alias("r"), F.lit(c).alias("c"), v.cast("string").alias("value"), F.lit(number).alias("is_number"))
    seven = F.when(F.col("o") % 4 == 0, "=SUM(A1)").when(F.col("o") % 9 == 0, "0").otherwise("12,5")
    parts = [
        cell(sheets.filter("id % 5 > 0"), 1, 1, F.lit("Title")), cell(sheets.filter("id % 5 = 0"), 1, 2, F.lit("Title beside")), cell(sheets.filter("id % 7 > 0"), 4, 1, F.lit("Row_ID")),
        cell(rows, "r", 1, F.col("r"), True), cell(rows, "r", 4, F.lit("data")), cell(rows.filter("o % 6 > 0"), "r", 6, F.lit("label")), cell(rows, "r", 7, seven), cell(rows, "r", 8, F.lit("-")),
        cell(sheets.limit(1).withColumn("sheet", F.lit("Summary")), 9, 1, F.lit("=1")),
    ]
    cells = parts[0]
    for more in parts[1:]:
        cells = cells.unionByName(more)
    merge = lambda d, right: d.select("sheet", F.col("r").alias("min_row"), F.lit(6).alias("min_col"), F.col("r").alias("max_row"), F.lit(right).alias("max_col"))
    return checks.sheet_issues(cells, merge(rows.filter("o % 10 > 0"), 7).unionByName(merge(rows.filter("o % 10 = 0"), 99)))


@query("sheet_counts", "select o_custkey as book, count_if(o_orderkey % 3 > 0) as n, case when count_if(o_orderkey % 3 > 0) = 0 then 'ERROR' else 'INFO' end as severity from orders group by 1")
def sheet_counts(t: Tables) -> DataFrame:
    return checks.sheet_count(t.orders.select(F.col("o_custkey").alias("book"), F.when(F.col("o_orderkey") % 3 == 0, "Summary").otherwise(text("s", F.col("o_orderkey"))).alias("sheet")))


@query("validation_summary", "select o_custkey as book, count_if(o_orderkey % 9 = 0) as errors, count_if(o_orderkey % 9 in (1, 2)) as warnings, count_if(o_orderkey % 9 = 0) = 0 as passed from orders group by 1")
def validation_summary(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 9
    return checks.validation_summary(t.orders.select(F.col("o_custkey").alias("book"), F.when(k == 0, "ERROR").when(k < 3, "WARNING").otherwise("INFO").alias("severity")), ["book"])


NOISE_SQL = """with s as (select o_custkey as unit, 'A.' || o_custkey % 30 || '.' || o_orderkey % 4 as section_id from orders), n as (select distinct unit, unnest([section_id, section_id[3:], split_part(section_id, '.', 2)]) as token from s) select unit, token from n"""


@query("section_noise", NOISE_SQL)
def section_noise(t: Tables) -> DataFrame:
    return checks.section_noise(t.orders.select(F.col("o_custkey").alias("unit"), text("A.", F.col("o_custkey") % 30, ".", F.col("o_orderkey") % 4).alias("section_id")))


RECALL_SQL = """with u as (select o_custkey as unit, count(*) as n from orders group by 1) select unit, 'deficit' as kind, (123000 + unit)::varchar as token, 1 as n from u where unit % 3 > 0
union all select unit, 'phantom', (4560 + unit % 5000)::varchar, case when unit % 3 > 0 then 2 else 1 end from u where unit % 4 = 0"""


@query("recall_by_severity", RECALL_SQL)
def recall_by_severity(t: Tables) -> DataFrame:
    """Pages with an id, a year and a number that nothing extracted, and cells with a number printed apart or not at all."""
    units = t.orders.select(F.col("o_custkey").alias("unit")).distinct()
    big, cell = (123000 + F.col("unit")).cast("string"), (4560 + F.col("unit") % 5000).cast("string")
    apart = F.concat(F.substring(cell, 1, 1), F.lit(" "), F.expr("substring(cast(4560 + unit % 5000 as string), 2)"))
    pages = units.select("unit", text("Section 14.275 of 2025 ", F.when(F.col("unit") % 3 > 0, big).otherwise(""), " and ", F.when(F.col("unit") % 4 > 0, apart).otherwise("none")).alias("text"))
    noise = checks.section_noise(units.withColumn("section_id", F.lit("B.14.275")))
    found = checks.number_recall(checks.numeric_tokens(units.withColumn("v", cell), "unit", "v"), pages, noise, whole=True)
    return checks.by_severity(found.filter("length > 3"), ["unit"]).select("unit", "kind", "token", "n")


@query("unit_findings", "select o_orderkey as unit, 'spans' as check, 'row ' || o_custkey as detail from orders where o_orderkey % 4 = 0 union all select o_orderkey, 'labels', 'label ' || o_orderstatus from orders where o_orderkey % 6 = 0")
def unit_findings(t: Tables) -> DataFrame:
    row = lambda d, *x: d.select(F.col("o_orderkey").alias("unit"), text(*x).alias("detail"))
    return checks.findings(spans=row(t.orders.filter("o_orderkey % 4 = 0"), "row ", F.col("o_custkey")), labels=row(t.orders.filter("o_orderkey % 6 = 0"), "label ", F.col("o_orderstatus")))


SWEEP_SQL = """with i as (select l_suppkey, list(l_orderkey || '-' || l_linenumber order by l_orderkey, l_linenumber, l_partkey) as f, count(*) as n from (select * from lineitem where l_discount > 0.09) group by 1)
select s_suppkey as unit, case when s_suppkey % 9 = 0 then 'no JSON' end as error, case when s_suppkey % 9 = 0 then -1 else coalesce(n, 0) end as n_issues, case when s_suppkey % 9 = 0 then null when coalesce(n, 0) > 10 then 'red' when coalesce(n, 0) >= 1 then 'yellow' else 'green' end as grade, array_to_string(f[1:3], ', ') as first from supplier left join i on l_suppkey = s_suppkey"""


@query("audit_sweep", SWEEP_SQL)
def audit_sweep(t: Tables) -> DataFrame:
    issues = t.lineitem.filter("l_discount > 0.09").select(F.col("l_suppkey").alias("unit"), F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("ord"), text(F.col("l_orderkey"), "-", F.col("l_linenumber")).alias("issue"))
    units = t.supplier.select(F.col("s_suppkey").alias("unit"), F.when(F.col("s_suppkey") % 9 == 0, "no JSON").alias("error"))
    return checks.sweep(units, issues, ["unit"]).withColumn("first", F.array_join("first", ", "))


RECORD_SQL = """with r as (select c_nationkey, round(greatest(0.0, 1 - case when c_custkey % 4 > 0 then 0.0 else 0.30 end - least(0.40, c_custkey % 3 * 0.10) - least(0.20, c_custkey % 5 * 0.05)), 2) as confidence, c_custkey % 3 > 0 or c_custkey % 4 = 0 as flagged from customer)
select c_nationkey, count(*) as tables, count_if(flagged or confidence < 0.8) as need_review, round(avg(confidence::decimal(4, 2)), 2) as avg_confidence from r group by 1"""


@query("summary_line", RECORD_SQL)
def summary_line(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    rows = t.customer.select("c_nationkey", (k % 4 > 0).alias("reconciles"), (k % 3).alias("flags"), (k % 5).alias("zero_rows"))
    return checks.summary_line(checks.table_record(rows), ["c_nationkey"])


SETS_SQL = """with a as (select o_custkey as book, o_orderkey as sheet, o_orderkey as ord from orders where o_orderkey % 11 > 0), b as (select o_custkey as book, o_orderkey as sheet, case when o_custkey % 4 = 0 then -o_orderkey else o_orderkey end as ord from orders where o_orderkey % 13 > 0),
f as (select coalesce(a.book, b.book) as book, coalesce(a.sheet, b.sheet) as sheet, a.ord as a, b.ord as b from a full join b on a.book = b.book and a.sheet = b.sheet)
select book, coalesce(string_agg(sheet, ',' order by a) filter (b is null), '') as only_a, coalesce(string_agg(sheet, ',' order by b) filter (a is null), '') as only_b, book % 4 > 0 or count_if(a is not null and b is not null) < 2 as same_order,
(book % 4 > 0 or count_if(a is not null and b is not null) < 2) and count_if(a is null or b is null) = 0 as identical from f where sheet <> 7 group by book"""


@query("sheet_sets", SETS_SQL)
def sheet_sets(t: Tables) -> DataFrame:
    """Books of two runs: sheets that one lacks, and an order that is reversed in every fourth book; sheet 7 is ignored."""
    k = F.col("o_orderkey")
    side = lambda d, o: d.select(F.col("o_custkey").alias("book"), k.cast("string").alias("sheet"), o.alias("ord"))
    found = matching.sheet_sets(side(t.orders.filter("o_orderkey % 11 > 0"), k), side(t.orders.filter("o_orderkey % 13 > 0"), F.when(F.col("o_custkey") % 4 == 0, -k).otherwise(k)), ["7"])
    return found.select("book", F.array_join("only_a", ",").alias("only_a"), F.array_join("only_b", ",").alias("only_b"), "same_order", "identical")


DIFF_SQL = """with v as (select o_custkey as c, o_orderkey as o, case when o_orderkey % 10 = 3 then 'only_a' when o_orderkey % 10 = 4 then 'only_b' when o_orderkey % 7 = 0 then 'changed' else 'same' end as verdict from orders)"""


def compared(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    verdict = F.when(k % 10 == 3, "only_a").when(k % 10 == 4, "only_b").when(k % 7 == 0, "changed").otherwise("same")
    return t.orders.select(F.col("o_custkey").alias("c"), F.lit("e").alias("element"), F.format_string("%010d", k).alias("series"), F.lit("p").alias("period"), verdict.alias("verdict"), F.when(k % 10 != 4, "1").alias("a"), F.when(k % 10 != 3, F.when(k % 7 == 0, "2").otherwise("1")).alias("b"))


@query("diff_summary", DIFF_SQL + "select c, count(*) as total_keys, count_if(verdict = 'same') as same, count_if(verdict = 'changed') as changed, count_if(verdict = 'only_a') as only_a, count_if(verdict = 'only_b') as only_b, round(100 * count_if(verdict = 'same') / count(*), 1) as match_pct from v group by 1")
def diff_summary(t: Tables) -> DataFrame:
    return matching.diff_summary(compared(t), ["c"])


@query("diff_report", DIFF_SQL + """, l as (select c, list_position(['changed', 'only_a', 'only_b', 'same'], verdict) as r, '[e] ' || lpad(o::varchar, 10, '0') || ' / p' as key, verdict, o from v)
select c, string_agg(case verdict when 'changed' then 'changed: ' || key || ': 1 -> 2' when 'only_a' then 'only in a: ' || key || ' = 1' when 'only_b' then 'only in b: ' || key || case when o % 7 = 0 then ' = 2' else ' = 1' end else 'same: ' || key || ' = 1' end, chr(10) order by r, key) as report from l group by 1""")
def diff_report(t: Tables) -> DataFrame:
    return matching.diff_report(compared(t), ["c"])


@query("run_comparison", "select c_nationkey, round(avg(c_custkey % 100), 1) as avg_match, round(sum(c_custkey % 10 / 8), 5) as cost_a, round(sum(c_custkey % 7 / 4), 5) as cost_b, round(sum(c_custkey % 10 / 8) - sum(c_custkey % 7 / 4), 5) as cost_diff from customer where c_custkey % 6 > 0 group by 1")
def run_comparison(t: Tables) -> DataFrame:
    """Every sixth run failed."""
    k = F.col("c_custkey")
    rows = t.customer.select("c_nationkey", F.when(k % 6 > 0, k % 100).alias("match_pct"), (k % 10 / 8).alias("cost_a"), (k % 7 / 4).alias("cost_b"))
    return matching.run_comparison(rows, ["c_nationkey"])


COST_SQL = """with c as (select o_custkey as run, row_number() over (partition by o_custkey order by o_orderkey)::int as n, o_orderkey % 1000 as p, o_orderkey % 90 as q, case when o_orderkey % 3 > 0 then o_orderkey % 7 end as h from orders)
select run, count(*) as calls, sum(p)::bigint as input_tokens, sum(p + q + coalesce(h, 0))::bigint as total_tokens, round(sum(p) / 1024, 5) as cost, string_agg('c' || n, ',' order by n) as labels from c group by 1"""


@query("cost_summary", COST_SQL)
def cost_summary(t: Tables) -> DataFrame:
    """The JSON summary of each run, read back."""
    from tableloom.plans.contents import ranked

    k = F.col("o_orderkey")
    calls = ranked(t).select(F.col("o_custkey").alias("run"), F.col("k").alias("n"), text("c", F.col("k")).alias("label"), (k % 1000).alias("prompt_tokens"), (k % 90).alias("output_tokens"), F.when(k % 3 > 0, k % 7).alias("thinking_tokens"), (k % 1000 / 1024).alias("est_cost_usd"))
    shape = "totals struct<calls bigint, input_tokens bigint, total_tokens bigint, est_cost_usd double>, calls array<struct<label string>>"
    found = ledger.cost_summary(calls, ["run"]).withColumn("s", F.from_json("summary", shape))
    return found.select("run", "s.totals.calls", "s.totals.input_tokens", "s.totals.total_tokens", F.col("s.totals.est_cost_usd").alias("cost"), F.array_join("s.calls.label", ",").alias("labels"))


@query("sheet_order", "with n as (select case o_orderkey % 5 when 0 then o_custkey || '.' || o_orderkey % 12 || ' Table ' || o_orderkey % 3 when 1 then 'B.' || o_orderkey % 12 || '.' || o_custkey else o_custkey || '.2' end as name from orders union select 'Contents' union select 'Cost') select name, row_number() over (order by case when name = 'Contents' then 0 when name = 'Cost' then 2 else 1 end, case when name like 'B.%' then 1 else 0 end, list_transform(regexp_extract_all(name, '[0-9]+'), lambda x: x::int), name)::int as n from n")
def sheet_order(t: Tables) -> DataFrame:
    from pyspark.sql import Window as W

    k, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.when(k % 5 == 0, text(c, ".", k % 12, " Table ", k % 3)).when(k % 5 == 1, text("B.", k % 12, ".", c)).otherwise(text(c, ".2"))
    names = t.orders.select(name.alias("name")).unionByName(t.region.select(F.lit("Contents").alias("name"))).unionByName(t.region.select(F.lit("Cost").alias("name"))).distinct()
    return names.withColumn("n", F.row_number().over(W.orderBy(*ledger.sheet_order("name"))))  # a book's sheets


WORKBOOK_SQL = """with k as (select *, row_number() over (partition by o_custkey order by o_orderkey) as k from orders) select 's' || o_custkey as sheet, 'label ' || replace(lower(o_orderpriority), '-', ' ') as label, '2025-12-31' as header, arg_max(floor(o_totalprice), k)::double as num from k where o_orderkey % 6 > 0 group by 1, 2"""


@query("workbook_cells", WORKBOOK_SQL)
def workbook_cells(t: Tables) -> DataFrame:
    """A sheet per customer; some values are printed as nothing."""
    from tableloom.plans.contents import ranked

    rows = ranked(t).withColumn("sheet", text("s", F.col("o_custkey"))).withColumn("r", (F.col("k") + 1).cast("int"))
    value = F.when(F.col("o_orderkey") % 6 == 0, "n.m.").otherwise(F.format_number(F.col("o_totalprice").cast("int"), 0))
    entry = lambda c, v: F.struct(F.lit(c).alias("c"), v.cast("string").alias("value"))
    body = rows.select("sheet", "r", F.explode(F.array(entry(1, F.col("k")), entry(2, F.lit("1")), entry(3, text("Label ", F.col("o_orderpriority"), " (1)")), entry(4, value))).alias("x"))
    heads = rows.select("sheet").distinct().select("sheet", F.lit(1).alias("r"), F.explode(F.array(entry(1, F.lit("Row ID")), entry(2, F.lit("Level")), entry(3, F.lit("Item")), entry(4, F.lit("31 Dec 25")))).alias("x"))
    cells = body.unionByName(heads).select(F.lit("b").alias("book"), "sheet", "r", "x.c", "x.value")
    return matching.workbook_cells(cells).select("sheet", "label", "header", F.col("v.num").alias("num"))


@query("numeric_cells", "select o_orderkey, o_orderkey % 6 < 4 as numeric from orders")
def numeric_cells(t: Tables) -> DataFrame:
    cells = F.array(*map(F.lit, ["1,234", "(5.5)", "", " - ", "n.m.", "12a"]))
    return t.orders.select("o_orderkey", V.is_numeric_cell(F.get(cells, (F.col("o_orderkey") % 6).cast("int"))).alias("numeric"))


@query("bank_results", "with l as (select n_name as bank, count(*) as slides, sum(c_custkey)::bigint as points, round(sum(c_custkey / 8), 4) as cost from customer join nation on n_nationkey = c_nationkey group by 1) select l.*, coalesce(case when n_nationkey % 2 = 0 then 'late ' || n_nationkey end, '—') as elapsed from l join nation on n_name = bank")
def bank_results(t: Tables) -> DataFrame:
    """Nations as banks; every second one has two runs, of which the later counts."""
    slides = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_name").alias("bank"), F.col("c_custkey").alias("n_points"), (F.col("c_custkey") / 8).alias("cost_usd"))
    runs = t.nation.filter("n_nationkey % 2 = 0").select(F.lower("n_name").alias("bank"), text("late ", F.col("n_nationkey")).alias("elapsed"), F.lit("2025-02").alias("generated_at"))
    return ledger.bank_results(slides, runs.unionByName(runs.select("bank", F.lit("early").alias("elapsed"), F.lit("2025-01").alias("generated_at"))))


@query("run_panel", "select n_name as bank, case when n_nationkey % 2 = 0 then 'doc' else '—' end as document, n_nationkey::varchar as slides, '—' as calls, case when n_nationkey % 3 > 0 then n_nationkey else 0 end as input_tokens, 0 as output_tokens, round(n_nationkey / 3, 4) as cost, '—' as elapsed, case when n_nationkey % 4 = 0 then '' else '2025-01-02 03:04' end as date from nation")
def run_panel(t: Tables) -> DataFrame:
    k, none = F.col("n_nationkey"), F.lit(None).cast("string")
    runs = t.nation.select(F.col("n_name").alias("bank"), F.when(k % 2 == 0, "doc").alias("document"), k.alias("slides"), none.alias("calls"), F.when(k % 3 > 0, k).alias("input_tokens"), F.lit(None).cast("int").alias("output_tokens"), (k / 3).alias("cost"), none.alias("elapsed"), F.when(k % 4 > 0, "2025-01-02T03:04:05").alias("generated_at"))
    return ledger.run_panel(runs)


@query("unreconciled_tables", "with f as (select *, row_number() over (partition by o_custkey order by lpad(o_orderkey::varchar, 9, '0')) as k from orders where o_orderkey % 3 = 0), g as (select o_custkey, count(*) as flagged, string_agg(lpad(o_orderkey::varchar, 9, '0'), ', ' order by k) filter (k <= 5) as first from f group by 1) select o.o_custkey as c, count(*) as tables, coalesce(any_value(flagged), 0) as flagged, coalesce(any_value(first), '') as first from orders o left join g on g.o_custkey = o.o_custkey group by 1")
def unreconciled_tables(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = t.orders.select(F.col("o_custkey").alias("c"), F.lpad(k.cast("string"), 9, "0").alias("table_id"), F.when(k % 3 == 0, "False").when(k % 3 == 1, "true").alias("totals_reconcile"))
    return ledger.unreconciled(rows, ["c"])


@query("slide_branches", "select conv_id, case when conv_id % 3 = 0 then 'resumed' when conv_id % 3 = 1 then 'single-pass' else 'multi-pass' end as branch from conversations group by 1")
def slide_branches(t: Tables) -> DataFrame:
    rows = t.conversations.select("conv_id").distinct()
    passes = F.when(F.col("conv_id") % 3 == 1, F.array(F.lit("0"), F.lit("1s"))).when(F.col("conv_id") % 3 == 2, F.array(F.lit("1"), F.lit("2")))
    return rows.select("conv_id", ledger.branch(passes).alias("branch"))


@query("shown_text", "select doc_id, md5(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')) as shown from documents")
def shown_text(t: Tables) -> DataFrame:
    from tableloom.functions import text as T

    return t.documents.select("doc_id", F.md5(T.escaped(F.col("text"))).alias("shown"))


@query("row_keys", "select p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') as key, [p_size, p_size + 1] as pages, list_transform(regexp_extract_all(p_name, '[a-z]+'), lambda w: upper(w[1]) || w[2:])[1] as label from part")
def row_keys(t: Tables) -> DataFrame:
    """Names as keys to join by, page lists, and names of fields as labels."""
    from tableloom.functions import text as T

    first = F.regexp_extract("p_name", "([a-z]+)", 1)
    return t.part.select("p_partkey", T.key(F.col("p_name")).alias("key"), T.page_list(text(F.col("p_size"), "+", F.col("p_size") + 1, "+x")).alias("pages"), T.auto_label(first).alias("label"))


@query("point_issues", "select o_custkey as c, count_if(o_orderkey % 5 = 0) as blank, count_if(o_orderkey % 7 = 0 and o_orderkey % 2 = 0) as illegible from orders group by 1 having count_if(o_orderkey % 5 = 0) + count_if(o_orderkey % 7 = 0 and o_orderkey % 2 = 0) > 0")
def point_issues(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = t.orders.select(F.col("o_custkey").alias("c"), F.when(k % 2 == 0, "text_table").otherwise("pie").alias("element_type"), F.when(k % 5 == 0, "  ").otherwise("s").alias("series"), F.when(k % 7 == 0, "?").otherwise("1").alias("value"))
    return checks.point_issues(rows, ["c"])


@query("failed_self_checks", "select o_orderkey, case o_orderkey % 5 when 1 then 'off' when 3 then 'unparseable' end as issue from orders where o_orderkey % 5 in (1, 3)")
def failed_self_checks(t: Tables) -> DataFrame:
    written = F.array(*map(F.lit, ["1+2=3; 4+5=9", "100 + 30 = 120", "5 = 2+3", "a=b=c", ""]))
    return checks.failed_self_checks(t.orders.select("o_orderkey", F.get(written, (F.col("o_orderkey") % 5).cast("int")).alias("self_check"))).select("o_orderkey", "issue")
