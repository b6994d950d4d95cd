"""Queries on printed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableloom.functions import text as T, values as V
from tableloom.operators import checks
from tableloom.plans.registry import Tables, query

# Tokens as tables print them, made of part keys: one form per remainder.
TOKENS_SQL = """select p_partkey, case p_partkey % 12 when 0 then '(1,' || lpad((p_partkey % 1000)::varchar, 3, '0') || ')' when 1 then p_size::varchar || '%' when 2 then '-'
 when 3 then '–' when 4 then '0' when 5 then '' when 6 then ' ' || p_partkey::varchar || ' ' when 7 then 'n.m.' when 8 then '+' || p_size::varchar || '.5' when 9 then '#'
 when 10 then p_size::varchar || 'x' else p_partkey::varchar || ',000' end as v from part"""
NUMBER = "'^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


def tokens(t: Tables) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    key = k.cast("string")
    forms = [F.concat(F.lit("(1,"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(")")), F.concat(size, F.lit("%")), F.lit("-"), F.lit("–"), F.lit("0"), F.lit(""), F.concat(F.lit(" "), key, F.lit(" ")), F.lit("n.m."), F.concat(F.lit("+"), size, F.lit(".5")), F.lit("#"), F.concat(size, F.lit("x")), F.concat(key, F.lit(",000"))]
    out = F.when(F.lit(False), F.lit(""))
    for i, form in enumerate(forms):
        out = out.when(k % 12 == i, form)
    return t.part.select("p_partkey", out.alias("v"))


def number_sql(core: str) -> str:
    return f"case when regexp_matches({core}, {NUMBER}) then try_cast({core} as double) end"


COERCE_SQL = f"""
with s as (select p_partkey, trim(v) as s from ({TOKENS_SQL})),
p as (select *, replace(s, ',', '') as t, s like '(%)' as neg from s),
c as (select *, case when neg then t[2:-2] else t end as core, case when neg then -1 else 1 end as sign from p),
l as (select *, rtrim(case when neg then s[2:-2] else s end, '%') as plain from c)
select p_partkey,
  case when s not in ('', '-', '–', '—', 'n.m.', 'nm', 'NA', 'N/A') and s not like '%\\%' escape '\\' then sign * {number_sql("core")} end as grid,
  case when s not in ('', '-', '–', '—', 'n.m.', 'nm', 'NA', 'N/A', '?') and s not like '%\\%' escape '\\' and s not like '%bps' and s not like '%x' then sign * {number_sql("replace(core, '+', '')")} end as point,
  sign * {number_sql("replace(replace(plain, ',', ''), '+', '')")} as lenient,
  {number_sql("rtrim(case when neg then '-' || core else t end, '%')")} as review,
  case when lower(s) not in ('', '-', '–', '—', 'n.m.', 'nm', 'na', 'n/a', '#', 'none') then sign * {number_sql("rtrim(core, '%')")} end as score_num,
  case when lower(s) not in ('', '-', '–', '—', 'n.m.', 'nm', 'na', 'n/a', '#', 'none') and {number_sql("rtrim(core, '%')")} is null then lower(s) end as score_txt
from l
"""


@query("coerce_values", COERCE_SQL)
def coerce_values(t: Tables) -> DataFrame:
    v, score = F.col("v"), V.score_value(F.col("v"))
    return tokens(t).select("p_partkey", V.grid_number(v).alias("grid"), V.point_number(v).alias("point"), V.lenient_number(v).alias("lenient"), V.review_number(V.stripped(v)).alias("review"), score["num"].alias("score_num"), score["txt"].alias("score_txt"))


STATE_SQL = f"""
with s as (select p_partkey, v, trim(v) as s, p_partkey % 5 = 0 as grey, p_partkey % 17 = 0 as head from ({TOKENS_SQL})),
x as (select *, case when head then 'section_header' when grey then 'suppressed' when s in ('-', '–', '—', '−') then 'nil' when s = '#' then 'rounds_to_zero' when s = '' then 'not_disclosed' else 'reported' end as status from s)
select p_partkey, case when s in ('-', '–', '—') then '-' else s end as cell_value, case when s in ('-', '–', '—') then 'nil' when s = '0' then 'zero' when s = '' then 'empty' else 'reported' end as cell_state,
  case when s in ('-', '–', '—') then 'nil' when s = '0' then 'zero' when grey then 'grey' else 'reported' end as migrated, status,
  s in ('', '-') as blank, case when status in ('nil', 'rounds_to_zero') then 0.0 when status = 'reported' then l end as num
from x left join (select p_partkey, lenient as l from ({COERCE_SQL})) using (p_partkey)
"""


@query("cell_state", STATE_SQL)
def cell_state(t: Tables) -> DataFrame:
    rows = tokens(t).withColumn("grey", F.col("p_partkey") % 5 == 0).withColumn("head", F.col("p_partkey") % 17 == 0)
    cell = V.cell_from_text(F.col("v"))
    old = V.normal_cell(F.struct(F.col("v").alias("value"), F.when(F.col("grey"), "suppressed").otherwise("rounds_to_zero").alias("cell_state")))
    rows = rows.withColumn("status", V.status(F.col("v"), F.when(F.col("head"), "section_header").otherwise("data"), F.col("grey")))
    return rows.select("p_partkey", cell["value"].alias("cell_value"), cell["cell_state"].alias("cell_state"), old["cell_state"].alias("migrated"), "status", V.is_empty(F.col("v")).alias("blank"), V.status_number(F.col("v"), F.col("status")).alias("num"))


@query(
    "rollup_check",
    """select o_orderkey, o_totalprice as expected, round(sum(l_extendedprice), 2) as got, abs(sum(l_extendedprice) - o_totalprice) <= greatest(2, abs(o_totalprice) * 0.01) as ok
    from orders join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_totalprice""",
)
def rollup_check(t: Tables) -> DataFrame:
    pairs = t.orders.select("o_orderkey", F.col("o_totalprice").alias("expected")).join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("value")), "o_orderkey")
    return checks.rollup(pairs, ["o_orderkey"]).withColumn("got", F.round("got", 2))


@query(
    "ratio_check",
    """with n as (select c_nationkey, sum(o_totalprice) as a, sum(c_acctbal) as b from orders join customer on c_custkey = o_custkey group by 1)
    select c_nationkey, round(round(a / b * 100) + (c_nationkey % 4) * 0.03 * round(a / b * 100), 4) as stated, round(a / b * 100, 4) as implied,
    abs(a / b * 100 - (round(a / b * 100) + (c_nationkey % 4) * 0.03 * round(a / b * 100))) <= greatest(5, abs(round(a / b * 100) + (c_nationkey % 4) * 0.03 * round(a / b * 100)) * 0.05) as ok from n""",
)
def ratio_check(t: Tables) -> DataFrame:
    n = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_nationkey").agg(F.sum("o_totalprice").alias("numerator"), F.sum("c_acctbal").alias("denominator"))
    whole = F.round(F.col("numerator") / F.col("denominator") * 100)
    n = n.withColumn("stated", whole + (F.col("c_nationkey") % 4) * 0.03 * whole)
    return checks.ratio(n, ["c_nationkey"]).withColumn("stated", F.round("stated", 4)).withColumn("implied", F.round("implied", 4))


@query(
    "self_check",
    """with c as (select l_orderkey, l_linenumber, l_partkey as a, l_suppkey as b, l_linenumber % 4 as k, l_orderkey % 9 as d from lineitem)
    select l_orderkey, l_linenumber, case k when 0 then 1 when 1 then 2 when 2 then 1 else 1 end::int as equations,
    case k when 3 then null else d::double end as delta, case k when 3 then null else d <= 5 end as ok from c""",
)
def self_check(t: Tables) -> DataFrame:
    """One sum, two sums, a sum on the right, and something that isn't an equation."""
    a, b, off = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey") % 9
    text = lambda x: x.cast("string")
    plain = F.concat(F.lit("[t] "), text(a), F.lit(" + "), text(b), F.lit(" = "), text(a + b + off))
    forms = F.when(F.col("l_linenumber") % 4 == 0, plain).when(F.col("l_linenumber") % 4 == 1, F.concat(plain, F.lit("; 1,000 - 1 = 999")))
    forms = forms.when(F.col("l_linenumber") % 4 == 2, F.concat(text(a - b + off), F.lit(" = "), text(a), F.lit("-"), text(b))).otherwise("totals agree")
    checked = V.self_check(forms)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.size(checked).alias("equations"), checked[0]["delta"].alias("delta"), checked[0]["ok"].alias("ok"))


@query(
    "bridge_balance",
    """select c_custkey, c_acctbal as opening, round(s, 2) as steps, round(c_acctbal + s + c_custkey % 8 + 0.5, 2) as closing, (c_custkey % 8 + 0.5)::double as delta, c_custkey % 8 < 5 as ok
    from customer join (select o_custkey, sum(case when o_orderkey % 2 = 0 then o_totalprice else -o_totalprice end) as s from orders group by 1) on o_custkey = c_custkey""",
)
def bridge_balance(t: Tables) -> DataFrame:
    steps = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("ord"), F.col("o_orderkey").cast("string").alias("series"), F.lit("bridge").alias("row_type"), F.when(F.col("o_orderkey") % 2 == 0, "+").otherwise("-").alias("sign"), F.col("o_totalprice").alias("num"))
    ends = steps.groupBy("c_custkey").agg(F.sum(V.bridge_amount(F.col("num"), F.col("sign"))).alias("s")).join(t.customer, "c_custkey")
    side = lambda role, ord_, num: ends.select("c_custkey", F.lit(ord_).cast("long").alias("ord"), F.lit(role).alias("series"), F.lit(role).alias("row_type"), F.lit(None).cast("string").alias("sign"), num.alias("num"))
    start, end = side("start", -1, F.col("c_acctbal")), side("end", 1 << 60, F.col("c_acctbal") + F.col("s") + F.col("c_custkey") % 8 + 0.5)
    again = start.withColumn("ord", F.lit(5).cast("long")).withColumn("num", F.lit(0.0))  # a repeated row, to be left out
    out = checks.bridge_balance(steps.unionByName(start).unionByName(end).unionByName(again), ["c_custkey"])
    return out.select("c_custkey", "opening", F.round("steps", 2).alias("steps"), F.round("closing", 2).alias("closing"), F.round("delta", 4).alias("delta"), "ok")


@query(
    "period_header_norm",
    """select o_orderkey, '20' || strftime(o_orderdate, '%y-%m-%d') as day, strftime(o_orderdate, '%Y-%m') as month, 'total for ' || year(o_orderdate)::varchar as other, true as is_year, false as is_word from orders""",
)
def period_header_norm(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", T.column_header(F.date_format(d, "d MMM yy")).alias("day"), T.column_header(F.date_format(d, "MMMM yyyy")).alias("month"), T.column_header(F.concat(F.lit("Total for: "), F.year(d).cast("string"))).alias("other"), T.is_period(F.year(d).cast("string")).alias("is_year"), T.is_period(F.lit("Total")).alias("is_word"))
