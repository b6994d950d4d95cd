"""The operators of this subpackage as queries over the tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableloom.llm.byte_conv import in_fold, score_quality
from tableloom.llm.cell_dedup import near_duplicates
from tableloom.llm.context_tree import score_texts
from tableloom.llm.jaccard_join import Jaccard, link_documents
from tableloom.llm.line_dedup import EVERY_LINE, dedup_lines
from tableloom.llm.mixing import mix
from tableloom.llm.packing import pack
from tableloom.llm.prefix_forest import search
from tableloom.llm.separator_scan import document_tokens
from tableloom.llm.tokens import Vocabulary
from tableloom.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

LINKS_SQL = f"""
with recursive d as (select doc_id, {WORDS} as w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) end) as g from d),
n as (select doc_id, count(*) as n from s group by 1),
c as (select a.doc_id as u, b.doc_id as v, count(*) as common from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
e as (select u, v from c join n x on x.doc_id = u join n y on y.doc_id = v where 100 * common >= 85 * (x.n + y.n - common)),
r(doc_id, v) as (select doc_id, doc_id from d union select r.doc_id, e.v from r join e on e.u = r.v)
select d.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(r.v)::bigint as component_id from d join r using (doc_id) left join n using (doc_id) group by d.doc_id
"""


@query("op1_prefix_forest")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


COSINE_SQL = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
e as (select a.vec_id as u, b.vec_id as v from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.9),
r(vec_id, v) as (select vec_id, vec_id from embeddings union select r.vec_id, e.v from r join e on e.u = r.v),
c as (select vec_id, min(v)::bigint as component_id from r group by 1), n as (select u as vec_id, count(*) as n from e group by 1)
select c.vec_id, coalesce(n, 0)::bigint as n_links, component_id, c.vec_id = component_id as kept from c left join n using (vec_id)
"""


@query("op2_cell_dedup", COSINE_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


@query("op3_context_tree")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read(spark, sf_dir, "documents"), ~in_fold("doc_id", 7, 2))


@query("op4_window_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), Vocabulary.byte_bpe()).drop("ids")


LINES_SQL = f"""
with l as (select doc_id, unnest(range(len(string_split(text, chr(10))))) as line_no, unnest(string_split(text, chr(10))) as text from documents where text is not null),
t as (select distinct doc_id, line_no, unnest({WORDS}) as w from l),
s as (select doc_id, line_no, count(*) as n from t group by all),
f as (select w, count(*) as c from t group by 1),
o as (select t.*, n, row_number() over (partition by doc_id, line_no order by c, w) as r from t join s using (doc_id, line_no) join f using (w)),
p as (select * from o where r <= n - (4 * n + 4) // 5 + 1),
c as (select distinct a.doc_id as d, a.line_no as i, b.doc_id as d2, b.line_no as i2, a.n as n, b.n as n2 from p a join p b on a.w = b.w and (b.doc_id < a.doc_id or b.doc_id = a.doc_id and b.line_no < a.line_no) and least(a.n, b.n) * 5 >= greatest(a.n, b.n) * 4),
m as (select distinct d, i from (select d, i from c join o x on x.doc_id = d and x.line_no = i join o y on y.doc_id = d2 and y.line_no = i2 and x.w = y.w group by d, i, d2, i2, c.n, c.n2 having 5 * count(*) >= 4 * (c.n + c.n2 - count(*)))),
k as (select doc_id, count(*) as n_lines, count(d) as n_removed, string_agg(text, chr(10) order by line_no) filter (d is null) as kept from l left join m on d = doc_id and i = line_no group by 1)
select d.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed, case when d.text is not null then md5(coalesce(kept, '')) end as text_md5 from documents d left join k using (doc_id)
"""


@query("op5_line_dedup", LINES_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents"), EVERY_LINE).select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


@query("op6_separator_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_tokens(read(spark, sf_dir, "documents"), Vocabulary.byte_bpe(plain=True), separator=50256)


@query("op7_budget_mix")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_parity_sketch_join", LINKS_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(read(spark, sf_dir, "documents"), Jaccard(n=4, num=17, den=20))


WARC_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
h as (select page_id, strlen(html) as n, sha1(html) as s, min(page_id) over (partition by html) as f from p),
b as (select *, array_to_string(list_transform(range(1, 41), lambda i: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][instr('0123456789abcdef', s[i])]), '') as bits from h)
select page_id, n::bigint as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(1 + 16 * bits[5 * i + 1]::int + 8 * bits[5 * i + 2]::int + 4 * bits[5 * i + 3]::int + 2 * bits[5 * i + 4]::int + bits[5 * i + 5]::int)::int]), '') as payload_digest,
  case when f < page_id then 'revisit' else 'response' end as record_type, case when f < page_id then f end as refers_to from b
"""


@query("op9_seekable_warc", WARC_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "pages")).drop("url")


@query("op10_byte_conv")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
