"""The corpus pipeline's stages, one after another, and the queries with SQL."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tableloom.llm.jaccard_join import Jaccard, link_documents
from tableloom.llm.mixing import mix
from tableloom.llm.packing import pack
from tableloom.llm.queries import ORACLES, QUERIES
from tableloom.llm.tokens import Vocabulary
from test_documents import groups, matches, shingles, split

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append((name, docs))
    return out


def test_stages_keep_the_columns_until_the_last(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [name for name, _ in stages] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "mixing", "packing"]
    assert all(df.columns == columns for _, df in stages[:-1])


def test_each_stage_takes_effect(spark, stages):
    by = dict(stages)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = by["quality_classifier"]
    assert kept.join(labels.filter("quality = 0"), "doc_id").count() <= 0.1 * labels.filter("quality = 0").count() + 1
    clean = labels.filter("quality = 1")
    assert kept.join(clean, "doc_id").count() >= 0.95 * clean.count()
    assert by["line_dedup"].agg(F.sum(F.length("text"))).first()[0] < kept.agg(F.sum(F.length("text"))).first()[0]
    last = link_documents(by["ngram_jaccard_join"])
    assert last.filter("component_id <> doc_id").isEmpty() and by["ngram_jaccard_join"].count() > 0
    packed = by["packing"]
    copies = by["mixing"].groupBy("doc_id").count()
    tokens = packed.groupBy("doc_id").agg((F.sum("length") / F.first("doc_tokens")).alias("copies"))
    assert copies.join(tokens, "doc_id").filter("count <> copies").isEmpty() and tokens.count() == copies.count()


def test_run_takes_an_empty_and_an_odd_table(spark, tmp_path, odd_docs):
    for name, docs in (("none", odd_docs.limit(0)), ("odd", odd_docs)):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / name / "labels.parquet"))
        assert cp.run(spark, str(tmp_path / name)).count() >= 0


def test_lines_of_few_words_go_too(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = duck.execute(ORACLES["op5_line_dedup"].replace("having count(*) >= 5", "having count(*) >= 1"))
    names = [d[0] for d in want.description]
    got = sorted(tuple(r) for r in QUERIES["op5_line_dedup"](spark, SF).select(names).collect())
    assert got == sorted(want.fetchall())
    one = spark.createDataFrame([(1, "Yes.\na"), (2, "yes.\nb"), (3, "A")], "doc_id long, text string").withColumn("source", F.lit("s"))
    assert {r["doc_id"]: r["text"] for r in cp.lines(spark, one, SF).collect()} == {1: "Yes.\na", 2: "b"}


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40)
    for k, name in enumerate(["_lines", "_removed", "_row", "_class", "_copies", "_size", "_x0", "_x1", "_x2", "n_lines", "size", "copies"]):
        docs = docs.withColumn(name, F.lit(k))
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns[-12:] == ["_lines", "_removed", "_row", "_class", "_copies", "_size", "_x0", "_x1", "_x2", "n_lines", "size", "copies"]
        assert [tuple(r)[-12:] for r in docs.distinct().collect()][0] == tuple(range(12))
    assert cp.STAGES[-1][1](spark, docs, SF).count() > 0


def test_run_keeps_rows_that_share_or_lack_an_id(spark, tmp_path):
    base = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60)
    ids = F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 5 == 1, F.col("doc_id") - 1).otherwise(F.col("doc_id"))
    base.withColumn("doc_id", ids).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    docs = cp.quality(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    columns, rows = docs.columns, [r.asDict() for r in docs.collect()]

    gone, lines = matches([(r["doc_id"], r["text"]) for r in rows], least=1), []
    for r in rows:
        kept = [x for i, x in enumerate((r["text"] or "").split("\n")) if (r["doc_id"], i) not in gone]
        if len(kept) == (r["text"] or "").count("\n") + 1 or split("\n".join(kept)):
            lines.append({**r, "text": None if r["text"] is None else "\n".join(kept)})
    j = Jaccard()
    sets = [shingles(r["text"], j.n) for r in lines]
    top = groups(range(len(lines)), lambda a, b: sets[a] and sets[b] and len(sets[a] & sets[b]) * j.den >= len(sets[a] | sets[b]) * j.num)
    best = {}
    for i, r in enumerate(lines):
        place = (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
        best[top[i]] = min(best.get(top[i], (place, r)), (place, r), key=lambda x: x[0])
    want = [tuple(r[c] for c in columns) for _, r in best.values()]
    assert any(r[columns.index("doc_id")] is None for r in want) and len({r[columns.index("doc_id")] for r in want}) < len(want)
    got = docs
    for name, stage in cp.STAGES[1:3]:
        got = stage(spark, got, str(tmp_path)).cache()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)

    copies = sorted((r["doc_id"], r["source"], r["size"], r["copies"]) for r in mix(got.na.fill(-1, ["doc_id"])).collect() if r["copies"])
    mixed = cp.mixing(spark, got.na.fill(-1, ["doc_id"]), str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["source"], len(split(r["text"]))) for r in mixed) == sum((Counter({(d, s, n): c}) for d, s, n, c in copies), Counter())
    pieces = cp.run(spark, str(tmp_path)).filter("start = 0").select("doc_id", "doc_tokens").collect()
    whole = pack(cp.mixing(spark, spark.createDataFrame(want, docs.schema), str(tmp_path)), Vocabulary.byte_bpe()).filter("start = 0").select("doc_id", "doc_tokens").collect()
    assert Counter(map(tuple, pieces)) == Counter(map(tuple, whole)) and any(r["doc_id"] is None for r in pieces)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        duck.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=str)
    assert sorted((tuple(r) for r in df.select(columns).collect()), key=str) == want
