"""Operators on vectors and pages against brute force."""

from __future__ import annotations

import hashlib
from base64 import b32encode

import numpy as np
import zstandard
from pyspark.sql import functions as F

from tableloom.llm import cell_dedup as cd, prefix_forest as pf, warc
from tableloom.scratch import Scratch

ODD = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, None]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.1]), (100, [0.0, 1.0]), (200, [-1.0, 0.0]), (10, []), (300, None)]


def odd(spark):
    return spark.createDataFrame([(*x, 0, "q") for x in ODD], "vec_id long, embedding array<float>, label int, id string")


def clustered(seed, n, d=24):
    r = np.random.default_rng(seed)
    x = r.normal(size=(6, d))[r.integers(0, 6, n)] + r.normal(size=(n, d))
    x[n // 2 : n // 2 + n // 8] = x[:1] + r.normal(size=(n // 8, d)) * 0.15  # a dense group around one vector
    x[-n // 10 :] = x[: n // 10]
    return x


def vectors(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)


def components(links):
    comp = np.arange(len(links))
    while True:
        new = np.where(links, comp[None, :], len(comp)).min(1)
        new = np.minimum(new, comp)
        if (new == comp).all():
            return comp
        comp = new


def test_search_is_exact_on_what_it_finds_and_finds_most(spark):
    x = np.random.default_rng(8).normal(size=(1500, 32))
    f = pf.Forest(block=600, chunk=7, sample=500)
    got = pf.search(vectors(spark, x), F.col("vec_id") % 100 == 0, 10, f).collect()
    hits = 0
    for q in range(0, 1500, 100):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, _, _ in own] == list(range(1, 11)) and q not in [v for _, v, _ in own]
        far = np.sqrt(((x - x[q]) ** 2).sum(1))
        assert all(abs(far[v] - s) < 1e-9 for _, v, s in own) and [s for _, _, s in own] == sorted(s for _, _, s in own)
        far[q] = np.inf
        hits += len(set(np.lexsort((np.arange(1500), far))[:10]) & {v for _, v, _ in own})
    assert hits / 150 >= 0.9


def test_search_recall_on_the_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.toPandas()
    x, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    got = pf.search(df, F.col("vec_id") % 100 == 0).toPandas()
    hits, n = 0, 0
    for q, own in got.groupby("query_id"):
        far = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        far[ids == q] = np.inf
        hits, n = hits + len(set(ids[np.lexsort((ids, far))[:10]]) & set(own["vec_id"])), n + 10
    assert n == 10 * (ids % 100 == 0).sum() and hits / n >= 0.9


def test_few_rows_are_compared_exactly(monkeypatch):
    x, f, looked = np.random.default_rng(22).normal(size=(12000, 48)), pf.Forest(), []
    lexsort = np.lexsort
    monkeypatch.setattr(pf.np, "lexsort", lambda keys: looked.append(len(keys[0])) or lexsort(keys))
    pf.nearest(np.arange(12000), x, np.arange(0, 12000, 600), x[::600], pf.Planes(x[: f.sample], f), 10)
    assert len(looked) == 20 and max(looked) + f.fitted <= 0.11 * 12000


def test_recall_in_one_large_block():
    r = np.random.default_rng(21)
    for x in (r.normal(size=(20000, 64)), r.normal(size=(40, 64))[r.integers(0, 40, 20000)] + r.normal(size=(20000, 64))):
        f, ids, hits = pf.Forest(), np.arange(20000), 0
        got = pf.nearest(ids, x, ids[::400], x[::400], pf.Planes(x[: f.sample], f), 10)
        for q in ids[::400]:
            far = ((x - x[q]) ** 2).sum(1)
            far[q] = np.inf
            hits += len({v for own, v, _ in got if own == q} & set(np.argsort(far)[:10].tolist()))
        assert hits / 500 >= 0.98


def test_a_vector_that_a_third_of_the_rows_have(spark):
    x = np.random.default_rng(23).normal(size=(3000, 16))
    x[:1000] = x[0]
    got = pf.search(vectors(spark, x), F.col("vec_id") % 100 == 0).collect()
    own = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 500, 900)}
    assert own == {0: list(range(1, 11)), 500: list(range(10)), 900: list(range(10))}


def test_search_odd_rows(spark):
    got = pf.search(odd(spark), F.col("vec_id") % 100 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(100, 1, 1), (100, 2, 2), (100, 3, 200), (200, 1, 100), (200, 2, 1), (200, 3, 2)]
    assert pf.search(odd(spark).limit(0), F.lit(True)).count() == 0 and pf.search(odd(spark), F.lit(False)).count() == 0


def test_cells_lose_no_link(spark):
    for seed, c in ((1, cd.Cells(rows_per_cell=40, block=64)), (2, cd.Cells(cosine=0.7, rows_per_cell=6, block=50))):
        x = clustered(seed, 700)
        u = cd.unit(x)
        links = u @ u.T >= c.cosine
        np.fill_diagonal(links, False)
        want = components(links)
        got = {r["vec_id"]: r for r in cd.near_duplicates(vectors(spark, x), c).collect()}
        assert [got[i]["n_links"] for i in range(700)] == links.sum(1).tolist()
        assert [got[i]["component_id"] for i in range(700)] == want.tolist()
        assert [got[i]["kept"] for i in range(700)] == (want == np.arange(700)).tolist()


def test_many_cells_on_the_tables(spark):
    df = spark.read.parquet("/root/testdata/check_s/embeddings.parquet").filter("vec_id % 3 = 0")
    found = df.toPandas()
    u = cd.unit(np.stack(found["embedding"]).astype(float))
    links = u @ u.T >= 0.9
    np.fill_diagonal(links, False)
    got = cd.near_duplicates(df, cd.Cells(rows_per_cell=200)).toPandas().set_index("vec_id").loc[found["vec_id"]]
    assert got["n_links"].tolist() == links.sum(1).tolist() and links.sum() > 100


def test_cells_odd_rows(spark):
    got = cd.near_duplicates(odd(spark)).collect()
    assert len(got) == len(ODD)
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert by[3] == (0, 3, True) and by[8] == (0, 8, True) and by[10] == (0, 10, True) and by[200] == (0, 200, True)
    assert by[1] == (2, 1, True) and by[2] == (2, 1, False)
    assert cd.near_duplicates(odd(spark).limit(0)).count() == 0


PAGES = [(3, "http://a/\r\nx", "<p>ä</p>"), (1, "http://b", "<p>ä</p>"), (2, None, None), (5, "u", ""), (7, "u", "tail\r\n\r\n" * 2000), (1, "http://b", "<p>ä</p>"), (None, "n", "<p>ä</p>"), (None, "n", "alone")]


def pages(spark):
    return spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, bundle int")


def test_archives_round_trip(spark):
    got = [tuple(r)[:5] for r in warc.round_trip(pages(spark)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    want = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        first = min((p for p, _, h in PAGES if (h or "") == (html or "") and p is not None), default=None)
        again = first is not None and page != first
        want.append((page, len(raw), b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first if again else None))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.round_trip(pages(spark).limit(0)).count() == 0
    assert {r["record_type"] for r in warc.round_trip(pages(spark), min_bytes=10**9).collect()} == {"response"}


def test_bundles_are_seekable_and_plain(spark):
    scratch = Scratch(spark, "t")
    index = warc.write_archives(pages(spark), scratch.table("archives"), scratch, frame_bytes=500).collect()
    for file in {r["file"] for r in index}:
        _, path = warc.opened(file) if hasattr(warc, "opened") else __import__("tableloom.llm.files", fromlist=["opened"]).opened(file)
        with open(path, "rb") as f:
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        frames = warc.seek_table(file)
        assert sum(n for _, _, n in frames) == len(whole)
        for r in (r for r in index if r["file"] == file):
            start, packed, plain = frames[r["frame"]]
            assert (start, packed) == (r["frame_start"], r["frame_size"])
            base = sum(n for _, _, n in frames[: r["frame"]])
            assert warc.parse(whole[base + r["start"] : base + r["start"] + r["size"]])["page_id"] == r["page_id"]
