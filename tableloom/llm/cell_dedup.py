"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products inside them, one representative kept.

Two unit vectors whose cosine is t or more are at most sqrt(2 - 2t) apart.  If their nearest centroids a and b
differ, the hyperplane between a and b separates them, so one of them is at most half that distance from it.
A vector therefore also joins every cell whose separating hyperplane is that near, and any two such vectors meet
in the own cell of at least one of them: none is lost at cell bounds.  A cell compares its own vectors with all that
joined it; a vector's links count in its own cell, or in the partner's where the partner did not join it.

Equal vectors collapse to one with a multiplicity first.  A cell that is larger than a block is split into blocks
and its pairs of blocks are separate tasks; a task gives sums and a spanning forest of its links, never pairs.
Products are taken in single precision, and those near the threshold or above it again in double precision.
Only the centroids come from a bounded sample; they are as many as max_cells at most and go to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tableloom.llm import wordscan as ws
from tableloom.llm.linking import components
from tableloom.llm.vectors import dimension, matrix, usable
from tableloom.scratch import Scratch

U = np.uint64


@dataclass(frozen=True)
class Cells:
    cosine: float = 0.9
    rows_per_cell: int = 4096
    max_cells: int = 1024
    sample: int = 16384
    iterations: int = 12
    block: int = 16384
    seed: int = 5


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def centroids(x: np.ndarray, k: int, c: Cells) -> np.ndarray:
    """Spherical k-means of unit vectors; an empty cell takes the vector that fits its own worst."""
    r = np.random.default_rng(c.seed)
    k = min(k, len(x))
    means = x[r.choice(len(x), k, replace=False)]
    for _ in range(c.iterations):
        near = x @ means.T
        home, fit = near.argmax(1), near.max(1)
        sums = np.zeros_like(means)
        np.add.at(sums, home, x)
        for empty in np.flatnonzero(np.bincount(home, minlength=k) == 0):
            worst = int(fit.argmin())
            sums[empty], fit[worst] = x[worst], 2
        norm = np.sqrt((sums * sums).sum(1, keepdims=True))
        means = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), means)
    return means


def cells_of(x: np.ndarray, means: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Which cells each unit vector joins, its own and those whose bound is near, and its own."""
    near = x @ means.T
    home = near.argmax(1)
    apart = np.sqrt(np.maximum(2 - 2 * means @ means.T, 0))[home]
    joins = near[np.arange(len(x)), home][:, None] - near <= apart * (np.sqrt(2 - 2 * cosine) / 2 + 1e-9)
    joins[np.arange(len(x)), home] = True
    return joins, home


def bit_words(joins: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words, cell 0 lowest."""
    k = -(-joins.shape[1] // 64) * 64
    full = np.zeros((len(joins), k), bool)
    full[:, : joins.shape[1]] = joins
    return np.packbits(full, axis=1, bitorder="little").view(U)


def merge(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Joins the trees of linked rows; parent stays flat, each row pointing at the least of its tree."""
    while True:
        a, b = parent[u], parent[v]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def linked(cell: int, x: np.ndarray, left: np.ndarray, right: np.ndarray, home: np.ndarray, many: np.ndarray, words: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Per row: links that count here, weighted by multiplicity, and the least row of its tree.

    left: rows whose own cell this is; right: rows that joined it.
    """
    links, parent = np.zeros(len(x), np.int64), np.arange(len(x))
    single = x.astype(np.float32)
    y = np.ascontiguousarray(single[right].T)
    for i in range(0, len(left), 512):
        rows = left[i : i + 512]
        a, b = np.nonzero(single[rows] @ y >= np.float32(cosine - 1e-5))
        u, v = rows[a], right[b]
        u, v = u[u != v], v[u != v]
        ok = np.concatenate([(x[u[j : j + 65536]] * x[v[j : j + 65536]]).sum(1) >= cosine for j in range(0, len(u), 65536)]) if len(u) else np.zeros(0, bool)
        u, v = u[ok], v[ok]
        links += np.bincount(u, many[v], len(x)).astype(np.int64)
        h = home[v]
        alone = (h != cell) & ((words[u, h // 64] >> (h % 64).astype(U)) & U(1) == 0)  # u did not join v's own cell
        links += np.bincount(v[alone], many[u[alone]], len(x)).astype(np.int64)
        merge(parent, u, v)
    return links, parent


def near_duplicates(vectors: DataFrame, c: Cells | None = None) -> DataFrame:
    """Per row of vectors (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors that are null, zero, of another length than most, or hold null or non-finite components link with
    nothing and are kept.  Copies of a vector link with each other, rows that repeat a vec_id included; of
    different vectors under one vec_id one is compared, for all of them.  A row without vec_id counts as a link of others, but is in no component and neither kept nor dropped: null.
    """
    c = c or Cells()
    spark = vectors.sparkSession
    scratch = Scratch(spark, "cell-dedup")
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    valid = vectors.filter(usable())
    d = dimension(valid)
    alone = lambda x: x.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    if d is None:
        return alone(vectors)
    fits = usable() & (F.size("embedding") == d)
    valid = vectors.filter(fits)
    kinds = scratch.save(valid.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("many")).filter("id is not null"), "kinds")
    n = kinds.count()
    sample = kinds.orderBy(F.xxhash64(F.lit(c.seed), "id"), "id").limit(c.sample).select("embedding").toArrow()
    k = min(c.max_cells, max(1, n // c.rows_per_cell))
    means = spark.sparkContext.broadcast(centroids(unit(matrix(sample["embedding"])), k, c) if n else np.zeros((1, d)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                joins, home = cells_of(unit(matrix(batch.column(2))), means.value, c.cosine)
                row, cell = np.nonzero(joins)
                words = bit_words(joins)
                masks = pa.ListArray.from_arrays(pa.array(np.arange(0, words.size + 1, words.shape[1], dtype=np.int32)), pa.array(words.reshape(-1).view(np.int64)))
                own = pa.array(home[row].astype(np.int32))
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), own, *(x.take(row) for x in (batch.column(0), batch.column(1), masks, batch.column(2)))], ["cell", "home", "id", "many", "cells", "embedding"])

    kind = dict(vectors.dtypes)["embedding"]
    placed = scratch.save(kinds.select("id", "many", "embedding").mapInArrow(assign, f"cell int, home int, id long, many long, cells array<long>, embedding {kind}"), "placed")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.count_if(F.col("cell") == F.col("home")).alias("own")).collect()  # max_cells at most
    by_cell = lambda k: F.create_map(*(F.lit(x) for r in sizes for x in (r["cell"], max(1, -(-r[k] // c.block)))))[F.col("cell")]
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    part = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    if sizes:
        placed = placed.withColumn("m", by_cell("n")).withColumn("h", by_cell("own"))
        right = placed.withColumn("j", part(F.col("m"))).withColumn("i", every(F.col("h"))).withColumn("left", F.lit(False))
        left = placed.filter("cell = home").withColumn("i", part(F.col("h"))).withColumn("j", every(F.col("m"))).withColumn("left", F.lit(True))
        dealt = left.unionByName(right)
    else:
        dealt = placed.withColumns({"i": F.lit(0), "j": F.lit(0), "left": F.lit(False)})
    dealt = dealt.select("cell", "i", "j", "left", "home", "id", "many", "cells", "embedding")

    def compare(table: pa.Table) -> pa.Table:
        ids, first, row = np.unique(table["id"].to_numpy(), return_index=True, return_inverse=True)  # a row may be on both sides
        is_left = table["left"].to_numpy(zero_copy_only=False)
        one = table.take(pa.array(first))
        words = one["cells"].combine_chunks().flatten().to_numpy().view(U).reshape(len(ids), -1)
        links, parent = linked(table["cell"][0].as_py(), unit(matrix(one["embedding"])), row[is_left], row[~is_left], one["home"].to_numpy(), one["many"].to_numpy(), words, c.cosine)
        own = np.flatnonzero((links > 0) | (parent != np.arange(len(ids))))
        ws.trim()
        return pa.table({"u": ids[own], "v": ids[parent[own]], "links": links[own]})

    found = scratch.save(dealt.groupBy("cell", "i", "j").applyInArrow(compare, "u long, v long, links long"), "found")
    scratch.drop("placed")
    comp = components(scratch, found.select("u", "v").filter("u <> v"), "comp")
    links = found.groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links"))
    named = kinds.join(links, "id", "left").join(comp, "id", "left").select("embedding", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("comp", "id").alias("component_id"))
    out = valid.join(named, "embedding", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id")).unionByName(alone(vectors.filter(~fits)).withColumn("kept", F.col("vec_id") == F.col("component_id")))
