"""N-gram Jaccard join by parity sketches.

Every element (a hashed word n-gram) flips one bit of a sketch, so the sketches of two sets differ in at most as
many bits as the sets' symmetric difference has elements.  Two sets of sizes a and b with Jaccard >= t differ in
at most D = (a + b)(1 - t) / (1 + t) elements.  A sketch is cut into k > D parts; by the pigeonhole principle at
least k - D parts of two such sets are equal.  k grows with the set's size, so it is fixed per size band, and
partners are in the same or in the next band.  A part is represented by the XOR of random words, one for each of
its bits that is set, which equals for equal parts.

Of its k parts a set needs to show only D + 1 if all sets show them in the same order (the prefix principle);
the order is by the number of elements in the part, most first, so parts that hold little or nothing of a text
are the ones left out.

Candidates of a bucket pass a length filter and the Hamming distance of a dense 512-bit parity sketch before the
exact sets are intersected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tableloom.llm import wordscan as ws
from tableloom.llm.linking import link_buckets, sized
from tableloom.scratch import Scratch

U = np.uint64
SKETCH = 8  # longs of the dense sketch


@dataclass(frozen=True)
class Jaccard:
    """num / den is the least similarity of a link; n the words of a shingle."""

    n: int = 5
    num: int = 4
    den: int = 5


@lru_cache(maxsize=None)
def bands(num: int, den: int, top: int) -> tuple[int, ...]:
    """Where size bands begin, up to past top: sizes num / den apart or closer are in the same or in neighbouring bands."""
    out = [1]
    while out[-1] <= top:
        out.append(out[-1] * den // num + 1)
    return tuple([*out, *(out[-1] * den // num + 1,)])


def differing(a: int, b: int, j: Jaccard) -> int:
    """The most elements by which two linked sets of these sizes differ."""
    return (a + b) * (j.den - j.num) // (j.den + j.num)


def plans(size: int, j: Jaccard) -> list[tuple[int, int, int]]:
    """(group, parts, parts to show) for a set: as the lower and as the upper band of two neighbouring ones."""
    lows = bands(j.num, j.den, size)
    i = int(np.searchsorted(lows, size, "right")) - 1
    out = []
    for lower, most in ((i, size * j.den // j.num), (i - 1, lows[i] - 1)):
        if lower < 0:
            continue
        end = bands(j.num, j.den, lows[lower] * 3 + 9)
        high, top = end[lower + 1] - 1, end[lower + 2] - 1
        worst = differing(high, min(top, high * j.den // j.num), j)
        if worst:  # else only equal sets link
            out.append((lower, worst * 7 // 5 + 2, differing(size, min(top, most), j) + 1))
    return out


def signatures(elements: np.ndarray, j: Jaccard) -> np.ndarray:
    """The keys under which a set meets every set it may be linked with."""
    out = []
    for group, k, show in plans(len(elements), j):
        x = ws.mix(elements ^ U(group * 0x9E3779B1 + 77))
        part = ((x >> U(32)) * U(k) >> U(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        count = np.bincount(part, minlength=k)
        some = np.flatnonzero(count)
        word = np.zeros(k, U)
        word[some] = np.bitwise_xor.reduceat(ws.mix((x[order] & U(0xFFFF)) + U(0x51_0000)), np.r_[0, np.cumsum(count[some])[:-1]])
        key = ws.mix(word ^ ws.mix(np.arange(k, dtype=U) + U(group << 32)))
        out.append(key[np.lexsort((key, -count))[:show]])
    return np.concatenate(out) if out else np.zeros(0, U)


def dense(elements: np.ndarray) -> np.ndarray:
    """The parity of the elements that fall on each of 512 bits, as longs."""
    odd = np.bincount(((elements >> U(16)) & U(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def fingerprint(elements: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a, b = ws.mix(elements).sum(dtype=U), ws.mix(elements ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=U)
    return int(np.int64(a.view(np.int64))), int(np.int64(b.view(np.int64)))


def _sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for lo, _, data, at in ws.chunks(column):
        start, end = ws.words(data, at)
        first = np.searchsorted(start, at)
        for i, x in enumerate(ws.shingles(ws.hashes(data, start, end), first, n)):
            yield lo + i, x


def describe(docs: DataFrame, j: Jaccard) -> DataFrame:
    """Per row of (doc_id, text): n_shingles, the set's fingerprint (a, b), dense sketch s0.. and signature keys."""
    fields = ["doc_id long", "n_shingles long", "a long", "b long", *(f"s{k} long" for k in range(SKETCH)), "keys array<long>"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held = batch.column(0), []
            for row, x in _sets(batch.column(1), j.n):
                held.append((row, len(x), *fingerprint(x), dense(x), signatures(x, j)))
                if len(held) == 2000:
                    yield pack(ids, held)
                    held = []
            if held:
                yield pack(ids, held)
            ws.trim()

    def pack(ids: pa.Array, held: list) -> pa.RecordBatch:
        rows, size, a, b, sketch, keys = zip(*held, strict=True)
        sketch = np.stack(sketch)
        columns = [ids.take(pa.array(rows)), pa.array(size, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), *(pa.array(sketch[:, k]) for k in range(SKETCH)), ws.lists(list(keys))]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in fields])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ", ".join(fields))


def element_sets(docs: DataFrame, n: int) -> DataFrame:
    """(id, size, elements) of rows of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for row, x in _sets(batch.column(1), n):
                held.append((row, x))
                if len(held) == 1000:
                    yield pack(batch, held)
                    held = []
            if held:
                yield pack(batch, held)
            ws.trim()

    def pack(batch: pa.RecordBatch, held: list) -> pa.RecordBatch:
        rows, sets = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array([len(x) for x in sets], pa.int64()), ws.lists(list(sets))], ["id", "size", "elements"])

    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(run, "id long, size long, elements array<long>")


def link_documents(docs: DataFrame, j: Jaccard | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id, the least doc_id that links reach.

    Rows whose shingle sets are equal are one class, which its least doc_id stands for.  Null or empty texts have
    no shingles and link with nothing.  Rows that repeat a doc_id share its component; a null doc_id belongs to
    the component of its equal texts and is null if it has none.  An empty table gives an empty result; other
    columns are ignored.
    """
    j = j or Jaccard()
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard-join")
    ws.small_batches(spark)
    docs = docs.select("doc_id", "text")
    about = scratch.save(describe(docs, j), "about")
    classes = about.filter("n_shingles > 0").groupBy("a", "b").agg(F.min("doc_id").alias("rep")).filter("rep is not null")
    classes = scratch.save(classes, "classes")
    copies = about.join(classes, ["a", "b"]).filter(F.col("doc_id") > F.col("rep")).select("doc_id", "a").distinct()
    copies = scratch.save(copies, "copies")
    reps = about.filter("n_shingles > 0 and doc_id is not null").join(sized(copies), ["doc_id", "a"], "left_anti").withColumnRenamed("doc_id", "id")

    keyed = reps.select("id", F.explode("keys").alias("key"))
    w = W.partitionBy("key")
    met = keyed.select("key", "id", F.min("id").over(w).alias("low"), F.max("id").over(w).alias("high"), F.xxhash64(F.count("*").over(w), F.min("id").over(w), F.max("id").over(w), F.bit_xor(F.xxhash64("id")).over(w)).alias("same")).filter("low < high").select("key", "id", "same")
    met = scratch.save(met, "met")
    scratch.release()
    one = met.groupBy("same").agg(F.min("key").alias("key"))  # of buckets with the same members, one
    buckets = scratch.save(met.join(one, ["same", "key"], "left_semi").select("key", "id").distinct(), "buckets")
    scratch.drop("met")

    ids = scratch.save(buckets.select("id").distinct(), "ids")
    facts = reps.join(sized(ids), "id", "left_semi").select("id", F.struct(F.col("n_shingles").alias("size"), *(f"s{k}" for k in range(SKETCH))).alias("fact")).distinct()
    buckets = scratch.save(buckets.join(facts, "id"), "buckets-facts")
    texts = docs.withColumnRenamed("doc_id", "id").join(sized(ids), "id", "left_semi").withColumnRenamed("id", "doc_id")
    sets = scratch.save(element_sets(texts, j.n).filter("size > 0"), "sets")
    scratch.drop("buckets")
    scratch.release()

    def close(a: Column, b: Column) -> Column:
        """Length filter, then the Hamming distance of the dense sketches."""
        apart = reduce(add, (F.bit_count(a[f"s{k}"].bitwiseXOR(b[f"s{k}"])) for k in range(SKETCH)))
        return (F.least(a["size"], b["size"]) * j.den >= F.greatest(a["size"], b["size"]) * j.num) & (apart * (j.den + j.num) <= (a["size"] + b["size"]) * (j.den - j.num))

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        """The exact Jaccard of the two sets."""
        whole = lambda s: sets.select(F.col("id").alias(s), F.col("elements").alias(f"e{s}"))
        common = F.size(F.array_intersect("eu", "ev"))
        linked = pairs.join(whole("v"), "v").join(whole("u"), "u").filter(common * j.den >= (F.size("eu") + F.size("ev") - common) * j.num)
        return scratch.save(linked.select("u", "v").distinct(), name)

    comp = link_buckets(scratch, buckets, close, verify)
    named = classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("a", "b", F.coalesce("comp", "rep").alias("comp"), F.lit(True).alias("some"))
    out = about.select("doc_id", "n_shingles", "a", "b").join(named, ["a", "b"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("comp", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
