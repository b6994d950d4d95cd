"""Connected components of links, and exact linking inside buckets of candidates without emitting all their pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from tableloom.scratch import Scratch


BROADCAST = 2_000_000  # values of eight bytes that may go to every task: 16 MB, twice that as rows


def sized(df: DataFrame, rows: int | None = None, most: int = BROADCAST) -> DataFrame:
    """df, to be broadcast if a count of its values (rows, if given, else one for each field) shows that it is small.

    A larger one is joined by a shuffle.
    """
    return F.broadcast(df) if (df.count() * len(df.columns) if rows is None else rows or 0) <= most else df


def unused(names: list[str]) -> Iterator[str]:
    """Column names that none of these equals, whatever their case."""
    taken = {n.lower() for n in names}
    return (n for n in (f"_x{k}" for k in count()) if n not in taken)


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One half of the alternating star contraction: hooks each node's larger (or smaller) neighbours to its least one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if small:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hooked = both.join(least, "u")
    if small:  # the node itself is hooked too
        return hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
    return hooked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """(id, comp) for every node of edges (u, v): comp is the least node that links reach.

    Alternating large-star and small-star steps, each a few shuffles over the remaining edges; the number of
    rounds grows with the logarithm of the longest chain.  Every round is a written table.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    k = 0
    while True:
        edges = scratch.save(_stars(_stars(edges, False), True), f"{name}-{k}")
        if k:
            scratch.drop(f"{name}-{k - 1}")
        tied = edges.groupBy("u").agg(F.count("*").alias("n")).join(edges.select(F.col("v").alias("u")).distinct().withColumn("tip", F.lit(True)), "u", "left")
        if tied.filter("n > 1 or tip").isEmpty():  # every node is hooked once, to a tip: stars only
            break
        k += 1
    tips = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("comp"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(tips)


def link_buckets(scratch: Scratch, buckets: DataFrame, close: Callable[[Column, Column], Column], verify: Callable[[DataFrame, str], DataFrame], rounds: int = 2) -> DataFrame:
    """Components, (id, comp) for linked ids, of all links that verify() confirms between members of a bucket.

    buckets: distinct (key, id, fact).  close(fact, fact) is true for all pairs that may be links;
    verify(pairs (u, v) with u < v, name) gives those that are, as a table.
    A few rounds compare each bucket's members with one pivot only, another one each round, so a group of n
    near copies costs n comparisons, not n * n.  Whatever members are then still in different components are
    compared pair by pair inside the join, so no link that joins two components is lost.
    """
    links, comp = None, None
    for k in range(rounds + 1):
        members = buckets.withColumn("c", F.col("id")) if comp is None else buckets.join(comp, "id", "left").select("key", "id", "fact", F.coalesce("comp", "id").alias("c"))
        order = F.col("id") if not k else F.xxhash64(F.lit(k), "id")
        pivots = members.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min(F.struct(order.alias("o"), "id", "c", "fact")).alias("p")).filter("low < high")
        if k < rounds:
            pairs = members.join(pivots.select("key", "p"), "key").filter(F.col("c") != F.col("p.c"))
            pairs = pairs.filter(close(F.col("fact"), F.col("p.fact"))).select(F.least("id", "p.id").alias("u"), F.greatest("id", "p.id").alias("v"))
        else:
            rest = scratch.save(members.join(pivots.select("key"), "key", "left_semi"), "open")
            if rest.isEmpty():
                break
            a, b = (rest.select("key", *(F.col(x).alias(f"{x}_{side}") for x in ("id", "fact", "c"))) for side in "ab")
            pairs = a.join(b, (a.key == b.key) & (F.col("id_a") < F.col("id_b")) & (F.col("c_a") != F.col("c_b")) & close(F.col("fact_a"), F.col("fact_b"))).select(F.col("id_a").alias("u"), F.col("id_b").alias("v"))
        pairs = scratch.save(pairs.distinct(), f"pairs-{k}")
        if pairs.isEmpty():
            continue
        found = verify(pairs, f"links-{k}")
        links = found if links is None else links.unionByName(found)
        if not found.isEmpty():
            comp = components(scratch, links, f"comp-{k}")
    return comp if comp is not None else buckets.select("id", F.col("id").alias("comp")).limit(0)
