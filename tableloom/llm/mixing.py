"""Mixing sources to target weights, in whole documents that add up to each source's budget.

Targets share a total by weight; a source's target stops at a multiple of its size and the excess is shared anew.
A source is taken whole as often as its target holds it.  The remaining budget is a subset sum over the source's
documents, of which only the number of each length matters: every length gives its proportional share, rounded
down, then further documents, longest first, until what is left is small enough for an exact bounded-knapsack
dynamic programme over the lengths that remain: 32,768 words, or four of the longest documents.  Which documents of a length are taken follows a seeded hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tableloom.scratch import Scratch

WORDS = r"[^\x20\x09-\x0D]+"
EXACT = 1 << 15  # what is left is solved exactly from so many words on, or from four of the longest documents on
BUCKETS = 4096  # a length's documents are counted by so many hash buckets, and ranked in one of them only


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5, 2, 1)  # of the sources in code point order, repeating
    share: float = 1.5  # of all sizes
    most: float = 2.0  # times its size that a source is taken at most
    seed: int = 42


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of total by weight, none above most times its size; what exceeds that is shared by the others."""
    out, free, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while free:
        unit = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * unit > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        free = [i for i in free if i not in full]
    return out


def fill(length: np.ndarray, free: np.ndarray, left: int) -> np.ndarray:
    """How many of each length's free documents fill left best, by a bounded-knapsack programme, shortest first."""
    more, steps = np.zeros(len(length), np.int64), []
    reach, first = np.zeros(left + 1, bool), np.zeros(left + 1, np.int32)  # sums, and the step that first reached each
    reach[0] = True
    for i in np.argsort(-length, kind="stable")[::-1]:
        size = int(length[i])
        if not size or size > left:
            continue
        some, lot = min(int(free[i]), left // size), 1
        while some > 0 and not reach[left]:
            lot = min(lot, some)
            new = np.flatnonzero(reach[: left + 1 - lot * size] & ~reach[lot * size :]) + lot * size
            reach[new], first[new] = True, len(steps)
            steps.append((i, lot))
            some, lot = some - lot, lot * 2
        if reach[left]:
            break
    at = int(np.flatnonzero(reach)[-1])
    while at:
        i, lot = steps[first[at]]
        more[i] += lot
        at -= lot * int(length[i])
    return more


def subset_sum(length: np.ndarray, count: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take: at most count, together at most budget words and as near to it as can be.

    Where shares and the greedy part leave more than EXACT words or a gap, the programme gets as many words as four of
    the longest documents have, which the greedy part can't miss, first with the shares and then without.  Exact for
    budgets up to that.
    """
    none = np.zeros(len(length), np.int64)
    total = int((length * count).sum())
    if not total or budget <= 0:
        return none
    if budget >= total:
        return count.copy()
    shares = np.array([int(c) * budget // total for c in count], np.int64)  # Python's integers don't overflow
    shares[length == 0] = 0
    order = np.argsort(-length, kind="stable")
    wide = max(EXACT, 4 * int(length.max()))
    best, gap = none, budget
    for base, window in ((shares, EXACT), (shares, wide), (none, wide)):
        take = base.copy()
        left = budget - int((take * length).sum())
        for i in order:
            if left <= window:
                break
            if length[i]:
                more = min(int(count[i] - take[i]), (left - window // 2) // int(length[i]))
                if more > 0:
                    take[i] += more
                    left -= more * int(length[i])
        if left > window:  # only lengths above window // 2 remain; the wide window leaves none
            continue
        take += fill(length, count - take, left)
        left = budget - int((take * length).sum())
        if left < gap:
            best, gap = take, left
        if not gap:
            break
    return best


def mix(docs: DataFrame, m: Mix | None = None) -> DataFrame:
    """Per row of docs (doc_id, source, text): doc_id, size, source_size, target, copies, taken.

    copies is how often the mix takes the document, taken = copies * size.  A null text has size 0; a null source
    is a source of its own, the last in order; documents of no words are taken as often as their source is taken
    whole.  Rows that repeat a doc_id are documents of their own.  Equal inputs give equal results.  The driver
    gets one row per source.
    """
    m = m or Mix()
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    # The text is part of the hash: rows that share or lack a doc_id don't meet in one bucket.
    drawn = lambda seed: F.xxhash64(F.lit(seed), "doc_id", "text")
    about = docs.select("doc_id", "source", word_count().alias("size"), F.pmod(drawn(m.seed), F.lit(BUCKETS)).alias("bucket"), drawn(m.seed + 1).alias("draw"))
    about = scratch.save(about, "about")
    held = scratch.save(about.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "held")
    found = held.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size")).collect()
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["source_size"] for r in found]
    wanted = targets(sizes, [m.weights[i % len(m.weights)] for i in range(len(found))], m.share * sum(sizes), m.most)
    plan = []
    for r, target in zip(found, wanted, strict=True):
        whole = min(int(target // r["source_size"]), int(m.most)) if r["source_size"] else 0
        budget = round(target - whole * r["source_size"]) if whole < m.most else 0
        plan.append((r["source"], r["source_size"], float(target), whole, budget))
    plan = spark.createDataFrame(plan, "source string, source_size long, target double, whole int, budget long")
    same = lambda a, b, *keys: [a[k].eqNullSafe(b[k]) for k in keys]

    lengths = held.groupBy("source", "size").agg(F.sum("n").alias("n"))
    lengths = lengths.join(plan, same(lengths, plan, "source")).select(lengths["source"], "size", "n", "budget", "source_size", "target", "whole")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ignore_index=True)
        rows["take"] = subset_sum(rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), int(rows["budget"][0]))
        return rows[["source", "size", "take", "source_size", "target", "whole"]]

    quota = scratch.save(lengths.groupBy("source").applyInPandas(fit, "source string, size long, take long, source_size long, target double, whole int"), "quota")
    w = W.partitionBy("source", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    slots = held.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
    slots = slots.join(quota, same(slots, quota, "source", "size")).select(slots["source"], slots["size"], "bucket", "source_size", "target", "whole", F.least("n", F.greatest(F.col("take") - F.col("before"), F.lit(0))).alias("need"), "n")
    rows = about.join(slots, same(about, slots, "source", "size", "bucket")).select("doc_id", about["source"], about["size"], about["bucket"], "draw", "source_size", "target", "whole", "need", "n")
    # Only the one bucket of a length in which the quota ends needs an order among its rows.
    rank = F.row_number().over(W.partitionBy("source", "size", "bucket").orderBy("draw", "doc_id"))
    part = (F.col("need") > 0) & (F.col("need") < F.col("n"))
    some = rows.filter(part).withColumn("more", (rank <= F.col("need")).cast("int"))
    rest = rows.filter(~part).withColumn("more", (F.col("need") > 0).cast("int"))
    copies = F.col("whole") + F.col("more")
    return some.unionByName(rest).select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))
