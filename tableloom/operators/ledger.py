"""Costs of calls, running totals, summaries and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tableloom.scratch import Scratch

RANGES = 64  # parts of a running sum


def call_cost(prompt: Column, output: Column, thinking: Column, price_in: float, price_out: float) -> Column:
    """Dollars of a call, prices per million tokens; thinking is charged as output."""
    return F.round((prompt * price_in + (output + thinking) * price_out) / 1e6, 6)


def prompt_tokens(total: Column, output: Column, thinking: Column) -> Column:
    """The prompt's tokens where only the total is told."""
    return F.greatest(total - output - thinking, F.lit(0))


def running_ledger(calls: DataFrame, order: list[str], cost: str, keys: list[str] | None = None) -> DataFrame:
    """calls with their number n and cumulative cost.

    Without keys a ledger is one sequence.  Its running sums come from the sums of range partitions of the order,
    so that no task gets all calls; with keys each key is a sequence.
    """
    if keys:
        w = W.partitionBy(*keys).orderBy(*order)
        return calls.withColumn("n", F.row_number().over(w)).withColumn("cumulative", F.sum(cost).over(w.rowsBetween(W.unboundedPreceding, 0)))
    # Written once: where a row's range ends may differ when its partition is made again.
    calls = Scratch(calls.sparkSession, "ledger").save(calls.repartitionByRange(RANGES, *order).withColumn("_p", F.spark_partition_id()), "dealt")
    dealt = calls
    own = W.partitionBy("_p").orderBy(*order)
    rows = dealt.withColumn("_n", F.row_number().over(own)).withColumn("_c", F.sum(cost).over(own.rowsBetween(W.unboundedPreceding, 0)))
    sums = rows.groupBy("_p").agg(F.count("*").alias("_k"), F.sum(cost).alias("_s"))  # a row per partition
    before = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("_p", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_k"), F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_s"))
    return rows.join(sums, "_p").withColumn("n", F.col("_n") + F.col("_k")).withColumn("cumulative", F.col("_c") + F.col("_s")).drop("_p", "_n", "_c", "_k", "_s")


def append_calls(ledger: DataFrame, new: DataFrame, order: list[str], cost: str) -> DataFrame:
    """The ledger with new calls numbered and summed on from its last row."""
    last = ledger.agg(F.coalesce(F.max("n"), F.lit(0)).alias("_n"), F.coalesce(F.max_by("cumulative", "n"), F.lit(0.0)).alias("_c"))
    rows = running_ledger(new, order, cost).crossJoin(F.broadcast(last))  # one row
    return ledger.unionByName(rows.withColumn("n", F.col("n") + F.col("_n")).withColumn("cumulative", F.col("cumulative") + F.col("_c")).drop("_n", "_c"), allowMissingColumns=True)


def with_total(rows: DataFrame, key: str, sums: list[str], total: str = "TOTAL") -> DataFrame:
    """Sums by key and a row of the whole."""
    out = rows.rollup(key).agg(*(F.sum(c).alias(c) for c in sums), F.count("*").alias("n"), F.grouping(key).alias("_g"))
    return out.withColumn(key, F.when(F.col("_g") == 1, total).otherwise(F.col(key))).drop("_g")


def unit_usage(chunks: DataFrame, key: str, fields: list[str]) -> DataFrame:
    return chunks.groupBy(key).agg(*(F.sum(c).alias(c) for c in fields))


def describe_call(label: Column, bank: Column, image: Column) -> Column:
    """What a call was doing, from its label: a section's numbers, its pages as p7 or p47-48, multi, and a chunk as _c1.

    bank and image add whose document it was and whether pictures were sent.
    """
    parts = F.split(label, "_")
    pages = F.coalesce(F.get(F.filter(parts, lambda x: x.startswith("p") & x.rlike("[0-9]")), F.lit(0)), F.lit(""))
    own = F.filter(parts, lambda x: ~x.startswith("p") & (x != F.regexp_replace(pages, "^p+", "")))
    chunk = F.regexp_extract(label, "_c([1-5])$", 1)
    section = F.array_join(F.when(chunk != "", F.slice(own, 1, F.greatest(F.size(own) - 1, F.lit(0)))).otherwise(own), ".")
    section = F.regexp_replace(section, r"^[._]+|[._]+$", "")
    tail = [F.when(label.contains("multi"), " (shared page — multiple sections)").otherwise(""), F.when(chunk != "", F.concat(F.lit(" chunk "), chunk)).otherwise(""), F.when(image, " +image").otherwise("")]
    return F.trim(F.concat(bank, F.lit(" §"), section, F.lit(" "), pages, *tail))


def unique_names(rows: DataFrame, base: str, order: list, keys: list[str], width: int = 31) -> DataFrame:
    """rows with name: base, or base shortened for a suffix ' (k)' where an earlier row has that name.

    A suffix may meet a name that is itself suffixed, so names are counted again until all differ.
    """
    scratch, n = Scratch(rows.sparkSession, "names"), 0
    rows = rows.withColumn("name", F.substring(base, 1, width)).withColumn("_k", F.lit(1))
    while True:
        w = W.partitionBy(*keys, F.col("name")).orderBy("_k", *order)
        rows = rows.withColumn("_d", F.row_number().over(w))
        # A row that repeats a name takes the next free number of its base.
        again = F.when(F.col("_d") > 1, F.greatest(F.col("_k"), F.lit(1)) + F.col("_d") - 1).otherwise(F.col("_k"))
        rows = rows.withColumn("_k", again)
        suffix = F.when(F.col("_k") > 1, F.concat(F.lit(" ("), F.col("_k").cast("string"), F.lit(")"))).otherwise("")
        rows = rows.withColumn("name", F.concat(F.substr(F.col(base), F.lit(1), F.lit(width) - F.length(suffix)), suffix))
        rows, n = scratch.save(rows, f"round-{n}"), n + 1
        if rows.groupBy(*keys, "name").count().filter("count > 1").isEmpty():
            return rows.drop("_k", "_d")


def cost_summary(calls: DataFrame, keys: list[str]) -> DataFrame:
    """A run's cost summary (keys, summary) as JSON: totals, then its calls in order of n."""
    total = lambda c: F.sum(F.coalesce(c, F.lit(0)))
    every = F.array_sort(F.collect_list(F.struct("n", "label", "prompt_tokens", "output_tokens", "thinking_tokens", "est_cost_usd")))
    tokens = total("prompt_tokens") + total("output_tokens") + total("thinking_tokens")
    totals = F.struct(F.count("*").alias("calls"), total("prompt_tokens").alias("input_tokens"), total("output_tokens").alias("output_tokens"), total("thinking_tokens").alias("thinking_tokens"), tokens.alias("total_tokens"), F.round(total("est_cost_usd"), 5).alias("est_cost_usd"))
    return calls.groupBy(*keys).agg(F.to_json(F.struct(totals.alias("totals"), every.alias("calls"))).alias("summary"))


def sheet_order(name: str) -> list[Column]:
    """Contents first, cost last, parts by letter, sections by number, tables by theirs."""
    c = F.col(name)
    rank = F.when(c == "Contents", 0).when(c.startswith("Cost"), 2).otherwise(1)
    number = F.transform(F.regexp_extract_all(c, F.lit("([0-9]+)"), F.lit(1)), lambda x: x.try_cast("int"))
    return [rank, F.regexp_extract(c, "^([A-Z])[.]", 1), number, c]


def branch(passes: Column) -> Column:
    """How a slide was read, from the names of its calls' passes."""
    return F.when(F.array_contains(passes, "1s"), "single-pass").when(F.size(F.coalesce(passes, F.array().cast("array<string>"))) > 0, "multi-pass").otherwise("resumed")


def bank_results(slides: DataFrame, runs: DataFrame) -> DataFrame:
    """Per bank of slides (bank, n_points, cost_usd): their number, points and cost, and how long its last run (bank, elapsed, generated_at) took."""
    last = runs.groupBy(F.upper("bank").alias("bank")).agg(F.max_by("elapsed", "generated_at").alias("elapsed"))
    rows = slides.groupBy("bank").agg(F.count("*").alias("slides"), F.sum("n_points").alias("points"), F.round(F.sum("cost_usd"), 4).alias("cost"))
    return rows.join(last, "bank", "left").withColumn("elapsed", F.coalesce("elapsed", F.lit("—")))


def run_panel(runs: DataFrame) -> DataFrame:
    """Runs as a panel lists them: gaps as dashes or zeros, the time to the minute, oldest first."""
    dash = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("—")).alias(c)
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    date = F.replace(F.substring(F.coalesce("generated_at", F.lit("")), 1, 16), F.lit("T"), F.lit(" "))
    return runs.orderBy(F.coalesce("generated_at", F.lit(""))).select(dash("bank"), dash("document"), dash("slides"), dash("calls"), zero("input_tokens"), zero("output_tokens"), F.round(F.coalesce("cost", F.lit(0.0)), 4).alias("cost"), dash("elapsed"), date.alias("date"))


def unreconciled(tables: DataFrame, keys: list[str]) -> DataFrame:
    """How many tables (keys, table_id, totals_reconcile) were read, how many don't reconcile, and the first five of those."""
    off = F.lower(F.coalesce("totals_reconcile", F.lit(""))) == "false"
    return tables.groupBy(*keys).agg(F.count("*").alias("tables"), F.count_if(off).alias("flagged"), F.array_join(F.slice(F.array_sort(F.collect_list(F.when(off, F.col("table_id")))), 1, 5), ", ").alias("first"))


def top_types(rows: DataFrame, what: str, n: int = 4) -> DataFrame:
    """The n most frequent values, ties by value."""
    return rows.groupBy(what).agg(F.count("*").alias("n")).orderBy(F.desc("n"), what).limit(n)


def hero(slides: DataFrame) -> DataFrame:
    """Totals over slides (bank, n_points, cost_usd)."""
    return slides.agg(F.count("*").alias("slides"), F.count_distinct("bank").alias("banks"), F.sum("n_points").alias("points"), F.sum("cost_usd").alias("cost"))
