"""Data points of slides: one row per printed value, and the shapes in which they are shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tableloom.functions import text as T, values as V
from tableloom.operators.sections import keep_first

# Fixed values.
ROW_TYPE_ALIASES = {"header": "section_header", "sub_header": "sub", "opening": "start", "closing": "end", "component": "bridge", "commentary": "note", "footnote": "note"}
KNOWN = ["series", "period", "value", "row_type", "level", "parent", "group", "sign", "order"]
VISUAL = ["waterfall", "stacked_bar", "stacked_bar_with_overlay", "trend_line", "kpi_grid", "pie", "donut_dual_ring"]
KNOWN_TYPES = ["text_table", *VISUAL, "npa_movement_table", "none"]
META_KEYS = ["overlay_series"]

SLIDE = "slide_title string, elements array<struct<element_idx int, element_type string, element_title string, source string, units string, self_check string, data_points array<string>>>"


def parse_points(raw: DataFrame) -> DataFrame:
    """raw(slide, bank, doc_title, raw) as data points.

    Role aliases get their names; order and level default to the position and 1; nested extra fields are lifted
    and other objects dropped; every extra field gets a label; status and number follow the printed token.
    """
    rows = raw.withColumn("s", F.from_json(T.without_fences(F.col("raw")), SLIDE))
    rows = rows.select("slide", "bank", "doc_title", F.coalesce("s.slide_title", F.lit("")).alias("slide_title"), F.explode("s.elements").alias("e"))
    rows = rows.select("*", F.posexplode("e.data_points").alias("i", "p"))
    fields = F.from_json("p", "map<string,string>")
    rows = rows.withColumn("f", fields).withColumn("nested", F.from_json(F.col("f")["extra_fields"], "map<string,string>"))
    known = F.array(*map(F.lit, [*KNOWN, "extra_fields", "extra_fields_label"]))
    extra = F.map_filter("f", lambda k, v: ~F.array_contains(known, k) & ~F.coalesce(v.startswith("{"), F.lit(False)))
    lifted = F.coalesce(F.map_filter("nested", lambda k, v: ~F.coalesce(v.startswith("{"), F.lit(False))), F.create_map().cast("map<string,string>"))
    extra = F.map_zip_with(extra, lifted, lambda k, a, b: F.coalesce(b, a))
    bare = F.filter(F.map_keys("x"), lambda k: ~F.endswith(k, F.lit("_label")) & ~F.array_contains(F.map_keys("x"), F.concat(k, F.lit("_label"))))
    labels = F.map_from_arrays(F.transform(bare, lambda k: F.concat(k, F.lit("_label"))), F.transform(bare, T.auto_label))
    rows = rows.withColumn("x", extra).withColumn("x", F.map_concat("x", labels))
    alias = F.create_map(*(F.lit(v) for kv in ROW_TYPE_ALIASES.items() for v in kv))
    f = F.col("f")
    role = F.coalesce(f["row_type"], F.lit("data"))
    rows = rows.withColumn("row_type", F.coalesce(alias[role], role)).withColumn("value", F.coalesce(f["value"], F.lit("")))
    rows = rows.withColumn("status", V.status(F.col("value"), F.col("row_type"), F.coalesce(f["suppressed"] == "true", F.lit(False))))
    series, source = F.coalesce(f["series"], F.lit("")), F.coalesce("e.source", F.lit("table"))
    ref = F.concat("doc_title", F.lit("#slide"), "slide", F.lit(":elem"), "e.element_idx", F.lit(":"), series, F.when(F.coalesce(f["period"], F.lit("")) != "", F.concat(F.lit(":"), f["period"])).otherwise(""))
    return rows.select(
        "slide", "slide_title", "bank", "doc_title",
        F.col("e.element_idx").alias("element_idx"), F.coalesce("e.element_type", F.lit("other")).alias("element_type"), F.coalesce("e.element_title", F.lit("")).alias("element_title"), source.alias("source"), F.coalesce("e.units", F.lit("")).alias("unit"),
        series.alias("series"), f["period"].alias("period"), "value", V.status_number(F.col("value"), F.col("status")).alias("value_num"), "row_type",
        F.coalesce(f["level"].try_cast("int"), F.lit(1)).alias("level"), f["parent"].alias("parent"), f["group"].alias("group"), f["sign"].alias("sign"), F.coalesce(f["order"].try_cast("int"), F.col("i")).alias("order"),
        "status", ref.alias("source_ref"), F.when(source == "chart", "gemini-vision").otherwise("gemini-text").alias("extracted_by"), F.col("x").alias("extra_fields"),
    )


def route(types: Column) -> Column:
    """skip, single or multi: how a slide of these element types is read."""
    return F.when(F.array_contains(types, "none"), "skip").when(F.arrays_overlap(types, F.array(*map(F.lit, VISUAL))), "single").otherwise("multi")


def split_known(types: Column, known: list[str]) -> Column:
    """struct(known, unknown) of element types; none is neither."""
    k = F.array(*map(F.lit, known))
    return F.struct(F.array_intersect(types, k).alias("known"), F.array_except(F.array_except(types, k), F.array(F.lit("none"))).alias("unknown"))


def derived_contracts(registry: DataFrame, found: DataFrame) -> DataFrame:
    """The registry (type, status) with types that it lacks, pending review."""
    new = found.select("type").distinct().join(registry, "type", "left_anti").withColumn("status", F.lit("pending_review"))
    return registry.select("type", "status").unionByName(new)


def first_order(points: DataFrame, keys: list[str], what: str) -> DataFrame:
    """The distinct values of what, by their first order: (keys, what, n from 1)."""
    firsts = points.groupBy(*keys, what).agg(F.min("order").alias("_o"))
    return firsts.withColumn("n", F.row_number().over(W.partitionBy(*keys).orderBy("_o", what))).drop("_o")


def extra_keys(points: DataFrame, keys: list[str], periods: bool = True) -> DataFrame:
    """The extra fields' names that aren't labels or meta data, by first appearance; without periods, none named like one.

    keys of an element give its fields as a whole, keys with the period those of one period, which leave out periods.
    """
    rows = points.select(*keys, "order", F.posexplode(F.map_keys("extra_fields")).alias("i", "name"))
    rows = rows.filter(~F.col("name").endswith("_label") & ~F.col("name").isin(META_KEYS))
    rows = rows if periods else rows.filter(~T.is_period(F.col("name")))
    firsts = rows.groupBy(*keys, "name").agg(F.min(F.struct("order", "i")).alias("_o"))
    return firsts.withColumn("n", F.row_number().over(W.partitionBy(*keys).orderBy("_o", "name"))).drop("_o")


def pivot(points: DataFrame, keys: list[str], periods: list[str]) -> DataFrame:
    """Series by period: the first point of each cell, series in their first order."""
    cells = keep_first(points, [*keys, "series", "period"], ["order", "value"])
    wide = cells.groupBy(*keys, "series").pivot("period", periods).agg(F.first("value"))
    return wide.join(first_order(points, keys, "series"), [*keys, "series"])


def period_list(points: DataFrame) -> list[str]:
    """The periods to pivot by, in their first order; they are as many as a slide has columns."""
    return [r["period"] for r in first_order(points, [], "period").filter("period is not null").orderBy("n").collect()]


def kpis(points: DataFrame, keys: list[str]) -> DataFrame:
    """One value per series, the first; points without a period go where their value stands under one."""
    dated = points.filter("period is not null").select(*keys, "series", "value").distinct()
    rest = points.filter("period is null").join(dated, [*keys, "series", "value"], "left_anti")
    return keep_first(points.filter("period is not null").unionByName(rest), [*keys, "series"], ["order", "value"])


def needs_check(source: Column, value: Column) -> Column:
    """Whether a shown value comes from a picture or wasn't found in the text."""
    return source.isin("chart", "unverified") & ~F.coalesce(value, F.lit("")).isin("", "-", "?")
