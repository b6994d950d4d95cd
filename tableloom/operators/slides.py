"""Slides as sheet cells: data points laid out by element, in long form (one row per cell)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tableloom.functions import text as T, values as V
from tableloom.operators import points as P
from tableloom.operators.sections import keep_first

# Element types that aren't shown, and those with a layout of their own.
SKIPPED = ["other", "none"]
BRIDGES = ["waterfall"]
KPIS = ["kpi_grid"]


def with_shape(points: DataFrame, keys: list[str]) -> DataFrame:
    """Points (keys, element_type, period, value, ...) with the shape of their element: bridge, kpi or pivot; skipped ones go.

    A KPI's points without a period whose value stands under a period go too; KPIs of several periods are pivots.
    """
    rows = points.filter(~F.col("element_type").isin(SKIPPED))
    dated = rows.filter(F.col("element_type").isin(KPIS) & (F.coalesce("period", F.lit("")) != ""))
    seen = dated.select(*keys, "value").distinct().withColumn("_seen", F.lit(True))
    several = dated.groupBy(*keys).agg((F.count_distinct("period") > 1).alias("_several"))
    rows = rows.join(seen, [*keys, "value"], "left").join(several, keys, "left")
    repeated = F.col("element_type").isin(KPIS) & (F.coalesce("period", F.lit("")) == "") & F.col("_seen").isNotNull()
    shape = F.when(F.col("element_type").isin(BRIDGES), "bridge").when(F.col("element_type").isin(KPIS) & ~F.coalesce("_several", F.lit(False)), "kpi").otherwise("pivot")
    return rows.filter(~repeated).withColumn("shape", shape).drop("_seen", "_several")


def extra_columns(points: DataFrame, keys: list[str]) -> DataFrame:
    """The extra fields (keys, period, name, at, is_period, header): each period's, in order of appearance."""
    rows = points.select(*keys, "period", "order", "extra_fields", F.posexplode(F.map_keys("extra_fields")).alias("i", "name"))
    label = F.nullif(rows["extra_fields"][F.concat("name", F.lit("_label"))], F.lit(""))
    rows = rows.filter(~F.col("name").endswith("_label") & ~F.col("name").isin(P.META_KEYS)).withColumn("label", label)
    known = F.create_map(*(F.lit(x) for kv in T.FRIENDLY.items() for x in kv))
    at = F.struct("order", "i")
    heads = rows.groupBy(*keys, "name").agg(F.min_by("label", F.when(F.col("label").isNotNull(), at)).alias("label"))
    firsts = rows.groupBy(*keys, "period", "name").agg(F.min(at).alias("at"))
    out = firsts.join(heads, [*keys, "name"]).withColumn("is_period", T.is_period(F.col("name")))
    return out.withColumn("header", F.coalesce("label", known[F.col("name")], T.auto_label(F.col("name")))).drop("label")


def pivot_columns(points: DataFrame, keys: list[str]) -> DataFrame:
    """The columns of a pivot (keys, col, kind, period, name, header): label, every period with its extras, promoted fields.

    Extra fields that are named like periods are columns of their own at the end, for the whole element.
    """
    periods = points.groupBy(*keys, "period").agg(F.min("order").alias("_o"), F.min("unit").alias("unit"))
    value = periods.select(*keys, "_o", "period", F.lit(None).cast("string").alias("name"), F.lit(1).alias("_rank"), F.lit(None).cast("struct<order:bigint,i:int>").alias("_at"), F.lit("value").alias("kind"), F.coalesce("period", F.nullif("unit", F.lit("")), F.lit("Value")).alias("header"))
    extras = extra_columns(points, keys)
    at = lambda c: F.struct(F.col(f"{c}.order").cast("bigint").alias("order"), F.col(f"{c}.i").alias("i")).alias("_at")
    own = extras.filter("not is_period").join(periods.select(*keys, "_o", F.col("period").alias("_p")), keys).filter(F.col("period").eqNullSafe(F.col("_p")))
    own = own.select(*keys, "_o", "period", "name", F.lit(2).alias("_rank"), at("at"), F.lit("extra").alias("kind"), "header")
    promoted = extras.filter("is_period").groupBy(*keys, "name").agg(F.min("at").alias("at"))
    promoted = promoted.select(*keys, F.lit(None).cast("bigint").alias("_o"), F.lit(None).cast("string").alias("period"), "name", F.lit(3).alias("_rank"), at("at"), F.lit("promoted").alias("kind"), F.col("name").alias("header"))
    every = value.withColumn("_o", F.col("_o").cast("bigint")).unionByName(own.withColumn("_o", F.col("_o").cast("bigint"))).unionByName(promoted)
    order = W.partitionBy(*keys).orderBy(F.col("_rank") == 3, "_o", "period", "_rank", "_at", "name")
    every = every.withColumn("col", F.row_number().over(order) + 1).select(*keys, "col", "kind", "period", "name", "header")
    head = points.groupBy(*keys).agg(F.min("unit").alias("unit"))
    label = head.select(*keys, F.lit(1).alias("col"), F.lit("label").alias("kind"), F.lit(None).cast("string").alias("period"), F.lit(None).cast("string").alias("name"), F.when(F.coalesce("unit", F.lit("")) != "", F.concat(F.lit("("), "unit", F.lit(")"))).otherwise("").alias("header"))
    return label.unionByName(every)


def pivot_cells(points: DataFrame, keys: list[str]) -> DataFrame:
    """A pivot's cells (keys, row from 1, col, header, text): the first point of a series and period fills its cells."""
    columns = pivot_columns(points, keys)
    series = P.first_order(points, keys, "series")
    level = points.groupBy(*keys, "series").agg(F.min_by("level", "order").alias("level"))
    rows = series.join(level, [*keys, "series"])
    cells = keep_first(points, [*keys, "series", "period"], ["order"]).select(*keys, "series", F.col("period").alias("_p"), "value", "extra_fields")
    first = points.groupBy(*keys).agg(F.min_by(F.struct(F.col("period").alias("p")), "order").alias("_first"))
    grid = rows.join(columns, keys).join(first, keys).withColumn("_of", F.when(F.col("kind") == "promoted", F.col("_first.p")).otherwise(F.col("period")))
    same = [grid[k] == cells[k] for k in [*keys, "series"]] + [grid["_of"].eqNullSafe(cells["_p"]), grid["kind"] != "label"]
    joined = grid.join(cells, same, "left")
    indent = F.concat(F.repeat(F.lit(" "), 4 * F.greatest(F.col("level") - 1, F.lit(0))), grid["series"])
    text = F.when(grid["kind"] == "label", indent).when(grid["kind"] == "value", F.coalesce("value", F.lit(""))).otherwise(F.coalesce(F.col("extra_fields")[grid["name"]], F.lit("")))
    return joined.select(*(grid[k] for k in keys), grid["n"].alias("row"), grid["col"], grid["header"], text.alias("text"))


def bridge_cells(points: DataFrame, keys: list[str]) -> DataFrame:
    """A bridge's cells (keys, row, col, header, text): label, signed amount, extra fields; repeated rows once."""
    rows = keep_first(points, [*keys, "series", "row_type"], ["order"]).withColumn("row", F.row_number().over(W.partitionBy(*keys).orderBy("order")))
    number = V.point_number(F.col("value"))
    signed = F.when(F.col("row_type") == "bridge", F.when(F.col("sign") == "+", F.abs(number)).when(F.col("sign") == "-", -F.abs(number)))
    amount = F.when(signed.isNotNull(), F.format_string("%+.0f", signed)).otherwise(F.col("value"))
    unit = F.coalesce(F.nullif("unit", F.lit("")), F.lit("S$m"))
    label = rows.select(*keys, "row", F.lit(1).alias("col"), F.concat(F.lit("("), unit, F.lit(")")).alias("header"), F.concat(F.when(F.col("row_type") == "bridge", "    ").otherwise(""), "series").alias("text"))
    value = rows.select(*keys, "row", F.lit(2).alias("col"), F.lit("S$m").alias("header"), amount.alias("text"))
    extras = extra_columns(points, keys).groupBy(*keys, "name").agg(F.min("at").alias("at"), F.min("header").alias("header"))
    extras = extras.withColumn("col", F.row_number().over(W.partitionBy(*keys).orderBy("at")) + 2)
    more = rows.join(extras, keys).select(*keys, "row", "col", "header", F.coalesce(F.col("extra_fields")[F.col("name")], F.lit("")).alias("text"))
    return label.unionByName(value).unionByName(more)


def kpi_cells(points: DataFrame, keys: list[str]) -> DataFrame:
    """A KPI list's cells: metric and value, the first of each series."""
    rows = keep_first(points, [*keys, "series"], ["order"]).withColumn("row", F.row_number().over(W.partitionBy(*keys).orderBy("order")))
    cell = lambda col, header, text: rows.select(*keys, "row", F.lit(col).alias("col"), F.lit(header).alias("header"), F.col(text).alias("text"))
    return cell(1, "Metric", "series").unionByName(cell(2, "Value", "value"))


def element_cells(points: DataFrame, keys: list[str]) -> DataFrame:
    """Every element's cells by its shape; keys end with the element's index, by which a slide's elements are stacked."""
    rows = with_shape(points, keys)
    shaped = lambda s: rows.filter(F.col("shape") == s).drop("shape")
    return pivot_cells(shaped("pivot"), keys).unionByName(bridge_cells(shaped("bridge"), keys)).unionByName(kpi_cells(shaped("kpi"), keys))


def stacked(cells: DataFrame, slide: list[str], element: str) -> DataFrame:
    """Cells of elements placed below each other: sheet_row from 4 on, two rows of heads and one free row for each."""
    heights = cells.groupBy(*slide, element).agg((F.max("row") + 3).alias("_h"))
    before = W.partitionBy(*slide).orderBy(element).rowsBetween(W.unboundedPreceding, -1)
    starts = heights.select(*slide, element, (F.lit(4) + F.coalesce(F.sum("_h").over(before), F.lit(0))).alias("_from"))
    return cells.join(starts, [*slide, element]).withColumn("sheet_row", (F.col("_from") + 1 + F.col("row")).cast("int")).drop("_from")


def width(points: DataFrame, keys: list[str], slide: list[str]) -> DataFrame:
    """How many columns the widest element of a slide has, four at least: (slide, n_cols)."""
    shown = points.filter(~F.col("element_type").isin(SKIPPED))
    kind = shown.groupBy(*keys).agg(F.min_by("element_type", "order").alias("kind"))
    extras = extra_columns(shown, keys)
    overall = extras.groupBy(*keys).agg(F.count_distinct("name").alias("all"), F.count_distinct(F.when(F.col("is_period"), F.col("name"))).alias("promoted"), F.count_if(~F.col("is_period")).alias("own"))
    periods = shown.select(*keys, "period").distinct().groupBy(*keys).agg(F.count("*").alias("periods"))
    rows = kind.join(periods, keys).join(overall, keys, "left").fillna(0, ["all", "promoted", "own"])
    n = F.when(F.col("kind").isin(BRIDGES), 2 + F.col("all")).when(F.col("kind").isin(KPIS), 2).otherwise(1 + F.col("periods") + F.col("own") + F.col("promoted"))
    return rows.groupBy(*slide).agg(F.greatest(F.lit(4), F.max(n)).cast("int").alias("n_cols"))
