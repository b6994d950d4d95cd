"""Files that the document pipeline reads and writes: JSON, JSON lines and CSV, in any store that Spark reads."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tableloom.functions.text import section_key, without_fences
from tableloom.operators.ledger import branch

SECTION = "section_id string, part string, number string, title string, page_ref string, start_page int, end_page int, is_leaf boolean"
CONTENTS = f"document struct<title string, pages int>, provenance struct<method string, warnings array<string>>, parts array<struct<part string, title string, start_page int, end_page int>>, sections array<struct<{SECTION}>>, all_sections array<struct<{SECTION}>>"
USAGE = "ts string, script string, label string, model string, image_used boolean, prompt_tokens bigint, output_tokens bigint, thinking_tokens bigint, total_tokens bigint, est_cost_usd double"
MANIFEST = "table_no int, table_id string, section_id string, section_title string, table_title string, start_page int, end_page int, pages string, n_pages int, layout string, dates string, needs_agent_review string"


def load_sections(spark: SparkSession, path: str) -> DataFrame:
    """Leaf sections of contents files, with their file, by start page, part and number."""
    rows = spark.read.schema(CONTENTS).json(path, multiLine=True).select(F.input_file_name().alias("file"), F.explode("sections").alias("s")).select("file", "s.*")
    part = F.when(F.col("part").isNull(), 0).otherwise(F.ascii("part") - 65)
    return rows.orderBy("file", "start_page", part, section_key(F.col("number")))


def load_index(spark: SparkSession, path: str) -> DataFrame:
    """Sheet index entries (section_id, sheet, title, start_page); the old key first_tab is read as sheet, no file as none."""
    schema = "section_id string, sheet string, first_tab string, title string, start_page int"
    try:
        rows = spark.read.schema(schema).json(path, multiLine=True)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], schema)
    return rows.select("section_id", F.coalesce("sheet", "first_tab").alias("sheet"), "title", "start_page")


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_raw(answers: DataFrame, path: str) -> None:
    """Raw answers (raw) as they came, a line each."""
    answers.select(F.col("raw").alias("value")).write.mode("overwrite").text(path)


def save_texts(files: DataFrame, folder: str) -> None:
    """Writes files (path, body) below a folder, through the store's own file system.

    Each task writes the files of its rows; a file that is written again is the same file.
    """
    from tableloom.sources.stores import put_text

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, body in zip(part["path"], part["body"], strict=True):
                put_text(f"{folder}/{path}", body)
            yield part[["path"]]

    files.mapInPandas(run, "path string").write.format("noop").mode("overwrite").save()


def with_grids(tables: DataFrame, grids: DataFrame) -> DataFrame:
    """Tables with the layout grid of their table_id (grids: table_id, grid), null where there is none."""
    return tables.join(grids.select("table_id", "grid"), "table_id", "left")


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A table manifest; its page list becomes an array."""
    rows = spark.read.schema(MANIFEST).option("header", True).csv(path)
    return rows.withColumn("pages", F.transform(F.split("pages", "[+]"), lambda x: x.try_cast("int")))


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Usage records of JSON lines; a bad line is a row with its text in corrupt."""
    return spark.read.schema(f"{USAGE}, corrupt string").option("columnNameOfCorruptRecord", "corrupt").json(path)


def load_meta(spark: SparkSession, path: str) -> DataFrame:
    """Audit records of units in any of the recorded shapes: usage nested, flat, or in two passes."""
    passes = "pass1 struct<usage struct<prompt_tokens bigint, output_tokens bigint, est_cost_usd double>>, pass2 struct<usage struct<prompt_tokens bigint, output_tokens bigint, est_cost_usd double>>"
    schema = f"unit_id string, document string, bank string, prompt_hash string, pages array<int>, partial boolean, n_tables int, n_rows int, usage struct<{USAGE}>, {USAGE}, validation struct<span_issues array<string>, number_issues array<string>, label_issues array<string>>, {passes}"
    rows = spark.read.schema(schema).json(path, multiLine=True).withColumn("file", F.input_file_name())
    total = lambda c: F.coalesce(f"usage.{c}", c, F.col(f"pass1.usage.{c}") + F.col(f"pass2.usage.{c}"))
    issues = lambda c: F.coalesce(F.size(f"validation.{c}"), F.lit(0))
    n = issues("span_issues") + issues("number_issues") + issues("label_issues")
    return rows.select("file", "unit_id", "document", "bank", "prompt_hash", "pages", F.coalesce("partial", F.lit(False)).alias("partial"), *(total(c).alias(c) for c in ("prompt_tokens", "output_tokens", "est_cost_usd")), n.alias("n_issues"))


def approved_contracts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("type string, status string, template string").json(path, multiLine=True).filter("status = 'approved'")


def load_slides(spark: SparkSession, folder: str) -> DataFrame:
    """Slides of an audit folder: points, meta and types of each slide joined; those of no type or without points are left out.

    A slide without a title has its number for one; branch tells how it was read.  A slide may lack its meta file.
    """
    at = F.regexp_extract(F.input_file_name(), r"([^/]+/[^/]+)/[^/]+$", 1).alias("slide")

    def part(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).json(f"{folder}/*/*/{name}.json", multiLine=True).select(at, "*")

    meta = part("meta", "cost_usd double, n_points int, validation_errors array<string>, usages array<struct<pass string>>")
    types = spark.read.text(f"{folder}/*/*/element_types.json", wholetext=True).select(at, F.from_json("value", "array<string>").alias("types"))
    points = part("datapoints", "slide_title string, element_idx int, series string, period string, value string")
    points = points.groupBy("slide").agg(F.count("*").cast("int").alias("points"), F.max("slide_title").alias("title"))
    rows = points.join(types, "slide").filter(F.exists("types", lambda x: x != "none")).join(meta, "slide", "left")
    number = F.regexp_extract("slide", r"slide_([0-9]+)$", 1).try_cast("int")
    rows = rows.withColumn("num", number).withColumn("title", F.coalesce(F.nullif("title", F.lit("")), F.concat(F.lit("Slide "), number)))
    return rows.withColumn("branch", branch(F.transform("usages", lambda u: u["pass"]))).withColumn("n_points", F.coalesce("n_points", "points")).withColumn("cost_usd", F.coalesce("cost_usd", F.lit(0.0))).drop("usages")


def run_summaries(spark: SparkSession, path: str, workbooks: DataFrame) -> DataFrame:
    """Run summaries by time, and a placeholder for each workbook (name) without one."""
    rows = spark.read.schema("name string, generated_at string, slides int, cost double").json(path, multiLine=True)
    return rows.unionByName(workbooks.select("name").join(rows, "name", "left_anti"), allowMissingColumns=True).orderBy("generated_at", "name")


def last_per_slug(paths: DataFrame) -> DataFrame:
    """The last audit folder of each bank."""
    return paths.groupBy("slug").agg(F.max("path").alias("path"))


def file_base64(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.base64("content").alias("base64"))


def first_json(rows: DataFrame, column: str = "raw") -> DataFrame:
    """rows with json: the first complete JSON value of a text, whatever follows it; null if there is none.

    Where a value ends depends on its nesting, which no pattern can follow.
    """
    def first(text: str | None) -> str | None:
        try:
            return json.dumps(json.JSONDecoder().raw_decode(text)[0], ensure_ascii=False) if text else None
        except ValueError:
            return None

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(first)

    salvage = F.pandas_udf(run, "string")
    return rows.withColumn("json", salvage(without_fences(F.col(column))))


def unwrap(tables: DataFrame, date: str, column: str = "tables", by: str = "reporting_date") -> DataFrame:
    """The one of several answers whose date contains the text, else the first."""
    fit = F.filter(column, lambda t: F.contains(t[by], F.lit(date)))
    return tables.withColumn("table", F.coalesce(F.get(fit, F.lit(0)), F.get(column, F.lit(0))))


def grid_words(cells: DataFrame) -> DataFrame:
    """Column extents of page grids (page, grid, top, col, l, r): left-most to right-most, grids from the top down."""
    cols = cells.groupBy("page", "grid", "col").agg(F.min("l").alias("x_left"), F.max("r").alias("x_right"))
    order = cells.groupBy("page", "grid").agg(F.max("top").alias("top"))
    from pyspark.sql import Window as W

    return cols.join(order.withColumn("grid_no", F.row_number().over(W.partitionBy("page").orderBy(F.desc("top"), "grid"))), ["page", "grid"])
