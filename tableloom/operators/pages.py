"""Pages and sheets as work: which are read, how they are cut, which sheets stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tableloom.functions import text as T

# Words that tell tables from narrative in section titles, what opens a contents page, sheets that stay.
TABLE_WORDS = (
    "(?i)METRICS|RATIO|RWA|RISK.WEIGHTED|FLOW STATEMENT|LCR|LEVERAGE|OVERVIEW|AVERAGE|COMPARISON|CREDIT RISK|COUNTERPARTY|SECURITI|"
    "MARKET RISK|CVA|OPERATIONAL|IRRBB|NSFR|BACKTESTING|COLLATERAL|EXPOSURE|CAPITAL|COMPOSITION|LINKAGE|PRUDENT|G.SIB|ASSET ENCUMB|"
    "QUANTITATIVE|DISCLOSURES|LOSSES|INDICATOR|MINIMUM"
)
NARRATIVE_WORDS = r"(?i)^(INTRODUCTION|SCOPE|ABBREVIATION|ATTESTATION|QUALITATIVE\s+DISC)"
CONTENTS = "(?i)content"
LASTING_SHEETS = ["Contents", "Cost"]


def page_text(pages: DataFrame, keys: list[str], marked: bool = False) -> DataFrame:
    """One text per key of pages (keys, page_no, text) in page order; marked puts a [PAGE n] line before each."""
    body = F.concat(F.lit("[PAGE "), F.col("page_no").cast("string"), F.lit("]\n"), F.col("text")) if marked else F.col("text")
    ordered = F.array_sort(F.collect_list(F.struct("page_no", body.alias("body"))))
    return pages.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["body"]), "\n").alias("text"))


def wanted(pages: DataFrame, units: DataFrame, keys: list[str]) -> DataFrame:
    """Pages (keys, page_no) of each unit (keys, unit_id, pages array): the projection that is sent on."""
    return units.select(*keys, "unit_id", F.explode("pages").alias("page_no")).join(pages, [*keys, "page_no"])


def needed_once(units: DataFrame, keys: list[str]) -> DataFrame:
    """Every page that some unit needs, once."""
    return units.select(*keys, F.explode("pages").alias("page_no")).distinct()


def has_table_rules(edges: DataFrame, pages: DataFrame, least: int = 5, share: float = 0.1) -> DataFrame:
    """Pages (doc_id, page_no) with ruled: enough horizontal edges of some width; true where no edges are known."""
    wide = (F.col("orientation") == "h") & (F.col("x1") - F.col("x0") > share * F.col("page_width"))
    counts = edges.groupBy("doc_id", "page_no").agg((F.count_if(wide) >= least).alias("ruled"))
    return pages.select("doc_id", "page_no").join(counts, ["doc_id", "page_no"], "left").withColumn("ruled", F.coalesce("ruled", F.lit(True)))


def contents_start(pages: DataFrame, first: int = 8) -> DataFrame:
    """The first of a document's first pages that says contents, else its second page."""
    hit = F.min(F.when(F.col("text").rlike(CONTENTS) & (F.col("page_no") <= first), F.col("page_no")))
    return pages.groupBy("doc_id").agg(F.coalesce(hit, F.lit(2)).alias("page_no"))


def legacy_contents_start(pages: DataFrame, first: int = 6) -> DataFrame:
    """The first of a document's first pages that says contents and a part or page, else its second page."""
    said = F.upper("text")
    hit = F.contains(said, F.lit("CONTENT")) & (F.contains(said, F.lit("PART A")) | F.contains(said, F.lit("PART B")) | F.contains(said, F.lit("PAGE")))
    return pages.groupBy("doc_id").agg(F.coalesce(F.min(F.when(hit & (F.col("page_no") <= first), F.col("page_no"))), F.lit(2)).alias("page_no"))


def contents_pages(pages: DataFrame, starts: DataFrame, span: int = 8, least: int = 2) -> DataFrame:
    """Contents pages: from the start as long as a page has dot-leader lines."""
    leaders = F.size(F.filter(T.lines(F.col("text")), lambda x: x.rlike("[.…]{4,}")))
    rows = pages.join(starts.withColumnRenamed("page_no", "start"), "doc_id").filter(F.col("page_no").between(F.col("start"), F.col("start") + span - 1))
    rows = rows.withColumn("bad", ((F.col("page_no") > F.col("start")) & (leaders < least)).cast("int"))
    seen = F.sum("bad").over(W.partitionBy("doc_id").orderBy("page_no"))
    return rows.withColumn("seen", seen).filter("seen = 0").drop("bad", "seen", "start")


def section_lines(text: Column) -> Column:
    """How many lines of a page are numbered as sections are."""
    return F.size(F.filter(T.lines(text), lambda x: x.rlike(r"^[0-9]+(?:[.][0-9]+)*[.]?\s+\S")))


def looks_like_contents(text: Column) -> Column:
    return text.rlike(CONTENTS) | text.rlike(r"(?m)^PART\s+[A-Z]") | (section_lines(text) >= 3)


def table_titles(sections: DataFrame) -> DataFrame:
    """Sections whose titles speak of tables and not of narrative."""
    return sections.filter(F.col("title").rlike(TABLE_WORDS) & ~F.trim("title").rlike(NARRATIVE_WORDS))


def plausible(sections: DataFrame, most: int = 300, documents: DataFrame | None = None) -> DataFrame:
    """Per document: ok and the reason, from the number of sections and of anchors beyond its pages.

    documents (doc_id) adds those that have no sections at all.
    """
    bad = F.count_if((F.col("start_page") < 1) | (F.col("start_page") > F.col("n_pages")) | F.col("start_page").isNull())
    out = sections.groupBy("doc_id").agg(F.count("*").alias("n"), bad.alias("bad"))
    if documents is not None:
        out = documents.select("doc_id").distinct().join(out, "doc_id", "left").fillna(0, ["n", "bad"])
    reason = F.when(F.col("n") == 0, "no sections").when(F.col("n") > most, "too many sections").when(F.col("bad") > F.greatest(F.lit(3.0), F.col("n") / 3), "anchors outside").otherwise("")
    return out.withColumn("reason", reason).withColumn("ok", F.col("reason") == "")


def cap_tables(tables: DataFrame, keys: list[str]) -> DataFrame:
    """Manifest rows (keys, start_page, end_page, layout) whose ranges end before the next one's start."""
    following = F.lead("start_page").over(W.partitionBy(*keys).orderBy("start_page", "title"))
    end = F.greatest("start_page", F.least("end_page", F.coalesce(following - 1, "end_page")))
    return tables.withColumn("end_page", end).withColumn("layout", F.when(end == F.col("start_page"), "single").otherwise(F.col("layout")))


def manifest(tables: DataFrame) -> DataFrame:
    """Tables (doc_id, path array<int>, title, start_page, end_page, layout, dates array<string>, notes) as manifest rows.

    They are numbered in reading order within a document.  A table that stands several times on its page becomes one row
    per date, with the date in its title; others keep all their dates in one row.
    """
    several = (F.col("layout") == "multiple_on_page") & (F.size("dates") > 1)
    dates = F.when(several, F.col("dates")).otherwise(F.array(F.array_join(F.coalesce("dates", F.array().cast("array<string>")), ", ")))
    rows = tables.withColumn("_several", F.coalesce(several, F.lit(False))).select("*", F.posexplode(dates).alias("_k", "date")).drop("dates").withColumnRenamed("date", "dates")
    rows = rows.withColumn("table_no", F.row_number().over(W.partitionBy("doc_id").orderBy("path", "start_page", "_k")))
    pages = F.transform(F.sequence("start_page", "end_page"), lambda p: p.cast("string"))
    rows = rows.withColumn("table_id", F.concat(F.format_string("t%03d_p", "table_no"), F.array_join(pages, "_"))).withColumn("pages", F.array_join(pages, "+"))
    rows = rows.withColumn("n_pages", F.size(pages)).withColumn("needs_agent_review", F.coalesce("notes", F.lit("")) != "")
    return rows.withColumn("title", F.when(F.col("_several"), F.concat("title", F.lit(" - "), "dates")).otherwise(F.col("title"))).drop("_k", "_several", "notes")


def clamp(page: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(page, high))


def stale_sheets(sheets: DataFrame, most_rows: int = 6) -> DataFrame:
    """Sheets (name, n_data, n_rows) to remove: numbered copies, and short ones without a data cell; contents and costs stay."""
    stale = F.col("name").rlike(r"\([0-9]+\)$") | ((F.col("n_data") == 0) & (F.col("n_rows") <= most_rows))
    return sheets.filter(~F.col("name").isin(LASTING_SHEETS) & stale)


def sheet_exists(sections: DataFrame, sheets: DataFrame) -> DataFrame:
    """Sections that have a sheet: named by their id, or by it and a title or a table's number."""
    own = F.regexp_extract("name", r"^(.*?)(?: -.*| Table .*)?$", 1)
    return sections.join(sheets.select(own.alias("section_id")).distinct(), "section_id", "left_semi")


def resume_from(groups: DataFrame, order: list, start: str) -> DataFrame:
    """Groups (doc_id, section_id, ...) of each document from a given one on, in order."""
    seen = F.max((F.col("section_id") == start).cast("int")).over(W.partitionBy("doc_id").orderBy(*order))
    return groups.withColumn("_s", seen).filter("_s = 1").drop("_s")


def contents_rows(index: DataFrame) -> DataFrame:
    """The rows of a contents sheet: entries by first page, with whether any of their slides has a chart."""
    return index.groupBy("section_id", "title").agg(F.min("page").alias("page"), F.bool_or("has_chart").alias("has_chart"))
