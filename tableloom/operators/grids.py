"""Table grids: nested tables as long cells, and repairs of their structure.

Long rows are (doc_id, table_id, row_idx, row_id, row_type, level, parent, label, ...), long cells add
(col_idx, value, cell_state).  Positions are columns; nothing relies on physical order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tableloom.functions import text as T, values as V

CELL = "struct<value string, cell_state string>"
ROW = f"struct<row_id string, row_type string, level int, parent string, label string, `values` array<{CELL}>>"
TABLE = f"struct<title string, label_header string, continued_from_previous boolean, section_id string, columns array<struct<`group` string, leaf string>>, rows array<{ROW}>>"
EXTRACTION = f"tables array<{TABLE}>"
LEGACY = EXTRACTION.replace(f"array<{CELL}>", "array<string>")
TABLE_KEY = ["doc_id", "table_id"]
TABLE_ROW = ["doc_id", "table_id", "row_idx"]


def parse_tables(raw: DataFrame) -> DataFrame:
    """raw(doc_id, raw): a model's JSON answers as tables(doc_id, table_id, title, ..., columns, rows).

    Rows whose cells are plain strings are upgraded, row by row, by the form of their first cell; old state names
    get their present ones.  An answer that is no JSON has corrupt = true and no tables.
    """
    # Read once, cells as text: a cell that is an object keeps its JSON, which is read where the row's first one is.
    rows = raw.withColumn("old", F.from_json(T.without_fences(F.col("raw")), LEGACY, {"mode": "PERMISSIVE"}))

    def upgraded(row: Column) -> Column:
        first = F.get(row["values"], F.lit(0))
        plain = first.isNotNull() & ~F.coalesce(first.startswith("{"), F.lit(False))
        cells = F.when(plain, F.transform(row["values"], V.cell_from_text)).otherwise(F.transform(row["values"], lambda x: V.normal_cell(F.from_json(x, CELL))))
        kind = F.coalesce(row["row_type"], F.lit("data"))
        return F.struct(row["row_id"].alias("row_id"), kind.alias("row_type"), row["level"].alias("level"), row["parent"].alias("parent"), row["label"].alias("label"), F.coalesce(cells, F.array().cast(f"array<{CELL}>")).alias("values"))

    out = rows.select("doc_id", F.col("old.tables").isNull().alias("corrupt"), F.posexplode_outer("old.tables").alias("table_id", "t"))
    return out.select("doc_id", "corrupt", "table_id", F.col("t.title").alias("title"), F.coalesce("t.label_header", F.lit("")).alias("label_header"), F.coalesce("t.continued_from_previous", F.lit(False)).alias("continued_from_previous"), F.coalesce("t.section_id", F.lit("")).alias("section_id"), F.col("t.columns").alias("columns"), F.transform("t.rows", upgraded).alias("rows"))


def long_rows(tables: DataFrame) -> DataFrame:
    return tables.select("doc_id", "table_id", F.size("columns").alias("n_cols"), F.posexplode("rows").alias("row_idx", "r")).select("doc_id", "table_id", "n_cols", "row_idx", "r.*")


def long_cells(tables: DataFrame) -> DataFrame:
    """One row per cell, with the column's headers and the parsed number."""
    cells = tables.select("doc_id", "table_id", "columns", F.posexplode("rows").alias("row_idx", "r")).select("doc_id", "table_id", "columns", "row_idx", "r.row_id", "r.row_type", "r.level", "r.parent", "r.label", F.posexplode("r.values").alias("col_idx", "c"))
    column = F.get("columns", F.col("col_idx"))
    return cells.select("doc_id", "table_id", "row_idx", "row_id", "row_type", "level", "parent", "label", "col_idx", column["group"].alias("col_group"), column["leaf"].alias("col_leaf"), "c.value", "c.cell_state", V.grid_number(F.col("c.value")).alias("num"))


def reasonable(tables: DataFrame) -> DataFrame:
    """doc_id, ok: every table has columns and rows and some row with cells; a document without tables is fine."""
    ok = (F.size("columns") > 0) & (F.size("rows") > 0) & F.exists("rows", lambda r: F.size(r["values"]) > 0)
    return tables.groupBy("doc_id").agg(F.bool_and(F.coalesce(ok, ~F.col("corrupt"))).alias("ok"))


def fill_parents(rows: DataFrame, keys: list[str], order: str = "row_idx", deepest: int = 4) -> DataFrame:
    """parent of every row of (keys, order, row_id, row_type, level): the nearest row one level up, by windows only.

    A shallower row between ends the search; levels 0 and 1 have no parent; notes keep theirs and anchor nothing.
    Parents without a printed id are called h1, h2, ... in the order in which they are first needed.
    """
    before = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    real = F.col("row_type") != "note"
    at = F.lit(None).cast(dict(rows.dtypes)[order])
    for n in range(2, deepest + 1):
        last = F.last(F.when(real & (F.col("level") <= n - 1), F.struct("level", F.col(order).alias("at"))), True).over(before)
        at = F.when(F.col("level") == n, F.when(last["level"] == n - 1, last["at"])).otherwise(at)
    rows = rows.withColumn("_up", F.when(real, at))
    needed = rows.filter("_up is not null").groupBy(*keys, F.col("_up").alias(order)).agg(F.min(order).alias("_first"))
    named = needed.join(rows.select(*keys, order, "row_id"), [*keys, order])
    named = named.withColumn("_n", F.row_number().over(W.partitionBy(*keys, F.col("row_id").isNull()).orderBy("_first")))
    named = named.select(*keys, F.col(order).alias("_up"), F.coalesce("row_id", F.concat(F.lit("h"), "_n")).alias("_id"))
    out = rows.join(named, [*keys, "_up"], "left").withColumn("parent", F.when(real, F.col("_id")).otherwise(F.col("parent"))).drop("_up", "_id")
    own = named.select(*keys, F.col("_up").alias(order), F.col("_id").alias("_own"))
    return out.join(own, [*keys, order], "left").withColumn("row_id", F.coalesce("row_id", "_own")).drop("_own")


def split_date_blocks(rows: DataFrame, keys: list[str], order: str = "row_idx") -> DataFrame:
    """Rows (keys, order, title, row_type, label, n_values) with block and title of the block's table.

    Two dated section headers or more, each with a row of values below it, split a table: their rows go, what
    stands above the first joins the first block.  Other tables stay whole, in block 1.
    """
    whole = W.partitionBy(*keys)
    date = T.date_in_header(F.col("label"))
    head = (F.col("row_type") == "section_header") & (date != "")
    rows = rows.withColumn("_head", head).withColumn("_block", F.sum(head.cast("int")).over(whole.orderBy(order)))
    rows = rows.withColumn("_full", F.max((F.col("n_values") > 0).cast("int")).over(W.partitionBy(*keys, "_block")))
    rows = rows.withColumn("_split", (F.max("_block").over(whole) >= 2) & (F.min(F.when(F.col("_block") > 0, F.col("_full"))).over(whole) == 1))
    rows = rows.withColumn("block", F.when(F.col("_split"), F.greatest("_block", F.lit(1))).otherwise(1).cast("int"))
    rows = rows.withColumn("_date", F.max(F.when(F.col("_head"), date)).over(W.partitionBy(*keys, "block")))
    title = F.trim(F.coalesce("title", F.lit("")))
    rows = rows.withColumn("title", F.when(~F.col("_split"), F.col("title")).when(title.isin("") | (title == F.col("_date")), F.col("_date")).otherwise(F.concat(title, F.lit(" — "), "_date")))
    return rows.filter("not (_split and _head)").drop("_head", "_block", "_full", "_split", "_date")


def stitch(tables: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Tables (keys, order, continued, title, n_cols, first_type) with head, the number of the table they continue.

    A table continues the one before if it says so, has no title, as many columns, and doesn't begin with a header.
    """
    w = W.partitionBy(*keys).orderBy(order)
    cont = F.col("continued") & (F.trim(F.coalesce("title", F.lit(""))) == "") & (F.col("n_cols") == F.lag("n_cols").over(w)) & ~F.col("first_type").isin("section_header", "sub_header")
    return tables.withColumn("head", F.sum((~F.coalesce(cont, F.lit(False))).cast("int")).over(w))


def footnotes_to_previous(tables: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Tables (keys, order, n_cols, all_notes) with host: one that is all notes and has no columns goes to the one before."""
    own = ~(F.col("all_notes") & (F.col("n_cols") == 0))
    return tables.withColumn("host", F.coalesce(F.last(F.when(own, F.col(order)), True).over(W.partitionBy(*keys).orderBy(order)), F.col(order)))


def expand_spans(cells: DataFrame, keys: list[str], fill: str = "↑ (merged)") -> DataFrame:
    """Cells (keys, row, ord, row_span, col_span, text) placed on a grid: (keys, row, col, text).

    A cell takes the first free places of its row; places below it in its rows are filled with a mark, places to
    its right are blank.  Where a cell goes depends on all before it, so a table is one group.
    """
    from collections.abc import Iterator

    import pyarrow as pa

    def place(cells: list[dict]) -> list[tuple[int, int, str]]:
        taken, row, col = {}, None, 0
        for cell in cells:
            r, high, wide = cell["row"], max(1, cell["row_span"]), max(1, cell["col_span"])
            if r != row:
                row, col = r, 0
            while (row, col) in taken:
                col += 1
            for i in range(high):
                for j in range(wide):
                    taken[row + i, col + j] = cell["text"] if not i and not j else fill if i else ""
            col += wide
        return [(r, c, text) for (r, c), text in taken.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            placed = [place(cells) for cells in batch.column(len(keys)).to_pylist()]
            owner = pa.array([i for i, x in enumerate(placed) for _ in x], pa.int64())
            row, col, text = zip(*(x for p in placed for x in p), strict=True) if len(owner) else ((), (), ())
            columns = [*(batch.column(i).take(owner) for i in range(len(keys))), pa.array(row, pa.int32()), pa.array(col, pa.int32()), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "row", "col", "text"])

    kinds = dict(cells.dtypes)
    whole = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("row").cast("int").alias("row"), "ord", F.col("row_span").cast("int").alias("row_span"), F.col("col_span").cast("int").alias("col_span"), F.col("text").cast("string").alias("text")))).alias("cells"))
    return whole.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "`row` int", "col int", "text string"]))


def null_spans(cells: DataFrame, keys: list[str], col: str = "col_idx", value: str = "value") -> DataFrame:
    """Span of each printed value over the nulls to its right; a row's leading nulls belong to its first value.

    cells has every column of a row; the result has the printed ones, with their first column and span.
    """
    w = W.partitionBy(*keys).orderBy(col)
    rows = cells.withColumn("_n", F.sum(F.col(value).isNotNull().cast("int")).over(w)).withColumn("_n", F.greatest("_n", F.lit(1)))
    return rows.groupBy(*keys, F.col("_n").alias("ord")).agg(F.min(col).alias("first_col"), F.count("*").alias("span"), F.max(value).alias("value")).filter("value is not null")


def header_groups(columns: DataFrame, keys: list[str]) -> DataFrame:
    """Merged group headers: runs of neighbouring columns (keys, col_idx, group) of the same group."""
    w = W.partitionBy(*keys).orderBy("col_idx")
    new = ~F.coalesce(F.col("group").eqNullSafe(F.lag("group").over(w)) & F.col("group").isNotNull(), F.lit(False)) | (F.row_number().over(w) == 1)
    rows = columns.withColumn("_run", F.sum(new.cast("int")).over(w))
    return rows.groupBy(*keys, "_run").agg(F.first("group").alias("group"), F.min("col_idx").alias("first_col"), F.max("col_idx").alias("last_col")).drop("_run")


def sheet_rows(cells: DataFrame) -> DataFrame:
    """Long cells as sheet rows: label indented by level, values in column order."""
    label = F.concat(F.repeat(F.lit(" "), 4 * F.greatest(F.col("level") - 1, F.lit(0))), "label")
    sheet = F.transform(F.array_sort(F.collect_list(F.struct("col_idx", "value"))), lambda x: x["value"])
    return cells.withColumn("label", label).groupBy(*TABLE_ROW, "label").agg(sheet.alias("cells"))


def column_edges(edges: DataFrame, keys: list[str], bucket: float = 3.0, least: int = 10, near: float = 6.0) -> DataFrame:
    """Column boundaries: x positions of vertical edges in buckets of 3 points, frequent ones, close ones merged."""
    rows = edges.withColumn("x", F.bround(F.col("x0") / bucket) * bucket).groupBy(*keys, "x").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    w = W.partitionBy(*keys).orderBy("x")
    rows = rows.withColumn("_new", F.coalesce(F.col("x") - F.lag("x").over(w) > near, F.lit(True)).cast("int")).withColumn("_g", F.sum("_new").over(w))
    return rows.groupBy(*keys, "_g").agg(F.min("x").alias("x"), F.sum("n").alias("n")).drop("_g")


def words_to_columns(words: DataFrame, keys: list[str], edges: list[float]) -> DataFrame:
    """Words (keys, text, x0, x1, top) with the column that their centre is in and the line they are on."""
    centre = (F.col("x0") + F.col("x1")) / 2
    return words.withColumn("col", F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: centre >= e))).withColumn("band", F.bround(F.col("top") / 3).cast("int"))


def anchored_text(words: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of words in visual order, each word with its x position."""
    rows = words.withColumn("band", F.bround(F.col("top") / 3).cast("int"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda x: F.concat(x["text"], F.lit("@"), F.bround(x["x0"]).cast("int").cast("string")))
    return rows.groupBy(*keys, "band").agg(F.array_join(parts, " ").alias("line"))


def row_header_columns(cells: DataFrame, keys: list[str], share: float = 0.6) -> DataFrame:
    """Per column (keys, col): whether it heads rows: flagged, all digits in the first one, or mostly text."""
    text = (~V.is_numeric_cell(F.col("text"))).cast("double")
    return cells.groupBy(*keys, "col").agg(F.bool_or("is_row_header").alias("_f"), F.bool_and(F.col("text").rlike("^[0-9]+[a-z]?$")).alias("_d"), F.avg(text).alias("_t")).select(*keys, "col", (F.col("_f") | ((F.col("col") == 0) & F.col("_d")) | (F.col("_t") >= share)).alias("heads_rows"))


def flatten_blocks(blocks: DataFrame) -> DataFrame:
    """blocks(doc_id, raw): recursive layout JSON as table rows (doc_id, table_no, title, page, row, cells).

    A table's title is the nearest heading before it.  The depth is the document's, which no type of Spark has.
    """
    import json
    from collections.abc import Iterator

    import pandas as pd

    def text_of(block: dict) -> str:
        words = block.get("textBlock") or {}
        inner = [*(words.get("blocks") or []), *(block.get("blocks") or [])]
        return " ".join(x for x in [words.get("text") or "", *map(text_of, inner)] if x).strip()

    def cell(c: dict) -> tuple:
        return " ".join(x for x in map(text_of, c.get("blocks") or []) if x).strip(), c.get("rowSpan", 1), c.get("colSpan", 1)

    def walk(items: list, heading: str) -> Iterator[tuple]:
        """(heading, page, [(is_header, cells)]) of every table; the innermost text block with a text that holds it heads it."""
        for block in items:
            words, table = block.get("textBlock") or {}, block.get("tableBlock")
            if table is not None:
                page = (block.get("pageSpan") or {}).get("pageStart", 1)
                yield heading, page, [(is_header, [cell(c) for c in r.get("cells") or []]) for part, is_header in (("headerRows", True), ("bodyRows", False)) for r in table.get(part) or []]
            yield from walk(words.get("blocks") or [], words.get("text") or heading)
            yield from walk(block.get("blocks") or [], heading)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for doc, raw in zip(part["doc_id"], part["raw"], strict=True):
                blocks = (json.loads(raw).get("document") or {}).get("documentLayout", {}).get("blocks") or []
                for n, (title, page, table) in enumerate(walk(blocks, "")):
                    rows += [(doc, n, title, page, i, head, [dict(zip(("text", "row_span", "col_span"), c, strict=True)) for c in cells]) for i, (head, cells) in enumerate(table)]
            yield pd.DataFrame(rows, columns=["doc_id", "table_no", "title", "page", "row", "is_header", "cells"])

    kind = dict(blocks.dtypes)["doc_id"]
    return blocks.select("doc_id", "raw").mapInPandas(run, f"doc_id {kind}, table_no int, title string, page int, `row` int, is_header boolean, cells array<struct<text string, row_span int, col_span int>>")


def header_rows(rows: DataFrame) -> DataFrame:
    """Per table of flatten_blocks: its header rows, its rows, and whether any cell is merged."""
    merged = F.bool_or(F.exists("cells", lambda c: (c["row_span"] > 1) | (c["col_span"] > 1)))
    return rows.groupBy("doc_id", "table_no", "title", "page").agg(F.count_if("is_header").cast("int").alias("header_rows"), F.count("*").cast("int").alias("n_rows"), merged.alias("merged"))


def layout_spans(rows: DataFrame, grid: DataFrame, n_cols: DataFrame, keys: list[str]) -> DataFrame:
    """Values and spans of extracted rows by the layout's grid, whose absent cells are merges.

    rows(keys, ord, row_id, row_type), grid(keys, row, col, text, col_span, is_col_header, is_row_header), n_cols(keys,
    n_cols) give (keys, ord, col_idx from 0, value, span).  A row finds its grid row by the id printed in the first column,
    else by its position among the grid's data rows; headers and notes are left out, rows beyond the grid too.  The first
    data column is the first that has a plain numeric or blank cell.
    """
    heads = grid.filter("is_col_header").select(*keys, "row").distinct()
    data = grid.join(heads, [*keys, "row"], "left_anti")
    ids = data.filter("col = 0 and trim(text) <> ''").groupBy(*keys, F.trim("text").alias("_id")).agg(F.max("row").alias("_by_id"))
    places = data.select(*keys, "row").distinct().select(*keys, F.col("row").alias("_by_place"), F.row_number().over(W.partitionBy(*keys).orderBy("row")).alias("_n"))
    plain = data.filter(~F.col("is_row_header") & (F.col("col_span") == 1) & V.is_numeric_cell(F.col("text")))
    offset = plain.groupBy(*keys).agg(F.min("col").alias("_from"))
    own = rows.filter("row_type not in ('section_header', 'note')").withColumn("_id", F.trim(F.coalesce("row_id", F.lit(""))))
    own = own.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy("ord")))
    own = own.join(ids, [*keys, "_id"], "left").join(places, [*keys, "_n"], "left").withColumn("row", F.coalesce("_by_id", "_by_place")).filter("row is not null")
    cells = own.select(*keys, "ord", "row").join(data.join(offset, keys, "left"), [*keys, "row"]).join(n_cols, keys)
    cells = cells.withColumn("col_idx", F.col("col") - F.coalesce("_from", F.lit(0))).filter("col_idx between 0 and n_cols - 1")
    text = F.trim(F.coalesce("text", F.lit("")))
    value = F.when(F.col("is_row_header") | (text == ""), None).when(text.isin("-", "–", "—"), "-").otherwise(F.regexp_replace(text, ",", ""))
    until = F.coalesce(F.lead("col_idx").over(W.partitionBy(*keys, "ord").orderBy("col_idx")), F.col("n_cols"))
    return cells.select(*keys, "ord", "col_idx", value.alias("value"), F.when(F.col("col_span") > 1, F.col("col_span")).otherwise(until - F.col("col_idx")).cast("int").alias("span"))


def column_map(columns: DataFrame, keys: list[str]) -> DataFrame:
    """Columns (keys, col, heads_rows) that hold data, numbered c1, c2, ... from the left."""
    data = columns.filter("not heads_rows")
    return data.select(*keys, "col", F.concat(F.lit("c"), F.row_number().over(W.partitionBy(*keys).orderBy("col"))).alias("col_id"))


def border_spans(printed: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Anchors and spans by printed borders: printed(keys, row_id, col_idx, text), a null being merged with its left neighbour.

    Gives (keys, row_id, col_idx, span, value) of the rows that have a span above 1.  The value of a span is the first
    of the extracted cells(keys, row_id, col_idx, value) in it that isn't blank, else what is printed; an unmerged cell
    keeps its own.
    """
    row = [*keys, "row_id"]
    runs = printed.withColumn("_run", F.sum(F.col("text").isNotNull().cast("int")).over(W.partitionBy(*row).orderBy("col_idx"))).filter("_run > 0")
    rows = runs.join(cells.withColumnRenamed("value", "_v"), [*row, "col_idx"], "left")
    some = F.when(~F.coalesce("_v", F.lit("")).isin("", "-"), F.col("col_idx"))
    spans = rows.groupBy(*row, "_run").agg(F.min("col_idx").alias("col_idx"), F.count("*").cast("int").alias("span"), F.min_by("_v", some).alias("_first"), F.min_by("_v", "col_idx").alias("_own"), F.max("text").alias("_text"))
    shown = F.regexp_replace(F.trim("_text"), "[ ,]", "")
    value = F.when(F.col("span") == 1, F.col("_own")).otherwise(F.coalesce("_first", F.when(shown != "", shown), F.lit("-")))
    merged = spans.withColumn("_most", F.max("span").over(W.partitionBy(*row))).filter("_most > 1")
    return merged.select(*row, "col_idx", "span", value.alias("value"))


def merge_hints(words: DataFrame, keys: list[str], edges: list[float], share: float = 0.3) -> DataFrame:
    """Merged cells of a page without grid lines: words(keys, text, x0, x1, top) and the edges between its columns.

    A column is in use if that share of the lines has a word in it.  A number takes the used columns next to its left
    that its line leaves empty: (keys, band, first_col, span, value).
    """
    rows = words_to_columns(words, keys, edges)
    present = rows.select(*keys, "band", "col").distinct()
    n = present.select(*keys, "band").distinct().groupBy(*keys).agg(F.count("*").alias("_n"))
    used = present.groupBy(*keys, "col").agg(F.count("*").alias("_c")).join(n, keys).filter(F.col("_c") >= F.greatest(F.lit(1.0), F.col("_n") * share))
    used = used.groupBy(*keys).agg(F.collect_set("col").alias("_used"))
    lines = present.groupBy(*keys, "band").agg(F.collect_set("col").alias("_there"))
    numbers = rows.filter(V.is_printed_number(F.col("text")))
    numbers = numbers.groupBy(*keys, "band", "col").agg(F.max_by("text", "x0").alias("value")).join(lines, [*keys, "band"]).join(used, keys)
    left = F.when(F.col("col") > 0, F.sequence(F.lit(0), F.col("col") - 1)).otherwise(F.array().cast("array<int>"))
    stop = F.filter(left, lambda c: F.array_contains("_there", c) | ~F.array_contains("_used", c))
    first = F.coalesce(F.array_max(stop), F.lit(-1)) + 1
    return numbers.withColumn("first_col", first).filter("first_col < col").select(*keys, "band", "first_col", (F.col("col") - F.col("first_col") + 1).alias("span"), "value")


def with_borders(cells: DataFrame, borders: DataFrame, keys: list[str]) -> DataFrame:
    """Cells (keys, row_id, col_idx, value) corrected by border information (keys, row_id, col_idx, span, value).

    An anchor's value replaces the cell's and its span is kept; the cells that a span covers go.
    """
    anchors = borders.select(*keys, "row_id", "col_idx", "span", F.col("value").alias("_v"), F.lit(True).alias("_b"))
    covered = borders.filter("span > 1").select(*keys, "row_id", F.explode(F.sequence(F.col("col_idx") + 1, F.col("col_idx") + F.col("span") - 1)).alias("col_idx")).distinct()
    out = cells.join(covered, [*keys, "row_id", "col_idx"], "left_anti").join(anchors, [*keys, "row_id", "col_idx"], "left")
    return out.withColumn("value", F.when(F.col("_b"), F.col("_v")).otherwise(F.col("value"))).withColumn("span", F.coalesce("span", F.lit(1))).drop("_v", "_b")


def repaired(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Both structural repairs, in order: dated blocks become tables of their own, then parents are filled in each."""
    return fill_parents(split_date_blocks(rows, keys), [*keys, "block"])
