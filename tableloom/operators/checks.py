"""Checks that give findings: one row for every thing that doesn't reconcile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tableloom.functions import text as T, values as V

# Words that tell subsets and flows in labels.
OF_WHICH = ["of which", "of which:", "o/w", "thereof", "including", "inc."]
INCOME = ["income", "revenue", "gain", "p&l", "net p&l"]
EXPENSE = ["expense", "cost", "loss", "p&l", "net p&l"]


def rollup(pairs: DataFrame, keys: list[str], tol_abs: float = 2.0, tol_pct: float = 1.0) -> DataFrame:
    """Children against parents: pairs(keys, expected, value) gives (keys, expected, got, ok).

    The sum of the children may differ by tol_abs or tol_pct per cent of the parent, whichever is more.
    """
    out = pairs.groupBy(*keys).agg(F.first("expected").alias("expected"), F.sum("value").alias("got"))
    return out.withColumn("ok", F.abs(F.col("got") - F.col("expected")) <= F.greatest(F.lit(tol_abs), F.abs("expected") * tol_pct / 100))


def rollup_tables(rows: DataFrame, cells: DataFrame, keys: list[str], tol_abs: float = 2.0, tol_pct: float = 1.0) -> DataFrame:
    """Roll-up mismatches of rows(keys, row_id, parent, row_type, label) and cells(keys, row_id, col_id, value).

    Left out: headers and notes as parents, parents with an "of which" or a note child, any blank child, a child of
    more than one and a half times the parent, and children that are income and expense of a formula.
    """
    label = F.lower(F.trim(F.coalesce("label", F.lit(""))))
    starts = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.startswith(label, w))
    holds = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(label, w))
    kids = rows.filter("parent is not null").groupBy(*keys, "parent").agg(F.bool_or(starts(OF_WHICH) | (F.col("row_type") == "note")).alias("subset"), F.bool_or(holds(INCOME)).alias("income"), F.bool_or(holds(EXPENSE)).alias("expense"))
    parents = rows.filter("row_type not in ('section_header', 'note')").select(*keys, F.col("row_id").alias("parent"))
    fit = kids.join(parents, [*keys, "parent"]).filter("not subset and not (income and expense)").select(*keys, "parent")
    number = cells.select(*keys, "row_id", "col_id", V.review_number(F.col("value")).alias("num"))
    child = rows.select(*keys, "row_id", "parent").join(fit, [*keys, "parent"]).join(number, [*keys, "row_id"])
    stated = number.filter("num is not null").select(*keys, F.col("row_id").alias("parent"), "col_id", F.col("num").alias("expected"))
    n = rows.filter("parent is not null").groupBy(*keys, "parent").agg(F.count("*").alias("n"))
    sums = child.join(stated, [*keys, "parent", "col_id"]).join(n, [*keys, "parent"]).groupBy(*keys, "parent", "col_id", "expected", "n").agg(F.sum("num").alias("got"), F.count("num").alias("known"), F.max(F.abs("num")).alias("most"))
    sums = sums.filter("known = n and (expected = 0 or most <= abs(expected) * 1.5)")
    return sums.filter(F.abs(F.col("got") - F.col("expected")) > F.greatest(F.lit(tol_abs), F.abs("expected") * tol_pct / 100)).select(*keys, F.col("parent").alias("row_id"), "col_id", "expected", F.round("got", 2).alias("got"))


def ratio(rows: DataFrame, keys: list[str], tol_abs: float = 5.0, tol_rel: float = 0.05) -> DataFrame:
    """rows(keys, numerator, denominator, stated): the implied percentage against the stated one."""
    implied = F.col("numerator") / F.nullif(F.col("denominator"), F.lit(0)) * 100
    return rows.select(*keys, "stated", implied.alias("implied"), (F.abs(implied - F.col("stated")) <= F.greatest(F.lit(tol_abs), F.abs("stated") * tol_rel)).alias("ok"))


def ratio_by_label(rows: DataFrame, cells: DataFrame, keys: list[str], tol_abs: float = 5.0, tol_rel: float = 0.05) -> DataFrame:
    """Coverage ratios that don't follow from their table: rows(keys, ord, row_id, label), cells(keys, row_id, col_idx, value).

    A row's number is its first numeric cell.  The rows are found by their labels, the last of each kind counts.
    """
    first = cells.select(*keys, "row_id", "col_idx", V.review_number(F.col("value")).alias("num")).filter("num is not null")
    first = first.groupBy(*keys, "row_id").agg(F.min_by("num", "col_idx").alias("num"))
    label = F.upper(F.coalesce("label", F.lit("")))
    kind = F.when(label.contains("TOTAL HQLA") | label.contains("HIGH-QUALITY LIQUID ASSETS"), "assets").when(label.contains("TOTAL NET CASH OUTFLOW"), "outflow").when(label.contains("LIQUIDITY COVERAGE RATIO"), "ratio")
    found = rows.withColumn("kind", kind).filter("kind is not null").join(first, [*keys, "row_id"])
    last = lambda k, c: F.max_by(F.when(F.col("kind") == k, F.col(c)), F.when(F.col("kind") == k, F.col("ord")))
    out = found.groupBy(*keys).agg(last("assets", "num").alias("assets"), last("outflow", "num").alias("outflow"), last("ratio", "num").alias("stated"), last("ratio", "row_id").alias("row_id"))
    out = out.filter("assets is not null and outflow <> 0 and stated <> 0").withColumn("implied", F.round(F.col("assets") / F.col("outflow") * 100, 1))
    off = F.abs(F.col("assets") / F.col("outflow") * 100 - F.col("stated")) > F.greatest(F.lit(tol_abs), F.abs("stated") * tol_rel)
    return out.filter(off).select(*keys, "row_id", "stated", "implied")


def review_summary(tables: DataFrame, flags: DataFrame, keys: list[str]) -> DataFrame:
    """How many tables (keys, table_id, skipped) have no flag, some, or were skipped; flags(keys, table_id)."""
    some = flags.select(*keys, "table_id").distinct().withColumn("_f", F.lit(True))
    rows = tables.join(some, [*keys, "table_id"], "left")
    skipped, flagged = F.coalesce("skipped", F.lit("")) != "", F.col("_f").isNotNull()
    return rows.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(~skipped & ~flagged).alias("ok"), F.count_if(flagged).alias("flagged"), F.count_if(skipped).alias("skipped"))


def span_mismatch(rows: DataFrame, v1: bool = False) -> DataFrame:
    """Rows (values, n_cols) whose cells don't fill the columns; rows without cells are fine.  v1 adds up spans."""
    n = F.aggregate("values", F.lit(0), lambda a, x: a + x["span"]) if v1 else F.size("values")
    return rows.withColumn("n_values", n).filter((F.size("values") > 0) & (F.col("n_values") != F.col("n_cols")))


def duplicate_labels(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Labels that data and total rows of a table repeat: a sign of shifted rows."""
    return rows.filter("row_type in ('data', 'total')").withColumn("label", F.trim("label")).filter("label <> ''").groupBy(*keys, "label").agg(F.count("*").alias("n")).filter("n > 1")


def number_recall(json: DataFrame, pages: DataFrame, noise: DataFrame | None = None, strict: bool = False, whole: bool = False) -> DataFrame:
    """Numbers that extracted cells and their pages don't print equally often.

    json(unit, token) are the purely numeric cell tokens, pages(unit, text) the units' texts, noise(unit, token) tokens
    to leave out.  phantom: more often extracted than printed, and not even in the text without spaces and commas.
    deficit: more often printed, longer than two characters, no year, no noise, and not seven digits or more where
    nothing numeric was extracted.  strict reports every difference.  whole takes a token as in the text only where it
    is made of whole numbers printed apart: not as a part of a longer one, nor as the end of one and the start of the next.
    """
    printed = pages.select("unit", F.explode(T.number_tokens(F.col("text"))).alias("token")).groupBy("unit", "token").agg(F.count("*").alias("printed"))
    found = json.groupBy("unit", "token").agg(F.count("*").alias("extracted"))
    both = found.join(printed, ["unit", "token"], "full").fillna(0, ["printed", "extracted"])
    kind = F.when(F.col("extracted") > F.col("printed"), "phantom").when(F.col("printed") > F.col("extracted"), "deficit")
    both = both.withColumn("kind", kind).filter("kind is not null")
    if not strict:
        some = json.select("unit").distinct().withColumn("some", F.lit(True))
        both = both.join(some, "unit", "left")
        if noise is not None:
            # A unit without an id has noise too.
            named = noise.select(F.col("unit").alias("of"), F.col("token").alias("named")).distinct().withColumn("noise", F.lit(True))
            both = both.join(named, F.expr("unit <=> of and token = named"), "left").drop("of", "named")
        else:
            both = both.withColumn("noise", F.lit(None).cast("boolean"))
        deficit = (F.col("kind") == "deficit") & (F.length("token") > 2) & ~F.col("token").rlike("^(19|20)[0-9]{2}$") & F.col("noise").isNull() & (F.col("some").isNotNull() | (F.length("token") < 7))
        # A unit's text meets only the list of tokens that it might hold in another spelling.
        asked = both.filter("kind = 'phantom'").groupBy("unit").agg(F.collect_set("token").alias("tokens"))
        squeezed = F.regexp_replace("text", r"[\s,]", "")
        holds = lambda x: F.contains(squeezed, x) & T.holds_number(F.col("text"), x) if whole else F.contains(squeezed, x)
        there = pages.join(asked, "unit").select("unit", F.explode(F.filter("tokens", holds)).alias("token")).distinct()
        both = both.filter((F.col("kind") == "phantom") | deficit).join(there.withColumn("kind", F.lit("phantom")), ["unit", "token", "kind"], "left_anti")
    return both.select("unit", "kind", "token", "extracted", "printed", F.length("token").alias("length"), F.abs(F.col("printed") - F.col("extracted")).alias("gap"))


def section_noise(sections: DataFrame) -> DataFrame:
    """(unit, token) of the section ids (unit, section_id) that a page prints: the id, and every prefix of its number."""
    number = F.regexp_replace("section_id", r"^[A-Za-z][.]", "")
    parts = F.split(number, "[.]")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))
    return sections.select("unit", F.explode(F.array_union(F.array("section_id"), prefixes)).alias("token")).distinct()


def by_severity(found: DataFrame, keys: list[str]) -> DataFrame:
    """Findings (keys, token, length, gap) with their rank n: longer tokens and larger gaps first."""
    return found.withColumn("n", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("length"), F.desc("gap"), "kind", "token")))


def findings(**found: DataFrame) -> DataFrame:
    """Findings of several checks, each (unit, detail), as one table (unit, check, detail)."""
    parts = [d.select("unit", F.lit(name).alias("check"), "detail") for name, d in found.items()]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def numeric_tokens(cells: DataFrame, unit: str, value: str) -> DataFrame:
    """(unit, token) of the cells that are nothing but a number."""
    token = F.regexp_replace(value, r"[,()\s%]", "")
    return cells.select(F.col(unit).alias("unit"), token.alias("token")).filter(F.col("token").rlike("^[0-9]+([.][0-9]+)?$"))


def bridge_balance(points: DataFrame, keys: list[str], tol: float = 5.0) -> DataFrame:
    """Bridges (keys, ord, series, row_type, sign, num): opening plus signed steps against closing.

    Of rows with the same series and role the first counts.
    """
    from tableloom.operators.sections import keep_first

    rows = keep_first(points, [*keys, "series", "row_type"], ["ord"])
    first = lambda role: F.min_by(F.when(F.col("row_type") == role, F.coalesce("num", F.lit(0.0))), F.when(F.col("row_type") == role, F.col("ord")))
    step = F.sum(F.when(F.col("row_type") == "bridge", V.bridge_amount(F.col("num"), F.col("sign"))))
    out = rows.groupBy(*keys).agg(first("start").alias("opening"), step.alias("steps"), first("end").alias("closing")).filter("opening is not null and steps is not null and closing is not null")
    return out.withColumn("delta", F.abs(F.col("opening") + F.col("steps") - F.col("closing"))).withColumn("ok", F.col("delta") <= tol)


def point_issues(points: DataFrame, keys: list[str]) -> DataFrame:
    """Blank labels and illegible values per element (keys, element_type, series, value)."""
    blank = F.count_if(F.trim(F.coalesce("series", F.lit(""))) == "")
    illegible = F.count_if((F.col("element_type") == "text_table") & (F.col("value") == "?"))
    return points.groupBy(*keys).agg(blank.alias("blank"), illegible.alias("illegible")).filter("blank + illegible > 0")


def failed_self_checks(rows: DataFrame, column: str = "self_check", strict: bool = False, tol: float = 5.0) -> DataFrame:
    """Self-checks whose equations are off or can't be read; strict takes exactly one equation."""
    checks = V.self_check(F.col(column), tol)
    out = rows.filter(F.coalesce(F.col(column), F.lit("")) != "").withColumn("checks", checks)
    wrong = F.exists("checks", lambda c: ~c["ok"])
    unread = F.exists("checks", lambda c: c["ok"].isNull()) | (F.size("checks") == 0)
    if strict:
        unread = unread | (F.length(F.regexp_replace(column, "[^=]", "")) != 1)
    return out.withColumn("issue", F.when(unread, "unparseable").when(wrong, "off")).filter("issue is not null").drop("checks")


def sheet_issues(cells: DataFrame, merges: DataFrame, first_row: int = 6) -> DataFrame:
    """Structural findings (severity, sheet, check, r) of data sheets.

    cells(sheet, r, c, value, is_number) has every cell that isn't empty, merges(sheet, min_row, min_col, max_row,
    max_col) the merged regions.  Data begin at the first row whose first cell is a number or a row id.
    """
    cells, merges = (d.filter("upper(sheet) <> 'SUMMARY'") for d in (cells, merges))
    lead = F.when((F.col("c") == 1) & (F.col("is_number") | F.trim("value").rlike("^[0-9]+[a-z]?$")), F.col("r"))
    head = (F.col("c") == 1) & F.col("r").between(3, 7) & ~F.col("is_number") & F.lower("value").rlike("row_id|label|level")
    sheets = cells.groupBy("sheet").agg(F.max("r").alias("rows"), F.max("c").alias("cols"), F.coalesce(F.min(lead), F.lit(first_row)).alias("start"), F.coalesce(F.bool_or((F.col("r") == 1) & (F.col("c") == 1) & ~V.is_empty(F.col("value"))), F.lit(False)).alias("titled"), F.bool_or(head).alias("headed"))
    anchors = cells.select("sheet", F.col("r").alias("min_row"), F.col("c").alias("min_col"), "value")
    merged = merges.join(sheets, "sheet").join(anchors, ["sheet", "min_row", "min_col"], "left")
    rows = cells.join(sheets.select("sheet", "start"), "sheet").filter("r >= start")
    number = F.when(F.col("c") >= 7, V.as_number(F.regexp_replace(F.trim("value"), ",", "")))
    full = F.count_if((F.col("c") >= 7) & ~V.is_empty(F.col("value")))
    # A zero counts as a dash in one test and as a value in the other, so no row is both blank and not all dashes.
    dashes = F.bool_and((F.col("c") < 7) | V.is_empty(F.col("value")) | (F.col("is_number") & (V.as_number(F.col("value")) == 0)))
    rows = rows.groupBy("sheet", "r").agg(F.collect_list(number).alias("nums"), full.alias("full"), dashes.alias("dashes"), F.bool_or(F.col("c") == 1).alias("named"), F.max(F.when(F.col("c") == 4, F.col("value"))).alias("row_type")).filter("named")
    sparse = rows.join(merged.filter("min_row >= start").select("sheet", F.col("min_row").alias("r")).distinct(), ["sheet", "r"], "left_anti").filter("coalesce(row_type, '') not in ('total', 'section_header', 'note')")
    say = lambda d, severity, name, r="r": d.select(F.lit(severity).alias("severity"), "sheet", F.lit(name).alias("check"), F.col(r).cast("int").alias("r"))
    found = [
        say(sheets.filter("not titled").withColumn("r", F.lit(1)), "ERROR", "header_present"),
        say(sheets.filter("not headed").withColumn("r", F.lit(3)), "WARNING", "header_present"),
        say(merged.filter((F.col("min_row") >= F.col("start")) & V.is_empty(F.col("value"))), "WARNING", "merge_value", "min_row"),
        say(merged.filter("max_row > rows or max_col > cols"), "ERROR", "merge_orphan", "min_row"),
        say(cells.filter("not is_number and value like '=%'"), "ERROR", "no_formula"),
        say(rows.filter(V.all_zero(F.col("nums"), 1)), "WARNING", "all_zero_row"),
        say(sparse.filter("full = 0 and not dashes"), "WARNING", "column_consistency"),
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def sheet_count(sheets: DataFrame) -> DataFrame:
    """Per book (book, sheet): its data sheets, and the severity of what that says."""
    n = F.count_if(F.upper("sheet") != "SUMMARY")
    return sheets.groupBy("book").agg(n.alias("n")).withColumn("severity", F.when(F.col("n") == 0, "ERROR").otherwise("INFO"))


def validation_summary(issues: DataFrame, keys: list[str]) -> DataFrame:
    """Errors and warnings per key, and whether it passes: without an error."""
    out = issues.groupBy(*keys).agg(F.count_if(F.col("severity") == "ERROR").alias("errors"), F.count_if(F.col("severity") == "WARNING").alias("warnings"))
    return out.withColumn("passed", F.col("errors") == 0)


def repeated_names(sheets: DataFrame) -> DataFrame:
    """Sheet names that occur more than once whatever their case."""
    return sheets.groupBy(F.lower("sheet").alias("name")).agg(F.count("*").alias("n")).filter("n > 1")


def grade(issues: Column) -> Column:
    """A traffic light of a number of issues."""
    return F.when(issues > 10, "red").when(issues >= 1, "yellow").otherwise("green")


def sweep(units: DataFrame, issues: DataFrame, keys: list[str], shown: int = 3) -> DataFrame:
    """Units (keys, error) graded by their issues (keys, ord, issue): (keys, error, n_issues, grade, first, n).

    Units that could not be read keep their error and have no grade; n ranks them first, then by issues.  first are the
    first issues.  A sweep is ranked as a whole: its rows are one per unit.
    """
    per = issues.groupBy(*keys).agg(F.count("*").alias("n_issues"), F.transform(F.slice(F.array_sort(F.collect_list(F.struct("ord", "issue"))), 1, shown), lambda x: x["issue"]).alias("first"))
    rows = units.join(per, keys, "left").withColumn("n_issues", F.when(F.col("error").isNotNull(), -1).otherwise(F.coalesce("n_issues", F.lit(0))))
    return rows.withColumn("grade", F.when(F.col("error").isNull(), grade(F.col("n_issues")))).orderBy(F.col("error").isNull(), F.desc("n_issues"), *keys)


def table_record(tables: DataFrame) -> DataFrame:
    """Tables (reconciles, flags, zero_rows, ...) with confidence and needs_review, as a summary sheet lists them."""
    rows = tables.withColumn("confidence", confidence(F.col("reconciles"), F.col("flags"), F.col("zero_rows")))
    return rows.withColumn("needs_review", (F.col("confidence") < 0.8) | (F.col("flags") > 0) | ~F.col("reconciles"))


def summary_line(records: DataFrame, keys: list[str]) -> DataFrame:
    """Tables, those that need review, and the mean confidence."""
    return records.groupBy(*keys).agg(F.count("*").alias("tables"), F.count_if("needs_review").alias("need_review"), F.round(F.avg(F.col("confidence").cast("decimal(4,2)")), 2).cast("double").alias("avg_confidence"))


def confidence(reconciles: Column, flags: Column, zero_rows: Column) -> Column:
    """1 less what doesn't reconcile, flags and all-zero rows cost, 0 at least."""
    return F.round(F.greatest(F.lit(0.0), 1 - F.when(reconciles, 0.0).otherwise(0.30) - F.least(F.lit(0.40), flags * 0.10) - F.least(F.lit(0.20), zero_rows * 0.05)), 2)
