"""Texts of documents: lines, numbers and labels in them, normal forms to compare by."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
STOP_WORDS = ["a", "b", "c", "the", "of", "and"]
FRIENDLY = {"yoy_pct": "YoY %", "yoy_change": "YoY %", "yoy": "YoY %", "qoq_pct": "QoQ %", "qoq_change": "QoQ %", "qoq": "QoQ %", "pct_change": "% Change", "change_pct": "% Change", "bar_total": "Total", "overlay_value": "Overlay"}
SHEET_FORBIDDEN = r"[\[\]:*?/\\]"
NUMBER_TOKEN = r"\(?[0-9][0-9,]*(?:[.][0-9]+)?\)?%?"
PERIOD = r"(?i)^\s*([0-9]{4}|[1-4]Q[0-9]{2}|FY[0-9]{2,4}|H[12]\s*[0-9]{2,4}|(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s*[-\s]\s*[0-9]{2,4})\s*$"
DATE_HEADER = r"(?:\b[0-9]{1,2}\s+)?(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+[0-9]{4}\b"


def lines(text: Column) -> Column:
    """Trimmed lines that aren't empty, in order."""
    return F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), lambda x: F.regexp_replace(x, r"^[\s ]+|[\s ]+$", "")), lambda x: x != "")


def words(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))


def word_set(text: Column) -> Column:
    return F.array_distinct(words(text))


def number_tokens(text: Column) -> Column:
    """Numbers as printed, without parentheses, per cent signs and separators."""
    raw = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({NUMBER_TOKEN})"), F.lit(1))
    return F.filter(F.transform(raw, lambda x: F.regexp_replace(F.regexp_replace(x, r"^[()%\s]+|[()%\s]+$", ""), ",", "")), lambda x: x != "")


def holds_number(text: Column, token: Column) -> Column:
    """Whether the text prints a number, spaces and commas within it aside, and no digits of the same number around it."""
    apart = F.regexp_replace(token, "([0-9.])", r"[$1][\\s,]*")
    return F.regexp(text, F.concat(F.lit("(?<![0-9])(?<![0-9][.,])"), apart, F.lit("(?![.,]?[0-9])")))


def is_narrative(text: Column, least: int = 10) -> Column:
    """Fewer numbers than a table's page has; false where there is no text to tell."""
    return F.coalesce(F.regexp_count(text, F.lit("[0-9][0-9,.]*")) < least, F.lit(False))


def key(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]", "")


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def row_label(text: Column) -> Column:
    """A label to join by: footnote marks and "of which" are gone."""
    return squeezed(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\([0-9]+\)|[0-9]+/|\bof which:?", " "))


def month_number(name: Column) -> Column:
    """1-12 from a month's first three letters, else null."""
    at = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substr(name, F.lit(1), F.lit(3))))
    return F.when(at > 0, at)


def column_header(text: Column) -> Column:
    """A column header to join by: dates as year-month-day or year-month, other texts squeezed."""
    t = F.trim(F.coalesce(text, F.lit("")))
    day, month = r"([0-9]{1,2})\s+([A-Za-z]{3,})\s+([0-9]{2,4})", r"([A-Za-z]{3,})\s+([0-9]{4})"
    d, m, y = (F.regexp_extract(t, day, i) for i in (1, 2, 3))
    year = F.when(y.try_cast("int") < 100, y.try_cast("int") + 2000).otherwise(y.try_cast("int"))
    whole = F.format_string("%04d-%02d-%02d", year, month_number(m), d.try_cast("int"))
    m2, y2 = F.regexp_extract(t, month, 1), F.regexp_extract(t, month, 2)
    part = F.format_string("%04d-%02d", y2.try_cast("int"), month_number(m2))
    return F.when((m != "") & month_number(m).isNotNull(), whole).when((m2 != "") & month_number(m2).isNotNull(), part).otherwise(squeezed(t))


def is_period(text: Column) -> Column:
    return F.coalesce(text.rlike(PERIOD), F.lit(False))


def date_in_header(label: Column) -> Column:
    """The date that makes a section header a date block's, else the empty string."""
    return F.regexp_extract(label, f"({DATE_HEADER})", 1)


def title_score(title: Column, leaf: Column) -> Column:
    """The share of the leaf's words that the title has."""
    return F.size(F.array_intersect(word_set(title), word_set(leaf))) / F.greatest(F.size(word_set(leaf)), F.lit(1))


def title_overlap(a: Column, b: Column) -> Column:
    """Common words over the smaller set, stop words left out."""
    stop = F.array(*map(F.lit, STOP_WORDS))
    x, y = F.array_except(word_set(a), stop), F.array_except(word_set(b), stop)
    return F.size(F.array_intersect(x, y)) / F.greatest(F.least(F.size(x), F.size(y)), F.lit(1))


def page_ref(ref: Column) -> Column:
    """A page reference in one spelling: 'A - 2' is 'A-2', '007' is '7'."""
    s = F.trim(F.coalesce(ref, F.lit("")))
    letter, number = r"^([A-E])\s*-\s*([0-9]{1,3})$", r"^[0-9]+$"
    joined = F.concat(F.regexp_extract(s, letter, 1), F.lit("-"), F.regexp_extract(s, letter, 2).try_cast("int").cast("string"))
    return F.when(s.rlike(letter), joined).when(s.rlike(number), F.regexp_replace(s, "^0+(?=[0-9])", "")).otherwise(s)


def footer_token(page_lines: Column) -> Column:
    """The page number or label that a page's lines print, the first rule that applies; '' if none does."""

    def first(of: Column, pattern: str, group: int = 1) -> Column:
        return F.regexp_extract(F.get(F.filter(of, lambda x: x.rlike(pattern)), F.lit(0)), pattern, group)

    def number(x: Column) -> Column:
        return F.regexp_replace(x, "^0+(?=[0-9])", "")

    tail = F.slice(page_lines, F.greatest(F.size(page_lines) - 1, F.lit(1)), 2)
    last = F.get(page_lines, F.size(page_lines) - 1)
    alone, trailing = r"^([A-E])\s*-\s*([0-9]{1,3})$", r"([A-E]-[0-9]{1,3})\s*$"
    label = F.concat(first(tail, alone), F.lit("-"), first(tail, alone, 2).try_cast("int").cast("string"))
    short = (F.length(last) <= 60) & ~last.contains(",") & ~last.contains("$") & (F.regexp_count(last, F.lit("[0-9]+")) <= 2)
    rules = [
        number(first(page_lines, r"\b20[0-9][0-9]\s+([0-9]{1,4})\s*$")),
        number(first(F.slice(page_lines, 1, 3), r"(?i)^Page\s+([0-9]{1,4})\s*$")),
        label,
        number(first(tail, r"(?i)\bPage\s+([0-9]{1,4})\b")),
        page_ref(first(tail, trailing)),
        F.when(short, number(F.regexp_extract(last, r"([0-9]{1,4})\s*$", 1))),
    ]
    return F.when(F.size(page_lines) > 0, F.coalesce(*(F.nullif(r, F.lit("")) for r in rules), F.lit(""))).otherwise("")


def section_key(number: Column) -> Column:
    """A dotted section number as integers, which compare as sections do."""
    return F.transform(F.split(number, "[.]"), lambda x: x.try_cast("int"))


def page_list(text: Column) -> Column:
    """'3+4' as [3, 4]."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "[+]"), lambda x: F.trim(x).try_cast("int")), lambda x: x.isNotNull())


def first_rule(text: Column, rules: list[tuple[str, str]], default: str = "unknown") -> Column:
    """The name of the first rule (name, pattern) that the text matches."""
    out = F.when(F.lit(False), F.lit(default))
    for name, pattern in rules:
        out = out.when(text.rlike(pattern), F.lit(name))
    return out.otherwise(default)


def first_date(text: Column) -> Column:
    """The first day, word and year of a text, as in 31 December 2025; '' if none."""
    return F.regexp_extract(text, r"\b([0-9]{1,2}\s+[A-Za-z]+\s+[0-9]{4})\b", 1)


def auto_label(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def extra_header(name: Column, fields: Column) -> Column:
    """A header of an extra field: its own label, a customary one, or its name in title case."""
    known = F.create_map(*(F.lit(x) for kv in FRIENDLY.items() for x in kv))
    return F.coalesce(F.nullif(F.get(F.array(fields[F.concat(name, F.lit("_label"))]), F.lit(0)), F.lit("")), known[name], auto_label(name))


def without_fences(raw: Column) -> Column:
    """A model's answer without its code fence and what stands before its first brace or bracket."""
    s = F.regexp_replace(F.regexp_replace(F.trim(raw), r"^```[a-zA-Z]*\s*", ""), r"\s*```\s*$", "")
    return F.regexp_replace(s, r"^[^{\[]+(?=[{\[])", "")


def sheet_base(section: Column, title: Column) -> Column:
    """A sheet's name before it is made unique: 31 characters at most, none of the forbidden ones."""
    raw = F.regexp_replace(F.concat_ws(" - ", section, title), r"^[ -]+|[ -]+$", "")
    clean = F.trim(F.regexp_replace(F.regexp_replace(raw, SHEET_FORBIDDEN, " "), r"\s+", " "))
    return F.coalesce(F.nullif(F.substr(clean, F.lit(1), F.lit(31)), F.lit("")), F.nullif(F.substr(section, F.lit(1), F.lit(31)), F.lit("")), F.lit("Sheet"))


def table_sheet_base(section: Column, n: Column) -> Column:
    """The name of a section's n-th table's sheet before it is made unique."""
    raw = F.regexp_replace(F.concat(section, F.lit(" Table "), n.cast("string")), SHEET_FORBIDDEN, " ")
    clean = F.substr(F.trim(F.regexp_replace(raw, r"\s+", " ")), F.lit(1), F.lit(31))
    return F.coalesce(F.nullif(clean, F.lit("")), F.concat(F.lit("t"), n.cast("string")))


def slide_tab_base(slide: Column, title: Column) -> Column:
    """A slide's tab before it is made unique: two digits and twenty characters of its title."""
    short = F.substr(F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), SHEET_FORBIDDEN, "")), F.lit(1), F.lit(20))
    return F.substr(F.concat(F.lpad(slide.cast("string"), 2, "0"), F.lit(" - "), F.coalesce(F.nullif(short, F.lit("")), F.lit("Slide"))), F.lit(1), F.lit(31))


def escaped(text: Column) -> Column:
    """A text as HTML shows it."""
    out = text
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def experiments(documents) -> "DataFrame":  # noqa: F821
    """Logs (doc_id, text) in Markdown as their experiments (doc_id, id, title, status, hypothesis, outcome, learning, decision, on_slides).

    An experiment is a third-level heading with an id, a title and a status, and the table below it.
    """
    head = r"(?i)^###\s+(E-[0-9]+)\s+[—–-]+\s+(.+?)\s+[●•]\s+(\w[\w /\t]+?)(?:\s*/[^\n]*)?\n"
    rows = documents.withColumn("_at", F.locate("## 7.", F.col("text"))).select("doc_id", "_at", F.posexplode(F.split("text", r"(?=###\s+E-[0-9]+)")).alias("_i", "body"), "text")
    rows = rows.filter(F.col("body").rlike(head)).withColumn("id", F.regexp_extract("body", head, 1))
    raw = F.upper(F.trim(F.regexp_extract("body", head, 3)))
    status = F.lit("failed")
    for words, name in ((["DESIGN"], "insight"), (["IMPLEMENT"], "implemented"), (["INSIGHT"], "insight"), (["PARTIAL"], "partial"), (["ADOPT"], "adopted")):
        status = F.when(raw.rlike("|".join(words)), F.lit(name)).otherwise(status)
    field = lambda name: F.substring(F.trim(F.regexp_extract("body", rf"(?s)\|\s*\*\*{name}\*\*\s*\|\s*(.+?)(?=\n\||\z)", 1)), 1, 500).alias(name.lower())
    number = F.regexp_extract("id", "([0-9]+)", 1).try_cast("int")
    on_slides = (number >= 7) | ((F.col("_at") > 1) & (F.instr(F.col("text"), F.col("body")) > F.col("_at")))
    return rows.select("doc_id", "id", F.trim(F.regexp_extract("body", head, 2)).alias("title"), status.alias("status"), *map(field, ("Hypothesis", "Outcome", "Learning", "Decision")), on_slides.alias("on_slides"))


def markdown_field(text: Column, name: str) -> Column:
    """The second cell of the row of a Markdown table whose first is the bold name."""
    return F.trim(F.regexp_extract(text, rf"\|\s*\*\*{name}\*\*\s*\|\s*([^|\n]*)\|", 1))
