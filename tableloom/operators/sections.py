"""From page lines to a section tree with page ranges, and from there to work units.

Inputs are long: lines(doc_id, page_no, line_no, line), sections(doc_id, part, number, title, page_ref).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tableloom.functions import text as T

# The grammar of printed contents.
PART = r"(?i)^PART\s+([A-Z])\b\s*[:\-]?\s*(.+?)(?:\.{2,}|…|$)"
ENTRY = r"^\s*[0-9]+(?:[.][0-9]+)*[.]?\s+\S"
REF_END = r"([A-E]-[0-9]{1,3}|[0-9]{1,4})\s*$"
WITH_REF = r"^([0-9]+(?:[.][0-9]+)*)[.]?\s+(.+?)[\s.…]{2,}\s*([A-E]-[0-9]{1,3}|[0-9]{1,4})\s*$"
WITHOUT_REF = r"^([0-9]+[.][0-9]+(?:[.][0-9]+)*)[.]?\s*([A-Za-z(].*?)?\s*$"
BARE_NUMBER = r"^[0-9]+[.][0-9]+(?:[.][0-9]+)*$"
OLD_PART = r"(?i)^PART\s+([A-Z])\s*[:\-]\s*(.+?)(?:\.{2,}|…|$)"
OLD_ENTRY = r"^([0-9]+(?:[.][0-9]+)*)\s+(.+?)(?:[.…\s]{2,}\s*([A-E]-[0-9]+))?\s*$"
OLD_PARTS = {"B": r"(?i)^20\s|^Part\s*B\b", "C": r"(?i)^21\s|^Part\s*C\b", "D": r"(?i)^22\s|^Part\s*D\b|^Attest", "E": r"(?i)^23\s|^Part\s*E\b|^Abbrev"}
OLD_STRUCTURE = "(?i)^(cover|content)s?$"
PAGE_HEAD = r"(?i)CONTENTS\s+Page|DBS GROUP|OCBC|UOB GROUP"


def page_lines(pages: DataFrame) -> DataFrame:
    """pages(doc_id, page_no, text) as (doc_id, page_no, line_no, line), trimmed and without empty lines."""
    return pages.select("doc_id", "page_no", F.posexplode(T.lines(F.col("text"))).alias("line_no", "line"))


def footer_map(pages: DataFrame) -> DataFrame:
    """(doc_id, token, page_no): the first page that prints each page label."""
    token = T.footer_token(T.lines(F.col("text")))
    return pages.select("doc_id", "page_no", token.alias("token")).filter("token <> ''").groupBy("doc_id", "token").agg(F.min("page_no").alias("page_no"))


def outline_map(outline: DataFrame) -> DataFrame:
    """outline(doc_id, ord, title, page_no) as the first page of each leading section number."""
    number = F.regexp_extract(F.trim("title"), r"^([0-9]+(?:[.][0-9]+)*)\b", 1)
    return outline.select("doc_id", "ord", "page_no", number.alias("number")).filter("number <> '' and page_no is not null").groupBy("doc_id", "number").agg(F.min_by("page_no", "ord").alias("page_no"))


def merge_wrapped(lines: DataFrame) -> DataFrame:
    """Contents lines (doc_id, line_no, line) as logical entries (doc_id, entry, line).

    An entry begins at a part or a numbered line and takes the lines below it until one ends in a page
    reference; stray lines after that are ignored.
    """
    w = W.partitionBy("doc_id").orderBy("line_no")
    is_part = F.regexp_replace("line", r"[.…]{2,}", "  ").rlike(PART)
    rows = lines.withColumn("part", is_part).withColumn("entry", F.sum((F.col("part") | F.col("line").rlike(ENTRY)).cast("int")).over(w)).filter("entry > 0")
    done = (F.col("part") | F.col("line").rlike(REF_END)).cast("int")
    within = W.partitionBy("doc_id", "entry").orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum(done).over(within), F.lit(0))).filter("before = 0")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), " ")
    return rows.groupBy("doc_id", "entry").agg(joined.alias("line"))


def parse_contents(entries: DataFrame) -> DataFrame:
    """Logical entries as (doc_id, entry, kind, part, number, section_id, title, page_ref), the first of each id."""
    clean = F.regexp_replace("line", r"[.…]{2,}", "  ")
    part = F.nullif(F.upper(F.regexp_extract(clean, PART, 1)), F.lit(""))
    rows = entries.withColumn("own", part).withColumn("part", F.last("own", True).over(W.partitionBy("doc_id").orderBy("entry")))
    ref, bare = F.col("line").rlike(WITH_REF), F.col("line").rlike(WITHOUT_REF)
    number = F.when(ref, F.regexp_extract("line", WITH_REF, 1)).otherwise(F.regexp_extract("line", WITHOUT_REF, 1))
    plain = F.rtrim(F.regexp_replace(F.regexp_extract("line", WITHOUT_REF, 2), "[. ]+$", ""))
    title = F.when(F.col("own").isNotNull(), F.regexp_replace(F.trim(F.regexp_extract(clean, PART, 2)), "[. ]+$", "")).when(ref, F.regexp_extract("line", WITH_REF, 2)).otherwise(F.coalesce(F.nullif(plain, F.lit("")), number))
    rows = rows.filter(F.col("own").isNotNull() | ref | bare).select(
        "doc_id",
        "entry",
        F.when(F.col("own").isNotNull(), "part").otherwise("section").alias("kind"),
        "part",
        F.when(F.col("own").isNull(), number).alias("number"),
        F.when(F.col("own").isNull(), F.concat_ws(".", "part", number)).alias("section_id"),
        title.alias("title"),
        F.when(F.col("own").isNull() & ref, T.page_ref(F.regexp_extract("line", WITH_REF, 3))).otherwise("").alias("page_ref"),
    )
    return keep_first(rows, ["doc_id", "kind", F.coalesce("section_id", "part")], ["entry"])


def legacy_contents(lines: DataFrame) -> DataFrame:
    """Contents lines (doc_id, line_no, line) by the older grammar: (doc_id, entry, kind, part, number, section_id, title, doc_page).

    An entry is one line, sections count within a part only, and a page is a part's letter and a number.
    """
    clean = F.trim(F.regexp_replace(F.trim("line"), r"[.…]{2,}", "  "))
    rows = lines.withColumn("_c", clean).withColumn("_own", F.nullif(F.upper(F.regexp_extract("_c", OLD_PART, 1)), F.lit("")))
    rows = rows.withColumn("part", F.last("_own", True).over(W.partitionBy("doc_id").orderBy("line_no")))
    head, entry = F.col("_own").isNotNull(), F.col("_c").rlike(OLD_ENTRY) & F.col("part").isNotNull()
    number = F.when(head, F.col("part")).otherwise(F.regexp_extract("_c", OLD_ENTRY, 1))
    title = F.when(head, F.regexp_extract("_c", OLD_PART, 2)).otherwise(F.regexp_extract("_c", OLD_ENTRY, 2))
    page = F.when(head, F.regexp_extract("_c", r"([A-E]-[0-9]+)\s*$", 1)).otherwise(F.regexp_extract("_c", OLD_ENTRY, 3))
    rows = rows.filter(head | entry).select("doc_id", F.col("line_no").alias("entry"), F.when(head, "part").otherwise("section").alias("kind"), "part", number.alias("number"), F.when(~head, F.concat_ws(".", "part", number)).alias("section_id"), F.regexp_replace(F.trim(title), "[. ]+$", "").alias("title"), F.nullif(page, F.lit("")).alias("doc_page"))
    return keep_first(rows, ["doc_id", "kind", F.coalesce("section_id", "part")], ["entry"])


def part_starts(outline: DataFrame) -> DataFrame:
    """(doc_id, part, start_page) from bookmarks (doc_id, ord, title, page_no): the first that names each part; A from the fifth page on."""
    rows = outline.filter("page_no is not null").withColumn("title", F.trim("title"))
    named = [rows.filter(F.col("title").rlike(pattern)).withColumn("part", F.lit(part)) for part, pattern in OLD_PARTS.items()]
    found = named[0]
    for more in named[1:]:
        found = found.unionByName(more)
    found = found.groupBy("doc_id", "part").agg(F.min_by("page_no", "ord").alias("start_page"))
    body = rows.filter(~F.col("title").rlike(OLD_STRUCTURE) & (F.col("page_no") >= 5))
    first = outline.select("doc_id").distinct().join(body.groupBy("doc_id").agg(F.min_by("page_no", "ord").alias("start_page")), "doc_id", "left")
    return found.unionByName(first.select("doc_id", F.lit("A").alias("part"), F.coalesce("start_page", F.lit(5)).alias("start_page")))


def spread_anchors(sections: DataFrame, parts: DataFrame, anchors: DataFrame) -> DataFrame:
    """Sections (doc_id, part, number, entry) with pages, from the bookmarks' pages (doc_id, page_no) within parts (doc_id, part, start_page, end_page).

    Top sections take the pages in order, those beyond the last page the last one, and end before the next one.
    If there are pages left over for all sections below them, these take them in order, else their top section's pages.
    """
    pages = parts.join(anchors.select("doc_id", "page_no").distinct(), "doc_id").filter("page_no between start_page and end_page").groupBy("doc_id", "part").agg(F.sort_array(F.collect_set("page_no")).alias("_pages"))
    none = F.array().cast("array<int>")
    rows = sections.join(parts.withColumnsRenamed({"start_page": "_low", "end_page": "_high"}), ["doc_id", "part"]).join(pages, ["doc_id", "part"], "left").withColumn("_pages", F.coalesce("_pages", none))
    own = W.partitionBy("doc_id", "part").orderBy("entry")
    tops = rows.filter(~F.col("number").contains(".")).withColumn("_i", F.row_number().over(own))
    tops = tops.withColumn("start_page", F.coalesce(F.get("_pages", F.least(F.col("_i"), F.size("_pages")) - 1), F.col("_low")))
    following = F.lead("start_page").over(own)
    tops = tops.withColumn("end_page", F.when(following.isNotNull(), F.greatest("start_page", following - 1)).otherwise(F.col("_high")))
    used = tops.groupBy("doc_id", "part").agg(F.collect_set("start_page").alias("_used"))
    subs = rows.filter(F.col("number").contains(".")).withColumn("_i", F.row_number().over(own)).withColumn("_n", F.count("*").over(W.partitionBy("doc_id", "part"))).join(used, ["doc_id", "part"], "left")
    free = F.array_except("_pages", F.coalesce("_used", none))
    lead = tops.select("doc_id", "part", F.col("number").alias("_top"), F.col("start_page").alias("_s"), F.col("end_page").alias("_e"))
    subs = subs.withColumn("_top", F.split("number", "[.]")[0]).join(lead, ["doc_id", "part", "_top"], "left").withColumn("_own", F.when(F.size(free) >= F.col("_n"), F.get(free, F.col("_i") - 1)))
    subs = subs.withColumn("start_page", F.coalesce("_own", "_s")).withColumn("end_page", F.coalesce("_own", "_e"))
    keep = [*sections.columns, "start_page", "end_page"]
    return tops.select(keep).unionByName(subs.select(keep))


def keep_first(rows: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key, in the given total order."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def prefixes(number: Column) -> Column:
    """'1.2.3' as ['1', '1.2', '1.2.3']."""
    parts = F.split(number, "[.]")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))


def leaves(sections: DataFrame) -> DataFrame:
    """Sections (doc_id, part, number) with is_leaf: no other section of the same part continues the number."""
    inner = sections.select("doc_id", F.coalesce("part", F.lit("")).alias("p"), F.explode(F.filter(prefixes(F.col("number")), lambda x, i: x != F.col("number"))).alias("number")).distinct().withColumn("inner", F.lit(True))
    out = sections.withColumn("p", F.coalesce("part", F.lit("")))
    return out.join(inner, ["doc_id", "p", "number"], "left").withColumn("is_leaf", F.col("inner").isNull()).drop("p", "inner")


def node_ranges(sections: DataFrame) -> DataFrame:
    """(doc_id, part, number, start_page, end_page) of every node: the range of the leaves below it, itself included."""
    rows = sections.select("doc_id", "part", F.explode(prefixes(F.col("number"))).alias("number"), "start_page", "end_page")
    return rows.groupBy("doc_id", "part", "number").agg(F.min("start_page").alias("start_page"), F.max("end_page").alias("end_page"))


def reading_order() -> list[Column]:
    part = F.when(F.col("part").isNull(), 0).otherwise(F.ascii("part") - 65)
    return [part, T.section_key(F.col("number"))]


def anchor(sections: DataFrame, footers: DataFrame, outline: DataFrame) -> DataFrame:
    """Sections with start_page: by page reference, else bookmark, else part label and number, else the one before."""
    f = lambda name, to: footers.select("doc_id", F.col("token").alias(name), F.col("page_no").alias(to))
    rows = sections.join(f("page_ref", "by_ref"), ["doc_id", "page_ref"], "left")
    rows = rows.join(outline.select("doc_id", "number", F.col("page_no").alias("by_mark")), ["doc_id", "number"], "left")
    rows = rows.withColumn("label", F.concat_ws("-", "part", "number")).join(f("label", "by_label"), ["doc_id", "label"], "left")
    return carry_forward(rows.withColumn("found", F.coalesce("by_ref", "by_mark", "by_label")), "found", ["doc_id"], reading_order(), F.lit(1), "start_page").drop("by_ref", "by_mark", "by_label", "label")


def carry_forward(rows: DataFrame, column: str, keys: list[str], order: list, default: Column, out: str) -> DataFrame:
    """Nulls of column take the last value before them, or the default."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(out, F.coalesce(F.last(column, True).over(w), default))


def end_pages(sections: DataFrame, keys: list[str], order: list, last: Column) -> DataFrame:
    """end_page of each section: the page before the next one's start, not before its own; the last one's is given."""
    following = F.lead("start_page").over(W.partitionBy(*keys).orderBy("start_page", *order))
    return sections.withColumn("end_page", F.coalesce(F.greatest("start_page", following - 1), last))


def heading_pages(sections: DataFrame, lines: DataFrame, top: int = 9, cover: float = 0.8) -> DataFrame:
    """Sections (doc_id, section_id, number, title, low, high) with heading_page.

    The first page of the range with a line that starts with the number; else the first with a line among its top
    ones that has most of the title's words.  A line offers every dotted prefix of its leading number, so the first
    rule is an equi join; only sections it leaves over go to the second, joined by title word.
    """
    lead = F.regexp_extract("line", r"^([0-9]+(?:[.][0-9]+)*)", 1)
    whole = F.regexp_extract("line", r"^[0-9]+(?:[.][0-9]+)*(\w?)", 1) == ""
    offers = lines.withColumn("lead", lead).filter("lead <> ''").select("doc_id", "page_no", F.explode(F.filter(prefixes(F.col("lead")), lambda x: (x != F.col("lead")) | whole)).alias("number")).distinct()
    exact = sections.join(offers, ["doc_id", "number"]).filter("page_no between low and high").groupBy("doc_id", "section_id").agg(F.min("page_no").alias("exact"))
    rows = sections.join(exact, ["doc_id", "section_id"], "left")
    rest = rows.filter("exact is null").select("doc_id", "section_id", "low", "high", T.word_set(F.col("title")).alias("ws")).filter(F.size("ws") > 0)
    rest = rest.withColumn("word", F.explode("ws"))
    heads = lines.filter(F.col("line_no") < top).select("doc_id", "page_no", "line_no", F.explode(T.word_set(F.col("line"))).alias("word"))
    hits = rest.join(heads, ["doc_id", "word"]).filter("page_no between low and high").groupBy("doc_id", "section_id", "page_no", "line_no").agg(F.count("*").alias("n"), F.first(F.size("ws")).alias("of"))
    loose = hits.filter(F.col("n") / F.col("of") >= cover).groupBy("doc_id", "section_id").agg(F.min("page_no").alias("loose"))
    return rows.join(loose, ["doc_id", "section_id"], "left").withColumn("heading_page", F.coalesce("exact", "loose")).drop("exact", "loose")


def refine_ends(sections: DataFrame, lines: DataFrame) -> DataFrame:
    """Sections with end_page raised to the last page, one past the range at most, that has a line with their number.

    The page after the range counts only if that line is marked as continued.
    """
    lead = F.regexp_extract("line", r"^([0-9]+(?:[.][0-9]+)*)", 1)
    offers = lines.withColumn("lead", lead).filter("lead <> ''").select("doc_id", "page_no", F.col("line").rlike(r"(?i)\(cont").alias("cont"), F.explode(prefixes(F.col("lead"))).alias("number"))
    hits = sections.select("doc_id", "section_id", "number", "start_page", "end_page").join(offers, ["doc_id", "number"])
    hits = hits.filter("page_no >= start_page and (page_no <= end_page or page_no = end_page + 1 and cont)").groupBy("doc_id", "section_id").agg(F.max("page_no").alias("last_page"))
    return sections.join(hits, ["doc_id", "section_id"], "left").withColumn("end_page", F.greatest("end_page", "last_page")).drop("last_page")


def shared_starts(sections: DataFrame) -> DataFrame:
    """Pages on which several sections start, with their ids in reading order."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(T.section_key(F.col("number")).alias("k"), "section_id"))), lambda x: x["section_id"]), ", ")
    return sections.groupBy("doc_id", "start_page").agg(F.count("*").alias("n"), ids.alias("section_ids")).filter("n > 1")


def part_ranges(sections: DataFrame) -> DataFrame:
    return sections.filter("part is not null").groupBy("doc_id", "part").agg(F.min("start_page").alias("start_page"), F.max("end_page").alias("end_page"))


def units(sections: DataFrame) -> DataFrame:
    """Every leaf as a work unit with its pages and the leaf that follows it."""
    following = F.lead(F.struct("section_id", "title", "start_page")).over(W.partitionBy("doc_id").orderBy("start_page", *reading_order()))
    return sections.withColumn("pages", F.sequence("start_page", F.greatest("start_page", "end_page"))).withColumn("next_leaf", following).withColumn("group_key", F.concat_ws(".", "part", F.split("number", "[.]")[0]))


def page_owners(ranges: DataFrame, keys: list[str], low: str, high: str) -> DataFrame:
    """Pages of [low, high] ranges with the number of ranges that own each; more than one makes it a shared page."""
    pages = ranges.select(*keys, F.explode(F.sequence(low, high)).alias("page"))
    return pages.groupBy(*keys, "page").agg(F.count("*").alias("owners")).withColumn("kind", F.when(F.col("owners") > 1, "multiple").otherwise("own"))


def runs(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Maximal runs of consecutive integers: (keys, low, high, n)."""
    distinct = rows.select(*keys, value).distinct()
    island = F.col(value) - F.row_number().over(W.partitionBy(*keys).orderBy(value))
    return distinct.withColumn("_i", island).groupBy(*keys, "_i").agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n")).drop("_i")


def chunks(rows: DataFrame, keys: list[str], order: str, size: int = 2, whole_from: int = 5) -> DataFrame:
    """chunk of each page: so many at a time, or all in one where there are at least whole_from of them."""
    w = W.partitionBy(*keys)
    n, rn = F.count("*").over(w), F.row_number().over(w.orderBy(order))
    return rows.withColumn("chunk", F.when(n >= whole_from, 0).otherwise(F.floor((rn - 1) / size)).cast("int"))


def two_column_contents(lines: DataFrame) -> DataFrame:
    """Contents lines (doc_id, line_no, line) with two-column pages repaired.

    Text extraction can give a page's dotted section numbers as a run of bare numbers and their titles as a block of
    lines further down.  The numbers of a run of at least two, each no more than three lines after the one before,
    take equal shares of the block's lines, the last one the remainder; the block's own lines go.  The block begins at
    the first line that begins no entry among the thirty after the run, and ends before the next entry or page head.
    A run with more numbers than the block has lines stays.  A document's contents are small; each is one group.
    """
    import re

    import pandas as pd

    bare, entry, part, head = (re.compile(x) for x in (BARE_NUMBER, ENTRY, PART, PAGE_HEAD))

    def opens(line: str) -> bool:
        return bool(entry.match(line) or part.match(re.sub(r"[.…]{2,}", "  ", line)))

    def repair(doc: pd.DataFrame) -> pd.DataFrame:
        doc = doc.sort_values("line_no", ignore_index=True)
        line, place = doc["line"].tolist(), doc["line_no"]
        numbers = doc.index[[bool(bare.match(x)) for x in line]].to_series()
        run = (place[numbers].diff() > 3).cumsum()
        gone: set[int] = set()
        for _, own in numbers.groupby(run.to_numpy()):
            after = [i for i in range(own.iloc[-1] + 1, len(line)) if not opens(line[i])]
            if len(own) < 2 or not after or place[after[0]] > place[own.iloc[-1]] + 30:
                continue
            stop = next((i for i in range(after[0], len(line)) if opens(line[i]) or head.search(line[i])), len(line))
            block = range(after[0], stop)
            share = len(block) // len(own)
            for k, i in enumerate(own if share else []):
                mine = block[k * share :] if k == len(own) - 1 else block[k * share : (k + 1) * share]
                line[i] = " ".join([line[i], *(doc["line"][j] for j in mine)])
                gone.update(mine)
        return doc.assign(line=line).drop(index=list(gone))

    kinds = dict(lines.dtypes)
    return lines.select("doc_id", "line_no", "line").groupBy("doc_id").applyInPandas(repair, f"doc_id {kinds['doc_id']}, line_no {kinds['line_no']}, line string")
