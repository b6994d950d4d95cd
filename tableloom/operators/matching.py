"""Matching and comparing: tables to sections, produced to golden, one extraction to another."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tableloom.functions import text as T, values as V


def score_pairs(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str, smaller: bool = False, stop: list[str] | None = None) -> DataFrame:
    """Pairs within the keys whose titles a and b share a word, with their score: an equi join on words, no cross join.

    left has (keys, l_ord, a), right has (keys, r_ord, b).  The score is the share of b's words that a has, or of
    the smaller set's words.
    """
    stop = F.array(*map(F.lit, stop or [])).cast("array<string>")
    words = lambda d, o, t: d.select(*keys, o, F.array_except(T.word_set(F.col(t)), stop).alias("ws")).withColumn("n", F.size("ws")).select(*keys, o, "n", F.explode("ws").alias("w"))
    x, y = words(left, "l_ord", a).withColumnRenamed("n", "nl"), words(right, "r_ord", b).withColumnRenamed("n", "nr")
    of = F.least("nl", "nr") if smaller else F.col("nr")
    return x.join(y, [*keys, "w"]).groupBy(*keys, "l_ord", "r_ord", "nl", "nr").agg(F.count("*").alias("common")).withColumn("score", F.col("common") / of)


def drop_next_section(tables: DataFrame) -> DataFrame:
    """Tables (title, own_title, last_page, next_title, next_start) without those that belong to the next section.

    They go only if that section starts on the unit's last page and its title fits strictly better.
    """
    gone = (F.col("next_start") == F.col("last_page")) & (T.title_score(F.col("title"), F.col("next_title")) > T.title_score(F.col("title"), F.col("own_title")))
    return tables.filter(~F.coalesce(gone, F.lit(False)))


def route_tables(tables: DataFrame, leaves: DataFrame, reuse: float = 0.5, sure: float = 0.34) -> DataFrame:
    """Each table (page, l_ord, section_id, title) of a shared page to one leaf (page, r_ord, number, title).

    A table's tag names its leaf.  Untagged tables take leaves by title score, best first, ties to the earlier pair,
    a leaf that has a table again only from reuse on.  The others go to the leaf of the last placed table above
    them; those above every placed one take the leaves that are left over, in order, and then the last leaf.
    flagged: without a title or tag to go by, below sure, or on a page of more or fewer tables than leaves.
    """
    place = W.partitionBy("page").orderBy(T.section_key(F.col("number")), "r_ord")
    ranked = leaves.withColumn("_k", F.row_number().over(place))
    tags = ranked.groupBy("page", F.col("number").alias("_tag")).agg(F.max("r_ord").alias("_tagged"))
    rows = tables.withColumn("_tag", F.trim(F.coalesce("section_id", F.lit("")))).join(tags, ["page", "_tag"], "left")

    pairs = score_pairs(rows.filter("_tagged is null"), leaves, ["page"], "title", "title").select("page", "l_ord", "r_ord", "score")
    taken = rows.filter("_tagged is not null").select("page", F.col("_tagged").alias("r_ord")).distinct().withColumn("taken", F.lit(True))
    pairs = pairs.join(ranked.select("page", "r_ord", "_k"), ["page", "r_ord"]).join(taken, ["page", "r_ord"], "left").fillna(False, ["taken"])
    kinds = dict(pairs.dtypes)

    def greedy(pairs: pd.DataFrame) -> pd.DataFrame:
        """What a page's pairs take depends on what better pairs took before; a page holds few tables."""
        pairs = pairs.sort_values(["score", "l_ord", "_k"], ascending=[False, True, True])
        full, placed, keep = set(pairs["r_ord"][pairs["taken"]]), set(), []
        for table, leaf, score in zip(pairs["l_ord"], pairs["r_ord"], pairs["score"], strict=True):
            fits = table not in placed and (score >= reuse or leaf not in full)
            keep.append(fits)
            if fits:
                placed.add(table)
                full.add(leaf)
        return pairs.loc[keep, ["page", "l_ord", "r_ord", "score"]]

    titled = pairs.groupBy("page").applyInPandas(greedy, f"page {kinds['page']}, l_ord {kinds['l_ord']}, r_ord {kinds['r_ord']}, score double")
    rows = rows.select("page", "l_ord", "_tagged").join(titled.select("page", "l_ord", F.col("r_ord").alias("_titled"), F.col("score").alias("_score")), ["page", "l_ord"], "left")
    above = W.partitionBy("page").orderBy("l_ord").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_own", F.coalesce("_tagged", "_titled")).withColumn("_above", F.last("_own", True).over(above))
    rows = rows.withColumn("_n", F.row_number().over(W.partitionBy("page", F.coalesce("_own", "_above").isNull()).orderBy("l_ord")))
    free = ranked.join(rows.filter("_own is not null").select("page", F.col("_own").alias("r_ord")).distinct(), ["page", "r_ord"], "left_anti")
    free = free.select("page", F.row_number().over(W.partitionBy("page").orderBy("_k")).alias("_n"), F.col("r_ord").alias("_free"))
    ends = ranked.groupBy("page").agg(F.max_by("r_ord", "_k").alias("_last"), F.count("*").alias("_leaves"))
    sizes = tables.groupBy("page").agg(F.count("*").alias("_tables"))
    rows = rows.join(free, ["page", "_n"], "left").join(ends, "page").join(sizes, "page")
    method = F.when(F.col("_tagged").isNotNull(), "section_id").when(F.col("_titled").isNotNull(), "title").when(F.col("_above").isNotNull(), "overflow").otherwise("order")
    score = F.when(F.col("_tagged").isNotNull(), 1.0).otherwise(F.coalesce("_score", F.lit(0.0)))
    flagged = method.isin("order", "overflow") | (score < sure) | (F.col("_tables") != F.col("_leaves"))
    return rows.select("page", "l_ord", F.coalesce("_own", "_above", "_free", "_last").alias("r_ord"), method.alias("method"), score.alias("score"), flagged.alias("flagged"))


def match_tabs(golden: DataFrame, produced: DataFrame, key: str, least: float = 0.34) -> DataFrame:
    """For each golden tab (key, r_ord, title) in order the best unused produced tab (key, l_ord, title), or none.

    One group is a workbook's tabs.
    """
    pairs = score_pairs(produced, golden, [key], "title", "title", True, T.STOP_WORDS).select(key, "r_ord", "l_ord", "score")
    kinds = dict(pairs.dtypes)

    def take(rows: pd.DataFrame) -> pd.DataFrame:
        used, out = set(), []
        for g, own in rows.sort_values(["r_ord", "score", "l_ord"], ascending=[True, False, True]).groupby("r_ord", sort=True):
            best = next(((p, s) for p, s in zip(own["l_ord"], own["score"], strict=True) if p not in used), None)
            if best and best[1] >= least:
                used.add(best[0])
                out.append((rows[key].iloc[0], g, best[0], float(best[1])))
        return pd.DataFrame(out, columns=[key, "r_ord", "l_ord", "score"])

    found = pairs.groupBy(key).applyInPandas(take, f"{key} {kinds[key]}, r_ord {kinds['r_ord']}, l_ord {kinds['l_ord']}, score double")
    return golden.select(key, "r_ord").join(found, [key, "r_ord"], "left").withColumn("score", F.coalesce(F.round("score", 2), F.lit(0.0)))


def workbook_cells(cells: DataFrame) -> DataFrame:
    """Sheet cells (book, sheet, r, c, value) as (book, sheet, label, header, v): the last value of each key.

    A row with two metadata headers or more begins a table: the column after the last of them has the labels, those
    after it the values.
    """
    meta = F.array(*map(F.lit, ["uniquerowid", "hierarchylevel", "parentrowid", "rowid", "level", "parent"]))
    rows = cells.filter("lower(sheet) not in ('contents', 'table of contents', 'toc')").groupBy("book", "sheet", "r").agg(F.map_from_entries(F.collect_list(F.struct("c", "value"))).alias("row"))
    is_meta = lambda v: F.array_contains(meta, T.key(v))
    headed = F.size(F.array_intersect(F.transform(F.map_values("row"), T.key), meta)) >= 2
    label_col = F.array_max(F.map_keys(F.map_filter("row", lambda c, v: is_meta(v)))) + 1
    heads = F.when(headed, F.struct(label_col.alias("at"), F.map_filter("row", lambda c, v: (c > label_col) & (F.coalesce(v, F.lit("")) != "")).alias("of")))
    rows = rows.withColumn("headed", headed).withColumn("h", F.last(heads, True).over(W.partitionBy("book", "sheet").orderBy("r")))
    rows = rows.filter("not headed and h is not null").withColumn("label", F.col("row")[F.col("h.at")]).filter("coalesce(label, '') <> ''")
    out = rows.select("book", "sheet", "r", T.row_label(F.col("label")).alias("label"), F.col("row"), F.explode("h.of").alias("c", "head"))
    out = out.withColumn("v", V.score_value(F.col("row")[F.col("c")])).filter("v.num is not null or v.txt is not null").withColumn("header", T.column_header(F.col("head")))
    return out.groupBy("book", "sheet", "label", "header").agg(F.max_by("v", F.struct("r", "c")).alias("v"))


def score(golden: DataFrame, produced: DataFrame, keys: list[str], tol: float = 0.51) -> DataFrame:
    """Golden against produced values (keys, v): match, mismatch, missing or extra for every key of either."""
    both = golden.withColumnRenamed("v", "g").join(produced.withColumnRenamed("v", "p"), keys, "full")
    verdict = F.when(F.col("p").isNull(), "missing").when(F.col("g").isNull(), "extra").when(V.equal_values(F.col("g"), F.col("p"), tol), "match").otherwise("mismatch")
    return both.withColumn("verdict", verdict)


def accuracy(verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Counts and accuracy per key of what was scored; extras don't count against it."""
    n = {v: F.count_if(F.col("verdict") == v) for v in ("match", "mismatch", "missing", "extra")}
    of = n["match"] + n["mismatch"] + n["missing"]
    return verdicts.groupBy(*keys).agg(*(c.alias(v) for v, c in n.items()), (n["match"] / F.nullif(of, F.lit(0))).alias("accuracy"))


def sheet_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Cells (keys, value) that differ by position, absent ones being blank."""
    plain = lambda c: F.coalesce(F.trim(c), F.lit(""))
    both = a.withColumnRenamed("value", "a").join(b.withColumnRenamed("value", "b"), keys, "full")
    return both.withColumn("a", plain(F.col("a"))).withColumn("b", plain(F.col("b"))).filter("a <> b")


def sheet_sets(a: DataFrame, b: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Two books' sheets (book, sheet, ord): per book those only in one, and whether shared ones stand in the same order.

    The result is one row per book: only_a, only_b, order_a, order_b (arrays in order), same_order, identical.
    """
    ignore = ignore or []
    side = lambda d, name: d.filter(~F.col("sheet").isin(ignore)).select("book", "sheet", F.col("ord").alias(name))
    both = side(a, "a").join(side(b, "b"), ["book", "sheet"], "full")
    names = lambda when, by: F.transform(F.array_sort(F.collect_list(F.when(when, F.struct(by, "sheet")))), lambda x: x["sheet"])
    shared = F.col("a").isNotNull() & F.col("b").isNotNull()
    out = both.groupBy("book").agg(names(F.col("b").isNull(), "a").alias("only_a"), names(F.col("a").isNull(), "b").alias("only_b"), names(shared, "a").alias("order_a"), names(shared, "b").alias("order_b"))
    out = out.withColumn("same_order", F.col("order_a") == F.col("order_b"))
    return out.withColumn("identical", F.col("same_order") & (F.size("only_a") == 0) & (F.size("only_b") == 0))


def extraction_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two extractions (element, series, period, ord, value) by key: same, changed, only_a, only_b.

    Keys are compared lower-case and trimmed; the last of repeated ones counts; numbers to four digits.
    """
    def side(d: DataFrame, name: str) -> DataFrame:
        keys = [F.lower(F.trim(F.coalesce(k, F.lit("")))).alias(k) for k in ("element", "series", "period")]
        return d.groupBy(*keys).agg(V.comparable(F.max_by("value", "ord")).alias(name))

    both = side(a, "a").join(side(b, "b"), ["element", "series", "period"], "full")
    return both.withColumn("verdict", F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").when(F.col("a") == F.col("b"), "same").otherwise("changed"))


def replace_rows(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """base without the keys that new has, and new: corrections of elements, upserts of an index, forced refreshes."""
    return base.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def upsert_last(index: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """As replace_rows with the last of the new rows of a key."""
    last = new.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))).filter("_n = 1").drop("_n", order)
    return replace_rows(index, last, [key])


def pair_by_position(tables: DataFrame, grids: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The k-th table with the k-th grid; tables beyond the last grid share it, without grids they have none."""
    n = lambda d: d.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(order)))
    counts = grids.groupBy(*keys).agg(F.count("*").alias("_n"))
    rows = n(tables).join(counts, keys, "left").withColumn("_k", F.least("_k", "_n"))
    return rows.drop("_n").join(n(grids).withColumnRenamed(order, "grid").select(*keys, "_k", "grid"), [*keys, "_k"], "left").drop("_k")


def corroborate(points: DataFrame, pages: DataFrame, legacy: bool = False) -> DataFrame:
    """points(page, value, source, extracted_by, confidence) checked against the numbers that pages(page, text) print.

    Found values are verified, others unverified; points whose page prints no numbers, or which don't come from
    text, stay.  Both sides are brought to one form; legacy compares the printed tokens as they are.
    """
    tokens = F.regexp_extract_all("text", F.lit(f"({T.NUMBER_TOKEN})"), F.lit(1)) if legacy else T.number_tokens(F.col("text"))
    seen = pages.select("page", F.explode(tokens).alias("core")).distinct().withColumn("hit", F.lit(True))
    any_ = seen.select("page").distinct().withColumn("layer", F.lit(True))
    strip = r"[,+()]" if legacy else r"[,+()%\s]"
    rows = points.withColumn("core", F.regexp_replace(F.trim(F.regexp_replace("value", strip, "")), "^-+", ""))
    rows = rows.join(seen, ["page", "core"], "left").join(any_, "page", "left")
    apt = (F.col("source") == "table") & F.col("layer") & (F.col("core") != "")
    pick = lambda c, yes, no: F.when(apt & F.col("hit"), yes).when(apt, no).otherwise(F.col(c)).alias(c)
    apt = F.coalesce(apt, F.lit(False))
    rest = [c for c in points.columns if c not in ("source", "extracted_by", "confidence")]
    return rows.select(*rest, F.when(apt & F.col("hit").isNull(), "unverified").otherwise(F.col("source")).alias("source"), pick("extracted_by", F.lit("textlayer-verified"), F.lit("unverified")), pick("confidence", F.lit(1.0), F.lit(0.4)))


def diff_summary(diff: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of the verdicts of extraction_diff and the share that matches, in per cent of all keys."""
    n = {v: F.count_if(F.col("verdict") == v) for v in ("same", "changed", "only_a", "only_b")}
    return diff.groupBy(*keys).agg(F.count("*").alias("total_keys"), *(c.alias(v) for v, c in n.items()), F.round(100 * n["same"] / F.greatest(F.count("*"), F.lit(1)), 1).alias("match_pct"))


def run_comparison(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """Mean match and total costs of compared runs (keys, match_pct, cost_a, cost_b); runs that failed have no match_pct."""
    good = summaries.filter("match_pct is not null")
    return good.groupBy(*keys).agg(F.round(F.avg("match_pct"), 1).alias("avg_match"), F.round(F.sum("cost_a"), 5).alias("cost_a"), F.round(F.sum("cost_b"), 5).alias("cost_b"), F.round(F.sum("cost_a") - F.sum("cost_b"), 5).alias("cost_diff"))


def diff_report(diff: DataFrame, keys: list[str]) -> DataFrame:
    """A comparison as ordered lines of text: (keys, report); what changed, then what one side lacks, then what agrees."""
    key = F.format_string("[%s] %s / %s", F.coalesce("element", F.lit("")), F.coalesce("series", F.lit("")), F.coalesce("period", F.lit("")))
    line = F.when(F.col("verdict") == "changed", F.concat(F.lit("changed: "), key, F.lit(": "), F.coalesce("a", F.lit("")), F.lit(" -> "), F.coalesce("b", F.lit(""))))
    line = line.when(F.col("verdict") == "only_a", F.concat(F.lit("only in a: "), key, F.lit(" = "), F.coalesce("a", F.lit(""))))
    line = line.when(F.col("verdict") == "only_b", F.concat(F.lit("only in b: "), key, F.lit(" = "), F.coalesce("b", F.lit(""))))
    line = line.otherwise(F.concat(F.lit("same: "), key, F.lit(" = "), F.coalesce("a", F.lit(""))))
    rank = F.array_position(F.array(*map(F.lit, ["changed", "only_a", "only_b", "same"])), F.col("verdict"))
    rows = diff.withColumn("_r", rank).withColumn("_l", line)
    ordered = F.array_sort(F.collect_list(F.struct("_r", "element", "series", "period", "_l")))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["_l"]), "\n").alias("report"))


def cached(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The work that no finished unit of the same document, pages and prompt covers."""
    return work.join(done.filter("not partial").select(*keys).distinct(), keys, "left_anti")


def words_in(title: Column) -> Column:
    return F.size(T.word_set(title))
