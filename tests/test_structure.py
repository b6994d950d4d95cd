"""Structure operators against direct loops, and small literal cases."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tableloom.functions import text as T, values as V
from tableloom.operators import checks, grids, ledger, matching, points, sections
from tableloom.sources import json_files


def direct_parents(rows):
    stack, ids, parents, n = {}, {r["i"]: r["row_id"] for r in rows}, {}, 0
    for r in rows:
        if r["row_type"] == "note":
            parents[r["i"]] = r["parent"]
            continue
        stack = {k: v for k, v in stack.items() if k <= r["level"]}
        up = stack.get(r["level"] - 1) if r["level"] >= 2 else None
        if up is not None and ids[up] is None:
            n += 1
            ids[up] = f"h{n}"
        parents[r["i"]] = ids[up] if up is not None else None
        stack[r["level"]] = r["i"]
    return {i: (ids[i], parents[i]) for i in parents}


def test_fill_parents_equals_a_stack_walk_however_rows_are_dealt(spark):
    r = random.Random(1)
    tables = [[{"t": t, "i": i, "row_id": r.choice([None, f"{i}"]), "level": r.randint(0, 3), "row_type": r.choice(["data"] * 9 + ["note"]), "parent": "own"} for i in range(r.randint(1, 14))] for t in range(60)]
    flat = [x for t in tables for x in t]
    r.shuffle(flat)
    df = spark.createDataFrame(flat, "t int, i int, row_id string, level int, row_type string, parent string").repartition(3)
    got = {(x["t"], x["i"]): (x["row_id"], x["parent"]) for x in grids.fill_parents(df, ["t"], "i", 3).collect()}
    assert got == {(t, i): v for t, rows in enumerate(tables) for i, v in direct_parents(rows).items()}


def test_wrapped_contents_lines_become_entries(spark):
    text = ["PART A: Capital", "1 Scope of the", "report .... A-2", "stray", "1.1 Detail without reference", "2. Second .... 17", "12.2.1 Deep .... 20", "2 Second again 18"]
    lines = spark.createDataFrame([("d", i, x) for i, x in enumerate(text)], "doc_id string, line_no int, line string")
    got = [tuple(r) for r in sections.parse_contents(sections.merge_wrapped(lines)).orderBy("entry").select("kind", "section_id", "title", "page_ref").collect()]
    assert got[0] == ("part", None, "Capital", "")
    assert ("section", "A.1", "Scope of the report", "A-2") in got
    assert ("section", "A.2", "Second", "17") in got and ("section", "A.12.2.1", "Deep", "20") in got
    assert len([g for g in got if g[1] == "A.2"]) == 1


def test_heading_pages_take_numbers_first_and_words_else(spark):
    lines = spark.createDataFrame([("d", 1, 0, "12.2.10 Other"), ("d", 2, 0, "12.2.1 Wanted"), ("d", 3, 1, "The counterparty credit risk table"), ("d", 3, 2, "12,345 6")], "doc_id string, page_no int, line_no int, line string")
    found = spark.createDataFrame([("d", "a", "12.2.1", "x", 1, 3), ("d", "b", "99", "Counterparty Credit Risk", 1, 3), ("d", "c", "12", "x", 3, 3), ("d", "e", "77", "nothing here", 1, 3)], "doc_id string, section_id string, number string, title string, low int, high int")
    got = {r["section_id"]: r["heading_page"] for r in sections.heading_pages(found, lines).collect()}
    assert got == {"a": 2, "b": 3, "c": 3, "e": None}


def test_leaves_know_their_part(spark):
    s = spark.createDataFrame([("d", "A", "1"), ("d", "A", "1.1"), ("d", "B", "1")], "doc_id string, part string, number string")
    assert {(r["part"], r["number"]): r["is_leaf"] for r in sections.leaves(s).collect()} == {("A", "1"): False, ("A", "1.1"): True, ("B", "1"): True}


def test_anchor_prefers_references_and_carries_forward(spark):
    s = spark.createDataFrame([("d", None, "1", "a", "7"), ("d", None, "2", "b", ""), ("d", None, "10", "c", "")], "doc_id string, part string, number string, title string, page_ref string")
    footers = spark.createDataFrame([("d", "7", 9)], "doc_id string, token string, page_no int")
    marks = spark.createDataFrame([("d", 0, "10 Ten", 30), ("d", 1, "10 again", 31)], "doc_id string, ord int, title string, page_no int")
    got = {r["number"]: r["start_page"] for r in sections.anchor(s, footers, sections.outline_map(marks)).collect()}
    assert got == {"1": 9, "2": 9, "10": 30}


def test_two_column_contents_are_paired(spark):
    text = ["1 Intro 2", "2.1", "2.2", "First", "title", "Second", "title", "3 Last 9"]
    lines = spark.createDataFrame([("d", i, x) for i, x in enumerate(text)], "doc_id string, line_no int, line string")
    got = [r["line"] for r in sections.two_column_contents(lines).orderBy("line_no").collect()]
    assert got == ["1 Intro 2", "2.1 First title", "2.2 Second title", "3 Last 9"]


def test_spans_take_the_first_free_places(spark):
    cells = spark.createDataFrame([(1, 0, "a", 2, 1, "A"), (1, 0, "b", 1, 2, "B"), (1, 1, "a", 1, 1, "C"), (1, 1, "b", 1, 1, "D")], "t int, `row` int, ord string, row_span int, col_span int, text string")
    got = {(r["row"], r["col"]): r["text"] for r in grids.expand_spans(cells, ["t"]).collect()}
    assert got == {(0, 0): "A", (1, 0): "↑ (merged)", (0, 1): "B", (0, 2): "", (1, 1): "C", (1, 2): "D"}


def test_rollup_of_tables_leaves_out_what_does_not_add_up(spark):
    rows = spark.createDataFrame([(1, "p", None, "total", "All"), (1, "a", "p", "data", "One"), (1, "b", "p", "data", "Two"), (2, "p", None, "total", "All"), (2, "a", "p", "data", "of which one"), (3, "p", None, "data", "Net"), (3, "a", "p", "data", "Income"), (3, "b", "p", "data", "Cost")], "t int, row_id string, parent string, row_type string, label string")
    cells = spark.createDataFrame([(1, "p", "x", "100"), (1, "a", "x", "(10)"), (1, "b", "x", "90"), (1, "p", "y", "100"), (1, "a", "y", "50"), (1, "b", "y", "51"), (1, "p", "z", "5"), (1, "a", "z", "-"), (1, "b", "z", "9"), (2, "p", "x", "9"), (2, "a", "x", "1"), (3, "p", "x", "9"), (3, "a", "x", "5"), (3, "b", "x", "1")], "t int, row_id string, col_id string, value string")
    got = [tuple(r) for r in checks.rollup_tables(rows, cells, ["t"]).collect()]
    assert got == [(1, "p", "x", 100.0, 80.0)]


def test_self_checks_are_read_not_evaluated(spark):
    rows = spark.createDataFrame([("1+2=3",), ("1+2=3; 4+5=9",), ("5 = 2+3",), ("a=b=c",), (None,), ("[T] 100 - 10 = 80",), ("__import__('os')=1",)], "self_check string")
    got = {r["self_check"]: r["issue"] for r in checks.failed_self_checks(rows).collect()}
    assert got == {"a=b=c": "unparseable", "[T] 100 - 10 = 80": "off", "__import__('os')=1": "unparseable"}
    strict = {r["self_check"] for r in checks.failed_self_checks(rows, strict=True).collect()}
    assert "1+2=3; 4+5=9" in strict


def test_names_stay_unique_when_a_suffix_is_taken(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a (2)"), (3, "a"), (4, "a")], "n int, b string")
    names = [r["name"] for r in ledger.unique_names(rows, "b", ["n"], []).orderBy("n").collect()]
    assert len(set(names)) == 4 and names[0] == "a"


def test_routing_by_tag_title_and_order(spark):
    tables = spark.createDataFrame([(1, 0, "1.2", "whatever"), (1, 1, "", "Credit risk exposures"), (1, 2, "", "zzz")], "page int, l_ord int, section_id string, title string")
    leaves = spark.createDataFrame([(1, 0, "1.1", "Credit risk"), (1, 1, "1.2", "Market risk")], "page int, r_ord int, number string, title string")
    got = {r["l_ord"]: (r["r_ord"], r["method"]) for r in matching.route_tables(tables, leaves).collect()}
    assert got == {0: (1, "section_id"), 1: (0, "title"), 2: (0, "overflow")}


def test_workbooks_are_read_by_label_and_header(spark):
    sheet = [["Unique Row ID", "Level", "Label", "31 Dec 25", "Dec 2024"], ["1", "1", "Loans (1)", "1,234", "-"], ["2", "1", "of which: retail", "(5)", "17.0%"]]
    cells = spark.createDataFrame([("b", "s", r, c, v) for r, row in enumerate(sheet) for c, v in enumerate(row)], "book string, sheet string, r int, c int, value string")
    got = {(r["label"], r["header"]): r["v"]["num"] for r in matching.workbook_cells(cells).collect()}
    assert got == {("loans", "2025-12-31"): 1234.0, ("retail", "2025-12-31"): -5.0, ("retail", "2024-12"): 17.0}


def test_points_from_json(spark):
    raw = '```json\n{"slide_title":"S","elements":[{"element_idx":1,"element_type":"waterfall","source":"chart","data_points":[{"series":"Open","value":"1,200","row_type":"opening","extra_fields":{"yoy_pct":"5%"}},{"series":"x","value":"–","order":7},{"value":"#","row_type":"header"}]}]}\n```'
    rows = points.parse_points(spark.createDataFrame([(3, "b", "D", raw)], "slide int, bank string, doc_title string, raw string")).orderBy("order").collect()
    assert [(r["row_type"], r["status"], r["value_num"], r["order"]) for r in rows] == [("start", "reported", 1200.0, 0), ("section_header", "section_header", None, 2), ("data", "nil", 0.0, 7)]
    assert rows[0]["extra_fields"] == {"yoy_pct": "5%", "yoy_pct_label": "Yoy Pct"} and rows[0]["source_ref"] == "D#slide3:elem1:Open"


def test_first_json_value_is_salvaged(spark):
    rows = spark.createDataFrame([("x {\"a\": [1, {\"b\": 2}]} trailing } text",), ("none",), (None,)], "raw string")
    assert [r["json"] for r in json_files.first_json(rows).collect()] == ['{"a": [1, {"b": 2}]}', None, None]


def test_blocks_are_flattened_with_their_heading(spark):
    raw = '{"document":{"documentLayout":{"blocks":[{"textBlock":{"type":"heading-1","text":"H","blocks":[{"tableBlock":{"headerRows":[{"cells":[{"blocks":[{"textBlock":{"text":"a"}}]}]}],"bodyRows":[{"cells":[{"blocks":[{"textBlock":{"text":"b"}}]}]}]},"pageSpan":{"pageStart":4}}]}}]}}}'
    got = [tuple(r) for r in grids.flatten_blocks(spark.createDataFrame([("d", raw)], "doc_id string, raw string")).collect()]
    assert got == [("d", 0, "H", 4, 0, True, [("a", 1, 1)]), ("d", 0, "H", 4, 1, False, [("b", 1, 1)])]


def test_scalars(spark):
    row = spark.range(1).select(
        T.page_ref(F.lit("A - 02")).alias("ref"), T.page_ref(F.lit("007")).alias("n"), T.page_list(F.lit("3+4")).alias("pages"), T.sheet_base(F.lit("1"), F.lit("a/b: c")).alias("sheet"),
        T.escaped(F.lit("<a&b>")).alias("html"), V.significant(F.lit(123456.0)).alias("sig"), T.row_label(F.lit("Of which: X (1)")).alias("label"), V.lenient_number(F.lit("(1,234.5)%")).alias("odd"),
        T.extra_header(F.lit("yoy_pct"), F.create_map(F.lit("a"), F.lit("b"))).alias("head"), T.markdown_field(F.lit("| **Cost** | $5 |"), "Cost").alias("field"),
    ).first()
    assert tuple(row)[:7] == ("A-2", "7", [3, 4], "1 - a b c", "&lt;a&amp;b&gt;", 123500.0, "x") and row["head"] == "YoY %" and row["field"] == "$5"


def test_stream_sums_by_window(spark, tmp_path):
    from tableloom.streaming import ledger as stream

    spark.sql("select timestamp'2024-01-01 00:10:00' as ts, 'a' as event_type, 2.0D as cost union all select timestamp'2024-01-01 00:50:00', 'a', 3.0D").write.parquet(str(tmp_path / "in"))
    calls = stream.calls_stream(spark, str(tmp_path / "in"), "ts timestamp, event_type string, cost double")
    q = stream.windowed_cost(calls, "cost").writeStream.format("memory").queryName("costs").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert [(r["calls"], r["cost"]) for r in spark.sql("select * from costs").collect()] == [(2, 5.0)]
