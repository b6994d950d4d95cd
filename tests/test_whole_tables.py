"""Queries that have to run over whole tables, where their registered SQL looks at a part of them only."""

from __future__ import annotations

import re
from collections import defaultdict

import pytest

from tableloom.functions import text as T
from tableloom.plans import registry
from test_queries import SF, duck, rows  # noqa: F401

PARTS = {
    "sweep_traffic_light": " and l_orderkey % 20 = 0",
    "wanted_pages": " where o_custkey % 50 = 0",
    "span_grid": " where l_orderkey % 4 = 0",
    "date_block_split": " where o_orderkey % 3 > 0",
}


def same(df, result):
    columns, names = sorted(df.columns), [d[0] for d in result.description]
    want = rows(([r[names.index(c)] for c in columns] for r in result.fetchall()), sorted(names))
    return rows(df.select(*(f"`{c}`" for c in columns)).collect(), columns) == want


@pytest.mark.parametrize("name", sorted(PARTS))
def test_query_takes_every_row(spark, duck, name):  # noqa: F811
    assert same(registry.QUERIES[name](spark, SF), duck.execute(registry.ORACLES[name].replace(PARTS[name], "")))


def test_pivot_has_every_period(spark, duck):  # noqa: F811
    years = [y for (y,) in duck.execute("select distinct year(o_orderdate) from orders order by 1").fetchall()]
    columns = ", ".join(f"max(case when period = {y} then v end) as \"{y}\"" for y in years)
    head, tail = registry.ORACLES["pivot_periods"].split("n::int as n, ")[0], " from s left join"
    sql = f"{head}n::int as n, {columns}{tail}{registry.ORACLES['pivot_periods'].split(tail)[1]}"
    assert len(years) > 3 and same(registry.QUERIES["pivot_periods"](spark, SF), duck.execute(sql))


def words(text):
    return set(re.findall("[a-z0-9]+", text.lower()))


def titles(duck):  # noqa: F811
    """By page: tables (page_id, tag, words) and leaves (item_id, words), from whole texts."""
    tables, leaves = defaultdict(list), defaultdict(list)
    for i, html in duck.execute("select page_id, html from pages order by 1").fetchall():
        found = re.search("<title>([^<]*)</title>", html)
        tables[i // 25].append((i, f"1.{i // 25 * 4 + i % 4}" if i % 9 == 0 else "", words(found[1] if found else "")))
    for i, text in duck.execute("select item_id, text from benchmark order by 1").fetchall():
        leaves[i // 4].append((i, words(text)))
    return tables, leaves


def test_tabs_match_on_whole_titles(spark, duck):  # noqa: F811
    tables, leaves = titles(duck)
    want = set()
    for page, own in leaves.items():
        used = set()
        for leaf, ws in own:
            ws = ws - set(T.STOP_WORDS)
            scores = sorted((-len(ws & (o - set(T.STOP_WORDS))) / max(1, min(len(ws), len(o - set(T.STOP_WORDS)))), i) for i, _, o in tables[page] if ws & (o - set(T.STOP_WORDS)))
            best = next(((i, -s) for s, i in scores if i not in used), (None, 0.0))
            if best[1] < 0.34:
                best = (None, 0.0)
            used.add(best[0])
            want.add((page, leaf, best[0], round(best[1], 2)))
    got = {(r["page"], r["r_ord"], r["l_ord"], r["score"]) for r in registry.QUERIES["greedy_tab_match"](spark, SF).collect()}
    assert got == want


def test_routes_score_whole_titles(spark, duck):  # noqa: F811
    tables, leaves = titles(duck)
    for r in registry.QUERIES["greedy_route"](spark, SF).filter("method = 'title'").collect():
        title = next(o for i, _, o in tables[r["page"]] if i == r["l_ord"])
        leaf = dict(leaves[r["page"]])[r["r_ord"]]
        assert r["score"] == pytest.approx(len(title & leaf) / len(leaf), abs=1e-6)
