"""Numbers in a page's text that are a part of another one."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from tableloom.functions import text as T
from tableloom.operators import checks
from tableloom.plans import registry

# The cell of each is a part of its page's number (47488), or ends the year and starts the number (25588).
PARTS = [25588, 45608, 85648, 47488, 53044, 58600]


def recall(spark, folder, keys):
    """recall_by_severity over orders of these customers, and what its SQL returns."""
    spark.createDataFrame(list(enumerate(keys)), "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    columns = ["unit", "kind", "token", "n"]
    got = [tuple(r) for r in registry.QUERIES["recall_by_severity"](spark, str(folder)).select(*columns).collect()]
    c = duckdb.connect()
    c.execute(f"create view orders as select * from '{folder}/orders.parquet/*.parquet'")
    return got, c.execute(f"select {', '.join(columns)} from ({registry.ORACLES['recall_by_severity']})").fetchall()


def test_recall_by_severity_of_cells_within_longer_numbers(spark, tmp_path):
    got, want = recall(spark, tmp_path, PARTS + [k + d for k in PARTS for d in (1, 2, 4)])
    assert sorted(got) == sorted(want)
    assert {u for u, kind, _, _ in got if kind == "phantom"} >= set(PARTS)


def test_recall_by_severity_of_orders_without_a_customer(spark, tmp_path):
    got, want = recall(spark, tmp_path, [None, 4, 5, None])
    assert sorted(map(str, got)) == sorted(map(str, want)) and want


TEXTS = [
    ("4 909 and", "4909", True),
    ("(4,909)", "4909", True),
    ("of 2025 4 909", "4909", True),
    ("x4909 y", "4909", True),
    ("3 4,909.", "4909", True),
    ("1 2.5 0%", "12.50", True),
    ("14909", "4909", False),
    ("49091", "4909", False),
    ("1,4909", "4909", False),
    ("4909.5", "4909", False),
    ("0.4909", "4909", False),
    ("2024 9091", "4909", False),
    ("4909", "4.09", False),
    ("", "4909", False),
]


def test_holds_number(spark):
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(TEXTS)], "i int, text string, token string, want boolean")
    assert [r["i"] for r in df.filter(T.holds_number(F.col("text"), F.col("token")) != F.col("want")).collect()] == []


@pytest.mark.parametrize("whole, phantoms", [(False, {"7777"}), (True, {"4909", "7777"})])
def test_phantoms_by_part_or_whole(spark, whole, phantoms):
    json = spark.createDataFrame([(1, t) for t in ("4909", "5151", "7777")], "unit long, token string")
    pages = spark.createDataFrame([(1, "149 091, 5 151")], "unit long, text string")
    found = checks.number_recall(json, pages, whole=whole).filter("kind = 'phantom'").collect()
    assert {r["token"] for r in found} == phantoms
