from __future__ import annotations

import pytest

ODD_TEXTS = [None, "", " \n\t ", "one", "a b c", "x" * 60000, ("long words here and there " * 4000), "Ünï ©ode 你好\n\nline", "a\nb\na\nb"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows and columns with clashing names."""
    rows = [(i, t, f"s{i % 2}", i) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "one", "s1", 3), (None, "one", None, None), (None, None, None, None), (50, "one", None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long").withColumnsRenamed({}).selectExpr("*", "'x' as lang", "1 as n_chars", "2 as score", "3 as component_id", "4 as block")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
