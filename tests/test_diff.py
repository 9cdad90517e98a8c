"""Drift of two snapshots against a plain comparison, and how often their rows are dealt out."""

import json

import pytest

from tableveil.operators import diff

COLUMNS = "table_name string, column_name string, type string, not_null boolean, `default` string"
OBJECTS = "category string, name string, parent string, def string"
A = [("t", "a", "int", False, None), ("t", "b", "int", True, "0"), ("t", "c", "int", False, None), ("same", "x", "int", False, None), ("gone", "g", "int", False, None), ("gone", "h", "int", True, "1"), ("swap", "old", "int", False, None), ("t", None, "int", False, None), (None, "n", "int", False, None)]
B = [("t", "a", "long", False, "1"), ("t", "b", "int", True, "0"), ("t", "d", "int", False, None), ("same", "x", "int", False, None), ("new", "g", "int", False, None), ("swap", "fresh", "int", True, None), ("t", None, "int", False, None), (None, "n", "int", False, None)]
OA = [("views", "v", None, "one"), ("triggers", "g", "t", "x"), ("triggers", "g", "u", "x"), ("sequences", "s", None, "1"), ("indexes", "i", "t", None), ("views", None, None, "one")]
OB = [("views", "v", None, "two"), ("triggers", "g", "t", "x"), ("sequences", "s", None, "2"), ("indexes", "i", "u", ""), ("constraints", "k", "t", "y"), ("views", None, None, "one")]


@pytest.fixture
def drift(make):
    return diff.compare(make(A, COLUMNS), make(B, COLUMNS), make(OA, OBJECTS), make(OB, OBJECTS))


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_all_differences(drift, make):
    tables = [("gone", "only_in_source"), ("new", "only_in_target"), (None, "only_in_source"), (None, "only_in_target")]
    # A name that is null is like no other, and a table without a name is never on both sides.
    columns = [("t", "c", "only_in_source", "int", False, None), ("t", "d", "only_in_target", "int", False, None), ("swap", "old", "only_in_source", "int", False, None), ("swap", "fresh", "only_in_target", "int", True, None), ("t", None, "only_in_source", "int", False, None), ("t", None, "only_in_target", "int", False, None)]
    drifted = [("t", "a", "int", "long", False, False, None, "1")]
    objects = [("views", "", "v", "modified", "one", "two"), ("triggers", "u", "g", "only_in_source", "x", None), ("constraints", "t", "k", "only_in_target", None, "y"), ("views", "", None, "only_in_source", "one", None), ("views", "", None, "only_in_target", None, "one")]
    for got, want in ((drift.tables, tables), (drift.columns, columns), (drift.column_drift, drifted), (drift.objects, objects)):
        assert rows(got) == sorted(map(repr, want))
    assert rows(diff.columns(make(A, COLUMNS), make(B, COLUMNS))) == sorted(map(repr, columns)) and rows(diff.tables(make(A, COLUMNS), make(B, COLUMNS))) == sorted(map(repr, tables))
    total = drift.summary.first().asDict()
    assert {k: v for k, v in total.items() if v and k != "in_sync"} == {"tables_only_in_source": 2, "tables_only_in_target": 2, "tables_modified": 2, "views_modified": 1, "views_only_in_source": 1, "views_only_in_target": 1, "triggers_only_in_source": 1, "constraints_only_in_target": 1, "diff_count": 11}
    found = [(r["section"], r["name"], json.loads(r["document"])) for r in drift.documents().collect()]
    assert [d for s, _, d in found if s == "summary"] == [total] and len(found) == 12
    t, swap, gone = ({n: d for s, n, d in found if s == "tables"}[n] for n in ("t", "swap", "gone"))
    assert [c["column_name"] for c in t["columns"]] == [None, None, "c", "d"] and t["column_drift"] == [{"column_name": "a", "source_type": "int", "target_type": "long", "source_not_null": False, "target_not_null": False, "source_default": None, "target_default": "1"}]
    assert swap["presence"] is None and swap["column_drift"] is None and gone == {"presence": "only_in_source", "columns": None, "column_drift": None}
    assert not total["in_sync"] and diff.compare(make(A[:4], COLUMNS), make(A[:4], COLUMNS), make(OA[:5], OBJECTS), make(OA[:5], OBJECTS)).summary.first()["in_sync"]


def test_columns_are_dealt_out_once(drift):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(drift.summary).count("Exchange hashpartitioning(table_name") == 1


def test_documents_and_their_summary_share_one_comparison(drift):
    found = drift.documents()
    assert found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Window") == 1 or "ReusedExchange" in final
    assert final.count("Exchange hashpartitioning(table_name") == 1


def test_objects_are_sorted_by_what_differs_early(drift):
    """Keys that begin with the category, or a name made of it, share their first bytes, so that a sort compares whole rows."""
    plan = drift.objects._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [parent#" in plan and "Sort [parent#" in plan and "Sort [category#" not in plan
