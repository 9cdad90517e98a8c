import json

import pytest

from tableveil.queries import QUERIES, SQL

from .compare import assert_same, connect


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_equal_sql(spark, sf, name):
    assert_same(spark, connect(sf), sf, QUERIES[name], SQL[name])


def test_json_reports(spark, sf):
    found = {(r["section"], r["name"]): json.loads(r["document"]) for r in QUERIES["diff_json"](spark, sf).collect()}
    total = found.pop(("summary", ""))
    tables = {n: d for (s, n), d in found.items() if s == "tables"}
    assert total["diff_count"] == len(found) and total["tables_only_in_source"] == sum(d["presence"] == "only_in_source" for d in tables.values())
    assert any(c["default"] is None for d in tables.values() for c in d["columns"] or [])
    rules = QUERIES["discover_json"](spark, sf).first()
    assert set(json.loads(rules["rules"]).values()) <= {"email", "name", "phone", "partial", "hash", "null", "random_int", "constant"}
    assert json.loads(QUERIES["progress_json"](spark, sf).first()["progress"])["tables_total"] == 128


def test_entry(spark, sf):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert rows and {r["full_name"] for r in rows} == {"XXXX"} and {r["status"] for r in rows} == {"active"}
