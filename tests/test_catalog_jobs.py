import pytest
from pyspark.sql import functions as F

from tableveil.functions.sensitivity import classify, ordered, rules
from tableveil.operators import checks, clone, diff, masking, runlog, verify
from tableveil.plans.spec import SpecError
from tableveil.queries import fresh, source
from tableveil.sources import catalog


@pytest.fixture
def shop(spark):
    fresh(spark, "t_shop", "t_copy")
    spark.sql("CREATE TABLE t_shop.items (id INT, name VARCHAR(20) DEFAULT 'none', price DECIMAL(10,2)) USING parquet")
    spark.sql("INSERT INTO t_shop.items VALUES (1, 'pen', 1.50), (2, 'ink', 3.00), (3, NULL, NULL)")
    spark.sql("CREATE TABLE t_shop.empty (x BIGINT) USING parquet")
    return "t_shop"


def test_structure_keeps_types_and_defaults(spark, shop):
    result = clone.clone_table(spark, shop, "items", "t_copy", {"include_data": False})
    assert (result.status, result.rows) == ("done", 0) and spark.table("t_copy.items").count() == 0
    a, b = (catalog.columns_snapshot(spark, s).where("table_name = 'items'").drop("schema_name").collect() for s in (shop, "t_copy"))
    assert a == b and any(r["default"] for r in b)


def test_conflicts(spark, shop):
    assert clone.clone_table(spark, shop, "items", "t_copy").rows == 3
    assert clone.clone_table(spark, shop, "items", "t_copy", {"conflict": "error"}).status == "failed"
    assert clone.clone_table(spark, shop, "items", "t_copy", {"conflict": "skip"}).status == "skipped"
    assert clone.clone_table(spark, shop, "items", "t_copy", {"conflict": "replace", "where": "id = 1"}).rows == 1
    assert spark.table("t_copy.items").count() == 1
    # A replacement may read what it replaces.
    assert clone.clone_frame(spark.table("t_copy.items"), "t_copy", "items", {"conflict": "replace"}).rows == 1
    assert clone.clone_table(spark, shop, "items", "t_copy", {"conflict": "rename"}).rows == 3
    assert spark.table("t_copy.items_old").count() == 1
    assert clone.clone_table(spark, shop, "items", "t_copy", {"conflict": "rename"}).status == "failed"
    assert clone.clone_table(spark, shop, "nothing", "t_copy").status == "failed"


def test_schema_with_views_on_views(spark, shop):
    spark.sql("CREATE VIEW t_shop.z_cheap AS SELECT id FROM t_shop.items WHERE price < 2")
    spark.sql("CREATE VIEW t_shop.a_top AS SELECT max(id) AS m FROM t_shop.z_cheap")
    catalog.create_matview(spark, shop, "totals", "SELECT count(*) AS n, 'it''s' AS tag FROM t_shop.items;")
    spark.sql("INSERT INTO t_shop.items VALUES (4, 'nib', 1.00)")
    results = {r.table_name: r for r in clone.clone_schema(spark, shop, "t_copy", {"parallel": 2})}
    assert {r.status for r in results.values()} == {"done"} and set(results) == {"items", "empty", "z_cheap", "a_top", "totals"}
    assert spark.table("t_copy.a_top").first()["m"] == 4
    assert spark.table("t_copy.totals").first()["n"] == 4  # computed anew
    assert "t_copy" in catalog.views(spark, "t_copy")["a_top"]
    with pytest.raises(SpecError):
        clone.clone_schema(spark, "no_such_schema", "t_copy")


def test_views_and_matviews_are_made_in_the_order_they_read_one_another(spark, shop):
    catalog.create_matview(spark, shop, "z_base", "SELECT id, price FROM t_shop.items")
    spark.sql("CREATE VIEW t_shop.y_over AS SELECT max(id) AS m FROM t_shop.z_base")  # a view on a materialized view
    catalog.create_matview(spark, shop, "a_last", "WITH empty AS (SELECT m FROM t_shop.y_over) SELECT m, 'empty' AS tag FROM empty")
    spark.sql("CREATE VIEW t_shop.b_both AS SELECT z.id AS items FROM t_shop.z_base AS z JOIN t_shop.y_over ON z.id = m")
    spark.sql("CREATE TABLE t_shop.gone (x INT) USING parquet")
    spark.sql("CREATE VIEW t_shop.broken AS SELECT x FROM t_shop.gone")
    spark.sql("CREATE VIEW t_shop.c_on_broken AS SELECT x FROM t_shop.broken")
    spark.sql("DROP TABLE t_shop.gone")
    assert catalog.relations_read(spark, shop, "WITH empty AS (SELECT * FROM t_shop.y_over) SELECT 't_shop.items', m FROM empty;") == {"y_over", "z_base"}
    results = {r.table_name: r for r in clone.clone_schema(spark, shop, "t_copy", {"parallel": 3})}
    assert {n for n, r in results.items() if r.status == "failed"} == {"broken", "c_on_broken"} and results["broken"].error
    assert (spark.table("t_copy.a_last").first().asDict(), spark.table("t_copy.b_both").first()["items"]) == ({"m": 3, "tag": "empty"}, 3)
    assert spark.catalog.currentDatabase() == "default"
    # With a prefix, a CTE or a column named like a table that the query does not read keeps its name.
    fresh(spark, "t_one")
    clone.clone_schema(spark, shop, "t_one", prefix="s__")
    assert spark.table("t_one.s__a_last").first()["tag"] == "empty" and spark.table("t_one.s__b_both").columns == ["items"]


def test_views_that_read_one_another_in_a_cycle_end():
    assert clone.levels(["a", "b", "c"], {"a": {"b"}, "b": {"a"}, "c": {"a"}}) == [["a", "b", "c"]]


def test_in_place_and_policies(spark, shop):
    clone.clone_table(spark, shop, "items", "t_copy")
    policies = masking.Policies(spark, "t_copy")
    policies.create("t_copy", "items", {"name": "name", "price": {"type": "constant", "value": "it's"}}, "owner")
    assert {r["name"] for r in policies.read_as("guest", "t_copy", "items").collect()} == {"XXXX", None}
    assert {r["price"] for r in spark.table("t_copy.items_masked").collect()} == {"it's"}
    assert policies.read_as("owner", "t_copy", "items").where("name = 'pen'").count() == 1
    policies.drop("t_copy", "items")
    assert policies.current().count() == 0 and spark.table("t_copy.items").count() == 3
    assert masking.mask_in_place(spark, "t_copy", "items", {"name": "hash"}) == (3, 1)
    assert spark.table("t_copy.items").where("length(name) = 32").count() == 2
    with pytest.raises(SpecError):
        masking.mask_in_place(spark, "t_copy", "items", {})
    with pytest.raises(SpecError):
        masking.mask_in_place(spark, "t_copy", "items", {"price": "name"})


def test_resume_retries_failures(spark, shop):
    fresh(spark, "t_log")
    spark.sql("CREATE TABLE t_copy.empty (x BIGINT) USING parquet")
    first = runlog.run_schema(spark, "t_log", 7, shop, "t_copy", {"conflict": "error"})
    assert {r.table_name: r.status for r in first} == {"empty": "failed", "items": "done"}
    again = runlog.resume(spark, "t_log", 7, shop, "t_copy", {"conflict": "replace"})
    assert {r.table_name: r.status for r in again} == {"empty": "done"}
    log = spark.table("t_log.run_log")
    assert runlog.latest(log).first()["status"] == "completed"
    line = runlog.progress(log, F.lit("2030-01-01").cast("timestamp")).first()
    assert line["progress_text"].endswith("elapsed") and "%" in line["progress_text"] and len(line["progress_bar"]) == 20


def test_verify_stats_mode(spark, shop):
    assert {r["table_name"]: r["n"] for r in verify.catalog_counts(spark, [shop], "stats").collect()} == {"items": 0, "empty": 0}
    spark.sql("ANALYZE TABLE t_shop.items COMPUTE STATISTICS")
    assert {r["table_name"]: r["n"] for r in verify.catalog_counts(spark, [shop], "stats").collect()} == {"items": 3, "empty": 0}


def test_first_rule_wins(spark):
    names = {"Email_Address": "email", "ip_address": "constant", "CNAME": None, "user_name": "name", "zipcode": "partial", "classname": "null", "adobe": "null", "qty": None, "telephone": "phone"}
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", classify(F.col("n"))["strategy"].alias("s")).collect()
    assert {r["n"]: r["s"] for r in got} == names and len(ordered()) == 42


def test_rules_equal_brute_force(spark):
    import random

    rng = random.Random(1)
    parts = [p.strip("%") for _, p, *_ in ordered()] + ["x", "_", "a", "id", "e", "name", "zi", "p", "\n", "."]
    names = ["".join(rng.choice(parts) for _ in range(rng.randrange(5))) for _ in range(3000)]
    want = {n: next((i for i, p, *_ in ordered() if (p.strip("%") in n if p.endswith("%") else n.endswith(p.strip("%")))), None) for n in names}
    got = spark.createDataFrame([(n,) for n in want], "n string").select("n", classify(F.upper("n"))["ord"].alias("o")).collect()
    assert {r["n"]: r["o"] for r in got} == want


def test_checks_with_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (None, 3), (None, 3)], "a int, b int")
    first = lambda x: x.first()["violations"]
    assert first(checks.unique(df, ["a"], "s", "t", "u")) == 1
    assert first(checks.primary_key(df, ["a"], "s", "t", "p")) == 3
    assert first(checks.predicate(df, "b > 2", "s", "t", "c")) == 1
    assert first(checks.foreign_key(df, ["a"], df.where("a is null"), ["a"], "s", "t", "f")) == 2
    none = df.where("false")
    assert [first(checks.unique(none, ["a"], "s", "t", "u")), first(checks.primary_key(none, ["a"], "s", "t", "p")), first(checks.foreign_key(none, ["a"], df, ["a"], "s", "t", "f"))] == [0, 0, 0]
    assert {r["violations"] for r in checks.not_null(none, ["a", "b"], "s", "t").collect()} == {0}


def test_exclusion_on_a_hot_key(spark):
    import random

    random.seed(3)
    rows = [(i, 1 if i % 3 else i % 7, random.randrange(1000), 0) for i in range(400)]
    df = spark.createDataFrame([(i, k, lo, lo + random.randrange(0, 30)) for i, k, lo, _ in rows], "id int, k int, lo int, hi int").withColumns({c: F.timestamp_seconds(F.col(c) * 60).cast("timestamp_ntz") for c in ("lo", "hi")})
    data = [tuple(r) for r in df.collect() if r["lo"] < r["hi"]]
    pairs = {(min(a[0], b[0]), max(a[0], b[0])) for a in data for b in data if a[0] != b[0] and a[1] == b[1] and a[2] < b[3] and b[2] < a[3]}
    got = [(r["left_id"], r["right_id"]) for r in checks.exclusion_pairs(df, "k", "lo", "hi", "id").collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    late = {max((a, b), key=lambda x: (x[2], x[0]))[0] for a in data for b in data if (min(a[0], b[0]), max(a[0], b[0])) in pairs and a[0] < b[0]}
    assert checks.exclusion(df, "k", "lo", "hi", "id", "s", "t", "x").first()["violations"] == len(late)


def test_data_copies_keep_the_definition(spark, shop):
    spark.sql("CREATE TABLE t_shop.parted (id INT NOT NULL, note VARCHAR(9) DEFAULT 'none', secret STRING NOT NULL, day DATE) USING parquet PARTITIONED BY (day)")
    spark.sql("INSERT INTO t_shop.parted VALUES (1, 'a', 's', DATE'2024-01-01'), (2, 'b', 't', DATE'2024-01-02')")
    assert clone.clone_table(spark, shop, "parted", "t_copy", {"mask": {"secret": "null"}}).rows == 2
    columns, partitions = catalog.definition(spark, "t_copy", "parted")  # file tables themselves hold no NOT NULL
    assert [(c["column_name"], c["type"], c["not_null"], c["default"]) for c in columns] == [("id", "int", False, None), ("note", "varchar(9)", False, "'none'"), ("secret", "string", False, None), ("day", "date", False, None)]
    assert partitions == ["day"] and spark.table("t_copy.parted").where("secret is null and day = '2024-01-02'").count() == 1
    assert clone.clone_table(spark, shop, "parted", "t_copy", {"columns": ["note", "id"]}, "some").rows == 2
    assert [(c["column_name"], c["type"]) for c in catalog.definition(spark, "t_copy", "some")[0]] == [("id", "int"), ("note", "varchar(9)")]


def test_a_stopped_swap_is_taken_up(spark, shop, monkeypatch):
    class Killed(BaseException):
        pass

    def killed_at(monkeypatch, start):
        """The session's next statement that begins so is not run."""
        real = type(spark).sql

        def sql(self, text, *args, **kwargs):
            if text.startswith(start):
                monkeypatch.undo()
                raise Killed
            return real(self, text, *args, **kwargs)

        monkeypatch.setattr(type(spark), "sql", sql)

    names = lambda: {t.name for t in spark.catalog.listTables("t_copy")}
    clone.clone_table(spark, shop, "items", "t_copy")
    # Stopped between the renames: only the old table is there, under its aside name.
    killed_at(monkeypatch, "ALTER TABLE `t_copy`.`items__staged")
    with pytest.raises(Killed):
        clone.clone_table(spark, shop, "items", "t_copy", {"conflict": "replace", "where": "id = 1"})
    assert "items" not in names()
    clone.recover(spark, "t_copy", "items")
    assert spark.table("t_copy.items").count() == 3 and not any("aside" in n for n in names())
    # Stopped before the old one was dropped.
    killed_at(monkeypatch, "DROP TABLE `t_copy`.`items__aside")
    with pytest.raises(Killed):
        clone.clone_table(spark, shop, "items", "t_copy", {"conflict": "replace", "where": "id < 3"})
    assert clone.clone_table(spark, shop, "items", "t_copy", {"conflict": "replace", "where": "id = 1"}).rows == 1
    assert not any("aside" in n for n in names()) and spark.table("t_copy.items").count() == 1
    killed_at(monkeypatch, "ALTER TABLE `t_copy`.`items__staged")
    with pytest.raises(Killed):
        masking.mask_in_place(spark, "t_copy", "items", {"name": "name"})
    assert masking.mask_in_place(spark, "t_copy", "items", {"name": "name"}) == (1, 1)


def test_resume_after_a_killed_run_doubles_nothing(spark, shop, monkeypatch):
    fresh(spark, "t_log2")
    real, seen = clone.clone_table, []

    class Killed(BaseException):
        pass

    def stop_at_the_second(*args, **kwargs):
        seen.append(args[2])
        result = real(*args, **kwargs)
        if len(seen) == 2:
            raise Killed  # its rows are written, its end is not in the log
        return result

    monkeypatch.setattr(clone, "clone_table", stop_at_the_second)
    with pytest.raises(Killed):
        runlog.run_schema(spark, "t_log2", 1, shop, "t_copy")
    monkeypatch.setattr(clone, "clone_table", real)
    assert spark.table("t_copy.items").count() == 3
    assert {(r["table_name"], r["phase"]) for r in spark.table("t_log2.run_log").collect()} == {(None, "begin"), ("empty", "copying"), ("empty", "done"), ("items", "copying")}
    again = runlog.resume(spark, "t_log2", 1, shop, "t_copy")
    assert [(r.table_name, r.rows) for r in again] == [("items", 3)] and spark.table("t_copy.items").count() == 3
    assert runlog.latest(spark.table("t_log2.run_log")).first()["status"] == "completed"
    assert runlog.resume(spark, "t_log2", 1, shop, "t_copy") == []


def _events(spark, rows):
    """A log from (job, parent, minute, table, phase, status)."""
    from datetime import datetime

    return spark.createDataFrame([(j, p, datetime(2024, 1, 1, 0, m), "schema", "s", t, ph, st, 4, 5, 50, None) for j, p, m, t, ph, st in rows], runlog.EVENTS)


def test_parents_run_until_the_last_child_has_ended(spark):
    rows = [(1, 100, 0, "a", "done", "completed"), (2, 100, 0, "b", "copying", "running")]
    seen = lambda rows: [(r["status"], r["phase"], r["running"]) for r in runlog.roll_up(_events(spark, rows)).orderBy("job_id").collect()]
    assert seen(rows) == [("running", "1/2 tables done", 1)]
    assert seen([*rows, (2, 100, 1, "b", "failed", "failed")]) == [("failed", "completed (1/2 ok)", 0)]
    assert seen([(1, 100, 0, "a", "failed", "failed"), rows[1]]) == [("running", "0/2 tables done (1 failed)", 1)]
    assert seen([*rows, (2, 100, 1, "b", "done", "cancelled")]) == [("cancelled", "completed (1/2 ok)", 0)]
    assert seen([*rows, (2, 100, 1, "b", "done", "completed"), (3, 200, 0, None, "begin", "pending")]) == [("completed", "completed (2/2 ok)", 0), ("running", "0/1 tables done", 1)]


def test_a_resumed_job_has_no_end_until_it_ends(spark):
    first = [(1, None, 0, None, "begin", "running"), (1, None, 1, "a", "done", "running"), (1, None, 2, "b", "skipped", "running"), (1, None, 3, None, "end", "failed")]
    again = [*first, (1, None, 10, None, "begin", "running"), (1, None, 11, "c", "done", "running")]
    line = lambda rows: runlog.progress(_events(spark, rows), F.lit("2024-01-01 00:20:00").cast("timestamp")).first()
    assert line(first)["end_time"].minute == 3 and line(first)["elapsed_ms"] == 180_000 and line(first)["tables_completed"] == 2
    running = line(again)
    assert running["end_time"] is None and running["elapsed_ms"] == 1_200_000 and not running["finished"] and running["pct_complete"] == 75
    assert line([*again, (1, None, 12, "d", "done", "running"), (1, None, 12, None, "end", "completed")])["pct_complete"] == 100


def test_literals_in_views_stay():
    text = "SELECT 't_shop.x' AS t, a.id FROM t_shop.items a JOIN `t_shop`.`empty` ON 'it''s t_shop.y' <> spark_catalog.t_shop.f"
    assert clone._retarget(text, "t_shop", "new") == "SELECT 't_shop.x' AS t, a.id FROM `new`.`items` a JOIN `new`.`empty` ON 'it''s t_shop.y' <> `new`.`f`"
    assert clone._retarget("SELECT items_n, 'items' FROM items, t_shop.items", "t_shop", "new", "p__", ("items",)) == "SELECT items_n, 'items' FROM `p__items`, `new`.`p__items`"


def test_tables_without_policy_are_closed(spark, shop):
    policies = masking.Policies(spark, "t_copy")
    with pytest.raises(SpecError):
        policies.read_as("guest", shop, "items")
    assert policies.read_as("guest", shop, "items", without_policy=True).count() == 3


def test_jdbc_tables_are_copied(spark, shop):
    url = f"jdbc:derby:memory:{shop};create=true"
    options = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.range(100).selectExpr("id", "concat('user', id, '@x.example') AS email").write.format("jdbc").options(url=url, dbtable="people", **options).save()
    result = clone.clone_jdbc(spark, url, "people", "t_copy", {"where": "id >= 40", "mask": {"email": "email"}}, key="id", lower=0, upper=100, parts=4, **options)
    assert result.rows == 60 and {r["email"] for r in spark.table("t_copy.people").collect()} == {"u***@x.example"}


def test_schemas_are_compared_by_name(spark, shop):
    spark.sql("CREATE VIEW t_shop.cheap AS SELECT id FROM t_shop.items WHERE price < 2")
    clone.clone_schema(spark, shop, "t_copy")
    same = diff.diff_schemas(spark, shop, "t_copy").summary.first()
    assert same["in_sync"] and same["diff_count"] == 0
    spark.sql("CREATE OR REPLACE VIEW t_copy.cheap AS SELECT id FROM t_copy.items WHERE price < 3")
    spark.sql("ALTER TABLE t_copy.items ADD COLUMNS (extra INT)")
    spark.sql("DROP TABLE t_copy.empty")
    drift = diff.diff_schemas(spark, shop, "t_copy")
    total = drift.summary.first()
    assert (total["tables_only_in_source"], total["tables_modified"], total["views_modified"], total["diff_count"]) == (1, 1, 1, 3)
    assert {(r["section"], r["name"]) for r in drift.documents().collect()} == {("summary", ""), ("tables", "empty"), ("tables", "items"), ("views", "cheap")}
    assert "extra" in drift.document().first()["document"]


def test_rules_are_a_relation(spark):
    assert rules(spark).count() == 42 and rules(spark).where("pattern = '%_name'").first()["ord"] == 9


@pytest.mark.parametrize("slices", [1, 7, None])
def test_long_ranges_meet_in_any_number_of_slices(spark, slices):
    rows = [(1, 1, 0, 10**6), (2, 1, 5, 6), (3, 1, 10**6, 10**6 + 1), (4, 2, 3, 4), (5, 1, 999_999, 10**6 + 5), (6, None, 0, 9)]
    df = spark.createDataFrame(rows, "id int, k int, lo long, hi long").withColumns({c: F.timestamp_seconds(c) for c in ("lo", "hi")})
    got = {(r["left_id"], r["right_id"]) for r in checks.exclusion_pairs(df, "k", "lo", "hi", "id", slices).collect()}
    assert got == {(1, 2), (1, 5), (3, 5)}
    assert {r["id"] for r in checks.overlapping_rows(df, "k", "lo", "hi", "id", slices).collect()} == {2, 3, 5}


def test_parents_are_copied_first_and_cycles_end(spark, shop):
    fresh(spark, "t_tree", "t_tree_copy")
    for name in ("a_lines", "b_orders", "c_people", "d_x", "e_y"):
        spark.sql(f"CREATE TABLE t_tree.{name} AS SELECT id, id % 3 AS other FROM range(3)")
    spark.sql("INSERT INTO t_tree.a_lines VALUES (9, 77)")
    rule = lambda t, ref: ("t_tree", t, f"{t}_fkey", "f", ["other"], None, ref, ["id"])
    rules = spark.createDataFrame([rule("a_lines", "b_orders"), rule("b_orders", "c_people"), rule("d_x", "e_y"), rule("e_y", "d_x")], catalog.CONSTRAINTS)
    results, verdicts = clone.clone_schema_checked(spark, "t_tree", "t_tree_copy", rules, {"parallel": 3})
    assert [r.table_name for r in results] == ["c_people", "b_orders", "a_lines", "d_x", "e_y"] and {r.status for r in results} == {"done"}
    assert {r["table_name"]: r["violations"] for r in verdicts.collect()} == {"a_lines": 1, "b_orders": 0, "d_x": 0, "e_y": 0}


def test_a_constraint_pass_reads_each_table_once(spark):
    fresh(spark, "t_rules")
    parent = [(1, 1.5, None, b"a"), (2, 2.5, "x", b"b"), (2, 0.0, "x", b"b"), (None, -0.0, None, None)]
    spark.createDataFrame(parent, "`i d` int, d double, s string, b binary").write.saveAsTable("t_rules.par")
    child = [(1, 1.5, "x", 0), (2, 9.0, None, 1), (7, None, "y", 2), (None, 0.0, "x,y", 3), (7, 2.5, "x", 4)]
    spark.createDataFrame(child, "ref long, d double, s string, n int").write.saveAsTable("t_rules.chi")
    spark.createDataFrame([], "ref long, n int").write.saveAsTable("t_rules.none")
    rule = lambda t, name, kind, columns, predicate=None, ref=None, refs=None: ("t_rules", t, name, kind, columns, predicate, ref, refs)
    rules = [
        rule("par", "par_pkey", "p", ["i d"]), rule("par", "par_d", "u", ["d"]), rule("par", "par_b", "u", ["b"]), rule("par", "par_two", "u", ["s", "i d"]),
        rule("par", "nulls", "n", ["i d", "s"]), rule("chi", "chi_fkey", "f", ["ref"], None, "par", ["i d"]), rule("chi", "chi_two", "f", ["s", "ref"], None, "par", ["s", "i d"]),
        rule("chi", "chi_d", "f", ["d"], None, "par", ["d"]), rule("chi", "chi_self", "f", ["n"], None, "chi", ["ref"]), rule("chi", "chi_n", "c", ["n"], "n < 3"),
        rule("chi", "chi_s", "c", ["s"], "s <> 'x'"), rule("none", "none_pkey", "p", ["ref"]), rule("none", "none_fkey", "f", ["n"], None, "par", ["i d"]),
        rule("chi", "gone", "u", ["zzz"]), rule("zzz", "zzz", "u", ["ref"]), rule("chi", "no_parent", "f", ["ref"], None, "zzz", ["ref"]),
    ]
    found = checks.constraint_pass(spark, "t_rules", spark.createDataFrame(rules, catalog.CONSTRAINTS))
    got = {r["constraint"]: r["violations"] for r in found.collect()}
    assert got == {
        "par_pkey": 2, "par_d": 1, "par_b": 1, "par_two": 1, "par_i d_not_null": 1, "par_s_not_null": 2, "chi_fkey": 2, "chi_two": 3, "chi_d": 1, "chi_self": 3,
        "chi_n": 2, "chi_s": 2, "none_pkey": 0, "none_fkey": 0,
    }
    assert all(r["ok"] == (r["violations"] == 0) for r in found.collect())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert [plan.count(f"t_rules.{t}") + plan.count(f"t_rules`.`{t}`") for t in ("par", "chi", "none")] == [1, 1, 1]
    assert checks.constraint_pass(spark, "t_rules", spark.createDataFrame([], catalog.CONSTRAINTS)).count() == 0


def test_a_constraint_pass_equals_the_single_checks(spark, sf):
    source(spark, sf, "t_pass", "lineitem", "orders")
    rules = [
        ("t_pass", "lineitem", "k", "p", ["l_orderkey", "l_linenumber"], None, None, None), ("t_pass", "lineitem", "day", "u", ["l_shipdate"], None, None, None),
        ("t_pass", "lineitem", "tax", "u", ["l_tax", "l_discount"], None, None, None), ("t_pass", "lineitem", "f", "f", ["l_partkey"], None, "orders", ["o_custkey"]),
        ("t_pass", "orders", "c", "c", ["o_totalprice"], "o_totalprice > 100000", None, None),
    ]
    got = {r["constraint"]: r["violations"] for r in checks.constraint_pass(spark, "t_pass", spark.createDataFrame(rules, catalog.CONSTRAINTS)).collect()}
    lines, orders = spark.table("t_pass.lineitem"), spark.table("t_pass.orders")
    single = [
        checks.primary_key(lines, rules[0][4], "", "", "k"), checks.unique(lines, rules[1][4], "", "", "day"), checks.unique(lines, rules[2][4], "", "", "tax"),
        checks.foreign_key(lines, ["l_partkey"], orders, ["o_custkey"], "", "", "f"), checks.predicate(orders, rules[4][5], "", "", "c"),
    ]
    assert got == {r["constraint"]: r["violations"] for v in single for r in v.collect()} and got["f"] > 0 and got["day"] > 0
