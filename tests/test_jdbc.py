"""Catalogs and masks of a database behind JDBC (Derby), and the texts for others."""

import json
import os
import subprocess
import sys
import tempfile
import uuid
from pathlib import Path

import duckdb
import pyspark
import pytest
from pyspark.sql import functions as F

from tableveil import queries
from tableveil.functions.expressions import DIALECTS, MySql, Postgres, Spark, dialect_of
from tableveil.functions.masks import mask_sql, shape
from tableveil.operators import checks, clone, diff, verify
from tableveil.plans.spec import CloneSpec, SpecError, read_rules
from tableveil.queries import fresh
from tableveil.sources.derby import packed
from tableveil.sources.jdbc import POSTGRES, JdbcCatalog, source_text, spark_default, spark_type

VALUES = ["ann@example.com", "@x.y", "noat", "", "a@b@c", "user@", None, "+1-555-123-4567", "1234", "12345", "Johnson", "Jo", "Zoë Ünïcode", "日本語テキスト@例え.jp", "it's"]
RULES = {"email": "email", "name": "name", "phone": "phone", "partial": {"type": "partial", "prefix": 2, "suffix": 3}, "ends": {"type": "partial", "prefix": 0, "suffix": 2}, "none": {"type": "partial", "prefix": 0, "suffix": 0}, "null": "null", "constant": {"type": "constant", "value": "it's \\ REDACTED"}}


def url_of(*statements, url=None):
    """A database in memory, a new one by default."""
    from pyspark.sql import SparkSession

    url = url or f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    run = SparkSession.getActiveSession().sparkContext._jvm.java.sql.DriverManager.getConnection(url).createStatement()
    for s in statements:
        run.execute(s)
    return url


@pytest.fixture
def shop(spark):
    url = url_of(
        "CREATE SCHEMA shop",
        "CREATE TABLE shop.cust (id INT NOT NULL PRIMARY KEY, email VARCHAR(40) DEFAULT 'it''s none', price DECIMAL(10,2) NOT NULL, made TIMESTAMP DEFAULT CURRENT_TIMESTAMP, note CLOB, CONSTRAINT price_check CHECK (price > 0))",
        "CREATE TABLE shop.kinds (a INT NOT NULL, b SMALLINT NOT NULL, raw VARCHAR(5) FOR BIT DATA, CONSTRAINT kinds_key PRIMARY KEY (b, a))",
        "CREATE TABLE shop.\"Orders\" (oid BIGINT NOT NULL GENERATED ALWAYS AS IDENTITY, cid INT CONSTRAINT orders_cust REFERENCES shop.cust, qty SMALLINT NOT NULL, d DATE NOT NULL, \"mixed Case\" DOUBLE, "
        "CONSTRAINT orders_key PRIMARY KEY (oid), CONSTRAINT orders_days UNIQUE (d, qty), CONSTRAINT orders_kinds FOREIGN KEY (qty, cid) REFERENCES shop.kinds (b, a))",
        "CREATE INDEX shop.by_day ON shop.\"Orders\" (qty, d DESC)",
        "CREATE VIEW shop.dear AS SELECT id FROM shop.cust WHERE price > 1",
        "CREATE SEQUENCE shop.numbers",
        "CREATE TRIGGER shop.told AFTER INSERT ON shop.cust FOR EACH ROW MODE DB2SQL VALUES 1",
        *(f"INSERT INTO shop.cust (id, email, price) VALUES ({i}, 'user{i}@x.example', {i}.50)" for i in range(1, 31)),
        *(f"INSERT INTO shop.kinds (a, b) VALUES ({i}, {i % 3})" for i in range(1, 31)),
        *(f"INSERT INTO shop.\"Orders\" (cid, qty, d) VALUES ({i}, {i % 3}, DATE('2024-01-{i:02}'))" for i in range(1, 31)),
    )
    return JdbcCatalog(spark, url, "SHOP")


def test_facts_of_a_schema(spark, shop):
    rows = {(r["table_name"], r["column_name"]): (r["ordinal"], r["type"], r["not_null"], r["default"]) for r in shop.columns().collect()}
    assert rows[("cust", "email")] == (2, "varchar(40)", False, "'it\\'s none'") and rows[("cust", "price")] == (3, "decimal(10,2)", True, None)
    assert rows[("cust", "made")] == (4, "timestamp", False, "current_timestamp()") and rows[("cust", "note")][1] == "string"
    assert rows[("Orders", "oid")][1:3] == ("bigint", True) and rows[("Orders", "mixed Case")][1] == "double" and rows[("kinds", "raw")][1] == "binary"
    assert ("dear", "id") not in rows
    found = {(r["table_name"], r["kind"], tuple(r["columns"]), r["ref_table"], tuple(r["ref_columns"] or ())) for r in shop.constraints().collect()}
    assert found == {
        ("cust", "p", ("id",), None, ()), ("cust", "c", (), None, ()), ("kinds", "p", ("b", "a"), None, ()), ("Orders", "p", ("oid",), None, ()), ("Orders", "u", ("d", "qty"), None, ()),
        ("Orders", "f", ("cid",), "cust", ("id",)), ("Orders", "f", ("qty", "cid"), "kinds", ("b", "a")),
    }
    objects = {(r["category"], r["name"], r["parent"]): r["def"] for r in shop.objects().collect()}
    assert objects[("indexes", "by_day", "Orders")] == "BTREE (3, 4 DESC)" and objects[("views", "dear", None)] == "CREATE VIEW dear AS SELECT id FROM cust WHERE price > 1"
    assert ("triggers", "told", "cust") in objects and ("sequences", "numbers", None) in objects and objects[("constraints", "orders_cust", "Orders")] == "f cid cust id"
    assert len(objects) == 4 + len(found)
    assert {r["table_name"]: r["n"] for r in shop.counts().collect()} == {"cust": 30, "kinds": 30, "Orders": 30}
    assert shop.bounds({"cust": ("CUST", "ID")}) == {"cust": (1, 30, 30)}


def test_a_schema_is_copied_verified_and_compared(spark, shop):
    fresh(spark, "j_copy")
    results = clone.clone_jdbc_schema(shop, "j_copy", {"parallel": 2}, masks={"cust": {"email": "email"}}, range_rows=7)
    assert [(r.table_name, r.status, r.rows, r.error) for r in results] == [(t, "done", 30, "") for t in ("cust", "kinds", "Orders")]
    assert {r["email"] for r in spark.table("j_copy.cust").collect()} == {"u***@x.example"} and spark.table("j_copy.cust").selectExpr("sum(price)").first()[0] == 480
    assert {r["match"] for r in verify.verify_copy(shop, "j_copy").collect()} <= {"✓", "✗ (missing)"}
    drift = diff.diff_schemas(spark, shop, "j_copy")
    kinds = {(r["table_name"], r["column_name"]): (r["source_type"], r["target_type"]) for r in drift.column_drift.collect()}
    # A masked text may be longer, so it is not bounded; the catalog's file tables hold no NOT NULL.
    assert kinds[("cust", "email")] == ("varchar(40)", "string") and all(a == b for k, (a, b) in kinds.items() if k != ("cust", "email"))
    assert {(r["category"], r["presence"]) for r in drift.objects.collect()} == {(c, "only_in_source") for c in ("indexes", "constraints", "triggers", "views", "sequences")}
    same = diff.diff_schemas(spark, shop, shop).summary.first()
    assert same["in_sync"]
    rules = shop.constraints().where("kind <> 'c'")
    verdicts = checks.constraint_pass(spark, "j_copy", rules).collect()
    assert verdicts and all(r["ok"] for r in verdicts)


def test_drift_between_two_sources(spark, shop):
    other = JdbcCatalog(spark, url_of("CREATE SCHEMA shop", "CREATE TABLE shop.cust (id BIGINT NOT NULL PRIMARY KEY, email VARCHAR(40))", "CREATE SEQUENCE shop.numbers", "CREATE VIEW shop.dear AS SELECT id FROM shop.cust WHERE id > 1"), "SHOP")
    drift = diff.diff_schemas(spark, shop, other)
    assert {(r["table_name"], r["presence"]) for r in drift.tables.collect()} == {("kinds", "only_in_source"), ("Orders", "only_in_source")}
    total = drift.summary.first()
    assert total["views_modified"] == 1 and total["sequences_only_in_source"] == 0 and total["tables_modified"] == 1 and not total["in_sync"]


def test_masks_that_the_database_cannot_compute_are_refused(spark, shop):
    fresh(spark, "j_refused")
    failed = [r for r in clone.clone_jdbc_schema(shop, "j_refused", masks={"cust": {"email": "hash"}}) if r.status == "failed"]
    assert [r.table_name for r in failed] == ["cust"] and "derby has no digest" in failed[0].error and not spark.catalog.tableExists("j_refused.cust")
    fresh(spark, "j_refused")
    assert {r.status for r in clone.clone_jdbc_schema(shop, "j_refused", masks={"cust": {"email": "hash"}}, at_source=False)} == {"done"}
    assert spark.table("j_refused.cust").where("length(email) = 32").count() == 30
    with pytest.raises(SpecError):
        clone.clone_jdbc(spark, shop.url, "SHOP.CUST", "j_refused", {"mask": {"ID": "null"}}, key="ID", at_source=True, lower=1, upper=9, parts=2)
    with pytest.raises(SpecError):
        dialect_of("jdbc:unheard:of")


@pytest.fixture
def texts(spark):
    url = url_of("CREATE TABLE texts (\"i\" INT, " + ", ".join(f'"{c}" VARCHAR(60)' for c in RULES) + ")")
    df = spark.createDataFrame([(i, *(v,) * len(RULES)) for i, v in enumerate(VALUES)], "i int, " + ", ".join(f"`{c}` string" for c in RULES))
    df.where("email is not null").write.format("jdbc").options(url=url, dbtable="texts").mode("append").save()
    url_of(f'INSERT INTO texts ("i") VALUES ({VALUES.index(None)})', url=url)  # Spark writes its nulls as CLOB, which Derby refuses
    return url, df


def test_all_forms_of_a_mask_agree(spark, texts):
    url, df = texts
    spec = CloneSpec.read({"mask": RULES})
    want = [tuple(r) for r in shape(df, spec).orderBy("i").collect()]
    fresh(spark, "j_forms")
    # Derby computes the masks.
    assert clone.clone_jdbc(spark, url, "texts", "j_forms", {"mask": RULES, "where": '"i" >= 0'}, at_source=True, key="i", lower=0, upper=20, parts=3).rows == len(VALUES)
    assert [tuple(r) for r in spark.table("j_forms.texts").orderBy("i").collect()] == want
    # Spark's text, as views have it; PostgreSQL's text in an engine that speaks alike.
    df.createOrReplaceTempView("texts_seen")
    made = ", ".join(mask_sql(spec.masks[c], df.schema[c].dataType, Spark()) for c in RULES)
    assert [tuple(r) for r in spark.sql(f"SELECT i, {made} FROM texts_seen ORDER BY i").collect()] == want
    con = duckdb.connect()
    con.register("seen", df.toPandas())
    made = ", ".join(mask_sql(spec.masks[c], df.schema[c].dataType, Postgres()) for c in RULES)
    assert con.sql(f"SELECT i, {made} FROM seen ORDER BY i").fetchall() == want


def test_hashes_and_draws_agree(spark, texts):
    _, df = texts
    rules = read_rules({"email": "hash", "i": {"type": "random_int", "min": 5, "max": 9}})
    con = duckdb.connect()
    con.register("seen", df.toPandas())
    got = con.sql(f"SELECT {mask_sql(rules['email'], df.schema['email'].dataType, Postgres())}, {mask_sql(rules['i'], df.schema['i'].dataType, Postgres())} FROM seen").fetchall()
    assert sorted(map(str, (g[0] for g in got))) == sorted(str(r[0]) for r in shape(df, CloneSpec.read({"mask": {"email": "hash"}})).select("email").collect())
    assert {g[1] for g in got} <= set(range(5, 10))
    seeded = read_rules({"i": {"type": "random_int", "min": 1, "max": 9, "seed": 3}})["i"]
    assert "rand(3)" in mask_sql(seeded, df.schema["i"].dataType, Spark()) and "rand(3)" in mask_sql(seeded, df.schema["i"].dataType, MySql())
    with pytest.raises(SpecError):
        mask_sql(seeded, df.schema["i"].dataType, Postgres())


def test_raw_values_stay_in_the_database(spark, texts):
    url, df = texts
    spec = CloneSpec.read({"columns": ["i", "email"], "where": "\"i\" > 3", "mask": {"email": "name", "phone": "phone"}})
    text = source_text(df, "texts", spec, url)
    assert text.startswith('SELECT "i", CASE WHEN (CAST("email" AS VARCHAR(32672)) IS NULL)') and text.endswith(' FROM texts WHERE "i" > 3') and "phone" not in text


def test_dialects_quote(spark):
    assert DIALECTS["mysql"].quoted("a`b", "c") == "`a``b`.`c`" and DIALECTS["derby"].string("it's") == "'it''s'" and MySql().string("\\'") == "'\\\\'''"


def test_types_and_defaults(spark):
    kinds = {
        "integer": "int", "BIGINT": "bigint", "character varying(20)": "varchar(20)", "character varying": "string", "numeric(10,2)": "decimal(10,2)", "numeric": "decimal(38,18)", "DECIMAL(5)": "decimal(5,0)",
        "timestamp without time zone": "timestamp_ntz", "timestamp(6) with time zone": "timestamp", "text": "string", "uuid": "string", "int4[]": "array<int>", "varchar(3)[]": "array<string>", "double precision": "double",
        "CHAR(5) FOR BIT DATA": "binary", "CLOB(2147483647)": "string", "bytea": "binary", "boolean": "boolean", "smallint": "smallint",
    }
    got = {r["t"]: r["s"] for r in spark.createDataFrame([(k,) for k in kinds], "t string").select("t", spark_type("t").alias("s")).collect()}
    assert got == kinds
    defaults = {"'none'::character varying": "'none'", "0": "0", "-1.5": "-1.5", "nextval('a_seq'::regclass)": None, "now()": "current_timestamp()", "CURRENT_TIMESTAMP": "current_timestamp()", "true": "true", "'it''s'": "'it\\'s'", "upper('x')": None, "NULL": None}
    got = {r["t"]: r["s"] for r in spark.createDataFrame([(k,) for k in defaults], "t string").select("t", spark_default("t").alias("s")).collect()}
    assert got == defaults


def test_standard_texts_run_elsewhere(spark):
    """The queries over information_schema, in another engine that has it."""
    con = duckdb.connect()
    con.sql("CREATE SCHEMA shop; CREATE TABLE shop.cust (id INTEGER PRIMARY KEY, name VARCHAR NOT NULL DEFAULT 'x', price DECIMAL(10,2)); CREATE TABLE shop.kinds (a INTEGER, b INTEGER, UNIQUE (b, a)); CREATE VIEW shop.v AS SELECT 1 AS x")
    rows = con.sql(POSTGRES.columns.replace("{s}", "'shop'")).fetchall()
    assert {(r[0], r[1], r[2], r[4]) for r in rows} == {("cust", "id", 1, 1), ("cust", "name", 2, 1), ("cust", "price", 3, 0), ("kinds", "a", 1, 0), ("kinds", "b", 2, 0)}
    keys = con.sql(POSTGRES.keys.replace("{s}", "'shop'")).fetchall()
    assert {(r[0], r[2], r[3], r[4]) for r in keys} >= {("cust", "p", 1, "id"), ("kinds", "u", 1, "b"), ("kinds", "u", 2, "a")}


def test_levels_of_what_reads_what():
    assert clone.levels(["a", "b", "c", "d"], {"a": {"b", "a"}, "b": {"c"}, "d": {"zz"}}) == [["c", "d"], ["b"], ["a"]]
    assert clone.levels(["a", "b", "c"], {"a": {"b"}, "b": {"a"}}) == [["c"], ["a", "b"]] and clone.levels([], {}) == []


def test_others_tables_are_not_dropped(spark):
    fresh(spark, "j_own")
    clone.clone_frame(spark.range(3), "j_own", "t")
    for name in ("t__aside", "t__staged", "t__aside_1"):
        spark.range(1).write.saveAsTable(f"j_own.{name}")
    assert clone.clone_frame(spark.range(5).where(F.col("id") > 0), "j_own", "t", {"conflict": "replace"}).rows == 4
    assert {t.name for t in spark.catalog.listTables("j_own") if not t.isTemporary} == {"t", "t__aside", "t__staged", "t__aside_1"}


def test_a_packed_database_is_read_by_another_jvm(spark, sf):
    """Executors are JVMs of their own; ours has the database open meanwhile."""
    there = queries._database(spark, sf, "supplier", "s_suppkey")
    assert [tuple(r) for r in there.counts().collect()] == [("APP", "supplier", 10)]
    code = "import sys\nfrom pyspark.sql import SparkSession\nspark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\nprint('rows', spark.read.format('jdbc').option('url', sys.argv[1]).option('dbtable', 'supplier').load().count())"
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_"))}
    other = subprocess.run([sys.executable, "-c", code, there.url], cwd=tempfile.mkdtemp(prefix="spark-"), env=env, capture_output=True, text=True, timeout=120)
    assert "rows 10" in other.stdout, other.stderr[-2000:]


def test_a_schema_is_verified_on_a_cluster(sf):
    """The whole query, from load to counts, where every executor is a JVM with a folder of its own."""
    root, spark_home = Path(tempfile.mkdtemp(prefix="spark-")), Path(pyspark.__file__).parent
    for d in ("home/work", "shared"):
        (root / d).mkdir(parents=True)
    for p in spark_home.iterdir():
        if p.name != "work":  # executors' folders are made in it
            (root / "home" / p.name).symlink_to(p)
    conf = {"spark.master": "local-cluster[2,2,1200]", "spark.executor.memory": "800m", "spark.driver.host": "127.0.0.1", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": f"{root}/warehouse", "spark.checkpoint.dir": f"file://{root}/shared"}
    code = "import json, os, sys\nfrom pyspark.sql import SparkSession\nspark = SparkSession.builder.config(map=json.loads(sys.argv[1])).getOrCreate()\nfrom tableveil import queries\nprint('rows', [list(r) for r in queries.jdbc_verify(spark, sys.argv[2]).collect()], flush=True)\nspark.stop()\nos._exit(0)"
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_"))} | {"SPARK_HOME": str(root / "home"), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYTHONPATH": str(Path(queries.__file__).parents[1]), "PYTHONIOENCODING": "utf-8", "PYSPARK_PYTHON": sys.executable}
    other = subprocess.run([sys.executable, "-c", code, json.dumps(conf), sf], cwd=root, env=env, capture_output=True, encoding="utf-8", timeout=300)
    assert "rows [['APP', 'supplier', 10, 10, '✓']]" in other.stdout, other.stderr[-2000:]


def test_a_packed_database_holds_all_values(spark, make):
    root = f"file:{tempfile.mkdtemp(prefix='spark-')}"
    rows = [(i, t, d, i % 2 == 0) for i, (t, d) in enumerate([*zip(VALUES, [0.1, -1e300, None, 1e-9, 123456789.125] * 3, strict=True), ('a "b", c', 1.0), ("two\nlines\r\n", 2.0), (" blanks ", 3.0), ("\\", 4.0), ('"', 5.0), (",", 6.0)])]
    held = packed({"t": make(rows, "id long, text string, x double, yes boolean"), "none": make([], "id long")}, root, {"t": "id", "none": "id"})
    fresh(spark, "j_packed")
    results = clone.clone_jdbc_schema(JdbcCatalog(spark, held, "APP"), "j_packed", range_rows=5)
    assert [(r.table_name, r.status, r.rows) for r in results] == [("none", "done", 0), ("t", "done", len(rows))]
    assert [tuple(r) for r in spark.table("j_packed.t").orderBy("id").collect()] == rows
    # A column with nulls or repeats is no key; its rows are all there.
    for ids in ([1, 2, None], [1, 2, 2]):
        there = JdbcCatalog(spark, packed({"t": make([(i,) for i in ids], "id int")}, root, {"t": "id"}), "APP")
        assert there.constraints().count() == 0 and there.counts().first()["n"] == 3
    with pytest.raises(SpecError):
        packed({"t": make([([1],)], "a array<int>")}, root)
    with pytest.raises(SpecError):
        packed({"t": make([(1,)], "a int")}, "hdfs://host/shared")
