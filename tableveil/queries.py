"""Every registered query over the given tables, with the DuckDB SQL that must give the same rows.

Frames that the reference's own tests make by hand (people with e-mail and phone, catalogs to compare, a run log) are
derived from the given tables by SQL that both engines read; {S} stands for the engine's text type.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.masks import shape
from .operators import checks, clone, diff, discover, masking, runlog, verify, versions
from .plans.spec import CloneSpec
from .sources import catalog
from .sources.derby import packed
from .sources.jdbc import JdbcCatalog
from .streaming.masked_copy import copy_into_table, masked_copy

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

PEOPLE = """SELECT c_custkey AS id, c_name AS full_name,
 CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN concat('user', CAST(c_custkey AS {S}))
      ELSE concat('user', CAST(c_custkey AS {S}), '@', lower(c_mktsegment), '.example') END AS email,
 CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '911'
      ELSE concat('+1-555-', lpad(CAST(c_custkey % 1000 AS {S}), 3, '0'), '-', lpad(CAST(c_custkey % 10000 AS {S}), 4, '0')) END AS phone,
 CAST(30000 + c_custkey * 37 % 120000 AS INT) AS salary,
 concat(lpad(CAST(c_custkey % 900 AS {S}), 3, '0'), '-45-', lpad(CAST(c_custkey % 10000 AS {S}), 4, '0')) AS ssn,
 CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS notes,
 CASE WHEN c_acctbal < 0 THEN 'suspended' WHEN c_custkey % 4 = 0 THEN 'inactive' ELSE 'active' END AS status
FROM customer"""

# A catalog with a table per customer and columns per order; names are built to meet the rules, their traps and none.
_NAMES = ("ip_address", "Email_Address", "CNAME", "user_name", "qty", "zipcode", "classname", "o_phone_no", "first_name", "api_key", "birth_year", "Salary", "card_number", "street", "total")
CATALOG = f"""SELECT 'hr' AS schema_name, concat('t', CAST(o_custkey AS {{S}})) AS table_name,
 concat(CASE CAST(o_orderkey % {len(_NAMES)} AS INT) {' '.join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_NAMES))} END, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('_', CAST(o_orderkey AS {{S}})) END) AS column_name,
 CAST(min(o_orderkey) AS INT) AS ordinal
FROM orders GROUP BY 1, 2, 3"""
VIEW_NAMES = "SELECT DISTINCT 'hr' AS schema_name, concat('t', CAST(o_custkey AS {S}), '_masked') AS view_name FROM orders WHERE o_custkey % 3 = 0"

# Two snapshots of a catalog with a table per part and a column per supplier of it, which drift by key.
_COLUMNS = """SELECT DISTINCT concat('t', CAST(l_partkey AS {{S}})) AS table_name, concat('c', CAST(l_suppkey AS {{S}})) AS column_name,
 CASE WHEN (l_partkey + l_suppkey) % 13 = 0 THEN '{0}' ELSE 'bigint' END AS type,
 (l_partkey + l_suppkey) % 17 = {1} AS not_null,
 CASE WHEN (l_partkey + l_suppkey) % 19 = {1} THEN '0' END AS "default"
FROM lineitem WHERE l_partkey % 11 <> {1} AND (l_suppkey + l_partkey) % 23 <> {1}"""
COLUMNS_A, COLUMNS_B = _COLUMNS.format("int", 1), _COLUMNS.format("string", 2)
_OBJECT_ROWS = """SELECT CASE CAST(l_partkey % 5 AS INT) WHEN 0 THEN 'indexes' WHEN 1 THEN 'constraints' WHEN 2 THEN 'triggers' WHEN 3 THEN 'views' ELSE 'sequences' END AS category, l_partkey AS n,
  CASE WHEN l_partkey % 5 IN (1, 2) THEN concat('t', CAST(l_suppkey AS {{S}})) END AS parent, CASE WHEN l_partkey % 4 = 3 THEN l_partkey + {0} ELSE 0 END AS d
 FROM lineitem WHERE l_partkey % 12 <> {0}"""
_OBJECTS = f"""SELECT category, concat(category, '_', CAST(n AS {{{{S}}}})) AS name, parent, concat('def ', CAST(min(d) AS {{{{S}}}})) AS def FROM (
 {_OBJECT_ROWS}) AS x GROUP BY category, n, parent"""
OBJECTS_A, OBJECTS_B = _OBJECTS.format(1), _OBJECTS.format(2)

# A run log: users are jobs, their events are tables copied.
RUN_LOG = """SELECT user_id AS job_id, CASE WHEN user_id % 4 <> 0 THEN user_id - user_id % 4 END AS parent_job_id, ts, 'schema' AS op_type, 'shop' AS schema_name,
 concat('t', CAST(event_id AS {S})) AS table_name, CASE WHEN event_id % 9 = 0 THEN 'failed' WHEN event_id % 10 = 1 THEN 'skipped' ELSE 'done' END AS phase,
 CASE CAST(event_id % 7 AS INT) WHEN 0 THEN 'failed' WHEN 1 THEN 'running' WHEN 2 THEN 'cancelled' WHEN 3 THEN 'pending' ELSE 'completed' END AS status,
 CAST(128 AS BIGINT) AS tables_total, event_id % 1000 AS rows, event_id % 1000 * 64 AS bytes, CASE WHEN event_id % 7 = 0 THEN 'lost' END AS error
FROM events"""
NOW = "2030-01-01 00:00:00"

MASK_ALL = {"email": "email", "full_name": "name", "phone": "phone", "ssn": "null"}
EMAIL = "CASE WHEN email IS NULL THEN NULL WHEN position('@' IN email) > 0 THEN concat(left(email, 1), '***@', split_part(email, '@', 2)) ELSE '***' END"
PHONE = "CASE WHEN phone IS NULL THEN NULL WHEN length(phone) > 4 THEN concat('***-', right(phone, 4)) ELSE '****' END"
PARTIAL = "CASE WHEN full_name IS NULL THEN NULL WHEN length(full_name) <= {n} THEN repeat('*', length(full_name)) ELSE concat(left(full_name, {p}), '***', right(full_name, {s})) END"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function as a query, with its SQL if it has one."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = f"WITH people AS ({duck(PEOPLE)}) {sql}" if "people" in sql else sql
        return f

    return put


def duck(sql: str) -> str:
    return sql.replace("{S}", "VARCHAR")


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def frame(spark: SparkSession, sf: str, sql: str, *names: str) -> DataFrame:
    """A derived frame: SQL over the given tables, handed over as DataFrames."""
    return derived(sql, **{n: load(spark, sf, n) for n in names})


def derived(sql: str, **frames: DataFrame) -> DataFrame:
    text = sql.replace("{S}", "STRING").replace('"default"', "`default`")
    views = {}
    for n, df in frames.items():
        spark = df.sparkSession
        views[n] = f"tv_{n}_{uuid.uuid4().hex[:8]}"
        df.createOrReplaceTempView(views[n])
        text = text.replace(f"FROM {n}", f"FROM {views[n]}")
    out = spark.sql(text)
    for v in views.values():
        spark.catalog.dropTempView(v)
    return out


def people(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, PEOPLE, "customer")


def fresh(spark: SparkSession, *names: str) -> None:
    """Empty databases, each in a folder of its own, so that nothing of an earlier run is met."""
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    for n in names:
        spark.sql(f"DROP DATABASE IF EXISTS `{n}` CASCADE")
        spark.sql(f"CREATE DATABASE `{n}` LOCATION '{root}/{n}-{uuid.uuid4().hex[:12]}'")


def _shared(spark: SparkSession) -> str:
    """A folder that the driver and all executors see."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def source(spark: SparkSession, sf: str, schema: str, *names: str) -> None:
    """A database over the given tables as they lie there."""
    fresh(spark, schema)
    for n in names:
        spark.catalog.createTable(f"`{schema}`.`{n}`", path=f"{sf}/{n}.parquet", source="parquet")


def counted(spark: SparkSession, results: list[clone.CloneResult]) -> DataFrame:
    """Row counts of what was copied, read from the copies."""
    frames = {(r.schema_name, r.table_name): spark.table(catalog.quoted(r.schema_name, r.table_name)) for r in results if r.status == "done"}
    return verify.counts(spark, frames)


def count_sql(schema: str, names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT '{schema}' AS schema_name, '{n}' AS table_name, count(*) AS n FROM {n}" for n in names)


# Copies


@query("SELECT * FROM lineitem")
def clone_table(spark, sf):
    source(spark, sf, "tv_src", "lineitem")
    fresh(spark, "tv_clone_table")
    clone.clone_table(spark, "tv_src", "lineitem", "tv_clone_table")
    return spark.table("tv_clone_table.lineitem")


@query("SELECT * FROM orders UNION ALL SELECT * FROM orders")
def clone_append_twice(spark, sf):
    fresh(spark, "tv_append")
    for _ in range(2):
        clone.clone_frame(load(spark, sf, "orders"), "tv_append", "orders")
    return spark.table("tv_append.orders")


_KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz"}


@query(
    "SELECT column_name, CASE data_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _KINDS.items()) + " END AS type, CAST(ordinal_position AS BIGINT) AS ordinal, CAST(0 AS BIGINT) AS rows, "
    "(SELECT count(*) FROM orders) AS source_rows FROM information_schema.columns WHERE table_name = 'orders'"
)
def clone_structure(spark, sf):
    source(spark, sf, "tv_src_s", "orders")
    fresh(spark, "tv_structure")
    clone.clone_table(spark, "tv_src_s", "orders", "tv_structure", {"include_data": False})
    columns = catalog.columns_snapshot(spark, "tv_structure").select("column_name", "type", F.col("ordinal").cast("long").alias("ordinal"))
    n = spark.table("tv_structure.orders").agg(F.count("*").alias("rows"))
    return columns.join(F.broadcast(n)).join(F.broadcast(load(spark, sf, "orders").agg(F.count("*").alias("source_rows"))))


@query("SELECT * FROM customer")
def clone_rename(spark, sf):
    source(spark, sf, "tv_src_r", "customer")
    fresh(spark, "tv_rename")
    clone.clone_table(spark, "tv_src_r", "customer", "tv_rename", target_table="customer_copy")
    return spark.table("tv_rename.customer_copy")


@query("SELECT 'tv_count' AS schema_name, 'events' AS table_name, 'done' AS status, count(*) AS rows, '' AS error FROM events")
def clone_row_count(spark, sf):
    fresh(spark, "tv_count")
    return clone.results_frame(spark, [clone.clone_frame(load(spark, sf, "events"), "tv_count", "events")])


_SHOP = ("customer", "nation", "orders", "part", "region", "supplier")


@query(count_sql("tv_schema", _SHOP))
def clone_schema(spark, sf):
    source(spark, sf, "tv_shop", *_SHOP)
    fresh(spark, "tv_schema")
    return counted(spark, clone.clone_schema(spark, "tv_shop", "tv_schema"))


@query(count_sql("tv_schema_p", _SHOP))
def clone_schema_parallel(spark, sf):
    source(spark, sf, "tv_shop_p", *_SHOP)
    fresh(spark, "tv_schema_p")
    return counted(spark, clone.clone_schema(spark, "tv_shop_p", "tv_schema_p", {"parallel": 4}))


@query(count_sql("tv_copy_tv_db_a", ("customer", "orders")) + " UNION ALL " + count_sql("tv_copy_tv_db_b", ("part", "supplier")))
def clone_database(spark, sf):
    source(spark, sf, "tv_db_a", "orders", "customer")
    source(spark, sf, "tv_db_b", "part", "supplier")
    fresh(spark, "tv_copy_tv_db_a", "tv_copy_tv_db_b")
    return counted(spark, clone.clone_database(spark, ["tv_db_b", "tv_db_a"], "tv_copy_"))


_RICH = "SELECT o_custkey, sum(o_totalprice) AS total FROM orders WHERE o_orderstatus <> 'orders' GROUP BY o_custkey"


@query(count_sql("tv_made", ("nation", "orders", "part")).replace("'nation'", "'tv_db_c__nation'").replace("'orders'", "'tv_db_c__orders'").replace("'part'", "'tv_db_d__part'") + f" UNION ALL SELECT 'tv_made', 'tv_db_c__rich', count(*) FROM ({_RICH})")
def clone_database_create(spark, sf):
    source(spark, sf, "tv_db_c", "orders", "nation")
    source(spark, sf, "tv_db_d", "part")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase("tv_db_c")
    spark.sql(f"CREATE VIEW rich AS {_RICH}")
    spark.catalog.setCurrentDatabase(before)
    fresh(spark, "tv_made")
    return counted(spark, clone.clone_database_create(spark, "tv_made", ["tv_db_d", "tv_db_c"]))


_ACTIVE = "SELECT c_custkey, c_name, c_acctbal FROM {0}customer WHERE c_acctbal >= 0"
_SUMMARY = "SELECT c_name, count(o_orderkey) AS order_count, round(sum(o_totalprice), 2) AS total FROM {0}customer LEFT JOIN {0}orders ON c_custkey = o_custkey GROUP BY c_name"
_STATS = "SELECT c_custkey, c_name, count(o_orderkey) AS order_count, round(coalesce(sum(o_totalprice), 0), 2) AS total_spent, max(o_orderdate) AS last_order FROM {0}customer LEFT JOIN {0}orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name"


def _with_views(spark, sf, target):
    source(spark, sf, f"{target}_src", "customer", "orders")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(f"{target}_src")
    spark.sql(f"CREATE VIEW active_customers AS {_ACTIVE.format('')}")
    spark.sql(f"CREATE VIEW order_summary AS {_SUMMARY.format(f'{target}_src.')}")
    catalog.create_matview(spark, f"{target}_src", "customer_stats", _STATS.format("") + ";")
    spark.catalog.setCurrentDatabase(before)
    fresh(spark, target)
    clone.clone_schema(spark, f"{target}_src", target)


@query(_ACTIVE.format(""))
def clone_view_active_customers(spark, sf):
    _with_views(spark, sf, "tv_views_a")
    return spark.table("tv_views_a.active_customers")


@query(_SUMMARY.format(""))
def clone_view_order_summary(spark, sf):
    _with_views(spark, sf, "tv_views_s")
    return spark.table("tv_views_s.order_summary")


@query(_STATS.format(""))
def clone_matview_customer_stats(spark, sf):
    _with_views(spark, sf, "tv_views_m")
    return spark.table("tv_views_m.customer_stats")


def _twice(spark, sf, schema, mode):
    fresh(spark, schema)
    customers = load(spark, sf, "customer")
    clone.clone_frame(customers, schema, "customer", {"where": "c_acctbal > 0"})
    return clone.clone_frame(customers, schema, "customer", {"where": "c_acctbal <= 0", "conflict": mode})


@query("SELECT 'tv_error' AS schema_name, 'customer' AS table_name, 'failed' AS status, CAST(0 AS BIGINT) AS rows, 'tv_error.customer exists' AS error, count(*) AS target_rows FROM customer WHERE c_acctbal > 0")
def conflict_error(spark, sf):
    result = clone.results_frame(spark, [_twice(spark, sf, "tv_error", "error")])
    return result.join(F.broadcast(spark.table("tv_error.customer").agg(F.count("*").alias("target_rows"))))


@query("SELECT * FROM customer WHERE c_acctbal > 0")
def conflict_skip(spark, sf):
    _twice(spark, sf, "tv_skip", "skip")
    return spark.table("tv_skip.customer")


@query("SELECT * FROM customer WHERE c_acctbal <= 0")
def conflict_replace(spark, sf):
    _twice(spark, sf, "tv_replace", "replace")
    return spark.table("tv_replace.customer")


@query("SELECT *, 'new' AS tag FROM customer WHERE c_acctbal <= 0 UNION ALL SELECT *, 'old' AS tag FROM customer WHERE c_acctbal > 0")
def conflict_rename(spark, sf):
    _twice(spark, sf, "tv_renamed", "rename")
    return spark.table("tv_renamed.customer").withColumn("tag", F.lit("new")).unionByName(spark.table("tv_renamed.customer_old").withColumn("tag", F.lit("old")))


_PLAN = "SELECT user_id AS job_id, concat('t', CAST(event_id AS {S})) AS table_name FROM events"


@query(f"WITH plan AS ({duck(_PLAN)}), log AS ({duck(RUN_LOG)}) SELECT * FROM plan WHERE NOT EXISTS (SELECT 1 FROM log WHERE log.job_id = plan.job_id AND log.table_name = plan.table_name AND phase IN ('done', 'skipped'))")
def resume_pending(spark, sf):
    return runlog.pending(frame(spark, sf, _PLAN, "events"), frame(spark, sf, RUN_LOG, "events"))


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus IS NOT NULL THEN 'XXXX' END AS o_orderstatus FROM orders WHERE o_totalprice > 1000")
def copy_in_ranges(spark, sf):
    """A copy range by range, run again when it is done: the second run finds every range in the manifest."""
    fresh(spark, "tv_ranges", "tv_ranges_log")
    options = {"columns": ["o_orderkey", "o_custkey", "o_orderstatus"], "where": "o_totalprice > 1000", "mask": {"o_orderstatus": "name"}}
    for _ in range(2):
        versions.copy_in_ranges(spark, "tv_ranges_log", 1, load(spark, sf, "orders"), "tv_ranges", "orders", options, parts=4)
    return spark.table("tv_ranges.orders")


@query("SELECT * FROM customer WHERE c_acctbal <= 0")
def replace_version(spark, sf):
    """A versioned table whose pointer moves to the new rows in one step."""
    fresh(spark, "tv_versions")
    for where in ("c_acctbal > 0", "c_acctbal <= 0"):
        versions.replace_table(load(spark, sf, "customer"), "tv_versions", "customer", {"where": where})
    versions.prune(spark, "tv_versions", "customer")
    return spark.table("tv_versions.customer")


# Projection, filter, masks


@query("SELECT id, email, status FROM people")
def select_columns(spark, sf):
    return shape(people(spark, sf), CloneSpec.read({"columns": ["status", "email", "id"]}))


@query("SELECT * FROM orders WHERE o_totalprice > 1000 AND o_orderstatus = 'F'")
def filter_where(spark, sf):
    return shape(load(spark, sf, "orders"), CloneSpec.read({"filter": "o_totalprice > 1000 AND o_orderstatus = 'F'"}))


@query("SELECT id, full_name FROM people WHERE salary > 60000")
def select_filter(spark, sf):
    return shape(people(spark, sf), CloneSpec.read({"columns": ["id", "full_name"], "where": "salary > 60000"}))


@query(f"SELECT id, full_name, {EMAIL} AS email, phone, salary, ssn, notes, status FROM people")
def mask_passthrough(spark, sf):
    return shape(people(spark, sf), CloneSpec.read({"mask": {"email": "email"}}))


@query(f"SELECT id, {EMAIL} AS email, salary FROM people WHERE salary > 60000 AND email IS NOT NULL")
def mask_columns_where(spark, sf):
    return shape(people(spark, sf), CloneSpec.read({"columns": ["salary", "email", "id"], "where": "salary > 60000 AND email IS NOT NULL", "mask": {"email": "email", "full_name": "name"}}))


def _masked(name: str, column: str, rule, sql: str) -> None:
    @query(f"SELECT id, {sql} AS {column} FROM people")
    def run(spark, sf):
        return shape(people(spark, sf), CloneSpec.read({"columns": ["id", column], "mask": {column: rule}}))

    QUERIES[name], SQL[name] = QUERIES.pop("run"), SQL.pop("run")


_masked("mask_email", "email", "email", EMAIL)
_masked("mask_name", "full_name", "name", "CASE WHEN full_name IS NOT NULL THEN 'XXXX' END")
_masked("mask_phone", "phone", "phone", PHONE)
_masked("mask_partial", "full_name", {"type": "partial", "prefix": 2, "suffix": 3}, PARTIAL.format(n=5, p=2, s=3))
_masked("mask_partial_default", "full_name", "partial", PARTIAL.format(n=2, p=1, s=1))
_masked("mask_hash", "email", "hash", "md5(email)")
_masked("mask_null", "ssn", "null", "CAST(NULL AS VARCHAR)")
_masked("mask_constant", "notes", "constant", "'REDACTED'")


@query("SELECT count(*) AS rows, count(*) AS inside, CAST(0 AS BIGINT) AS empty FROM people")
def mask_random_int_bounds(spark, sf):
    masked = shape(people(spark, sf), CloneSpec.read({"mask": {"salary": {"type": "random_int", "min": 200, "max": 100}}}))
    return masked.agg(F.count("*").alias("rows"), F.count_if(F.col("salary").between(100, 200)).alias("inside"), F.count_if(F.col("salary").isNull()).alias("empty"))


_ALL_MASKED = f"id, CASE WHEN full_name IS NOT NULL THEN 'XXXX' END AS full_name, {EMAIL} AS email, {PHONE} AS phone, salary, CAST(NULL AS VARCHAR) AS ssn, notes, status"


@query(f"SELECT {_ALL_MASKED} FROM people WHERE status = 'active'")
def clone_masked(spark, sf):
    fresh(spark, "tv_masked")
    clone.clone_frame(people(spark, sf), "tv_masked", "people", {"where": "status = 'active'", "mask": MASK_ALL})
    return spark.table("tv_masked.people")


@query(f"SELECT {_ALL_MASKED} FROM people")
def mask_in_place(spark, sf):
    fresh(spark, "tv_in_place")
    clone.clone_frame(people(spark, sf), "tv_in_place", "people")
    masking.mask_in_place(spark, "tv_in_place", "people", MASK_ALL)
    return spark.table("tv_in_place.people")


def _database(spark, sf: str, name: str, key: str) -> JdbcCatalog:
    """A table of ours in a database (the Derby that comes with Spark), behind JDBC."""
    return JdbcCatalog(spark, packed({name: load(spark, sf, name)}, _shared(spark), {name: key}), "APP")


@query(f"SELECT c_custkey, {PARTIAL.format(n=5, p=2, s=3).replace('full_name', 'c_name')} AS c_name, c_nationkey, c_acctbal, {PHONE.replace('phone', 'c_mktsegment')} AS c_mktsegment FROM customer")
def jdbc_masked_copy(spark, sf):
    """A schema behind JDBC, copied with masks that the database computes."""
    fresh(spark, "tv_jdbc")
    clone.clone_jdbc_schema(_database(spark, sf, "customer", "c_custkey"), "tv_jdbc", masks={"customer": {"c_name": {"type": "partial", "prefix": 2, "suffix": 3}, "c_mktsegment": "phone"}})
    return spark.table("tv_jdbc.customer")


@query("SELECT 'APP' AS schema_name, 'supplier' AS table_name, count(*) AS source_rows, count(*) AS target_rows, '✓' AS match FROM supplier")
def jdbc_verify(spark, sf):
    """Counts of a schema behind JDBC, taken there, against its copy."""
    there = _database(spark, sf, "supplier", "s_suppkey")
    fresh(spark, "tv_jdbc_v")
    clone.clone_jdbc_schema(there, "tv_jdbc_v")
    return verify.verify_copy(there, "tv_jdbc_v")


def _policy(spark, sf, schema):
    fresh(spark, schema)
    clone.clone_frame(people(spark, sf), schema, "people")
    policies = masking.Policies(spark, schema)
    policies.create(schema, "people", MASK_ALL, "auditor")
    return policies


@query(f"SELECT {_ALL_MASKED} FROM people")
def policy_masked_view(spark, sf):
    _policy(spark, sf, "tv_policy")
    return spark.table("tv_policy.people_masked")


@query("SELECT * FROM people")
def policy_read_privileged(spark, sf):
    return _policy(spark, sf, "tv_policy_a").read_as("auditor", "tv_policy_a", "people")


@query(f"SELECT {_ALL_MASKED} FROM people")
def policy_read_public(spark, sf):
    return _policy(spark, sf, "tv_policy_b").read_as("analyst", "tv_policy_b", "people")


@query("SELECT md5(CAST(c_custkey AS VARCHAR)) AS c_custkey, count(*) AS orders FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def hash_join_integrity(spark, sf):
    text = lambda df, key: df.withColumn(key, F.col(key).cast("string")).select(key)
    customers = shape(text(load(spark, sf, "customer"), "c_custkey"), CloneSpec.read({"mask": {"c_custkey": "hash"}}))
    orders = shape(text(load(spark, sf, "orders"), "o_custkey"), CloneSpec.read({"mask": {"o_custkey": "hash"}}))
    return customers.join(orders, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_custkey").agg(F.count("*").alias("orders"))


# Discovery


def _rules_sql() -> str:
    from .functions.sensitivity import ordered

    rules = ", ".join(f"({i}, '{p.strip('%')}', {str(p.endswith('%')).lower()}, '{c}', '{s}')" for i, p, c, s in ordered())
    return (
        f"WITH names AS ({duck(CATALOG)}), rules(ord, core, inside, category, strategy) AS (VALUES {rules}), "
        "hits AS (SELECT names.*, ord, category, strategy, row_number() OVER (PARTITION BY table_name, column_name ORDER BY ord) AS k FROM names JOIN rules ON CASE WHEN inside THEN contains(lower(column_name), core) ELSE ends_with(lower(column_name), core) END), "
        "first AS (SELECT * EXCLUDE (k) FROM hits WHERE k = 1)"
    )


_FOUND = _rules_sql()


@query(f"{_FOUND} SELECT * FROM first")
def discover_columns(spark, sf):
    return discover.sensitive_columns(frame(spark, sf, CATALOG, "orders"))


@query(f"{_FOUND} SELECT table_name, column_name, strategy FROM first")
def discover_by_table(spark, sf):
    return discover.by_table(frame(spark, sf, CATALOG, "orders")).select("table_name", F.explode("strategies").alias("column_name", "strategy"))


@query()
def discover_json(spark, sf):
    return discover.as_json(frame(spark, sf, CATALOG, "orders"))


@query(
    f"{_FOUND}, v AS ({duck(VIEW_NAMES)}) SELECT first.schema_name, table_name, column_name, category AS sensitivity, CASE WHEN view_name IS NULL THEN 'UNMASKED' ELSE 'MASKED (view)' END AS mask_status, "
    "CASE WHEN view_name IS NULL THEN concat('Apply mask strategy: ', strategy) ELSE concat('OK - masked via ', table_name, '_masked view') END AS recommendation FROM first LEFT JOIN v ON view_name = concat(table_name, '_masked')"
)
def masking_report(spark, sf):
    return discover.masking_report(frame(spark, sf, CATALOG, "orders"), frame(spark, sf, VIEW_NAMES, "orders"))


@query("SELECT c_custkey, CASE WHEN c_name IS NOT NULL THEN 'XXXX' END AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def clone_autodiscovered(spark, sf):
    source(spark, sf, "tv_auto_src", "customer", "nation")
    fresh(spark, "tv_auto")
    clone.clone_schema(spark, "tv_auto_src", "tv_auto", masks=discover.rules_for(catalog.columns_snapshot(spark, "tv_auto_src")))
    return spark.table("tv_auto.customer")


# Verification


def _verified(spark, sf, schema, names, target):
    return verify.verify(verify.counts(spark, {(schema, n): load(spark, sf, n) for n in names}), verify.counts(spark, {(schema, n): df for n, df in target.items()}))


def _same(schema: str, names) -> str:
    return " UNION ALL ".join(f"SELECT '{schema}' AS schema_name, '{n}' AS table_name, count(*) AS source_rows, count(*) AS target_rows, '✓' AS match FROM {n}" for n in names)


def _beside(copies: DataFrame, names: dict[str, str]) -> DataFrame:
    """Counts of copies under the names of their source schemas."""
    return copies.replace(names, subset=["schema_name"])


@query(_same("tv_v_src", TABLES))
def verify_schema(spark, sf):
    source(spark, sf, "tv_v_src", *TABLES)
    fresh(spark, "tv_v_copy")
    clone.clone_schema(spark, "tv_v_src", "tv_v_copy", {"parallel": 4})
    return verify.verify(verify.catalog_counts(spark, ["tv_v_src"]), _beside(verify.catalog_counts(spark, ["tv_v_copy"]), {"tv_v_copy": "tv_v_src"}))


@query(_same("tv_v_a", ("customer", "orders")) + " UNION ALL " + _same("tv_v_b", ("lineitem",)))
def verify_all(spark, sf):
    source(spark, sf, "tv_v_a", "customer", "orders")
    source(spark, sf, "tv_v_b", "lineitem")
    fresh(spark, "tv_vc_tv_v_a", "tv_vc_tv_v_b")
    clone.clone_database(spark, ["tv_v_a", "tv_v_b"], "tv_vc_")
    copied = verify.catalog_counts(spark, ["tv_vc_tv_v_a", "tv_vc_tv_v_b"])
    return verify.verify(verify.catalog_counts(spark, ["tv_v_a", "tv_v_b"]), _beside(copied, {f"tv_vc_{s}": s for s in ("tv_v_a", "tv_v_b")}))


@query(_same("tv_vs", ("customer", "orders")) + " UNION ALL SELECT 'tv_vs', 'part', count(*) * 0, count(*) * 0, '✓' FROM part")
def verify_stats(spark, sf):
    """Counts from statistics: a table that was never analyzed counts as empty."""
    fresh(spark, "tv_vs", "tv_vs_copy")
    for schema in ("tv_vs", "tv_vs_copy"):
        for n in ("customer", "orders", "part"):
            clone.clone_frame(load(spark, sf, n), schema, n)
        for n in ("customer", "orders"):
            spark.sql(f"ANALYZE TABLE {schema}.{n} COMPUTE STATISTICS")
    return verify.verify(verify.catalog_counts(spark, ["tv_vs"], "stats"), _beside(verify.catalog_counts(spark, ["tv_vs_copy"], "stats"), {"tv_vs_copy": "tv_vs"}))


@query("SELECT 's' AS schema_name, 'customer' AS table_name, count(*) AS source_rows, count(*) FILTER (c_acctbal > 0) AS target_rows, '✗' AS match FROM customer UNION ALL SELECT 's', 'orders', count(*), count(*), '✓' FROM orders")
def verify_mismatch(spark, sf):
    return _verified(spark, sf, "s", ("customer", "orders"), {"customer": load(spark, sf, "customer").where("c_acctbal > 0"), "orders": load(spark, sf, "orders")})


@query("SELECT 's' AS schema_name, 'part' AS table_name, count(*) AS source_rows, CAST(0 AS BIGINT) AS target_rows, '✗ (missing)' AS match FROM part UNION ALL SELECT 's', 'orders', count(*), count(*), '✓' FROM orders")
def verify_missing(spark, sf):
    return _verified(spark, sf, "s", ("part", "orders"), {"orders": load(spark, sf, "orders"), "region": load(spark, sf, "region")})


# Constraints


def _verdict(table: str, constraint: str, kind: str, violations: str) -> str:
    return f"SELECT 's' AS schema_name, '{table}' AS table_name, '{constraint}' AS \"constraint\", '{kind}' AS kind, CAST(v AS BIGINT) AS violations, v = 0 AS ok FROM ({violations}) AS x(v)"


@query(_verdict("lineitem", "lineitem_pkey", "p", "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)") + " UNION ALL " + _verdict("orders", "orders_pkey", "p", "SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)"))
def check_pk(spark, sf):
    lines = checks.primary_key(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "s", "lineitem", "lineitem_pkey")
    return lines.unionByName(checks.primary_key(load(spark, sf, "orders"), ["o_orderkey"], "s", "orders", "orders_pkey"))


@query(_verdict("people", "people_email_key", "u", "SELECT count(*) FROM (SELECT 1 FROM people WHERE notes IS NOT NULL GROUP BY notes, salary HAVING count(*) > 1)"))
def check_unique(spark, sf):
    return checks.unique(people(spark, sf), ["notes", "salary"], "s", "people", "people_email_key")


_RANGES = "SELECT event_id, user_id, ts AS lo, ts + INTERVAL 1 HOUR AS hi FROM events"


def _ranges(spark, sf):
    return load(spark, sf, "events").select("event_id", "user_id", F.col("ts").alias("lo"), (F.col("ts") + F.expr("interval 1 hour")).alias("hi"))


@query(f"WITH r AS ({_RANGES}) SELECT a.user_id, least(a.event_id, b.event_id) AS left_id, greatest(a.event_id, b.event_id) AS right_id FROM r a JOIN r b ON a.user_id = b.user_id AND a.event_id < b.event_id AND a.lo < b.hi AND b.lo < a.hi")
def check_exclusion_pairs(spark, sf):
    return checks.exclusion_pairs(_ranges(spark, sf), "user_id", "lo", "hi", "event_id")


@query(_verdict("events", "events_excl", "x", f"SELECT count(*) FILTER (lo < m) FROM (SELECT lo, max(hi) OVER (PARTITION BY user_id ORDER BY lo, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM ({_RANGES}))"))
def check_exclusion(spark, sf):
    return checks.exclusion(_ranges(spark, sf), "user_id", "lo", "hi", "event_id", "s", "events", "events_excl")


@query(_verdict("people", "people_email_check", "c", "SELECT count(*) FILTER (NOT (email LIKE '%@%')) FROM people"))
def check_predicate(spark, sf):
    return checks.predicate(people(spark, sf), "email LIKE '%@%'", "s", "people", "people_email_check")


@query(_verdict("orders", "orders_customer_fkey", "f", "SELECT count(*) FROM orders WHERE o_custkey % 10 = 0") + " UNION ALL " + _verdict("lineitem", "lineitem_order_fkey", "f", "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"))
def check_fk(spark, sf):
    holes = load(spark, sf, "customer").where("c_custkey % 10 <> 0")
    orders = load(spark, sf, "orders")
    first = checks.foreign_key(orders, ["o_custkey"], holes, ["c_custkey"], "s", "orders", "orders_customer_fkey")
    return first.unionByName(checks.foreign_key(load(spark, sf, "lineitem"), ["l_orderkey"], orders, ["o_orderkey"], "s", "lineitem", "lineitem_order_fkey"))


@query(" UNION ALL ".join(_verdict("people", f"people_{c}_not_null", "n", f"SELECT count(*) FILTER ({c} IS NULL) FROM people") for c in ("id", "email", "phone", "notes")))
def check_not_null(spark, sf):
    return checks.not_null(people(spark, sf), ["id", "email", "phone", "notes"], "s", "people")


_RULES = [
    ("tv_cp_src", "lineitem", "lineitem_pkey", "p", ["l_orderkey", "l_linenumber"], None, None, None),
    ("tv_cp_src", "lineitem", "lineitem_order_fkey", "f", ["l_orderkey"], None, "orders", ["o_orderkey"]),
    ("tv_cp_src", "orders", "orders_pkey", "p", ["o_orderkey"], None, None, None),
    ("tv_cp_src", "orders", "orders_customer_fkey", "f", ["o_custkey"], None, "customer", ["c_custkey"]),
    ("tv_cp_src", "orders", "orders_price_check", "c", ["o_totalprice"], "o_totalprice > 1000", None, None),
    ("tv_cp_src", "orders", "orders_part_fkey", "f", ["o_orderkey"], None, "part", ["p_partkey"]),
    ("tv_cp_src", "supplier", "supplier_pkey", "p", ["s_suppkey"], None, None, None),
]


@query(
    " UNION ALL ".join(
        _verdict(t, c, k, v).replace("'s' AS schema_name", "'tv_cp' AS schema_name")
        for t, c, k, v in (
            ("lineitem", "lineitem_copy_pkey", "p", "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"),
            ("orders", "orders_copy_pkey", "p", "SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)"),
            ("orders", "orders_copy_price_check", "c", "SELECT count(*) FROM orders WHERE o_totalprice <= 1000"),
            ("lineitem", "lineitem_copy_order_fkey", "f", "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
            ("orders", "orders_copy_customer_fkey", "f", "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"),
        )
    )
)
def constraint_pass(spark, sf):
    """A schema copy (customers filtered), then its constraints; those of tables that are not there are left out."""
    source(spark, sf, "tv_cp_src", "lineitem", "orders")
    fresh(spark, "tv_cp")
    clone.clone_schema(spark, "tv_cp_src", "tv_cp", {"parallel": 2})
    clone.clone_frame(load(spark, sf, "customer"), "tv_cp", "customer", {"where": "c_acctbal > 0"})
    return checks.constraint_pass(spark, "tv_cp", spark.createDataFrame(_RULES, catalog.CONSTRAINTS), "_copy")


@query(
    " UNION ALL ".join(
        _verdict(t, c, k, v).replace("'s' AS schema_name", "'tv_cc' AS schema_name")
        for t, c, k, v in (
            ("lineitem", "lineitem_pkey", "p", "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"),
            ("orders", "orders_pkey", "p", "SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)"),
            ("orders", "orders_price_check", "c", "SELECT count(*) FROM orders WHERE o_totalprice <= 1000"),
            ("lineitem", "lineitem_order_fkey", "f", "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
            ("orders", "orders_customer_fkey", "f", "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
        )
    )
)
def clone_schema_checked(spark, sf):
    """A schema copied parents first, and the constraints of its copy, in one call."""
    source(spark, sf, "tv_cc_src", "lineitem", "orders", "customer")
    fresh(spark, "tv_cc")
    return clone.clone_schema_checked(spark, "tv_cc_src", "tv_cc", spark.createDataFrame(_RULES, catalog.CONSTRAINTS), {"parallel": 2})[1]


# Constraints of derived tables: one per order, over two of ten columns.
_CONSTRAINTS = "SELECT concat('t', CAST(o_orderkey % 50 AS {S})) AS table_name, concat('t', CAST(o_orderkey % 50 AS {S}), '_key', CAST(o_orderkey AS {S})) AS name, 'u' AS kind, concat('c', CAST(o_orderkey % 10 AS {S})) AS a, concat('c', CAST(o_custkey % 10 AS {S})) AS b FROM orders"


def _constraints(spark, sf):
    return frame(spark, sf, _CONSTRAINTS, "orders").select("table_name", "name", "kind", F.array("a", "b").alias("columns"))


@query(f"WITH c AS ({duck(_CONSTRAINTS)}) SELECT table_name, name, kind FROM c WHERE a IN ('c1', 'c2', 'c3', 'c4') AND b IN ('c1', 'c2', 'c3', 'c4') AND table_name <> 't7'")
def constraints_kept(spark, sf):
    rows = _constraints(spark, sf)
    kept = checks.kept_constraints(rows, ["c1", "c2", "c3", "c4"])
    return checks.new_constraints(kept, rows.where("table_name = 't7'")).select("table_name", "name", "kind")


@query(f"WITH c AS ({duck(_CONSTRAINTS)}) SELECT table_name, concat(table_name, '_copy', substr(name, length(table_name) + 1)) AS name FROM c")
def constraints_renamed(spark, sf):
    return checks.renamed_constraints(_constraints(spark, sf), F.col("table_name"), F.concat("table_name", F.lit("_copy"))).select("table_name", "name")


# Drift


def _kept(spark, df: DataFrame) -> DataFrame:
    """Rows written once, so that every comparison reads them and none makes them anew."""
    path = f"{_shared(spark)}/snapshot-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _pairs(spark, sf) -> DataFrame:
    """The pairs of keys that the snapshots are made of, found once and dealt out by part."""
    return _kept(spark, load(spark, sf, "lineitem").select("l_partkey", "l_suppkey").repartition("l_partkey").distinct())


def _columns(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """COLUMNS_A and COLUMNS_B: different pairs have different names, so nothing is left to make distinct."""
    return tuple(derived(sql.replace("SELECT DISTINCT", "SELECT"), lineitem=pairs) for sql in (COLUMNS_A, COLUMNS_B))


def _objects(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """OBJECTS_A and OBJECTS_B, of one row per object: a pair if it has a parent, else a part. An object's rows have one d."""
    of_table = "coalesce(l_partkey % 5 IN (1, 2), false)"
    rows = pairs.where(of_table).unionAll(pairs.where(f"NOT {of_table}").groupBy("l_partkey").agg(F.min("l_suppkey").alias("l_suppkey")))
    named = "SELECT category, concat(category, '_', CAST(n AS {S})) AS name, parent, concat('def ', CAST(d AS {S})) AS def"
    return tuple(derived(f"{named} FROM ({_OBJECT_ROWS.format(d)}) AS x", lineitem=rows) for d in (1, 2))


_AB = f"""WITH a AS ({duck(COLUMNS_A)}), b AS ({duck(COLUMNS_B)}), oa AS ({duck(OBJECTS_A)}), ob AS ({duck(OBJECTS_B)}),
x1 AS (SELECT coalesce(s.table_name, t.table_name) AS table_name, CASE WHEN t.table_name IS NULL THEN 'only_in_source' ELSE 'only_in_target' END AS presence
  FROM (SELECT DISTINCT table_name FROM a) s FULL JOIN (SELECT DISTINCT table_name FROM b) t ON s.table_name = t.table_name WHERE s.table_name IS NULL OR t.table_name IS NULL),
common AS (SELECT table_name FROM a INTERSECT SELECT table_name FROM b),
ca AS (SELECT * FROM a WHERE table_name IN (FROM common)), cb AS (SELECT * FROM b WHERE table_name IN (FROM common)),
x2 AS (SELECT ca.table_name, ca.column_name, 'only_in_source' AS presence, ca.type, ca.not_null, ca."default" FROM ca ANTI JOIN cb USING (table_name, column_name)
  UNION ALL SELECT cb.table_name, cb.column_name, 'only_in_target', cb.type, cb.not_null, cb."default" FROM cb ANTI JOIN ca USING (table_name, column_name)),
x3 AS (SELECT ca.table_name, ca.column_name, ca.type AS source_type, cb.type AS target_type, ca.not_null AS source_not_null, cb.not_null AS target_not_null, ca."default" AS source_default, cb."default" AS target_default
  FROM ca JOIN cb USING (table_name, column_name) WHERE ca.type <> cb.type OR ca.not_null <> cb.not_null OR ca."default" IS DISTINCT FROM cb."default"),
ka AS (SELECT category, CASE WHEN category IN ('constraints', 'triggers') THEN parent ELSE '' END AS parent, name, CASE WHEN category = 'sequences' THEN '' ELSE def END AS def FROM oa),
kb AS (SELECT category, CASE WHEN category IN ('constraints', 'triggers') THEN parent ELSE '' END AS parent, name, CASE WHEN category = 'sequences' THEN '' ELSE def END AS def FROM ob),
x4 AS (SELECT coalesce(ka.category, kb.category) AS category, coalesce(ka.parent, kb.parent) AS parent, coalesce(ka.name, kb.name) AS name,
    CASE WHEN kb.name IS NULL THEN 'only_in_source' WHEN ka.name IS NULL THEN 'only_in_target' ELSE 'modified' END AS presence,
    CASE WHEN coalesce(ka.category, kb.category) <> 'sequences' THEN ka.def END AS source_def, CASE WHEN coalesce(ka.category, kb.category) <> 'sequences' THEN kb.def END AS target_def
  FROM ka FULL JOIN kb ON ka.category = kb.category AND ka.parent = kb.parent AND ka.name = kb.name WHERE ka.name IS NULL OR kb.name IS NULL OR ka.def <> kb.def)"""


@query(f"{_AB} SELECT * FROM x1")
def diff_tables(spark, sf):
    return diff.tables(*_columns(_pairs(spark, sf)))


@query(f"{_AB} SELECT * FROM x2")
def diff_columns(spark, sf):
    return diff.columns(*_columns(_pairs(spark, sf)))


@query(f"{_AB} SELECT * FROM x3")
def diff_column_drift(spark, sf):
    return diff.column_drift(*_columns(_pairs(spark, sf)))


@query(f"{_AB} SELECT * FROM x4 WHERE category <> 'sequences'")
def diff_objects(spark, sf):
    return diff.objects(*(df.where("category <> 'sequences'") for df in _objects(_pairs(spark, sf))))


@query(f"{_AB} SELECT name, presence FROM x4 WHERE category = 'sequences'")
def diff_sequences(spark, sf):
    return diff.objects(*(df.where("category = 'sequences'") for df in _objects(_pairs(spark, sf)))).select("name", "presence")


def _diffs(spark, sf) -> diff.Drift:
    pairs = _pairs(spark, sf)
    return diff.compare(*_columns(pairs), *_objects(pairs))


_MARKS = [f"{c}_{p}" for c in ("tables", *diff.CATEGORIES) for p in ("only_in_source", "only_in_target", "modified") if not (c == "sequences" and p == "modified")]


@query(
    f"{_AB}, marks AS (SELECT concat('tables_', presence) AS m FROM x1 UNION ALL SELECT 'tables_modified' FROM (SELECT table_name FROM x2 UNION SELECT table_name FROM x3) UNION ALL SELECT concat(category, '_', presence) FROM x4) "
    f"SELECT {', '.join(f"count(*) FILTER (m = '{m}') AS {m}" for m in _MARKS)}, count(*) AS diff_count, count(*) = 0 AS in_sync FROM marks"
)
def diff_summary(spark, sf):
    return _diffs(spark, sf).summary


@query()
def diff_json(spark, sf):
    return _diffs(spark, sf).documents()


@query(
    "SELECT 'orders' AS table_name, column_name, 'only_in_source' AS presence, CASE data_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _KINDS.items()) + " END AS type FROM information_schema.columns "
    "WHERE table_name = 'orders' AND column_name NOT IN ('o_orderkey', 'o_custkey')"
)
def diff_schemas(spark, sf):
    """Columns that a partial copy lacks, from the two schemas' names."""
    source(spark, sf, "tv_ds_src", "orders", "customer")
    fresh(spark, "tv_ds")
    clone.clone_table(spark, "tv_ds_src", "orders", "tv_ds", {"columns": ["o_orderkey", "o_custkey"]})
    clone.clone_table(spark, "tv_ds_src", "customer", "tv_ds")
    return diff.diff_schemas(spark, "tv_ds_src", "tv_ds").columns.select("table_name", "column_name", "presence", "type")


@query("SELECT 'tv_sr' AS schema_name, 'people' AS table_name, column_name, sensitivity, 'MASKED (view)' AS mask_status, 'OK - masked via people_masked view' AS recommendation, masked AS column_masked FROM (SELECT unnest(['full_name', 'email', 'phone', 'salary', 'ssn']) AS column_name, unnest(['PII - Name', 'Email', 'Phone', 'Financial', 'National ID']) AS sensitivity, unnest([true, true, true, false, true]) AS masked) WHERE EXISTS (SELECT 1 FROM people)")
def masking_report_schema(spark, sf):
    policies = _policy(spark, sf, "tv_sr")
    report = discover.schema_report(spark, "tv_sr", policies.current())
    return report.where("table_name = 'people'")


# Run log


def _log(spark, sf):
    return frame(spark, sf, RUN_LOG, "events")


_LAST = f"WITH log AS ({duck(RUN_LOG)}), last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ts DESC, table_name DESC) = 1)"


@query(f"{_LAST} SELECT job_id, op_type, status, phase, table_name, error, ts FROM last")
def jobs_latest(spark, sf):
    return runlog.latest(_log(spark, sf))


# The text's share is left out here: the engines print exact halves apart (12.25 as 12.3 and 12.2).
@query(
    f"{_LAST}, sums AS (SELECT job_id, max(tables_total) AS tables_total, count(*) FILTER (phase IN ('done', 'skipped')) AS tables_completed, CAST(sum(rows) AS BIGINT) AS rows_copied, CAST(sum(bytes) AS BIGINT) AS bytes_copied, min(ts) AS start_time, "
    "CASE WHEN arg_max(status, (ts, table_name)) IN ('completed', 'failed', 'cancelled') THEN max(ts) FILTER (status IN ('completed', 'failed', 'cancelled')) END AS end_time FROM log GROUP BY job_id), "
    f"p AS (SELECT *, tables_completed * 100.0::DOUBLE / tables_total AS pct_complete, (epoch_us(coalesce(end_time, TIMESTAMP '{NOW}')) - epoch_us(start_time)) // 1000 AS elapsed_ms FROM sums), "
    "b AS (SELECT *, CAST(least(20, floor(pct_complete / 100 * 20)) AS INT) AS k, CAST(floor(elapsed_ms / 1000) AS BIGINT) AS sec FROM p) "
    "SELECT job_id, op_type, status, phase, schema_name, table_name AS current_table, b.tables_total, tables_completed, rows_copied, bytes_copied, start_time, end_time, elapsed_ms, pct_complete, concat(repeat('█', k), repeat('░', 20 - k)) AS progress_bar, "
    "concat(rows_copied, ' rows | ', CASE WHEN sec // 3600 < 10 THEN concat('0', sec // 3600) ELSE CAST(sec // 3600 AS VARCHAR) END, ':', lpad(CAST(sec // 60 % 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(sec % 60 AS VARCHAR), 2, '0'), ' elapsed') AS progress_tail, "
    "error AS error_message, status IN ('completed', 'failed', 'cancelled') AS finished FROM b JOIN last USING (job_id)"
)
def progress_detail(spark, sf):
    rows = runlog.progress(_log(spark, sf), F.lit(NOW).cast("timestamp_ntz"))
    return rows.withColumn("progress_tail", F.expr("substring(progress_text, instr(progress_text, '|') + 2)")).drop("progress_text")


@query()
def progress_json(spark, sf):
    return runlog.progress_json(_log(spark, sf), F.lit(NOW).cast("timestamp_ntz"))


@query(
    f"{_LAST}, c AS (SELECT parent_job_id, count(*) AS children, count(*) FILTER (status = 'completed') AS ok, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'cancelled') AS cancelled, "
    "count(*) FILTER (status IN ('running', 'pending')) AS running FROM last WHERE parent_job_id IS NOT NULL GROUP BY 1) SELECT parent_job_id AS job_id, children, ok, failed, cancelled, running, "
    "CASE WHEN running > 0 THEN 'running' WHEN failed > 0 THEN 'failed' WHEN cancelled > 0 THEN 'cancelled' ELSE 'completed' END AS status, "
    "CASE WHEN running > 0 THEN concat(ok, '/', children, ' tables done', CASE WHEN failed > 0 THEN concat(' (', failed, ' failed)') ELSE '' END) ELSE concat('completed (', ok, '/', children, ' ok)') END AS phase FROM c"
)
def pool_rollup(spark, sf):
    return runlog.roll_up(_log(spark, sf))


# Streams


@query("SELECT event_id, ts, user_id, 'XXXX' AS event_type, value, md5(props) AS props FROM events WHERE value > 50")
def stream_masked_copy(spark, sf):
    root = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/") + f"/stream-{uuid.uuid4().hex}"
    path = f"{sf}/events.parquet"
    run = masked_copy(spark, path, load(spark, sf, "events").schema, f"{root}/out", f"{root}/state", {"where": "value > 50", "mask": {"event_type": "name", "props": "hash"}})
    run.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("SELECT event_id, ts, user_id, 'XXXX' AS event_type, value, md5(props) AS props FROM events WHERE value > 50")
def stream_table_copy(spark, sf):
    """A stream into a catalog table that is lost between a batch's write and its commit, and started again."""
    fresh(spark, "tv_stream", "tv_stream_log")
    state = spark.catalog.getDatabase("tv_stream").locationUri.rstrip("/") + "/state"

    def lost(number):
        raise InterruptedError(f"lost after batch {number}")

    for hook in (lost, None):
        run = copy_into_table(spark, f"{sf}/events.parquet", load(spark, sf, "events").schema, "tv_stream", "events", state, {"where": "value > 50", "mask": {"event_type": "name", "props": "hash"}}, ("tv_stream_log", 1), written_batch=hook)
        with contextlib.suppress(StreamingQueryException if hook else ()):
            run.awaitTermination()
    return spark.table("tv_stream.events")
