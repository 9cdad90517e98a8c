"""Copies of tables, schemas and databases: filtered, column-wise, masked, with four ways to meet an existing target."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.masks import shape
from ..plans.spec import CloneSpec, SpecError, check_database_name, check_schema_name
from ..sources.catalog import create_matview, databases, definition, matview_query, quoted, read_jdbc, relations_read, table_property, tables, views
from ..sources.jdbc import JdbcCatalog, read_masked
from .checks import constraint_pass


@dataclass(frozen=True)
class CloneResult:
    schema_name: str
    table_name: str
    status: str  # done, skipped, failed
    rows: int = 0
    error: str = ""


RESULT = "schema_name string, table_name string, status string, rows long, error string"


def results_frame(spark: SparkSession, results: list[CloneResult]) -> DataFrame:
    return spark.createDataFrame([(r.schema_name, r.table_name, r.status, r.rows, r.error) for r in results], RESULT)


def _write(df: DataFrame, schema: str, table: str, include_data: bool) -> int:
    """Appends by column name; the row count is observed while writing, so nothing is scanned twice."""
    if not include_data:
        df.limit(0).write.mode("append").saveAsTable(quoted(schema, table))
        return 0
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").saveAsTable(quoted(schema, table))
    return seen.get["rows"]


@dataclass(frozen=True)
class Definition:
    """What a new target takes over from its source: columns (column_name, type, not_null, default), the columns it is
    partitioned by, and the columns' types as Spark reads them."""

    columns: list[dict]
    partitions: list[str]
    types: dict

    @staticmethod
    def of(spark: SparkSession, schema: str, table: str) -> Definition:
        return Definition(*definition(spark, schema, table), {f.name: f.dataType for f in spark.table(quoted(schema, table)).schema})


def _create_like(rows: DataFrame, like: Definition, schema: str, table: str, spec: CloneSpec) -> list[str]:
    """Makes the target with the source's types, NOT NULL, defaults and partitioning, as far as its columns are copied.

    A masked column whose type changes, or that is a bounded text (a mask may be longer), takes the mask's type, without
    default; one that is masked with nulls may be null.
    Returns the columns that the target is partitioned by.
    """
    lines = []
    for c in (c for c in like.columns if c["column_name"] in rows.columns):
        name = c["column_name"]
        same = rows.schema[name].dataType == like.types[name] and not (name in spec.masks and "char(" in c["type"])
        nulls = name in spec.masks and (spec.masks[name].strategy == "null" or not same)
        line = f"{quoted(name)} {c['type'] if same else rows.schema[name].dataType.simpleString()}"
        line += " NOT NULL" if c["not_null"] and not nulls else ""
        lines.append(line + (f" DEFAULT {c['default']}" if c["default"] is not None and same else ""))
    kept = [p for p in like.partitions if p in rows.columns]
    by = f" PARTITIONED BY ({', '.join(map(quoted, kept))})" if kept else ""
    rows.sparkSession.sql(f"CREATE TABLE {quoted(schema, table)} ({', '.join(lines)}) USING parquet{by}")
    return kept


def _fill(rows: DataFrame, schema: str, table: str, spec: CloneSpec, like: Definition | None) -> int:
    """Makes a new table, like its source if its definition is known, and writes the rows."""
    if like is None:
        return _write(rows, schema, table, spec.include_data)
    kept = _create_like(rows, like, schema, table, spec)
    if not spec.include_data:
        return 0
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append")
    (writer.partitionBy(*kept) if kept else writer).saveAsTable(quoted(schema, table))
    return seen.get["rows"]


#: Property of a table that stands aside while another takes its name: that name.
ASIDE = "tableveil.aside"


def new_name(table: str, what: str) -> str:
    """A name that no other table has, so that nothing is in the way and nothing has to be dropped for it."""
    return f"{table}__{what}_{uuid.uuid4().hex[:8]}"


def _aside(spark: SparkSession, schema: str, table: str) -> list[str]:
    """Tables that our swaps have put aside for this one; others of such names are not ours."""
    pattern = f"{table}__aside_*".replace("'", "")
    found = (r["tableName"] for r in spark.sql(f"SHOW TABLES IN {quoted(schema)} LIKE '{pattern}'").collect() if not r["isTemporary"])
    return [t for t in sorted(found) if table_property(spark, schema, t, ASIDE) == table]


def recover(spark: SparkSession, schema: str, table: str) -> None:
    """Ends a swap that a stopped run has left half done: the old table comes back, or goes if the new one stands."""
    for aside in _aside(spark, schema, table):
        if spark.catalog.tableExists(quoted(schema, table)):
            spark.sql(f"DROP TABLE {quoted(schema, aside)}")
        else:
            spark.sql(f"ALTER TABLE {quoted(schema, aside)} RENAME TO {quoted(schema, table)}")
            spark.sql(f"ALTER TABLE {quoted(schema, table)} UNSET TBLPROPERTIES ('{ASIDE}')")


def swap(spark: SparkSession, schema: str, staged: str, table: str, keep_as: str | None = None) -> None:
    """Puts a staged table in another's place; the old one stays aside, marked as ours, until the new one stands.

    If a run stops between the renames, the next copy to the table calls `recover`. keep_as: the old table stays under
    this name.
    """
    old = keep_as or new_name(table, "aside")
    held = "'" + table.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if keep_as is None:
        spark.sql(f"ALTER TABLE {quoted(schema, table)} SET TBLPROPERTIES ('{ASIDE}' = {held})")
    spark.sql(f"ALTER TABLE {quoted(schema, table)} RENAME TO {quoted(schema, old)}")
    spark.sql(f"ALTER TABLE {quoted(schema, staged)} RENAME TO {quoted(schema, table)}")
    if keep_as is None:
        spark.sql(f"DROP TABLE {quoted(schema, old)}")


def clone_frame(df: DataFrame, schema: str, table: str, options=None, like: Definition | None = None) -> CloneResult:
    """Copies a DataFrame's rows into schema.table; an existing table meets the specification's conflict mode.

    like: the definition that a new target takes over.
    """
    spec = CloneSpec.read(options)
    return _put(shape(df, spec), schema, table, spec, like)


def _put(rows: DataFrame, schema: str, table: str, spec: CloneSpec, like: Definition | None) -> CloneResult:
    """Rows that are filtered and masked already, put into schema.table."""
    spark = rows.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(check_schema_name(schema))}")
    recover(spark, schema, table)
    exists = spark.catalog.tableExists(quoted(schema, table))
    if not exists:
        return CloneResult(schema, table, "done", _fill(rows, schema, table, spec, like))
    if spec.conflict == "error":
        return CloneResult(schema, table, "failed", error=f"{schema}.{table} exists")
    if spec.conflict == "skip":
        return CloneResult(schema, table, "skipped")
    if spec.conflict == "append":
        return CloneResult(schema, table, "done", _write(rows, schema, table, spec.include_data))
    keep_as = f"{table}_old" if spec.conflict == "rename" else None
    if keep_as and spark.catalog.tableExists(quoted(schema, keep_as)):
        return CloneResult(schema, table, "failed", error=f"{schema}.{keep_as} exists")
    # The source may read the target, and the write may fail, so the new rows stand before the old ones go.
    staged = new_name(table, "staged")
    n = _fill(rows, schema, staged, spec, like)
    swap(spark, schema, staged, table, keep_as)
    return CloneResult(schema, table, "done", n)


def clone_table(spark: SparkSession, source_schema: str, table: str, target_schema: str, options=None, target_table: str | None = None) -> CloneResult:
    """Copies a catalog table with its definition, under another name if one is given."""
    spec = CloneSpec.read(options)
    target = target_table or table
    try:
        return clone_frame(spark.table(quoted(source_schema, table)), target_schema, target, spec, Definition.of(spark, source_schema, table))
    except SpecError:
        raise
    except Exception as e:  # noqa: BLE001  a failed table must not stop the others
        return CloneResult(target_schema, target, "failed", error=str(e).splitlines()[0][:500])


def clone_jdbc(spark: SparkSession, url: str, table: str, target_schema: str, options=None, target_table: str | None = None, at_source: bool = False, like: Definition | None = None, **reading) -> CloneResult:
    """Copies a table behind JDBC; `reading` goes to `read_jdbc` (key, lower, upper, parts and reader options).

    Filters and columns are pushed to the source, so other rows and columns do not travel. at_source: the database
    computes the masks as well, so raw values never leave it; the filter is then in the database's SQL.
    """
    name, spec = target_table or table.rpartition(".")[2].strip('"`'), CloneSpec.read(options)
    if at_source:
        return _put(read_masked(spark, url, table, spec, **reading), target_schema, name, spec, like)
    return clone_frame(read_jdbc(spark, url, table, **reading), target_schema, name, spec, like)


#: Rows that one range of a key is to hold where a table is read in ranges.
RANGE_ROWS = 1_000_000


def clone_jdbc_schema(source: JdbcCatalog, target: str, options=None, masks: dict[str, dict] | None = None, at_source: bool = True, range_rows: int = RANGE_ROWS) -> list[CloneResult]:
    """Copies all tables of a schema behind JDBC with their types, NOT NULL and defaults, in name order, parents first.

    Catalog facts come in one query per kind for the whole schema. A table whose primary key is one whole number is read
    in ranges of it, of about `range_rows` rows. masks gives rules per table; with at_source the database computes them,
    and a table with a mask that it cannot compute fails rather than send raw values. `parallel` tables are copied at once.
    """
    spark, spec = source.spark, CloneSpec.read(options)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(check_schema_name(target))}")
    known = source.names()
    names = {t: held for t, (held, _) in known.items()}
    columns: dict[str, list[dict]] = {}
    for r in source.columns().orderBy("table_name", "ordinal").collect():
        columns.setdefault(r["table_name"], []).append(r.asDict())
    rules = source.constraints().collect()
    keys = {}
    for r in rules:
        kinds = {c["column_name"]: c["type"] for c in columns.get(r["table_name"], [])}
        if r["kind"] == "p" and len(r["columns"]) == 1 and kinds.get(r["columns"][0]) in ("tinyint", "smallint", "int", "bigint"):
            keys[r["table_name"]] = r["columns"][0]
    bounds = source.bounds({t: (names[t], known[t][1][k]) for t, k in keys.items()})

    def one(table: str) -> CloneResult:
        try:
            own = CloneSpec.read({"mask": masks[table]}).masks if masks and table in masks else spec.masks
            there = known[table][1]
            wanted = replace(spec, masks={there[c]: replace(r, column=there[c]) for c, r in own.items() if c in there}, columns=tuple(there[c] for c in spec.columns) if spec.columns else None)
            reading = dict(source.options)
            low, high, n = bounds.get(table, (None, None, 0))
            key = there[keys[table]] if table in keys else None
            if key and n > range_rows and key not in wanted.masks and (wanted.columns is None or key in wanted.columns):
                reading |= {"key": key, "lower": low, "upper": high + 1, "parts": -(-n // range_rows)}
            if at_source:
                rows = read_masked(spark, source.url, source.full(names[table]), wanted, **reading)
            else:
                rows = shape(read_jdbc(spark, source.url, source.full(names[table]), **reading), wanted)
            rows = rows.select(*(F.col(f"`{old}`").alias(new) for new, old in there.items() if old in rows.columns))
            types = dict(zip(there, (column_type(c["type"]) for c in columns[table]), strict=True))
            rows = rows.select(*(F.col(f"`{c}`").cast(types[c]).alias(c) for c in rows.columns))
            renamed = replace(wanted, masks={new: wanted.masks[old] for new, old in there.items() if old in wanted.masks}, columns=None, where=None)
            return _put(rows, target, table, renamed, Definition(columns[table], [], {f.name: f.dataType for f in rows.schema}))
        except Exception as e:  # noqa: BLE001  a failed table must not stop the others
            return CloneResult(target, table, "failed", error=str(e).splitlines()[0][:500])

    order = [t for level in levels(list(names), {t: {r["ref_table"] for r in rules if r["table_name"] == t and r["kind"] == "f"} for t in names}) for t in level]
    with ThreadPoolExecutor(max(1, min(spec.parallel, len(order) or 1))) as pool:
        return list(pool.map(one, order))


def column_type(text: str) -> str:
    """The type that Spark reads a column of this name as: bounded texts are strings there."""
    return "string" if text.startswith(("varchar", "char")) else text


def levels(names: list[str], reads: dict[str, set[str]]) -> list[list[str]]:
    """Names in groups, each of which reads only earlier groups; those of a cycle come last, together."""
    left, out = set(names), []
    while left:
        free = sorted(n for n in left if not (reads.get(n, set()) - {n}) & left)
        if not free:
            return [*out, sorted(left)]
        out.append(free)
        left -= set(free)
    return out


_LITERAL = re.compile(r"('(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\")")


def _retarget(text: str, source: str, target: str, prefix: str = "", names: tuple[str, ...] = ()) -> str:
    """A view's text over the target's tables; text literals stay. With a prefix, unqualified names of `names` get it too."""
    qualified = re.compile(rf"(?<![\w.`])(?:`?spark_catalog`?\.)?`?{re.escape(source)}`?\.`?(\w+)`?")
    bare = re.compile(rf"(?<![\w.`])`?({'|'.join(map(re.escape, sorted(names, key=len, reverse=True)))})`?(?![\w`(])") if prefix and names else None

    def change(part: str) -> str:
        part = qualified.sub(lambda m: quoted(target, f"{prefix}{m[1]}" if m[1] in names or not prefix else m[1]), part)
        return bare.sub(lambda m: quoted(f"{prefix}{m[1]}"), part) if bare else part

    return "".join(part if i % 2 else change(part) for i, part in enumerate(_LITERAL.split(text)))


def clone_queries(
    spark: SparkSession, source: str, target: str, kept: dict[str, str], computed: dict[str, str], prefix: str = "", names: tuple[str, ...] = (),
    spec: CloneSpec | None = None, told: Callable[[str, CloneResult | None], None] | None = None,
) -> list[CloneResult]:
    """Makes views (kept) and materialized views (computed) anew over the target's tables, each after those it reads.

    What each reads is taken from the plans that Spark resolves in the source. All that read nothing unmade are made at
    once, `parallel` at a time; one that fails does not stop the rest, and what reads it fails in its turn. names: the
    source's tables, which carry the prefix in the target.
    """
    spec, texts = spec or CloneSpec(), kept | computed
    before = spark.catalog.currentDatabase()
    try:
        spark.catalog.setCurrentDatabase(source)
        reads = {n: relations_read(spark, source, q) for n, q in texts.items()}
        spark.catalog.setCurrentDatabase(target)

        def one(name: str) -> CloneResult:
            if told and name in computed:
                told(name, None)
            try:
                # Only what the query reads takes the prefix, so its columns and aliases may be called like other tables.
                own = tuple(n for n in (*names, *texts) if n in reads[name] or not reads[name])
                query = _retarget(texts[name], source, target, prefix, own)
                if name in kept:
                    spark.sql(f"CREATE OR REPLACE VIEW {quoted(target, prefix + name)} AS {query}")
                    result = CloneResult(target, prefix + name, "done")
                else:
                    create_matview(spark, target, prefix + name, query, replace=spec.conflict == "replace")
                    result = CloneResult(target, prefix + name, "done", spark.table(quoted(target, prefix + name)).count())
            except Exception as e:  # noqa: BLE001
                result = CloneResult(target, prefix + name, "failed", error=str(e).splitlines()[0][:500])
            if told and name in computed:
                told(name, result)
            return result

        with ThreadPoolExecutor(max(1, min(spec.parallel, len(texts)))) as pool:
            return [r for group in levels(list(texts), reads) for r in pool.map(one, group)]
    finally:
        spark.catalog.setCurrentDatabase(before)


def clone_schema(
    spark: SparkSession, source: str, target: str, options=None, masks: dict[str, dict] | None = None, only: list[str] | None = None,
    prefix: str = "", told: Callable[[str, CloneResult | None], None] | None = None, reads: dict[str, set[str]] | None = None,
) -> list[CloneResult]:
    """Copies a schema's tables in name order, then its views and materialized views in the order in which they read one
    another; materialized views are computed anew.

    masks gives rules per table. With `parallel` that many tables are copied at once, and one that fails does not stop
    the rest. prefix stands before every name in the target. told(table, None) is called as a table begins, and
    told(table, result) as it ends. reads: tables that each table refers to and that are copied before it.
    """
    spec = CloneSpec.read(options)
    if not spark.catalog.databaseExists(source):
        raise SpecError(f"no schema {source}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(check_schema_name(target))}")
    every = tables(spark, source)
    names = [t for t in every if only is None or t in only]
    queries = {t: q for t in names if (q := matview_query(spark, source, t))}
    plain = [t for t in names if t not in queries]
    specs = {t: replace(spec, masks=CloneSpec.read({"mask": masks[t]}).masks) if masks and t in masks else spec for t in plain}

    def one(table: str) -> CloneResult:
        if told:
            told(table, None)
        result = clone_table(spark, source, table, target, specs[table], prefix + table)
        if told:
            told(table, result)
        return result

    out = []
    with ThreadPoolExecutor(max(1, min(spec.parallel, len(plain)))) as pool:
        for group in levels(plain, reads or {}):
            out += pool.map(one, group)
    kept, computed = views(spark, source) if spec.views else {}, queries if spec.matviews else {}
    return out + clone_queries(spark, source, target, kept, computed, prefix, tuple(every), spec, told)


def clone_schema_checked(spark: SparkSession, source: str, target: str, constraints: DataFrame, options=None, masks: dict[str, dict] | None = None) -> tuple[list[CloneResult], DataFrame]:
    """clone_schema with parents copied before the tables that refer to them, and then the target's constraints.

    constraints: catalog.CONSTRAINTS of the source. Tables that refer to one another in a cycle are copied last, together.
    Returns what was copied and the verdicts (checks.VERDICTS) over the copies.
    """
    reads: dict[str, set[str]] = {}
    for r in constraints.where("kind = 'f'").select("table_name", "ref_table").distinct().collect():
        reads.setdefault(r["table_name"], set()).add(r["ref_table"])
    results = clone_schema(spark, source, target, options, masks=masks, reads=reads)
    return results, constraint_pass(spark, target, constraints)


def clone_database(spark: SparkSession, schemas: list[str] | None = None, prefix: str = "copy_", options=None) -> list[CloneResult]:
    """Copies every schema, ascending, each into one named with the prefix."""
    chosen = sorted(schemas) if schemas is not None else [d for d in databases(spark) if not d.startswith(prefix)]
    return [r for d in chosen for r in clone_schema(spark, d, f"{prefix}{d}", options)]


def clone_database_create(spark: SparkSession, name: str, schemas: list[str], options=None) -> list[CloneResult]:
    """Makes the database if it is missing and copies schemas into it, views and materialized views too; with several,
    every name carries its schema."""
    check_database_name(name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}")
    prefixes = {s: f"{s}__" if len(schemas) > 1 else "" for s in sorted(schemas)}
    return [r for s, prefix in prefixes.items() for r in clone_schema(spark, s, name, options, prefix=prefix)]
