"""Catalog facts and rows of a database behind JDBC.

A `JdbcCatalog` reads what it tells (columns, constraints, indexes, triggers, views, sequences, counts) in one query per
kind of fact for a whole schema, never one per table, and gives it in the shapes of `sources.catalog`, with Spark's types
and, where they can be expressed, Spark's defaults. Facts stay DataFrames until someone collects them.

Rows are read with the filter, the columns and, if wished, the masks in the text that the database runs, so raw values
do not leave it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import dialect_of
from ..functions.masks import check_types, mask_sql
from ..plans.spec import CloneSpec, SpecError
from .catalog import COLUMNS, CONSTRAINTS, OBJECTS, read_jdbc

#: Names of types in the databases, and Spark's type for them.
TYPES = {
    "boolean": "boolean", "bool": "boolean", "bit": "boolean",
    "tinyint": "tinyint", "smallint": "smallint", "int2": "smallint", "smallserial": "smallint",
    "integer": "int", "int": "int", "int4": "int", "serial": "int", "mediumint": "int",
    "bigint": "bigint", "int8": "bigint", "bigserial": "bigint",
    "real": "float", "float4": "float", "float": "double", "double": "double", "double precision": "double", "float8": "double",
    "date": "date", "timestamp without time zone": "timestamp_ntz", "datetime": "timestamp_ntz",
    "timestamp": "timestamp", "timestamp with time zone": "timestamp", "timestamptz": "timestamp",
    "bytea": "binary", "blob": "binary", "binary": "binary", "varbinary": "binary", "longblob": "binary",
}
#: Of these the arguments stay; numbers without any take the largest decimal.
SIZED = {"character varying": "varchar", "varchar": "varchar", "character": "char", "char": "char", "bpchar": "char", "numeric": "decimal", "decimal": "decimal", "number": "decimal"}
#: Tables that one query counts.
COUNTED = 50


def spark_type(text: str | Column) -> Column:
    """Spark's name of a database's type; what Spark has no type for is a string, an array an array."""
    raw = F.trim(F.lower(F.col(text) if isinstance(text, str) else text))
    item = F.regexp_replace(raw, r"(\[\])+$", "")
    base, size = F.trim(F.regexp_replace(item, r"\s*\([^)]*\)", "")), F.regexp_extract(item, r"\(\s*([0-9]+(?:\s*,\s*[0-9]+)?)\s*\)", 1)
    known = F.create_map(*(F.lit(x) for pair in TYPES.items() for x in pair))
    sized = F.create_map(*(F.lit(x) for pair in SIZED.items() for x in pair))
    kind, bits = F.element_at(sized, base), F.when(F.endswith(base, F.lit(" for bit data")), "binary")
    args = F.concat(F.lit("("), F.regexp_replace(size, " ", ""), F.lit(")"))
    with_size = F.when((kind == "decimal") & (size == ""), "decimal(38,18)").when((kind == "decimal") & ~F.contains(size, F.lit(",")), F.concat(F.lit("decimal("), size, F.lit(",0)"))).when(size == "", "string").otherwise(F.concat(kind, args))
    one = F.coalesce(F.element_at(known, base), F.when(kind.isNotNull(), with_size), bits, F.lit("string"))
    return F.when(raw != item, F.concat(F.lit("array<"), F.regexp_replace(one, r"^(var)?char\(.*", "string"), F.lit(">"))).otherwise(one)


def spark_default(text: str | Column) -> Column:
    """A default that Spark can hold: numbers, texts, truth values, the time; null for others (sequences, functions)."""
    raw = F.regexp_replace(F.trim(F.col(text) if isinstance(text, str) else text), r"::[A-Za-z_ ]+(\([0-9, ]*\))?(\[\])?$", "")
    literal = raw.rlike(r"^[-+]?[0-9]+(\.[0-9]+)?$|^'(?:[^']|'')*'$") | F.lower(raw).isin("true", "false")
    quoted = F.when(F.startswith(raw, F.lit("'")), F.concat(F.lit("'"), F.replace(F.replace(F.substring(raw, F.lit(2), F.length(raw) - 2), F.lit("\\"), F.lit("\\\\")), F.lit("''"), F.lit("\\'")), F.lit("'"))).otherwise(F.lower(raw))
    return F.when(literal, quoted).when(F.lower(raw).rlike(r"^(current[_ ]timestamp|now|localtimestamp)(\(\d*\))?$"), "current_timestamp()")


@dataclass(frozen=True)
class Facts:
    """Queries over a database's own catalog; {s} stands for the schema as a text literal.

    columns: table_name, column_name, ordinal, type, not_null (0 or 1), default_text
    keys: table_name, name, kind (p, u, f), place, column_name, ref_table, ref_place, ref_column
    predicates: table_name, name, predicate
    indexes, triggers, views, sequences: name, parent, def; several rows of one name are put together
    """

    columns: str
    keys: str
    predicates: str
    indexes: str
    triggers: str
    views: str
    sequences: str
    #: Whether names that are not quoted are kept in capitals.
    capitals: bool = False


_TABLES = "JOIN information_schema.tables t ON t.table_schema = c.table_schema AND t.table_name = c.table_name AND t.table_type = 'BASE TABLE'"
_KEYS = """SELECT c.table_name AS table_name, c.constraint_name AS name, CASE c.constraint_type WHEN 'PRIMARY KEY' THEN 'p' WHEN 'UNIQUE' THEN 'u' ELSE 'f' END AS kind,
 k.ordinal_position AS place, k.column_name AS column_name, {ref_table} AS ref_table, k.ordinal_position AS ref_place, {ref_column} AS ref_column
FROM information_schema.table_constraints c
JOIN information_schema.key_column_usage k ON k.constraint_schema = c.constraint_schema AND k.constraint_name = c.constraint_name AND k.table_name = c.table_name {joins}
WHERE c.table_schema = {{s}} AND c.constraint_type IN ('PRIMARY KEY', 'UNIQUE', 'FOREIGN KEY')"""
_CHECKS = """SELECT c.table_name AS table_name, c.constraint_name AS name, x.check_clause AS predicate FROM information_schema.table_constraints c
JOIN information_schema.check_constraints x ON x.constraint_schema = c.constraint_schema AND x.constraint_name = c.constraint_name
WHERE c.table_schema = {s} AND c.constraint_type = 'CHECK' AND x.check_clause NOT LIKE '%IS NOT NULL'"""

POSTGRES = Facts(
    columns=f"""SELECT c.table_name AS table_name, c.column_name AS column_name, c.ordinal_position AS ordinal,
 CASE WHEN c.data_type = 'ARRAY' THEN substr(c.udt_name, 2) || '[]' WHEN c.character_maximum_length IS NOT NULL THEN c.data_type || '(' || CAST(c.character_maximum_length AS VARCHAR) || ')'
  WHEN c.data_type IN ('numeric', 'DECIMAL') AND c.numeric_precision IS NOT NULL THEN 'numeric(' || CAST(c.numeric_precision AS VARCHAR) || ',' || CAST(c.numeric_scale AS VARCHAR) || ')' ELSE c.data_type END AS type,
 CASE c.is_nullable WHEN 'NO' THEN 1 ELSE 0 END AS not_null, c.column_default AS default_text
FROM information_schema.columns c {_TABLES} WHERE c.table_schema = {{s}}""",
    keys=_KEYS.format(
        ref_table="u.table_name", ref_column="u.column_name",
        joins="""LEFT JOIN information_schema.referential_constraints r ON r.constraint_schema = c.constraint_schema AND r.constraint_name = c.constraint_name AND c.constraint_type = 'FOREIGN KEY'
LEFT JOIN information_schema.key_column_usage u ON u.constraint_schema = r.unique_constraint_schema AND u.constraint_name = r.unique_constraint_name AND u.ordinal_position = k.position_in_unique_constraint""",
    ),
    predicates=_CHECKS,
    indexes="SELECT indexname AS name, tablename AS parent, indexdef AS def FROM pg_indexes WHERE schemaname = {s} AND indexname NOT IN (SELECT constraint_name FROM information_schema.table_constraints WHERE table_schema = {s})",
    triggers="SELECT trigger_name AS name, event_object_table AS parent, action_timing || ' ' || event_manipulation || ' ' || action_orientation || ' ' || action_statement AS def FROM information_schema.triggers WHERE trigger_schema = {s}",
    views="SELECT table_name AS name, CAST(NULL AS TEXT) AS parent, view_definition AS def FROM information_schema.views WHERE table_schema = {s} UNION ALL SELECT matviewname, NULL, definition FROM pg_matviews WHERE schemaname = {s}",
    sequences="SELECT sequence_name AS name, CAST(NULL AS TEXT) AS parent, CAST(NULL AS TEXT) AS def FROM information_schema.sequences WHERE sequence_schema = {s}",
)

MYSQL = Facts(
    columns=f"""SELECT c.table_name AS table_name, c.column_name AS column_name, c.ordinal_position AS ordinal, CASE WHEN c.data_type IN ('char', 'varchar', 'decimal') THEN c.column_type ELSE c.data_type END AS type,
 CASE c.is_nullable WHEN 'NO' THEN 1 ELSE 0 END AS not_null, CASE WHEN c.data_type IN ('char', 'varchar', 'text', 'enum') THEN quote(c.column_default) ELSE c.column_default END AS default_text
FROM information_schema.columns c {_TABLES} WHERE c.table_schema = {{s}}""",
    keys=_KEYS.format(ref_table="k.referenced_table_name", ref_column="k.referenced_column_name", joins=""),
    predicates=_CHECKS,
    indexes="SELECT index_name AS name, table_name AS parent, concat(CASE non_unique WHEN 0 THEN 'UNIQUE ' ELSE '' END, group_concat(column_name ORDER BY seq_in_index)) AS def FROM information_schema.statistics WHERE table_schema = {s} AND index_name NOT IN (SELECT constraint_name FROM information_schema.table_constraints WHERE table_schema = {s}) GROUP BY index_name, table_name, non_unique",
    triggers="SELECT trigger_name AS name, event_object_table AS parent, concat(action_timing, ' ', event_manipulation, ' ', action_statement) AS def FROM information_schema.triggers WHERE trigger_schema = {s}",
    views="SELECT table_name AS name, NULL AS parent, view_definition AS def FROM information_schema.views WHERE table_schema = {s}",
    sequences="SELECT table_name AS name, NULL AS parent, NULL AS def FROM information_schema.tables WHERE table_schema = {s} AND table_type = 'SEQUENCE'",
)

_OWN = "JOIN SYS.SYSTABLES t ON t.TABLEID = {0}.{1} JOIN SYS.SYSSCHEMAS s ON s.SCHEMAID = t.SCHEMAID WHERE s.SCHEMANAME = {{s}}"
_KEY = "JOIN SYS.SYSKEYS {0} ON {0}.CONSTRAINTID = {1} JOIN SYS.SYSCONGLOMERATES {2} ON {2}.CONGLOMERATEID = {0}.CONGLOMERATEID"

def _listed(descriptor: str) -> str:
    """The columns that an index's descriptor names by number, BTREE (4, 3 DESC), as a text with a blank before and a
    comma or a blank behind every number."""
    text = f"CAST({descriptor} AS VARCHAR(2000))"
    inner = f"SUBSTR({text}, LOCATE('(', {text}) + 1, LENGTH({text}) - LOCATE('(', {text}) - 1)"
    return f"(' ' || {inner} || ',')"


def _at(number: str, descriptor: str) -> str:
    """Where a column's number stands in a key's descriptor; 0 if it does not."""
    return f"LOCATE(' ' || TRIM(CAST({number} AS CHAR(5))) || ',', {_listed(descriptor)})"


DERBY = Facts(
    columns="SELECT t.TABLENAME AS table_name, c.COLUMNNAME AS column_name, c.COLUMNNUMBER AS ordinal, CAST(c.COLUMNDATATYPE AS VARCHAR(200)) AS type, "
    "CASE WHEN CAST(c.COLUMNDATATYPE AS VARCHAR(200)) LIKE '% NOT NULL' THEN 1 ELSE 0 END AS not_null, CAST(c.COLUMNDEFAULT AS VARCHAR(2000)) AS default_text FROM SYS.SYSCOLUMNS c " + _OWN.format("c", "REFERENCEID") + " AND t.TABLETYPE = 'T'",
    keys=" UNION ALL ".join((
        f"SELECT t.TABLENAME AS table_name, k.CONSTRAINTNAME AS name, CASE k.TYPE WHEN 'P' THEN 'p' ELSE 'u' END AS kind, {_at('c.COLUMNNUMBER', 'g.DESCRIPTOR')} AS place, c.COLUMNNAME AS column_name, CAST(NULL AS VARCHAR(128)) AS ref_table, 0 AS ref_place, CAST(NULL AS VARCHAR(128)) AS ref_column "
        f"FROM SYS.SYSCONSTRAINTS k {_KEY.format('y', 'k.CONSTRAINTID', 'g')} JOIN SYS.SYSCOLUMNS c ON c.REFERENCEID = k.TABLEID AND {_at('c.COLUMNNUMBER', 'g.DESCRIPTOR')} > 0 {_OWN.format('k', 'TABLEID')}",
        f"SELECT t.TABLENAME AS table_name, k.CONSTRAINTNAME AS name, 'f' AS kind, {_at('c.COLUMNNUMBER', 'g.DESCRIPTOR')} AS place, c.COLUMNNAME AS column_name, o.TABLENAME AS ref_table, {_at('p.COLUMNNUMBER', 'h.DESCRIPTOR')} AS ref_place, p.COLUMNNAME AS ref_column FROM SYS.SYSCONSTRAINTS k JOIN SYS.SYSFOREIGNKEYS f ON f.CONSTRAINTID = k.CONSTRAINTID JOIN SYS.SYSCONGLOMERATES g ON g.CONGLOMERATEID = f.CONGLOMERATEID "
        f"JOIN SYS.SYSCOLUMNS c ON c.REFERENCEID = k.TABLEID AND {_at('c.COLUMNNUMBER', 'g.DESCRIPTOR')} > 0 {_KEY.format('y', 'f.KEYCONSTRAINTID', 'h')} JOIN SYS.SYSTABLES o ON o.TABLEID = h.TABLEID "
        f"JOIN SYS.SYSCOLUMNS p ON p.REFERENCEID = o.TABLEID AND {_at('p.COLUMNNUMBER', 'h.DESCRIPTOR')} > 0 {_OWN.format('k', 'TABLEID')}",
    )),
    predicates="SELECT t.TABLENAME AS table_name, k.CONSTRAINTNAME AS name, CAST(x.CHECKDEFINITION AS VARCHAR(30000)) AS predicate FROM SYS.SYSCHECKS x JOIN SYS.SYSCONSTRAINTS k ON k.CONSTRAINTID = x.CONSTRAINTID " + _OWN.format("k", "TABLEID"),
    indexes=f"SELECT g.CONGLOMERATENAME AS name, t.TABLENAME AS parent, CAST(g.DESCRIPTOR AS VARCHAR(2000)) AS def FROM SYS.SYSCONGLOMERATES g {_OWN.format('g', 'TABLEID')} AND g.ISINDEX AND NOT g.ISCONSTRAINT AND t.TABLETYPE = 'T'",
    triggers=f"SELECT x.TRIGGERNAME AS name, t.TABLENAME AS parent, x.FIRINGTIME || ' ' || x.EVENT || ' ' || CAST(x.TRIGGERDEFINITION AS VARCHAR(30000)) AS def FROM SYS.SYSTRIGGERS x {_OWN.format('x', 'TABLEID')}",
    views=f"SELECT t.TABLENAME AS name, CAST(NULL AS VARCHAR(128)) AS parent, CAST(x.VIEWDEFINITION AS VARCHAR(30000)) AS def FROM SYS.SYSVIEWS x {_OWN.format('x', 'TABLEID')}",
    sequences="SELECT x.SEQUENCENAME AS name, CAST(NULL AS VARCHAR(128)) AS parent, CAST(NULL AS VARCHAR(128)) AS def FROM SYS.SYSSEQUENCES x JOIN SYS.SYSSCHEMAS s ON s.SCHEMAID = x.SCHEMAID WHERE s.SCHEMANAME = {s}",
    capitals=True,
)

FACTS = {"postgresql": POSTGRES, "mysql": MYSQL, "mariadb": MYSQL, "derby": DERBY}


class JdbcCatalog:
    """A schema of a database behind JDBC. Names in capitals of databases that fold to these are given in small letters."""

    def __init__(self, spark: SparkSession, url: str, schema: str, **options: str):
        self.spark, self.url, self.schema, self.options = spark, url, schema, options
        self.dialect = dialect_of(url)
        self.facts = FACTS[url.split(":")[1]]

    def query(self, sql: str) -> DataFrame:
        """Rows of a query that the database runs; column names in small letters."""
        rows = self.spark.read.format("jdbc").option("url", self.url).option("query", sql).options(**self.options).load()
        return rows.toDF(*(c.lower() for c in rows.columns))

    def _fact(self, name: str) -> DataFrame:
        return self.query(getattr(self.facts, name).replace("{s}", self.dialect.string(self.schema)))

    def _name(self, column: str | Column) -> Column:
        name = F.col(column) if isinstance(column, str) else column
        return F.when(name == F.upper(name), F.lower(name)).otherwise(name) if self.facts.capitals else name

    def columns(self) -> DataFrame:
        """catalog.COLUMNS, with Spark's types and defaults."""
        rows = self._fact("columns")
        kind = F.regexp_replace("type", "(?i) NOT NULL$", "")
        return rows.select(
            F.lit(self.schema).alias("schema_name"), self._name("table_name").alias("table_name"), self._name("column_name").alias("column_name"), F.col("ordinal").cast("int").alias("ordinal"),
            spark_type(kind).alias("type"), (F.col("not_null") == 1).alias("not_null"), spark_default("default_text").alias("default"),
        ).to(_schema(COLUMNS))

    def constraints(self) -> DataFrame:
        """catalog.CONSTRAINTS: keys, foreign keys and predicates."""
        listed = lambda place, name: F.array_sort(F.collect_set(F.struct(F.col(place).cast("int").alias("place"), self._name(name).alias("name"))))
        keys = self._fact("keys").groupBy("table_name", "name", "kind").agg(listed("place", "column_name").alias("c"), listed("ref_place", "ref_column").alias("r"), F.max(self._name("ref_table")).alias("ref_table"))
        named = keys.select(
            self._name("table_name").alias("table_name"), self._name("name").alias("name"), F.trim("kind").alias("kind"), F.col("c.name").alias("columns"),
            F.lit(None).cast("string").alias("predicate"), "ref_table", F.when(F.col("ref_table").isNotNull(), F.col("r.name")).alias("ref_columns"),
        )
        none = F.lit(None).cast("array<string>")
        checks = self._fact("predicates").select(self._name("table_name").alias("table_name"), self._name("name").alias("name"), F.lit("c").alias("kind"), F.array().cast("array<string>").alias("columns"), "predicate", F.lit(None).cast("string").alias("ref_table"), none.alias("ref_columns"))
        both = named.unionByName(checks)
        return both.select(F.lit(self.schema).alias("schema_name"), *both.columns).to(_schema(CONSTRAINTS))

    def objects(self) -> DataFrame:
        """catalog.OBJECTS: indexes, constraints, triggers, views and sequences, their texts without the schema's name."""
        parts = []
        for category in ("indexes", "triggers", "views", "sequences"):
            rows = self._fact(category).groupBy("name", "parent").agg(F.array_join(F.array_sort(F.collect_set(F.col("def").cast("string"))), "; ").alias("def"))
            parts.append(rows.select(F.lit(category).alias("category"), self._name("name").alias("name"), self._name("parent").alias("parent"), "def"))
        rules = self.constraints()
        text = F.concat_ws(" ", "kind", F.array_join("columns", ","), "predicate", "ref_table", F.array_join("ref_columns", ","))
        parts.append(rules.select(F.lit("constraints").alias("category"), "name", F.col("table_name").alias("parent"), text.alias("def")))
        rows = reduce(DataFrame.unionByName, parts)
        bare = F.regexp_replace(F.regexp_replace("def", rf'(?i)(?<![\w."])"?\Q{self.schema}\E"?\.', ""), r"\s+", " ")
        return rows.select(F.lit(self.schema).alias("schema_name"), "category", "name", "parent", F.trim(bare).alias("def")).to(_schema(OBJECTS))

    def names(self) -> dict[str, tuple[str, dict[str, str]]]:
        """Tables by name, ascending: the name that the database has, and its names of the columns, in order."""
        rows = self._fact("columns").select("table_name", "column_name", "ordinal", self._name("table_name").alias("t"), self._name("column_name").alias("c"))
        out: dict[str, tuple[str, dict[str, str]]] = {}
        for r in sorted(rows.collect(), key=lambda r: (r["t"], r["ordinal"])):
            out.setdefault(r["t"], (r["table_name"], {}))[1][r["c"]] = r["column_name"]
        return out

    def full(self, table: str) -> str:
        """A table's name in the database's text."""
        return self.dialect.quoted(self.schema, table)

    def counts(self, names: dict[str, str] | None = None) -> DataFrame:
        """(schema_name, table_name, n) of the tables, counted by the database, many in one query."""
        names = list(({t: held for t, (held, _) in self.names().items()} if names is None else names).items())
        parts = []
        for at in range(0, len(names), COUNTED):
            lines = (f"SELECT CAST({self.dialect.string(given)} AS {'CHAR(128)' if self.dialect.name == 'mysql' else 'VARCHAR(128)'}) AS table_name, count(*) AS n FROM {self.full(held)}" for given, held in names[at : at + COUNTED])
            parts.append(self.query(" UNION ALL ".join(lines)))
        if not parts:
            return self.spark.createDataFrame([], "schema_name string, table_name string, n long")
        return reduce(DataFrame.unionAll, parts).select(F.lit(self.schema).alias("schema_name"), F.trim("table_name").alias("table_name"), F.col("n").cast("long").alias("n"))

    def bounds(self, keys: dict[str, tuple[str, str]]) -> dict[str, tuple[int, int, int]]:
        """Smallest and largest key and rows of tables; keys: given name to (name, key column) in the database."""
        out, names = {}, list(keys.items())
        for at in range(0, len(names), COUNTED):
            lines = (f"SELECT {i} AS i, CAST(min({self.dialect.quoted(key)}) AS BIGINT) AS low, CAST(max({self.dialect.quoted(key)}) AS BIGINT) AS high, count(*) AS n FROM {self.full(held)}" for i, (_, (held, key)) in enumerate(names[at : at + COUNTED]))
            for r in self.query(" UNION ALL ".join(lines)).collect():
                out[names[at + r["i"]][0]] = (r["low"], r["high"], r["n"])
        return out


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl.replace("default string", "`default` string"))


def source_text(raw: DataFrame, table: str, spec: CloneSpec, url: str, key: str | None = None) -> str:
    """The query that filters, chooses and masks at the source; raw: the table as Spark sees it, for names and types.

    The filter is in the source's SQL. A masked key cannot deal out the reading, since ranges need its raw values.
    """
    dialect, kinds = dialect_of(url), {f.name: f.dataType for f in raw.schema}
    check_types(raw.schema, spec.masks)
    if missing := [c for c in spec.columns or () if c not in kinds]:
        raise SpecError(f"no such columns: {', '.join(missing)}")
    names = [c for c in raw.columns if spec.columns is None or c in spec.columns]
    if key is not None and (key in spec.masks or key not in names):
        raise SpecError(f"{key} deals out the reading, so it has to be copied unmasked")
    made = (f"{mask_sql(spec.masks[c], kinds[c], dialect)} AS {dialect.quoted(c)}" if c in spec.masks else dialect.quoted(c) for c in names)
    return f"SELECT {', '.join(made)} FROM {table}" + (f" WHERE {spec.where}" if spec.where else "")


def read_masked(spark: SparkSession, url: str, table: str, spec: CloneSpec, *, key: str | None = None, **reading) -> DataFrame:
    """What a copy takes of a table, filtered and masked by the database; masked columns keep their types."""
    options = {k: v for k, v in reading.items() if k not in ("lower", "upper", "parts")}
    raw = read_jdbc(spark, url, table, **options)
    rows = read_jdbc(spark, url, f"({source_text(raw, table, spec, url, key)}) tv", key=key, **reading)
    kinds = {f.name: f.dataType for f in raw.schema}
    return rows.select(*(F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in rows.columns))


def masks_there(raw: DataFrame, spec: CloneSpec, url: str) -> bool:
    """Whether the database can compute all masks of the specification."""
    try:
        source_text(raw, "t", spec, url)
    except SpecError:
        return False
    return True
