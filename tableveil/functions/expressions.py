"""Scalar expressions as small trees that compile to a Spark column, Spark SQL text, or another database's SQL text.

One tree says what a mask computes, and every form of it is made from that tree, so the forms cannot drift apart. The
trees hold only what all dialects have: length, position, substring, concatenation, CASE, comparison and literals; what
a database lacks (a digest, say) its dialect refuses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.spec import SpecError


@dataclass(frozen=True)
class Node:
    """kind: column, text, number, null, or the name of an operation over `parts`."""

    kind: str
    parts: tuple = ()


def column(name: str) -> Node:
    return Node("column", (name,))


def literal(value: str | int) -> Node:
    return Node("text" if isinstance(value, str) else "number", (value,))


def null(kind: T.DataType) -> Node:
    return Node("null", (kind,))


def as_text(x: Node) -> Node:
    return Node("as_text", (x,))


def length(x: Node) -> Node:
    return Node("length", (x,))


def position(mark: str, x: Node) -> Node:
    """Place of the first mark in x, from 1; 0 without one."""
    return Node("position", (literal(mark), x))


def substring(x: Node, start: Node, count: Node) -> Node:
    return Node("substring", (x, start, count))


def concat(*parts: Node) -> Node:
    return Node("concat", parts)


def add(a: Node, b: Node) -> Node:
    return Node("add", (a, b))


def subtract(a: Node, b: Node) -> Node:
    return Node("subtract", (a, b))


def above(a: Node, b: Node) -> Node:
    return Node("above", (a, b))


def is_null(x: Node) -> Node:
    return Node("is_null", (x,))


def case(*branches: Node) -> Node:
    """Condition, value, condition, value ..., value otherwise."""
    return Node("case", branches)


def digest(x: Node) -> Node:
    """MD5 of a text, 32 hexadecimal digits."""
    return Node("digest", (x,))


def drawn(low: int, high: int, seed: int | None) -> Node:
    """A whole number from low to high, drawn per row."""
    return Node("drawn", (low, high, seed))


def left(x: Node, n: int) -> Node:
    return substring(x, literal(1), literal(n))


def right(x: Node, n: int) -> Node:
    """The last n characters of a text that has as many."""
    return substring(x, add(subtract(length(x), literal(n)), literal(1)), literal(n))


def to_column(node: Node) -> Column:
    """The Spark column."""
    p = node.parts
    match node.kind:
        case "column":
            return F.col(f"`{p[0].replace('`', '``')}`")
        case "text" | "number":
            return F.lit(p[0])
        case "null":
            return F.lit(None).cast(p[0])
        case "as_text":
            return to_column(p[0]).cast("string")
        case "length":
            return F.length(to_column(p[0]))
        case "position":
            return F.position(to_column(p[0]), to_column(p[1]))
        case "substring":
            return F.substring(*map(to_column, p))
        case "concat":
            return F.concat(*map(to_column, p))
        case "add":
            return to_column(p[0]) + to_column(p[1])
        case "subtract":
            return to_column(p[0]) - to_column(p[1])
        case "above":
            return to_column(p[0]) > to_column(p[1])
        case "is_null":
            return to_column(p[0]).isNull()
        case "digest":
            return F.md5(to_column(p[0]))
        case "drawn":
            share = F.rand(p[2]) if p[2] is not None else F.rand()
            return F.floor(share * (p[1] - p[0] + 1) + p[0]).cast("int")
        case "case":
            out = F.when(to_column(p[0]), to_column(p[1]))
            for i in range(2, len(p) - 1, 2):
                out = out.when(to_column(p[i]), to_column(p[i + 1]))
            return out.otherwise(to_column(p[-1]))
    raise SpecError(f"no column for {node.kind}")


class Dialect:
    """SQL text of trees. The base writes the standard's functions; a method returns None for what a database lacks."""

    name, mark, text = "standard", '"', "VARCHAR(32672)"

    def quoted(self, *names: str) -> str:
        return ".".join(f"{self.mark}{n.replace(self.mark, 2 * self.mark)}{self.mark}" for n in names)

    def string(self, value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def null(self, kind: T.DataType) -> str:
        return "NULL"

    def length(self, x: str) -> str:
        return f"length({x})"

    def position(self, mark: str, x: str) -> str:
        return f"position({mark} IN {x})"

    def substring(self, x: str, start: str, count: str) -> str:
        return f"substr({x}, {start}, {count})"

    def concat(self, *parts: str) -> str:
        return "(" + " || ".join(parts) + ")"

    def digest(self, x: str) -> str | None:
        return None

    def drawn(self, low: int, high: int, seed: int | None) -> str | None:
        return None

    def sql(self, node: Node) -> str:
        p = node.parts
        match node.kind:
            case "column":
                return self.quoted(p[0])
            case "text":
                return self.string(p[0])
            case "number":
                return str(p[0])
            case "null":
                return self.null(p[0])
            case "as_text":
                return f"CAST({self.sql(p[0])} AS {self.text})"
            case "add" | "subtract" | "above":
                sign = {"add": "+", "subtract": "-", "above": ">"}[node.kind]
                return f"({self.sql(p[0])} {sign} {self.sql(p[1])})"
            case "is_null":
                return f"({self.sql(p[0])} IS NULL)"
            case "case":
                whens = " ".join(f"WHEN {self.sql(p[i])} THEN {self.sql(p[i + 1])}" for i in range(0, len(p) - 1, 2))
                return f"CASE {whens} ELSE {self.sql(p[-1])} END"
            case "drawn":
                out = self.drawn(*p)
            case _:
                out = getattr(self, node.kind)(*map(self.sql, p))
        if out is None:
            raise SpecError(f"{self.name} has no {node.kind}")
        return out


class Spark(Dialect):
    """Text for views that outlive the session."""

    name, mark, text = "spark", "`", "STRING"

    def string(self, value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def null(self, kind: T.DataType) -> str:
        return f"CAST(NULL AS {kind.simpleString()})"

    def concat(self, *parts: str) -> str:
        return f"concat({', '.join(parts)})"

    def digest(self, x: str) -> str:
        return f"md5({x})"

    def drawn(self, low: int, high: int, seed: int | None) -> str:
        return f"CAST(floor(rand({'' if seed is None else seed}) * {high - low + 1} + {low}) AS INT)"


class Postgres(Dialect):
    """PostgreSQL and what speaks as it does."""

    name, text = "postgresql", "TEXT"

    def digest(self, x: str) -> str:
        return f"md5({x})"

    def drawn(self, low: int, high: int, seed: int | None) -> str | None:
        # The database's draws cannot be repeated by a seed of ours.
        return f"CAST(floor(random() * {high - low + 1} + {low}) AS INTEGER)" if seed is None else None


class MySql(Dialect):
    name, mark, text = "mysql", "`", "CHAR"

    def string(self, value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "''") + "'"

    def length(self, x: str) -> str:
        return f"char_length({x})"

    def concat(self, *parts: str) -> str:
        return f"concat({', '.join(parts)})"

    def digest(self, x: str) -> str:
        return f"md5({x})"

    def drawn(self, low: int, high: int, seed: int | None) -> str:
        return f"CAST(floor(rand({'' if seed is None else seed}) * {high - low + 1} + {low}) AS SIGNED)"


class Derby(Dialect):
    """Derby has neither digests nor draws per row."""

    name = "derby"

    def null(self, kind: T.DataType) -> str:
        names = {T.StringType: self.text, T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE", T.DateType: "DATE", T.TimestampType: "TIMESTAMP", T.BooleanType: "BOOLEAN", T.ShortType: "SMALLINT", T.FloatType: "REAL"}
        if isinstance(kind, T.DecimalType):
            return f"CAST(NULL AS DECIMAL({kind.precision}, {kind.scale}))"
        if isinstance(kind, (T.VarcharType, T.CharType)):
            return f"CAST(NULL AS VARCHAR({kind.length}))"
        if type(kind) not in names:
            raise SpecError(f"derby has no {kind.simpleString()}")
        return f"CAST(NULL AS {names[type(kind)]})"

    def position(self, mark: str, x: str) -> str:
        return f"locate({mark}, {x})"


#: By the name that a JDBC address begins with.
DIALECTS: dict[str, Dialect] = {"postgresql": Postgres(), "mysql": MySql(), "mariadb": MySql(), "derby": Derby()}


def dialect_of(url: str) -> Dialect:
    """The dialect of jdbc:<name>:..."""
    name = url.split(":")[1] if url.count(":") > 1 else ""
    if name not in DIALECTS:
        raise SpecError(f"no SQL dialect for {name or url}")
    return DIALECTS[name]
