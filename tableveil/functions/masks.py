"""Masks as built-in column expressions: they run in code generation, on batches and on streams alike.

A mask is a tree (functions.expressions), from which the column, the text of a view and the text that a database runs
are all made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.spec import CloneSpec, MaskRule, SpecError
from .expressions import Dialect, Node, above, add, as_text, case, column, concat, digest, drawn, is_null, left, length, literal, null, position, right, substring, subtract, to_column

#: Strategies whose result is text.
TEXT = {"email", "name", "phone", "partial", "hash"}


def tree(rule: MaskRule, kind: T.DataType) -> Node:
    """What the rule computes from its column; nulls stay null but for random_int and constant, which replace them too."""
    text = as_text(column(rule.column))
    size = length(text)
    unless_null = lambda *branches: case(is_null(text), null(T.StringType()), *branches)
    match rule.strategy:
        case "email":
            # Of a text with several @, the part between the first two.
            at = position("@", text)
            rest = substring(text, add(at, literal(1)), size)
            part = case(above(position("@", rest), literal(0)), substring(rest, literal(1), subtract(position("@", rest), literal(1))), rest)
            return unless_null(above(at, literal(0)), concat(left(text, 1), literal("***@"), part), literal("***"))
        case "name":
            return unless_null(literal("XXXX"))
        case "phone":
            return unless_null(above(size, literal(4)), concat(literal("***-"), right(text, 4)), literal("****"))
        case "partial":
            most = rule.prefix + rule.suffix
            if not most:
                return unless_null(above(size, literal(0)), literal("***"), literal(""))
            ends = [left(text, rule.prefix), literal("***"), right(text, rule.suffix)]
            kept = concat(*(e for e, n in zip(ends, (rule.prefix, 1, rule.suffix), strict=True) if n))
            return unless_null(above(size, literal(most)), kept, substring(literal("*" * most), literal(1), size))
        case "hash":
            return digest(text)
        case "null":
            return null(kind)
        case "random_int":
            return drawn(rule.low, rule.high, rule.seed)
        case "constant":
            return literal(rule.value)
    raise SpecError(f"unknown mask strategy {rule.strategy!r}")


def mask(rule: MaskRule, kind: T.DataType) -> Column:
    """The masked column."""
    return to_column(tree(rule, kind))


def mask_sql(rule: MaskRule, kind: T.DataType, dialect: Dialect) -> str:
    """The masked column as a database's SQL text; an error where the database cannot compute it."""
    return dialect.sql(tree(rule, kind))


def check_types(schema: T.StructType, rules: dict[str, MaskRule], required: set[str] = frozenset()) -> None:
    """Refuses, before anything runs, masks whose result a table's column could not hold."""
    kinds = {f.name: f.dataType for f in schema}
    if missing := [c for c in rules if c not in kinds]:
        raise SpecError(f"mask rules for columns that do not exist: {', '.join(missing)}")
    for column, rule in rules.items():
        kind = kinds[column]
        textual = isinstance(kind, (T.StringType, T.CharType, T.VarcharType))
        if rule.strategy in TEXT and not textual:
            raise SpecError(f"column {column}: {rule.strategy} makes text, the column is {kind.simpleString()}")
        if rule.strategy == "random_int" and not (textual or isinstance(kind, T.NumericType)):
            raise SpecError(f"column {column}: random_int does not fit {kind.simpleString()}")
        if rule.strategy == "null" and column in required:
            raise SpecError(f"column {column} must not be null")
        if rule.strategy == "constant" and isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            raise SpecError(f"column {column}: a constant does not fit {kind.simpleString()}")


def apply_masks(df: DataFrame, rules: dict[str, MaskRule], keep_types: bool = True) -> DataFrame:
    """df with masked columns in place; keep_types casts each result to its column's type (a view need not)."""
    kinds = {f.name: f.dataType for f in df.schema}
    out = []
    for name, kind in kinds.items():
        kept = F.col(f"`{name}`")
        if name in rules:
            masked = mask(rules[name], kind)
            kept = (masked.cast(kind) if keep_types else masked).alias(name)
        out.append(kept)
    return df.select(*out)


def shape(df: DataFrame, spec: CloneSpec) -> DataFrame:
    """Rows and columns that a copy takes: the filter sees raw values, then columns in source order, then masks.

    Rules for columns outside the list are left aside; a listed column or a rule without a column is an error.
    """
    if missing := [c for c in spec.columns or () if c not in df.columns]:
        raise SpecError(f"no such columns: {', '.join(missing)}")
    check_types(df.schema, spec.masks)
    if spec.where:
        df = df.where(spec.where)
    if spec.columns is not None:
        df = df.select(*(f"`{c}`" for c in df.columns if c in spec.columns))
    rules = {c: r for c, r in spec.masks.items() if c in df.columns}
    return apply_masks(df, rules) if rules else df
