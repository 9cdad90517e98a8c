"""Copy specifications: options as a dict or JSON, read strictly."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import Any

#: Strategies, conflict modes, and the words that a row filter must not hold.
STRATEGIES = ("email", "name", "phone", "partial", "hash", "null", "random_int", "constant")
CONFLICTS = ("append", "error", "skip", "replace", "rename")
FORBIDDEN = ("INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER", "TRUNCATE", "GRANT", "REVOKE", "COPY", "EXECUTE", "CALL", "DO", "SET", "RESET", "LOAD")

_WORDS = re.compile(r"[A-Za-z0-9_]+")


class SpecError(ValueError):
    """An option that cannot be honoured."""


@dataclass(frozen=True)
class MaskRule:
    column: str
    strategy: str
    prefix: int = 1
    suffix: int = 1
    low: int = 0
    high: int = 99_999
    value: str = ""
    seed: int | None = None


def read_rule(column: str, given: str | dict[str, Any]) -> MaskRule:
    """A rule from "strategy" or {"type": strategy, ...}."""
    short = isinstance(given, str)
    options = {"type": given} if short else dict(given)
    strategy = options.pop("type", None)
    if strategy not in STRATEGIES:
        raise SpecError(f"column {column}: unknown mask strategy {strategy!r}")
    allowed = {"partial": {"prefix", "suffix"}, "random_int": {"min", "max", "seed"}, "constant": {"value"}}.get(strategy, set())
    if unknown := set(options) - allowed:
        raise SpecError(f"column {column}: {strategy} takes no {', '.join(sorted(unknown))}")
    if strategy == "partial":
        prefix, suffix = int(options.get("prefix", 1)), int(options.get("suffix", 1))
        if min(prefix, suffix) < 0:
            raise SpecError(f"column {column}: prefix and suffix must not be negative")
        return MaskRule(column, strategy, prefix=prefix, suffix=suffix)
    if strategy == "random_int":
        low, high = int(options.get("min", 0)), int(options.get("max", 0))
        if low == high == 0:
            high = 99_999
        return MaskRule(column, strategy, low=min(low, high), high=max(low, high), seed=options.get("seed"))
    if strategy == "constant":
        return MaskRule(column, strategy, value="REDACTED" if short else str(options.get("value", "")))
    return MaskRule(column, strategy)


def read_rules(given: str | dict[str, Any]) -> dict[str, MaskRule]:
    try:
        rules = json.loads(given) if isinstance(given, str) else given
    except ValueError as e:
        raise SpecError(f"mask rules are not JSON: {e}") from e
    if not isinstance(rules, dict) or not rules:
        raise SpecError("mask rules must be a non-empty object")
    return {column: read_rule(column, rule) for column, rule in rules.items()}


def check_filter(text: str) -> str:
    """The filter itself, if it holds no statement separator and none of the forbidden words, quoted or not."""
    if ";" in text:
        raise SpecError("a row filter must not hold ';'")
    if bad := sorted({w.upper() for w in _WORDS.findall(text)} & set(FORBIDDEN)):
        raise SpecError(f"a row filter must not hold {', '.join(bad)}")
    return text


def check_schema_name(name: str) -> str:
    if not name or len(name.encode()) > 63 or any(ord(c) < 32 or ord(c) == 127 for c in name):
        raise SpecError(f"bad schema name {name!r}")
    return name


def check_database_name(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_]+", name):
        raise SpecError(f"bad database name {name!r}")
    return name


@dataclass(frozen=True)
class CloneSpec:
    include_data: bool = True
    columns: tuple[str, ...] | None = None
    where: str | None = None
    masks: dict[str, MaskRule] = field(default_factory=dict)
    conflict: str = "append"
    parallel: int = 1
    matviews: bool = True
    views: bool = True

    @staticmethod
    def read(given: str | dict[str, Any] | CloneSpec | None = None) -> CloneSpec:
        """A specification from its options; unknown keys and bad values are errors."""
        if isinstance(given, CloneSpec):
            return given
        try:
            options = dict(json.loads(given) if isinstance(given, str) else given or {})
        except (ValueError, TypeError) as e:
            raise SpecError(f"options are not a JSON object: {e}") from e
        where = options.pop("where", options.pop("filter", None))
        masks = options.pop("mask", None)
        columns = options.pop("columns", None)
        conflict = options.pop("conflict", "append")
        known = {"include_data", "parallel", "matviews", "views"}
        if unknown := set(options) - known:
            raise SpecError(f"unknown options: {', '.join(sorted(unknown))}")
        if conflict not in CONFLICTS:
            raise SpecError(f"unknown conflict mode {conflict!r}")
        if columns is not None and not columns:
            raise SpecError("the column list is empty")
        return CloneSpec(columns=tuple(columns) if columns is not None else None, where=check_filter(where) if where else None, masks=read_rules(masks) if masks else {}, conflict=conflict, **options)
