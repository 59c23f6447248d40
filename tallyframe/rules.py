"""Configuration of a comparison, run identity, and the status vocabulary."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame

# Statuses are part of the interface.
SOURCE_ONLY, TARGET_ONLY, MATCH, CHANGED = "SOURCE_ONLY", "TARGET_ONLY", "MATCH", "CHANGED"
SOURCE_NULL, TARGET_NULL, VALUE_MISMATCH = "SOURCE_NULL", "TARGET_NULL", "VALUE_MISMATCH"
MISSING_IN_SOURCE, MISSING_IN_TARGET, MISMATCH, HASH_MISMATCH = "MISSING_IN_SOURCE", "MISSING_IN_TARGET", "MISMATCH", "HASH_MISMATCH"
ONLY_IN_SOURCE, ONLY_IN_TARGET, COUNT_MISMATCH = "ONLY_IN_SOURCE", "ONLY_IN_TARGET", "COUNT_MISMATCH"
EXACT_MATCH, FALSE_MISMATCH, TRUE_MISMATCH = "EXACT_MATCH", "FALSE_MISMATCH", "TRUE_MISMATCH"
PASS, FAIL, COUNTS_ONLY, ERROR = "PASS", "FAIL", "COUNTS_ONLY", "ERROR"
NULL_TEXT, HASH_NULL = "<NULL>", "∅"
NULL_EQUIVALENTS = ("", "null", "n/a", "na")


def parse_column_list(value: str | Iterable[str] | None) -> list[str]:
    """Names from a comma-separated string or any iterable; blanks go, order stays."""
    if value is None:
        return []
    parts = value.split(",") if isinstance(value, str) else value
    return unique_in_order(p.strip() for p in parts if p and p.strip())


def unique_in_order(values: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(values))


def duplicate_labels(columns: Iterable[str]) -> list[str]:
    """Column labels that occur more than once, ignoring case."""
    seen: dict[str, int] = {}
    for c in columns:
        seen[c.lower()] = seen.get(c.lower(), 0) + 1
    return [c for c, n in seen.items() if n > 1]


def selected_tables(names: Iterable[str], include: str | None = None, exclude: str | None = None, most: int | None = None) -> list[str]:
    """Sorted table names that fully match ``include`` and not ``exclude``; at most ``most``."""
    kept = [n for n in sorted(names) if (not include or re.fullmatch(include, n)) and not (exclude and re.fullmatch(exclude, n))]
    return kept[:most] if most else kept


@dataclass(frozen=True)
class ReconRule:
    """How two copies of a table are compared."""

    keys: tuple[str, ...]
    exclude: tuple[str, ...] = ()
    source_where: str | None = None
    target_where: str | None = None
    numeric_abs: float = 0.0
    numeric_rel: float = 0.0
    timestamp_seconds: float = 0.0
    trim_strings: bool = False
    lower_strings: bool = False
    null_equivalents: tuple[str, ...] = ()
    hash_buckets: int = 1024
    zone: str = "UTC"

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("a rule needs at least one key column")
        if min(self.numeric_abs, self.numeric_rel, self.timestamp_seconds) < 0:
            raise ValueError("tolerances are not negative")
        if self.hash_buckets < 1:
            raise ValueError("hash_buckets is at least 1")


@dataclass(frozen=True)
class TablePair:
    """Two frames that ought to hold the same records."""

    source: DataFrame
    target: DataFrame
    name: str = "table"

    def filtered(self, rule: ReconRule) -> "TablePair":
        source = self.source.where(rule.source_where) if rule.source_where else self.source
        target = self.target.where(rule.target_where) if rule.target_where else self.target
        return TablePair(source, target, self.name)


@dataclass(frozen=True)
class RunContext:
    """Identity of a run; pass both values in for reproducible reports."""

    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None))


def resolve(columns: Iterable[str], wanted: Iterable[str]) -> list[str]:
    """``wanted`` names as they are spelled in ``columns``, ignoring case; an error names all that are missing."""
    by_lower = {c.lower(): c for c in columns}
    missing = [w for w in wanted if w.lower() not in by_lower]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    return [by_lower[w.lower()] for w in wanted]


def common_columns(pair: TablePair, rule: ReconRule, same_type: bool = False) -> list[tuple[str, str]]:
    """(source, target) spellings of the shared columns: keys first, then source order, without exclusions.

    ``same_type`` keeps only columns whose types are equal on both sides.
    """
    target = {f.name.lower(): f for f in pair.target.schema}
    keys = [k.lower() for k in resolve(pair.source.columns, rule.keys)]
    resolve(pair.target.columns, rule.keys)
    out = {x.lower() for x in rule.exclude} - set(keys)
    shared = [
        (f.name, target[f.name.lower()].name)
        for f in pair.source.schema
        if f.name.lower() in target and f.name.lower() not in out
        and (not same_type or f.name.lower() in keys or f.dataType == target[f.name.lower()].dataType)
    ]
    return sorted(shared, key=lambda c: keys.index(c[0].lower()) if c[0].lower() in keys else len(keys))
