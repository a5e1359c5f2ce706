"""Declarations that describe a table; every operator is driven by these."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

KeepWhen = Callable[[list[str]], Column | None]


@dataclass(frozen=True)
class Rule:
    """Rows stay where ``keep`` is true. ``keep`` sees the column names; None means: not applicable."""

    rule_id: str
    description: str
    keep: KeepWhen
    columns: tuple[str, ...] = ()
    severity: str = "medium"
    rationale: str = ""


@dataclass(frozen=True)
class ForeignKey:
    child: str
    parent: str
    columns: tuple[str, ...]
    parent_columns: tuple[str, ...] = ()  # same names as in the child when empty


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...]
    casts: dict[str, str] = field(default_factory=dict)
    defaults_from: dict[str, str] = field(default_factory=dict)  # new column -> column it copies
    not_null: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    dedupe_keys: tuple[str, ...] = ()
    dedupe_order: tuple[str, ...] = ()
    repeats_checked: tuple[str, ...] = ()  # repeats on these columns are counted and kept
    optional: bool = False
    empty_ddl: str = ""
    provenance: tuple[str, ...] = ("source_file",)
    cast_rule_id: str = "SIL_CAST_NUM"
