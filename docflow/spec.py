"""Rule specifications: what to look for in a document, written as data.

A :class:`Spec` names the record's fields with their constraints, the layouts a
document can have, and the checks that look at several fields at once. The
operators compile it to native column expressions, so another kind of document
needs another ``Spec`` and no other code.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

FIELD_TYPES = ("string", "bigint", "double", "date")

# A pattern shared by several rules is matched once on the text and its groups
# are then read from the matched piece, which has no surroundings to look at.
_LOOKS_AROUND = re.compile(r"\(\?<?[=!]|\\[bBGAZz]")


@dataclass(frozen=True)
class Field:
    """One field of the record and the constraints on its value."""

    name: str
    dtype: str = "string"
    required: bool = True
    min_length: int | None = None
    max_length: int | None = None
    gt: float | None = None
    ge: float | None = None
    choices: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.dtype not in FIELD_TYPES:
            raise ValueError(f"{self.name}: type {self.dtype!r} is not one of {FIELD_TYPES}")


@dataclass(frozen=True)
class Rule:
    """Field ``field`` is group ``group`` of ``pattern``'s first match.

    ``part`` reads a piece of a comma-separated address line: ``city`` or
    ``state``. A rule that finds nothing yields null.
    """

    field: str
    pattern: str
    group: int = 1
    part: str | None = None

    def __post_init__(self) -> None:
        if self.part not in (None, "city", "state"):
            raise ValueError(f"{self.field}: unknown address part {self.part!r}")


@dataclass(frozen=True)
class SectionCount:
    """Field ``field`` counts ``bullet`` matches from ``heading`` to the text's end."""

    field: str
    heading: str
    bullet: str


@dataclass(frozen=True)
class Layout:
    """A document template, recognised by a literal marker phrase.

    A layout without rules is recognised but has no parser.
    """

    name: str
    marker: str
    rules: tuple[Rule, ...] = ()
    counts: tuple[SectionCount, ...] = ()

    def __post_init__(self) -> None:
        for pattern in self.shared_patterns:
            if _LOOKS_AROUND.search(pattern):
                raise ValueError(f"layout {self.name}: shared pattern looks around: {pattern}")

    @property
    def has_parser(self) -> bool:
        return bool(self.rules or self.counts)

    @property
    def shared_patterns(self) -> tuple[str, ...]:
        """Patterns that feed more than one rule, in order of first use."""
        used = [rule.pattern for rule in self.rules]
        return tuple(p for p in dict.fromkeys(used) if used.count(p) > 1)


@dataclass(frozen=True)
class RecordCheck:
    """A check over several fields; both parts are SQL expressions over them."""

    violated: str
    message: str


@dataclass(frozen=True)
class Spec:
    fields: tuple[Field, ...]
    layouts: tuple[Layout, ...]
    checks: tuple[RecordCheck, ...] = ()

    def __post_init__(self) -> None:
        names = self.names
        if len(set(names)) != len(names):
            raise ValueError("field names must be unique")
        if len({layout.name for layout in self.layouts}) != len(self.layouts):
            raise ValueError("layout names must be unique")
        for layout in self.layouts:
            targets = [rule.field for rule in layout.rules] + [c.field for c in layout.counts]
            unknown = set(targets) - set(names)
            if unknown:
                raise ValueError(f"layout {layout.name}: no such fields: {sorted(unknown)}")
            if len(set(targets)) != len(targets):
                raise ValueError(f"layout {layout.name}: a field has more than one rule")

    @property
    def names(self) -> tuple[str, ...]:
        """Field names in record order, which is the order of every report."""
        return tuple(field.name for field in self.fields)

    @property
    def parsed(self) -> tuple[Layout, ...]:
        return tuple(layout for layout in self.layouts if layout.has_parser)

    def field(self, name: str) -> Field:
        return _named(self.fields, name, "field")

    def layout(self, name: str) -> Layout:
        return _named(self.layouts, name, "layout")


def _named(entries: tuple, name: str, kind: str):
    for entry in entries:
        if entry.name == name:
            return entry
    raise ValueError(f"unknown {kind} {name!r}")
