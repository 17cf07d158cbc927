"""Filters that the scan applies to a file's values while it reads the file.

A predicate is (column, op, value) with a column of the scan that holds text or
a flag, or one group of a person name (``("PatientName", "Alphabetic")``). Null
compares as in SQL: the row is dropped, also under ``not``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

OPS: dict[str, Callable] = {
    "=": lambda a, b: a == b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "startswith": lambda a, b: a.startswith(b),
    "endswith": lambda a, b: a.endswith(b),
    "contains": lambda a, b: b in a,
}
NULL_OPS = ("is null", "is not null", "<=>")


@dataclass(frozen=True)
class Predicate:
    column: tuple       # (name,) or (name, field)
    op: str
    value: object = None
    negated: bool = False

    @property
    def takes_null(self) -> bool:
        """Whether a row whose column is null can pass."""
        return self.holds(None)

    def holds(self, value) -> bool:
        """Whether the row is wanted, ``value`` being the column's."""
        if value is not None and len(self.column) > 1:
            value = value[self.column[1]]
        if self.op in NULL_OPS:
            if self.op == "<=>":
                hit = value == self.value if value is not None else self.value is None
            else:
                hit = (value is None) == (self.op == "is null")
        elif value is None or self.value is None:
            return False
        else:
            hit = OPS[self.op](value, self.value)
        return hit != self.negated


def predicate(column, op: str, value=None, negated: bool = False) -> Predicate:
    """``column``: a name, or (name, field) of a person name."""
    column = (column,) if isinstance(column, str) else tuple(column)
    if op not in OPS and op not in NULL_OPS:
        raise ValueError(f"unknown filter {op!r}: one of {', '.join((*OPS, *NULL_OPS))}")
    return Predicate(column, op, tuple(value) if op == "in" else value, negated)
