"""Optional filters folded into one predicate, as a search form sends them."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(clauses: Iterable[Column | None]) -> Column | None:
    """AND of the clauses that were given; None when none was."""
    given = [c for c in clauses if c is not None]
    return reduce(and_, given) if given else None


def equals(column: Column, value) -> Column | None:
    return None if value is None else column == F.lit(value)


def at_least(column: Column, value) -> Column | None:
    return None if value is None else column >= value


def at_most(column: Column, value) -> Column | None:
    return None if value is None else column <= value


def same_text(column: Column, value: str | None) -> Column | None:
    """Case-insensitive equality."""
    return None if not value else F.lower(column) == F.lower(F.lit(value))


def contains_text(column: Column, value: str | None) -> Column | None:
    """Case-insensitive containment; % and _ in the value act as wildcards."""
    return None if not value else column.ilike(f"%{value}%")
