"""What tests compare with: days, sorted rows, close numbers."""

from __future__ import annotations

import datetime
import math


def day(n: int) -> datetime.date:
    return datetime.date(2026, 1, 1) + datetime.timedelta(days=n)


def rows(df, *order):
    """Rows as tuples, sorted by the given columns."""
    names = df.columns
    picked = sorted(df.collect(), key=lambda r: tuple(
        (r[c] is not None, r[c]) for c in (order or names)))
    return [tuple(r) for r in picked]


def column(df, name, *order):
    return [r[df.columns.index(name)] for r in rows(df, *order)]


def close_to(a, b, rel=1e-9):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=rel, abs_tol=1e-12)
