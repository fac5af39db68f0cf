"""Casts and divisions that give null where ANSI mode would raise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def to_measure(c: Column | str) -> Column:
    """Double with NaN made null: a NaN would be carried forward by a fill."""
    return F.nanvl(to_double(c), F.lit(None).cast("double"))


def to_long(c: Column | str) -> Column:
    """Whole number, fraction cut off; ``'12.0'`` is no bigint under ANSI, but it is a decimal."""
    x = _col(c)
    return F.coalesce(x.try_cast("bigint"), x.try_cast("decimal(38,6)").try_cast("bigint"))


def to_date(c: Column | str) -> Column:
    return _col(c).try_cast("date")


def nonzero(c: Column | str) -> Column:
    """The value, or null where it is zero."""
    return F.nullif(_col(c), F.lit(0))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; null where the denominator is null or zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def first_nonzero(*cs: Column | str) -> Column:
    """The first value that is neither null nor zero, else the last value."""
    *head, last = cs
    return F.coalesce(*[nonzero(c) for c in head], _col(last))


def first_nonempty(*cs: Column | str) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cs])


def is_blank(c: Column | str) -> Column:
    """Null or numeric zero; text that is no number is not blank."""
    return _col(c).isNull() | F.coalesce(to_double(c) == 0, F.lit(False))
