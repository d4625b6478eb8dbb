"""Guarded percentages, shares and small flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .dates import as_col

MONEY = "decimal(19,4)"


def pct_of(num: str, den: str, cast: str = "decimal(9,2)", as_text: bool = False) -> Column:
    """100 * num / den, 0 when den is 0, rounded half up to ``cast``. Both are column names or SQL text."""
    n, d = (f"cast({x} as decimal(20,0))" for x in (num, den))
    out = f"if({d} = 0, cast(0 as {cast}), cast({n} * 100 / nullif({d}, 0) as {cast}))"
    return F.expr(f"concat(cast({out} as string), '%')" if as_text else out)


def share_of(num: str, den: str, cast: str = "decimal(9,6)", empty: str = "0") -> Column:
    """num / den, ``empty`` (SQL text) when den is 0."""
    n, d = (f"cast({x} as decimal(20,0))" for x in (num, den))
    return F.expr(f"if({d} = 0, cast({empty} as {cast}), cast({n} / nullif({d}, 0) as {cast}))")


def money_share(num: str, den: str, digits: int = 3) -> Column:
    """num / den of two amounts rounded to ``digits``, 0 when den is 0 or missing."""
    kind = f"decimal(18,{digits})"
    n, d = (f"coalesce(cast({x} as decimal(28,4)), 0)" for x in (num, den))
    return F.expr(f"if({d} = 0, cast(0 as {kind}), cast(round({n} / nullif({d}, 0), {digits}) as {kind}))")


def not_null_and_positive(c) -> Column:
    """1 when the value is present and above zero, else 0."""
    return F.when(F.coalesce(as_col(c), F.lit(0)) > 0, 1).otherwise(0)


def yes_no(cond: Column, yes: str = "Y", no: str = "N") -> Column:
    """``yes`` where the condition holds; an unknown condition counts as ``no``."""
    return F.when(cond, yes).otherwise(no)


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))
