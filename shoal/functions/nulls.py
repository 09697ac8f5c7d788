"""R-compatible null semantics as Column expressions.

The surveys were integrated with dplyr, whose NA rules differ from SQL's in
ways that change results silently.  Each helper pins one rule:

* ``strict_sum``   - ``sum()`` without ``na.rm``: null if any input is null.
* ``sum0``         - ``sum(na.rm=TRUE)``: zero over nothing.
* ``r_ifelse``     - ``ifelse``/``if_else(missing=)``: null condition is null
                     (or ``missing``), not the else branch.
* ``in_list``      - ``%in%``: never null, so ``!x %in% s`` keeps nulls.
* ``recode``       - ``dplyr::recode`` with explicit default.
* ``null_safe_on`` - dplyr joins match NA keys to NA keys.
"""

from __future__ import annotations

from functools import reduce
from typing import Any, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP = object()  # recode default: keep unmatched values unchanged


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def strict_sum(c: str | Column) -> Column:
    """Aggregate: sum, or null when any value in the group is null."""
    c = col_of(c)
    return F.when(F.count(F.lit(1)) == F.count(c), F.sum(c))


def sum0(c: str | Column) -> Column:
    """Aggregate: sum ignoring nulls, 0 over nothing."""
    return F.coalesce(F.sum(col_of(c)), F.lit(0))


def r_ifelse(cond: Column, yes: Any, no: Any, missing: Any = None) -> Column:
    """``ifelse(cond, yes, no)``: a null condition yields ``missing``."""
    def lit(v):
        return v if isinstance(v, Column) else F.lit(v)
    return (F.when(cond.isNull(), lit(missing))
            .when(cond, lit(yes))
            .otherwise(lit(no)))


def in_list(c: str | Column, values: Iterable[Any]) -> Column:
    """``x %in% values``: false (never null) for null x."""
    return F.coalesce(col_of(c).isin(list(values)), F.lit(False))


def not_in(c: str | Column, values: Iterable[Any]) -> Column:
    return ~in_list(c, values)


def r_grepl(c: str | Column, pattern: str, ignore_case: bool = False) -> Column:
    """``grepl``: null input is FALSE."""
    pat = ("(?i)" if ignore_case else "") + pattern
    return F.coalesce(col_of(c).rlike(pat), F.lit(False))


def recode(c: str | Column, mapping: Mapping[Any, Any], default: Any = KEEP) -> Column:
    """CASE over a literal mapping.

    ``default=KEEP`` keeps unmatched values (string recode); ``None`` turns
    them null (recode that changes type); any other value replaces them.
    """
    c = col_of(c)
    expr = None
    for key, value in mapping.items():
        cond = c.isNull() if key is None else (c == F.lit(key))
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if expr is None:
        return c if default is KEEP else F.lit(default)
    return expr.otherwise(c if default is KEEP else F.lit(default))


def null_safe_on(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> Column:
    """Join condition matching null keys to null keys."""
    return reduce(lambda a, b: a & b,
                  [left[quoted(k)].eqNullSafe(right[quoted(k)]) for k in keys])


def strict_divide(num: Column, den: Column) -> Column:
    """Division that is null where R would give Inf/NaN (x/0)."""
    return F.try_divide(num, den)
