"""Filter predicates (F1, F7) and first-failure classification."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_failure(checks: Sequence[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """First label whose failure condition is true; ``otherwise`` when none is.

    Conditions are wrapped in ``coalesce(cond, false)`` so a NULL test never
    counts as a failure by accident (the three-valued ``~NULL`` trap).
    """
    expr = None
    for label, failed in checks:
        cond = F.coalesce(failed, F.lit(False))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise)) if otherwise is not None else expr


def bronze_valid(key="transaction_id", merchant="merchant_id", amount="amount") -> Column:
    """key, merchant and amount present and amount > 0 (NULL -> false)."""
    return F.coalesce(
        _c(key).isNotNull() & _c(merchant).isNotNull() & _c(amount).isNotNull() & (_c(amount) > 0),
        F.lit(False))


def within_days(d, anchor, days: int) -> Column:
    """``anchor - days <= d <= anchor`` (inclusive both ends)."""
    a = _c(anchor)
    return (_c(d) >= F.date_sub(a, days)) & (_c(d) <= a)
