"""One helper for expressions that mention a value many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it.

    Without it a nested expression is copied into every mention, and the generated code
    grows past what can be compiled.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
