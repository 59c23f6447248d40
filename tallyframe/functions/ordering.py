"""Orders of reports for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..rules import CHANGED, ERROR, FAIL, SOURCE_ONLY, TARGET_ONLY

#: What a reader looks for first; all that is not named comes after.
WORST_FIRST = (ERROR, FAIL)
ROWS_FIRST = (CHANGED, SOURCE_ONLY, TARGET_ONLY)


def status_rank(status: Column, order: tuple[str, ...] = WORST_FIRST) -> Column:
    """The place of a status in ``order``, from 1; one that is not in it, or null, comes after."""
    rank = F.array_position(F.array(*map(F.lit, order)), status)
    return F.coalesce(F.nullif(rank, F.lit(0)), F.lit(len(order) + 1)).cast("int")


def for_display(df: DataFrame, then: list[str], status: str = "status", order: tuple[str, ...] = WORST_FIRST) -> DataFrame:
    """``df`` with ``display_rank``, in the order of ranks, then of the columns ``then``, nulls last."""
    ranked = df.withColumn("display_rank", status_rank(F.col(f"`{status}`"), order))
    return ranked.orderBy("display_rank", *(F.col(f"`{c}`").asc_nulls_last() for c in then))
