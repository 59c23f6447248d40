"""Tolerant equality, differences, and the semantic class of a mismatch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..rules import EXACT_MATCH, FALSE_MISMATCH, NULL_TEXT, TRUE_MISMATCH, ReconRule
from .classify import is_datelike, is_numberlike


def seconds(col: Column) -> Column:
    """Seconds since the epoch of a timestamp of either kind, or of a date."""
    return F.unix_micros(col.cast("timestamp")) / F.lit(1e6)


def equal(s: Column, t: Column, kind: T.DataType, rule: ReconRule) -> Column:
    """Both null: true; one null: false; numbers and timestamps within the rule's tolerance; else equality."""
    same = s.eqNullSafe(t)
    if isinstance(kind, T.NumericType) and (rule.numeric_abs or rule.numeric_rel):
        a, b = s.cast("double"), t.cast("double")
        limit = F.greatest(F.lit(float(rule.numeric_abs)), F.lit(float(rule.numeric_rel)) * F.greatest(F.abs(a), F.abs(b), F.lit(1.0)))
        return F.coalesce(F.abs(a - b) <= limit, same)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) and rule.timestamp_seconds:
        return F.coalesce(F.abs(seconds(s) - seconds(t)) <= rule.timestamp_seconds, same)
    return same


def absolute_difference(s: Column, t: Column) -> Column:
    return F.abs(t - s)


def relative_difference(s: Column, t: Column) -> Column:
    """|t - s| over max(|s|, 1)."""
    return F.abs(t - s) / F.greatest(F.abs(s), F.lit(1.0))


def difference_seconds(s: Column, t: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.datediff(t, s) * F.lit(86400.0)
    return seconds(t) - seconds(s)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 if the whole is 0."""
    return F.when(whole == 0, 0.0).otherwise(100.0 * part / whole)


def safe_decimal(text: Column) -> Column:
    """A number from text, null if it is none."""
    return F.trim(text).try_cast("decimal(38,10)")


def to_minute(text: Column) -> Column:
    """The minute of a date or time text, whatever its separator, fraction and zone; null if it is none.

    Works on the text, so years like 9999 pass through; a bare date is midnight.
    """
    shape = r"^\s*(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2}))?"
    day, time = F.regexp_extract(text, shape, 1), F.regexp_extract(text, shape, 2)
    return F.when(day != "", F.concat(day, F.lit("T"), F.when(time == "", "00:00").otherwise(time)))


def semantic_class(s: Column, t: Column, source_type: str, target_type: str) -> tuple[Column, Column]:
    """Class and reason for two normalised texts.

    Equal text is exact. For date-like types texts of the same minute, and for
    numeric types equal numbers, differ only in representation.
    """
    exact, false, reason = s.eqNullSafe(t), F.lit(False), F.lit(None).cast("string")
    both = (s != NULL_TEXT) & (t != NULL_TEXT)
    if is_datelike(source_type) or is_datelike(target_type):
        false, reason = both & (to_minute(s) == to_minute(t)), F.lit("same minute; seconds, fraction or zone differ")
    elif is_numberlike(source_type) or is_numberlike(target_type):
        false, reason = both & (safe_decimal(s) == safe_decimal(t)), F.lit("equal number; text differs")
    false = F.coalesce(false, F.lit(False))
    kind = F.when(exact, EXACT_MATCH).when(false, FALSE_MISMATCH).otherwise(TRUE_MISMATCH)
    why = F.when(exact, "equal").when(false, reason).when(~both, "null on one side").otherwise("different value")
    return kind, why
