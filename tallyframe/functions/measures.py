"""Measures and features used in profiling and rule mining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Z95 = 1.959963984540054


def safe_ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0)))


def day_difference(later: Column, earlier: Column) -> Column:
    return F.datediff(later.try_cast("date"), earlier.try_cast("date"))


def banded(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands: the first label up to the first edge, the last beyond the last edge; null for null."""
    out = F.when(col.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels, strict=False):
        out = out.when(col <= edge, label)
    return out.otherwise(labels[-1])


def age_band(age: Column) -> Column:
    return banded(age, (18, 30, 45, 60, 75), ("<=18", "19-30", "31-45", "46-60", "61-75", ">75"))


def missing_flag(col: Column) -> Column:
    return col.isNull().cast("int")


def wilson(positives: Column, n: Column) -> tuple[Column, Column]:
    """The 95 % Wilson score interval of a rate."""
    p, z2 = positives / n, Z95**2
    centre, half = (p + z2 / (2 * n)) / (1 + z2 / n), Z95 * F.sqrt((p * (1 - p) + z2 / (4 * n)) / n) / (1 + z2 / n)
    return F.greatest(centre - half, F.lit(0.0)), F.least(centre + half, F.lit(1.0))


def rule_score(lift: Column, rate: Column, records: Column, positives: Column) -> Column:
    return lift * rate * F.log1p(records) * F.sqrt(positives)


#: The actions a rule can recommend.
ACTIONS = ("High-priority investigation / specialist review", "Enhanced document and provider validation", "Additional automated checks", "Monitor")


def recommended_action(lift: Column, test_lift: Column, test_records: Column, high: float = 2.0, some: float = 1.5, least: int = 1) -> Column:
    """By lift on held-out records first, then by lift on the records the rule was mined on."""
    tested = F.coalesce(test_records >= least, F.lit(False))
    return (
        F.when(tested & (test_lift >= high), ACTIONS[0]).when(tested & (test_lift >= some), ACTIONS[1])
        .when(lift >= high, ACTIONS[1]).when(lift >= some, ACTIONS[2]).otherwise(ACTIONS[3])
    )


def date_grains(col: Column) -> dict[str, Column]:
    """Year, month, ISO year, ISO week, and year with week."""
    iso_year, week = F.extract(F.lit("YEAROFWEEK"), col), F.weekofyear(col)
    return {
        "year": F.year(col), "month": F.date_format(col, "yyyy-MM"), "iso_year": iso_year, "iso_week": week,
        "year_week": F.concat(iso_year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0")),
    }


def bin_number(col: Column, edges: Sequence[float]) -> Column:
    """The number, from 1, of the right-closed bin between ascending edges; null for null, or if there are fewer than two edges.

    The first edge belongs to the first bin; what lies outside goes to the bin at that end.
    """
    if len(edges) < 2:
        return F.lit(None).cast("int")
    inner = F.array(*(F.lit(float(e)) for e in edges[1:-1])) if len(edges) > 2 else F.array().cast("array<double>")
    passed = F.aggregate(inner, F.lit(0), lambda n, e: n + (e < col).cast("int"))
    return F.when(col.isNotNull(), passed + 1)


def bin_edges(number: Column, edges: Sequence[float]) -> tuple[Column, Column]:
    """The exact lower and upper edge of a bin."""
    side = lambda values: F.get(F.array(*(F.lit(float(e)) for e in values)), number - 1) if values else F.lit(None).cast("double")
    return side(list(edges[:-1])), side(list(edges[1:]))


def bin_labels(edges: Sequence[float]) -> list[str]:
    """A text for each bin, for show: edges with six digits, or all of them where six would not tell edges apart."""
    short = [f"{e:g}" for e in edges]
    text = short if len(set(short)) == len(edges) else [repr(float(e)) for e in edges]
    return [f"({lo}, {hi}]" for lo, hi in zip(text, text[1:], strict=False)]


def binned(col: Column, edges: Sequence[float], unknown: str = "UNKNOWN") -> Column:
    """The text of a value's bin; bins of different numbers have different texts."""
    labels = bin_labels(edges)
    return F.coalesce(F.get(F.array(*map(F.lit, labels)), bin_number(col, edges) - 1), F.lit(unknown)) if labels else F.lit(unknown)


def split_part(ids: Sequence[Column], parts: int, seed: int = 0) -> Column:
    """A reproducible part number of a row, from its id."""
    return F.pmod(F.xxhash64(*ids, F.lit(seed)), F.lit(parts))
