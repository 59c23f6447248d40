"""Canonical text of a value, so that copies in different systems compare equal."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..rules import HASH_NULL, NULL_TEXT, ReconRule

ISO_DATE, ISO_MICROS = "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def zone_normalised(col: Column, kind: T.DataType, zone: str = "UTC", comparison: str = "UTC") -> Column:
    """A timestamp as wall-clock time of the comparison zone; times without zone are taken as wall clock of ``zone``."""
    if isinstance(kind, T.TimestampNTZType):
        utc = F.to_utc_timestamp(col.cast("timestamp"), zone)
    elif isinstance(kind, T.TimestampType):
        utc = F.to_utc_timestamp(col, F.current_timezone())
    else:
        return col
    return utc if comparison == "UTC" else F.from_utc_timestamp(utc, comparison)


def number_text(col: Column, scale: int = 18) -> Column:
    """Fixed-scale text of a number; values too large for that scale keep their plain text."""
    return F.coalesce(col.try_cast(f"decimal(38,{scale})").cast("string"), col.cast("string"))


def canonical(col: Column, kind: T.DataType, rule: ReconRule | None = None, scale: int = 18) -> Column:
    """Type-directed text of a value, null for null.

    With a rule, strings are trimmed and lower-cased as it says and its null
    equivalents (compared trimmed, ignoring case) become null.
    """
    zone = rule.zone if rule else "UTC"
    if isinstance(kind, T.StringType):
        text = F.trim(col) if rule and rule.trim_strings else col
        text = F.lower(text) if rule and rule.lower_strings else text
        if rule and rule.null_equivalents:
            text = F.when(~F.lower(F.trim(col)).isin([x.lower() for x in rule.null_equivalents]), text)
        return text
    if isinstance(kind, T.BooleanType):
        return F.when(col, "true").when(~col, "false")
    if isinstance(kind, T.NumericType):
        return number_text(col, scale)
    if isinstance(kind, T.DateType):
        return F.date_format(col, ISO_DATE)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.date_format(zone_normalised(col, kind, zone), ISO_MICROS), F.lit("Z"))
    if isinstance(kind, T.BinaryType):
        return F.base64(col)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col, {"ignoreNullFields": "false"})
    return col.cast("string")


def normalised(col: Column, kind: T.DataType) -> Column:
    """Text of a value for row comparison, ``<NULL>`` for null; the same on both sides."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(col, ISO_MICROS)
    elif isinstance(kind, T.DateType):
        text = F.date_format(col, ISO_DATE)
    elif isinstance(kind, T.BooleanType):
        text = F.when(col, "true").when(~col, "false")
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(col, {"ignoreNullFields": "false"})
    elif isinstance(kind, T.BinaryType):
        text = F.base64(col)
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def category_text(col: Column, most: int | None = None) -> Column:
    """A category as text, ``<NULL>`` for null, optionally cut to ``most`` characters."""
    text = F.coalesce(col.cast("string"), F.lit(NULL_TEXT))
    return F.substring(text, 1, most) if most else text


def json_hash(texts: Iterable[tuple[str, Column]]) -> Column:
    """SHA-256 of the JSON of named canonical texts."""
    return F.sha2(F.to_json(F.struct(*(F.coalesce(c, F.lit(HASH_NULL)).alias(n) for n, c in texts))), 256)


def pair_hash(df: DataFrame, columns: Iterable[str]) -> Column:
    """SHA-256 of ``name=value`` pairs joined by ``||``."""
    kinds = {f.name: f.dataType for f in df.schema}
    return F.sha2(F.concat_ws("||", *(F.concat(F.lit(f"{c}="), normalised(F.col(f"`{c}`"), kinds[c])) for c in columns)), 256)


def portable_hash(texts: Iterable[Column]) -> Column:
    """A number of 60 bits from SHA-256 of the texts, null told apart from every text; any system that has SHA-256 can work it out.

    Each text is preceded by its length, so no two rows of texts are written alike.
    """
    parts = (F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(HASH_NULL)) for t in texts)
    return F.conv(F.substring(F.sha2(F.concat(*parts), 256), 1, 15), 16, 10).cast("long")


def bucket(keys: Iterable[Column], buckets: int) -> Column:
    return F.pmod(portable_hash(keys), F.lit(buckets))


def missing_cleaned(col: Column, tokens: Iterable[str]) -> Column:
    """Trimmed text; missing-value tokens become null."""
    return F.when(~F.trim(col).isin(list(tokens)), F.trim(col))
