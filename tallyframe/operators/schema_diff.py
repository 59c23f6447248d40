"""Comparison of schemas: one table, or all tables of two schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.classify import TYPE_NAMES, classify

METADATA = "table_name string, ordinal_position int, column_name string, data_type string, is_nullable boolean, column_class string"


def schema_rows(spark: SparkSession, schema: T.StructType, table: str = "") -> DataFrame:
    """A schema as metadata rows, positions from 1."""
    rows = [(table, i, f.name, f.dataType.simpleString(), f.nullable, classify(f.dataType)) for i, f in enumerate(schema, 1)]
    return spark.createDataFrame(rows, METADATA)


def catalogue_schema_rows(spark: SparkSession, database: str, names: list[str]) -> DataFrame:
    """The metadata rows of many tables of a catalogue schema; tables that cannot be read come as one row without columns.

    Only metadata pass through the driver: one row for each column.
    """
    rows = []
    for name in names:
        try:
            schema = spark.table(f"`{database}`.`{name}`").schema
        except Exception:  # noqa: BLE001 - an unreadable table is a result
            rows.append((name, None, None, None, None, None))
            continue
        rows += [(name, i, f.name, f.dataType.simpleString(), f.nullable, classify(f.dataType)) for i, f in enumerate(schema, 1)]
    return spark.createDataFrame(rows, METADATA)


def common_type(col: Column, extra: dict[str, str] | None = None) -> Column:
    """The common name of a type text; precision is ignored, unknown names stay."""
    plain = F.trim(F.substring_index(F.lower(col), "(", 1))
    names = F.create_map(*(F.lit(x) for pair in {**TYPE_NAMES, **(extra or {})}.items() for x in pair))
    return F.coalesce(names[plain], plain)


def side_by_side(source: DataFrame, target: DataFrame) -> DataFrame:
    """Metadata rows of both sides on lower-cased table and column names."""
    def tagged(df: DataFrame, tag: str) -> DataFrame:
        keys = [F.lower("table_name").alias("table_name"), F.lower("column_name").alias("column_name")]
        return df.select(*keys, *(F.col(c).alias(f"{tag}_{c}") for c in ("ordinal_position", "data_type", "is_nullable", "column_class")))

    return tagged(source, "source").join(tagged(target, "target"), ["table_name", "column_name"], "full_outer")


def schema_diff(source: DataFrame, target: DataFrame, by_class: bool = False) -> DataFrame:
    """Status of each column: missing, type, nullability (or class), or equal."""
    s, t = F.col("source_data_type"), F.col("target_data_type")
    status = F.when(s.isNull(), "TARGET_ONLY_COLUMN").when(t.isNull(), "SOURCE_ONLY_COLUMN")
    if by_class:
        status = status.when(F.col("source_column_class") != F.col("target_column_class"), "CLASSIFICATION_MISMATCH").when(s != t, "TYPE_MISMATCH").otherwise("PASS")
    else:
        status = status.when(s != t, "TYPE_MISMATCH").when(F.col("source_is_nullable") != F.col("target_is_nullable"), "NULLABILITY_MISMATCH").otherwise("MATCH")
    return side_by_side(source, target).withColumn("status", status)


def type_check(source: DataFrame, target: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Status of each column by common type names."""
    s, t = common_type(F.col("source_data_type"), extra), common_type(F.col("target_data_type"), extra)
    status = (
        F.when(F.col("source_data_type").isNull(), "MISSING_IN_SOURCE").when(F.col("target_data_type").isNull(), "MISSING_IN_TARGET")
        .when(s == t, "MATCH").otherwise("TYPE_MISMATCH")
    )
    both = side_by_side(source, target)
    return both.select("table_name", "column_name", "source_data_type", "target_data_type", s.alias("source_common_type"), t.alias("target_common_type"), status.alias("status"))


def type_check_all(source: DataFrame, target: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Status of each column over all tables of two schemas; a missing table is told apart from a missing column."""
    s_tables = source.select(F.lower("table_name").alias("table_name"), F.lit(True).alias("in_source")).distinct()
    t_tables = target.select(F.lower("table_name").alias("table_name"), F.lit(True).alias("in_target")).distinct()
    both = side_by_side(source, target).join(s_tables, "table_name", "left").join(t_tables, "table_name", "left")
    same_type = common_type(F.col("source_data_type"), extra) == common_type(F.col("target_data_type"), extra)
    same_place = F.col("source_ordinal_position") == F.col("target_ordinal_position")
    status = (
        F.when(F.col("in_source").isNull(), "TABLE_MISSING_IN_SOURCE").when(F.col("in_target").isNull(), "TABLE_MISSING_IN_TARGET")
        .when(F.col("source_data_type").isNull(), "COLUMN_MISSING_IN_SOURCE").when(F.col("target_data_type").isNull(), "COLUMN_MISSING_IN_TARGET")
        .when(~same_place & ~same_type, "ORDINAL_AND_TYPE_MISMATCH").when(~same_place, "ORDINAL_MISMATCH").when(~same_type, "TYPE_MISMATCH").otherwise("MATCH")
    )
    return both.select("table_name", "column_name", "source_ordinal_position", "target_ordinal_position", "source_data_type", "target_data_type", status.alias("status"))


def table_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Tables on either side, with SOURCE_ONLY_TABLE, TARGET_ONLY_TABLE or MATCH."""
    s = source.select(F.lower("table_name").alias("table_name"), F.lit(1).alias("s")).distinct()
    t = target.select(F.lower("table_name").alias("table_name"), F.lit(1).alias("t")).distinct()
    return s.join(t, "table_name", "full_outer").select("table_name", F.when(F.col("t").isNull(), "SOURCE_ONLY_TABLE").when(F.col("s").isNull(), "TARGET_ONLY_TABLE").otherwise("MATCH").alias("status"))


def type_check_summary(detail: DataFrame, by_table: bool = True) -> DataFrame:
    """Columns, matches and mismatches of a type check, by table or overall."""
    keys = ["table_name"] if by_table else []
    out = detail.groupBy(*keys).agg(
        F.count("*").alias("total_columns"), F.count_if(F.col("status") == "MATCH").alias("matched_columns"),
        F.count_if(F.col("status") != "MATCH").alias("mismatched_columns"), F.count_if(F.col("status").contains("MISSING")).alias("missing_columns"),
        F.count_if(F.col("status").isin("TYPE_MISMATCH", "ORDINAL_AND_TYPE_MISMATCH")).alias("type_mismatches"), F.count_if(F.col("status").isin("ORDINAL_MISMATCH", "ORDINAL_AND_TYPE_MISMATCH")).alias("ordinal_mismatches"),
    )
    return out.withColumn("overall_status", F.when(F.col("mismatched_columns") > 0, "MISMATCH").otherwise("MATCH"))
