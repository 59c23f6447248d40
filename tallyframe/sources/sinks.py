"""Where reports go: audit tables, single CSV files, status events, manifests."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..rules import RunContext
from .readers import quoted, safe_name

AUDIT_COLUMNS = ("run_id", "run_ts", "check_name", "output_type", "source_database", "source_schema", "source_table", "target_catalog", "target_schema", "target_table")


def with_audit_columns(df: DataFrame, run: RunContext, check: str, output: str, source: tuple[str | None, str | None, str | None] = (None,) * 3, target: tuple[str | None, str | None, str | None] = (None,) * 3, table_context: bool = True) -> DataFrame:
    """``df`` with the ten audit columns in front; without table context both table names are null (schema-wide checks)."""
    clash = [c for c in df.columns if c.lower() in AUDIT_COLUMNS]
    df = df.withColumnsRenamed({c: f"report_{c}" for c in clash})
    text = lambda v: F.lit(v).cast("string")
    table = (lambda v: v) if table_context else (lambda v: None)
    values = [text(run.run_id), F.lit(run.run_ts).cast("timestamp"), text(check), text(output), text(source[0]), text(source[1]), text(table(source[2])), text(target[0]), text(target[1]), text(table(target[2]))]
    return df.select(*(v.alias(n) for n, v in zip(AUDIT_COLUMNS, values, strict=True)), *map(F.col, map(quoted, df.columns)))


def audit_table_name(schema: str, prefix: str, suffix: str, table: str | None = None) -> str:
    """A qualified audit table name; outputs whose schema varies by table carry the table's name."""
    return f"{safe_name(schema)}.{'_'.join(safe_name(p) for p in (prefix, suffix, table) if p)}"


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(schema)}")


def append_audit(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Appends by column names; columns that the table lacks are added to it, those that ``df`` lacks are null.

    A column that comes with another type is an error, raised with both schemas in the message.
    """
    spark = df.sparkSession
    try:
        if spark.catalog.tableExists(table):
            own, order = {f.name.lower(): f for f in df.schema}, with_new_columns(df, table)
            df.select(*((F.col(quoted(own[f.name.lower()].name)) if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in order)).write.mode("append").insertInto(table)
        else:
            df.write.format(fmt).mode("append").saveAsTable(table)
    except Exception as e:
        now = spark.table(table).schema.simpleString() if spark.catalog.tableExists(table) else "no table"
        raise RuntimeError(f"append to {table} failed; incoming {df.schema.simpleString()}; existing {now}") from e


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inserts that overwrite take the place of the partitions they write to, not of the whole table; ``insertInto`` reads this from the session only."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: What a run's part of an audit table is known by; a retried run writes the same parts again.
RUN_PARTS = ("run_id", "output_type", "report_of")


def append_run(df: DataFrame, table: str, run: RunContext, output: str, of: str, marks: str, fmt: str = "parquet") -> int:
    """Puts the rows of one run, report and table into an audit table so that it may be done again: gives the rows written.

    The table is partitioned by ``RUN_PARTS``; only the run's own partition is
    overwritten (dynamic mode), so a retried run leaves no row twice, and other runs'
    rows are not touched. The commit mark is an event in ``marks`` that comes after the
    rows; ``committed`` shows only rows whose part has one. New columns are added as
    ``append_audit`` does, and a type that changes is an error with both schemas.
    """
    spark = df.sparkSession
    own = df.select(*(F.col(quoted(c)) for c in df.columns if c.lower() not in RUN_PARTS))
    parts = {"run_id": run.run_id, "output_type": output, "report_of": of}
    rows = own.withColumns({k: F.lit(v) for k, v in parts.items()})
    try:
        if not spark.catalog.tableExists(table):
            spark.createDataFrame([], rows.schema).write.format(fmt).partitionBy(*RUN_PARTS).saveAsTable(table)
        order = with_new_columns(rows, table)
        values = {f.name.lower(): f.name for f in rows.schema}
        aligned = rows.select(*((F.col(quoted(values[f.name.lower()])) if f.name.lower() in values else F.lit(None).cast(f.dataType)).alias(f.name) for f in order))
        if aligned.isEmpty():  # no rows would overwrite no partition: what an earlier try left goes by name
            where = ", ".join(f"{k} = '" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for k, v in parts.items())
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({where})")
        else:
            with dynamic_overwrite(spark):
                aligned.write.format(fmt).mode("overwrite").insertInto(table)
        spark.catalog.refreshTable(table)  # whose files of this partition are others now
        n = spark.table(table).where(reduce(lambda a, b: a & b, (F.col(k) == v for k, v in parts.items()))).count()  # of this partition's files only
    except Exception as e:
        now = spark.table(table).schema.simpleString() if spark.catalog.tableExists(table) else "no table"
        raise RuntimeError(f"append to {table} failed; incoming {df.schema.simpleString()}; existing {now}") from e
    append_audit(spark.createDataFrame([(table, *parts.values(), n, run.run_ts)], "audit_table string, run_id string, output_type string, report_of string, n_rows long, run_ts timestamp"), marks)
    return n


def committed(spark: SparkSession, table: str, marks: str) -> DataFrame:
    """The rows of an audit table whose part was written to its end."""
    done = spark.table(marks).where(F.col("audit_table") == table).select(*RUN_PARTS).distinct()
    return spark.table(table).join(done, list(RUN_PARTS), "left_semi")


def with_new_columns(df: DataFrame, table: str) -> T.StructType:
    """Adds the columns of ``df`` that the table lacks to it, and gives its schema; a column that comes with another type is an error."""
    spark = df.sparkSession
    have, own = {f.name.lower(): f for f in spark.table(table).schema}, {f.name.lower(): f for f in df.schema}
    differing = [n for n, f in own.items() if n in have and have[n].dataType != f.dataType]
    if differing:
        raise ValueError(f"types differ: {', '.join(differing)}")
    new = [f"{quoted(f.name)} {f.dataType.simpleString()}" for n, f in own.items() if n not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")
    return spark.table(table).schema


def overwrite(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", True).saveAsTable(table)


def status_event(spark: SparkSession, run: RunContext, status: str, table: str, at, fmt: str = "parquet") -> None:
    """A status as an appended event; nothing is updated in place."""
    append_audit(spark.createDataFrame([(run.run_id, status, at)], "run_id string, status string, event_ts timestamp"), table, fmt)


def latest_status(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).groupBy("run_id").agg(F.max_by("status", "event_ts").alias("status"), F.max("event_ts").alias("event_ts"))


def truncate_audit(spark: SparkSession, schema: str, prefix: str) -> list[str]:
    """Empties every table of the schema whose name starts with the prefix; returns their names."""
    names = sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary and t.name.startswith(safe_name(prefix)))
    for n in names:
        spark.sql(f"TRUNCATE TABLE {quoted(schema)}.{quoted(n)}")
    return names


def write_csv(df: DataFrame, folder: str, single: bool = True) -> None:
    """A report as CSV with a header and all values quoted; ``single`` gives one part file and is for small reports."""
    (df.coalesce(1) if single else df).write.mode("overwrite").options(header=True, quoteAll=True).csv(folder)


def write_csv_file(df: DataFrame, path: str) -> None:
    """A small report as one CSV file at ``path`` itself, in any file system that Spark writes to."""
    parts = f"{path}.parts"
    write_csv(df, parts)
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    to_path = jvm.org.apache.hadoop.fs.Path
    files = to_path(path).getFileSystem(conf)
    part = next(s.getPath() for s in files.listStatus(to_path(parts)) if s.getPath().getName().startswith("part-"))
    files.delete(to_path(path), False)
    files.rename(part, to_path(path))
    files.delete(to_path(parts), True)


def inventory(reports: dict[str, DataFrame]) -> DataFrame:
    """One row for each report: its name, rows and columns."""
    rows = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("report"), "n_rows", F.lit(len(df.columns)).alias("n_columns")) for name, df in reports.items()]
    return reduce(DataFrame.unionByName, rows)


def csv_folder(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), "_".join(safe_name(p) for p in parts)])


def write_long(df: DataFrame, path: str, by: list[str]) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_excel(reports: dict[str, DataFrame], path: str, rows: int = 200_000) -> None:
    """One sheet per report, at most ``rows`` rows each; needs the optional package openpyxl."""
    import pandas as pd

    with pd.ExcelWriter(path) as book:
        for name, df in reports.items():
            df.limit(rows).toPandas().to_excel(book, sheet_name=re.sub(r"[\[\]:*?/\\]", "_", name)[:31], index=False)


def manifest(spark: SparkSession, reports: dict[str, str]) -> DataFrame:
    """Names and places of exported reports."""
    return spark.createDataFrame(sorted(reports.items()), "report string, path string")


def text_safe(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that years beyond a consumer's range survive an export."""
    return df.withColumns({c: F.col(quoted(c)).cast("string") for c, t in df.dtypes if t.startswith(("timestamp", "date"))})
