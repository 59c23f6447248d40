"""Intermediate tables: written once to the shared folder, read back, deleted after use."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Only where that is unset and Spark runs on this machine alone, as in tests,
    a temporary folder is set; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tallyframe-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, computed once however often it is read; a lost executor costs a re-read."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Watch:
    """Aggregates of a frame that are taken while its rows go by, in whatever job reads them first."""

    def __init__(self, df: DataFrame, **aggs: Column):
        self.watch, self.df, self.aggs = Observation(), df, [c.alias(n) for n, c in aggs.items()]
        self.rows = df.observe(self.watch, *self.aggs)

    def values(self) -> dict[str, int]:
        """What was seen, once ``rows`` have been read."""
        try:
            return self.watch.get
        except Py4JJavaError:  # of a relation that Spark knows to be empty, rows are not read at all
            return self.df.agg(*self.aggs).first().asDict()


def discarded(*tables: DataFrame) -> None:
    """Deletes tables that came from ``settled`` and that nothing reads any more."""
    for df in tables:
        files = df.inputFiles()
        if files:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
            folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(conf).delete(folder, True)
