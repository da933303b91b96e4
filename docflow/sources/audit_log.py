"""The append-only log of review decisions, as JSON lines, compressed by gzip.

The log is partitioned by the day of the review and by a hash of the file name, so
that one document's history is read from one bucket of each day, and a day without
the others. Entries repeat their day, reviewer and field names, and take about a
tenth of their size compressed; files without compression, from before, are read as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from docflow.sources import folders

AUDIT_SCHEMA = StructType(
    [
        StructField(name, StringType())
        for name in (
            "timestamp",
            "reviewer",
            "file",
            "field",
            "action",
            "old_value",
            "new_value",
        )
    ]
)
_PARTED = StructType([*AUDIT_SCHEMA.fields, StructField("day", StringType()), StructField("bucket", IntegerType())])

BUCKETS = 64
# Tasks that write one bucket of an append.
WRITERS = 4


def _bucket(file: Column) -> Column:
    return F.pmod(F.xxhash64(file), F.lit(BUCKETS)).cast("int")


def append_audit(entries: DataFrame, path: str) -> None:
    """Add entries to the log, one JSON object per line; nothing is ever rewritten."""
    rows = entries.select(
        *AUDIT_SCHEMA.names, F.substring("timestamp", 1, 10).alias("day"), _bucket(F.col("file")).alias("bucket")
    )
    dealt = rows.repartition("day", "bucket", F.pmod(F.xxhash64("file", "field"), F.lit(WRITERS)))
    dealt.write.mode("append").partitionBy("day", "bucket").option("ignoreNullFields", False).json(path, compression="gzip")


def read_audit(
    spark: SparkSession, path: str, file: str | None = None, day: str | None = None
) -> DataFrame:
    """All entries of the log, or those of one file or day (``2024-03-01``, in UTC).

    None if there is no log yet. A broken line is an error. Files that lie in the log's
    folder itself, from before it was partitioned, are read as well.
    """
    days, flat = folders.names(spark, path)
    rows = spark.createDataFrame([], AUDIT_SCHEMA)
    reader = spark.read.option("mode", "FAILFAST")
    days = [name for name in days if name.startswith("day=")]
    if days:
        below = [f"{path}/{name}" for name in days]
        parted = reader.schema(_PARTED).option("basePath", path).json(below)
        if file is not None:
            parted = parted.filter(F.col("bucket") == _bucket(F.lit(file)))
        if day is not None:
            parted = parted.filter(F.col("day") == day)
        rows = parted.select(*AUDIT_SCHEMA.names)
    if flat:
        old = reader.schema(AUDIT_SCHEMA).json([f"{path}/{name}" for name in flat])
        old = old if day is None else old.filter(F.substring("timestamp", 1, 10) == day)
        rows = rows.unionByName(old) if days else old
    return rows if file is None else rows.filter(F.col("file") == file)
