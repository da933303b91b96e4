"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# A certificate's fields make one projection of dozens of pattern matches. Fused
# into a single generated method it passes HotSpot's limit of 8000 bytes, beyond
# which a method is never compiled, or even the class file's limit of 64 KB. With
# this limit Spark generates such projections as many small methods instead.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
