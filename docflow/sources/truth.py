"""The answer key: a CSV of strings, its typed form and its unreadable values."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from docflow.certificate import CERTIFICATES
from docflow.functions import us_date
from docflow.operators.frames import require_columns
from docflow.spec import Spec

_LAYOUTS = StructType([StructField("file", StringType()), StructField("layout", StringType())])


def path_is_absent(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def truth_schema(spec: Spec = CERTIFICATES) -> StructType:
    names = ("file", "layout", *spec.names)
    return StructType([StructField(name, StringType()) for name in names])


@dataclass(frozen=True)
class KeyPart:
    """Files of a key that are read alike.

    ``names`` is their header. If ``broken``, a quoted value may go on in the next
    line, and each file is read by one task; otherwise large files are split.
    """

    names: tuple[str, ...]
    broken: bool
    files: tuple[str, ...]


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def key_parts(spark: SparkSession, path: str, wanted: tuple[str, ...]) -> list[KeyPart]:
    """How the files of a key are to be read, found in one pass over their lines.

    A value is quoted across a line end exactly if a line before it ends with an odd
    number of quotes open, so a file whose lines all have an even number holds none.
    A file's header is its first line that is not blank; it must have the columns
    ``wanted``, in any order and among any others. The driver gets one row a file.
    """
    lines = spark.read.text(path).select(
        "value", _decoded(F.col("_metadata.file_path")).alias("file"), F.monotonically_increasing_id().alias("place")
    )
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    named = reduce(Column.__and__, [value.contains(name) for name in wanted])
    # A line with all the names is a header, so the list has one entry a file.
    headers = F.collect_list(F.when(named, F.struct("place", "value")))
    files = lines.groupBy("file").agg(
        F.min(F.when(F.trim(value) != "", F.col("place"))).alias("first"),
        F.array_min(headers).alias("header"),
        (F.count_if(quotes % 2 == 1) > 0).alias("broken"),
    )
    found: dict[tuple, list[str]] = {}
    for row in files.filter("first IS NOT NULL").orderBy("file").collect():
        names = ()
        if row["header"] is not None and row["header"]["place"] == row["first"]:
            names = tuple(next(csv.reader([row["header"]["value"].removeprefix("\ufeff")])))
        if not set(wanted) <= set(names):
            # Also a header whose own names hold line breaks.
            names = tuple(_csv(spark, [row["file"]], True).columns)
        missing = [name for name in wanted if name not in names]
        if missing:
            raise ValueError(f"the answer key's file {row['file']} lacks the columns {missing}; it has {list(names)}")
        found.setdefault((names, row["broken"]), []).append(row["file"])
    return [KeyPart(names, broken, tuple(files)) for (names, broken), files in found.items()]


def _csv(spark: SparkSession, files: list[str], broken: bool, schema: StructType | None = None) -> DataFrame:
    literal = [re.sub(r"([\\{}\[\]*?])", r"\\\1", file) for file in files]
    return spark.read.csv(literal, schema=schema, header=True, mode="FAILFAST", escape='"', multiLine=broken)


def _read_columns(spark: SparkSession, path: str, wanted: tuple[str, ...], *further: Column) -> DataFrame:
    """The columns ``wanted`` of all the key's files, each found by its file's own header."""
    frames = []
    for part in key_parts(spark, path, wanted):
        # Read by place; of columns of one name the last counts.
        place = {name: f"_{i}" for i, name in enumerate(part.names)}
        schema = StructType([StructField(f"_{i}", StringType()) for i in range(len(part.names))])
        rows = _csv(spark, list(part.files), part.broken, schema)
        frames.append(rows.select(*[F.col(place[name]).alias(name) for name in wanted], *further))
    if frames:
        return reduce(DataFrame.unionByName, frames)
    none = StructType([StructField(name, StringType()) for name in wanted])
    return spark.createDataFrame([], none).select("*", *[F.lit(None).alias("position") for _ in further])


def read_truth(spark: SparkSession, path: str, spec: Spec = CERTIFICATES) -> DataFrame:
    """The key as it is written: every column a string.

    Columns are found by name, in each file by its own header: they may come in any
    order, and among further ones, which are not read. A file that lacks one is
    refused. Quoted values may hold doubled quotes, backslashes and line breaks; a file
    with a line break in a value is read by one task, any other in splits.
    """
    return _read_columns(spark, path, tuple(truth_schema(spec).names))


# A date of the key may have one-digit months and days.
KEY_DATE = r"^\d{1,2}/\d{1,2}/\d{4}\z"


def _typed(name: str, dtype: str) -> Column:
    text = F.col(name)
    if dtype == "string":
        return F.nullif(text, F.lit(""))
    if dtype == "date":
        return us_date(F.when(text.rlike(KEY_DATE), text))
    # A cast would read a trailing letter as a Java suffix: 12.5d.
    suffixed = text.rlike(r"[0-9.][dDfF]\s*$")
    return F.when((text != "") & ~suffixed, text).try_cast(dtype)


def normalize_truth(truth: DataFrame, spec: Spec = CERTIFICATES) -> DataFrame:
    """The key in the record's types. Blank is null; so is what cannot be read.

    Unreadable values are listed by :func:`truth_rejects`; check it before
    trusting a score.
    """
    require_columns(truth, ("file", "layout", *spec.names), "the answer key")
    typed = [_typed(field.name, field.dtype).alias(field.name) for field in spec.fields]
    return truth.select("file", "layout", *typed)


def truth_rejects(truth: DataFrame, spec: Spec = CERTIFICATES) -> DataFrame:
    """One row per value of the key that is there but cannot be read."""
    typed = [field for field in spec.fields if field.dtype != "string"]
    unread = {
        f.name: (F.col(f.name) != "") & _typed(f.name, f.dtype).isNull() for f in typed
    }
    entries = F.array(
        *[
            F.when(bad, F.struct(F.lit(name).alias("field"), F.col(name).alias("value")))
            for name, bad in unread.items()
        ]
    )
    return truth.select("file", F.inline(F.array_compact(entries)))


def read_truth_layouts(spark: SparkSession, path: str) -> DataFrame:
    """``(file, layout)`` of the key, one row per file; empty if there is no key.

    A file named more than once has the layout of its last row, the key's own files
    taken by name.
    """
    # Spark reads files by size, so the row number alone does not follow their names.
    position = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    try:
        rows = _read_columns(spark, path, ("file", "layout"), position.alias("position"))
    except AnalysisException as error:
        if not path_is_absent(error):
            raise
        return spark.createDataFrame([], _LAYOUTS)
    return rows.groupBy("file").agg(F.max_by("layout", "position").alias("layout"))
