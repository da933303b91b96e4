"""Documents from files, and documents from page texts."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from docflow.operators.frames import require_columns
from docflow.sources.scratch import has_scratch, staged

PAGE_BREAK = "\n\n"
PAGES_PER_RUN = 4096
# Rows of one task where each row is wide, or costs much.
ROWS_PER_TASK = 100_000
# Files, and bytes of files, that one task opens; folders that one task lists.
FILES_PER_TASK = 10_000
BYTES_PER_TASK = 1 << 27
FOLDERS_PER_TASK = 1_000
# Rows, and about as many bytes, that a task hands over at once.
ROWS_PER_BATCH = 1_000
BYTES_PER_BATCH = 1 << 24


def _below(spark: SparkSession, path: str) -> str:
    """The path, without scheme and host, below which the files of ``path`` are named."""
    parts = path.rstrip("/").split("/")
    fixed = next((i for i, part in enumerate(parts) if re.search(r"[*?{\[]", part)), len(parts))
    at = spark._jvm.org.apache.hadoop.fs.Path("/".join(parts[:fixed]) or "/")
    qualified = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at)
    return qualified.toUri().getPath().rstrip("/")


# Signs that Spark's writers escape in the name of a partition's folder.
_ESCAPED = re.compile(r"""[\x01-\x1F"#%'*/:=?\\\x7F{\[\]^]""")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folder_name(folder: str | None) -> str:
    return "folder=" + (_ESCAPED.sub(lambda sign: f"%{ord(sign[0]):02X}", folder) if folder else _NO_VALUE)


def write_corpus(texts: DataFrame, path: str) -> None:
    """Each row of ``(folder, text)`` as a file of its own, ended by a line feed, below ``folder=<folder>``.

    On a file system of the machines' own, Spark's writer starts two processes a file to
    set its mode and its checksum's; there the tasks write the files themselves. A file is
    there whole or not at all, and a repeated task writes the same names again.
    """
    spark = texts.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getUri().getScheme() != "file":
        texts.select("folder", "text").write.partitionBy("folder").option("maxRecordsPerFile", 1).text(path)
        return
    below = files.makeQualified(at).toUri().getPath()

    def write(rows: Iterator[Row]) -> None:
        task = TaskContext.get()
        for i, (folder, text) in enumerate(rows):
            name, into = f"part-{task.partitionId():05}-{i:07}.txt", f"{below}/{_folder_name(folder)}"
            os.makedirs(into, exist_ok=True)
            draft = f"{into}/.{name}-{task.taskAttemptId()}"
            with open(draft, "wb") as file:
                file.write(text.encode() + b"\n")
            os.replace(draft, f"{into}/{name}")

    os.makedirs(below)
    texts.select("folder", "text").foreachPartition(write)


def _own_folder(spark: SparkSession, path: str) -> bytes | None:
    """The folder of ``path``, if it is one on a file system of the machines' own, and no pattern."""
    if re.search(r"[*?{}\[\]\\]", path) or not has_scratch(spark):
        return None
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getUri().getScheme() != "file" or not files.exists(at) or not files.getFileStatus(at).isDirectory():
        return None
    return os.fsencode(files.makeQualified(at).toUri().getPath())


def _packed(spark: SparkSession) -> Column:
    """Whether the name ``file`` ends, in whatever case, as those of files that Spark's readers unpack."""
    conf = spark._jsc.hadoopConfiguration()
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    new = spark._jvm.org.apache.hadoop.util.ReflectionUtils.newInstance
    # Besides those of Hadoop's codecs Spark knows two more.
    endings = [".gzip", ".zstd", *(new(codec, conf).getDefaultExtension().lower() for codec in codecs)]
    name = F.lower(F.col("file").cast("string"))
    return reduce(Column.__or__, [F.endswith(name, F.lit(ending)) for ending in endings])


def _shown(name: bytes, folder: bool) -> bool:
    """Whether Spark's readers take notice of a file or folder of that name."""
    hidden = name[:1] == b"." or (name[:1] == b"_" and b"=" not in name)
    listed = name.startswith((b"_metadata", b"_common_metadata")) or not (hidden or name.endswith(b"._COPYING_"))
    return listed and (folder or not hidden)


def _inside(below: bytes, folder: bytes) -> Iterator[tuple[bytes, int, bool]]:
    """Name below ``below``, size and whether it is a folder, of each folder and file with content in ``folder``."""
    with os.scandir(os.path.join(below, folder)) as entries:
        for entry in entries:
            is_folder = entry.is_dir()
            size = entry.stat().st_size if not is_folder and entry.is_file() else 0
            if (is_folder or size) and _shown(entry.name, is_folder):
                yield os.path.join(folder, entry.name), size, is_folder


def _files(spark: SparkSession, below: bytes) -> DataFrame:
    """``(file, size, folder)`` of every file with content below a folder, listed by the tasks.

    A level of folders after the other, so the driver never holds a name, and each
    folder is listed once.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = _inside(below, folder)
                while some := list(islice(found, ROWS_PER_BATCH)):
                    columns = [pa.array(values, kind) for values, kind in zip(zip(*some), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names=["file", "size", "folder"])

    kinds = (pa.binary(), pa.int64(), pa.bool_())
    folders, levels = spark.createDataFrame([(bytearray(),)], "file binary"), []
    while not folders.isEmpty():
        dealt = spread(folders, tasks_for(folders, FOLDERS_PER_TASK)) if levels else folders
        level = staged(dealt.mapInArrow(listed, "file binary, size long, folder boolean"), "corpus-files")
        levels.append(level.filter("not folder"))
        folders = level.filter("folder").select("file")
    return reduce(DataFrame.unionAll, levels)


def _checked(place: bytes, content: bytes) -> bytes:
    """``content``, after a look at the checksums that Hadoop's writers leave beside a file."""
    folder, name = os.path.split(place)
    try:
        with open(os.path.join(folder, b"." + name + b".crc"), "rb") as file:
            sums = file.read()
    except FileNotFoundError:
        return content
    step = int.from_bytes(sums[4:8], "big")
    if sums[:4] == b"crc\0" and step:
        for i, at in enumerate(range(0, len(content), step)):
            if zlib.crc32(content[at : at + step]).to_bytes(4, "big") != sums[8 + 4 * i : 12 + 4 * i]:
                raise OSError(f"checksum error: {os.fsdecode(place)} from byte {at} on")
    return content


def _texts(files: DataFrame, below: bytes) -> DataFrame:
    """``(file, text)`` of the files below a folder; each is opened once."""

    def batch(names: list[str], texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], names=["file", "text"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            names, texts, size = [], [], 0
            for name in some.column(0).to_pylist():
                place = os.path.join(below, name)
                with open(place, "rb") as file:
                    texts.append(_checked(place, file.read()))
                names.append(name.decode(errors="replace"))
                size += len(texts[-1])
                if size >= BYTES_PER_BATCH or len(names) >= ROWS_PER_BATCH:
                    yield batch(names, texts)
                    names, texts, size = [], [], 0
            if names:
                yield batch(names, texts)

    return files.mapInArrow(read, "file string, text binary").select("file", F.col("text").cast("string").alias("text"))


def read_corpus(spark: SparkSession, path: str, format: str = "text") -> DataFrame:
    """All documents of a directory as ``(file, text)``.

    ``text``: one document per file, in the directory or a folder below it, named by
    its path from the directory on (``north/one.txt``), so that equal names in two
    folders stay apart; of a pattern, from the last directory before its first sign.
    Spark passes over files without content, so these are no documents.
    Any other format must have the two columns already. Rows come in no particular
    order.

    Spark's reader holds every file's entry in the driver. A directory on a file system of
    the machines' own is therefore listed and read by the tasks; patterns, other file
    systems and directories with packed files (``.gz``), which Spark unpacks, are left to it.
    """
    if format == "text":
        folder = _own_folder(spark, path)
        if folder is not None:
            files = _files(spark, folder)
            held = files.agg(F.count(F.lit(1)), F.sum("size"), F.bool_or(_packed(spark)))
            n, size, packed = (value or 0 for value in held.first())
            if not packed:
                tasks = max(spark.sparkContext.defaultParallelism, -(-n // FILES_PER_TASK), -(-size // BYTES_PER_TASK))
                return _texts(spread(files.select("file"), tasks), folder)
        below = _below(spark, path)
        uri = F.regexp_replace("_metadata.file_path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
        place = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
        own = F.when(place == below, F.substring_index(place, "/", -1)).otherwise(F.substr(place, F.lit(len(below) + 2)))
        files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
        return files.select(own.alias("file"), F.col("value").alias("text"))
    docs = spark.read.format(format).load(path)
    require_columns(docs, ("file", "text"), path)
    return docs.select("file", "text")


def repeated_files(docs: DataFrame) -> DataFrame:
    """``(file, documents)`` of names that more than one document has; joins on ``file`` need none."""
    return docs.groupBy("file").agg(F.count(F.lit(1)).alias("documents")).filter("documents > 1")


def spread(docs: DataFrame, partitions: int) -> DataFrame:
    """``docs`` dealt evenly over ``partitions``.

    Reading fields costs far more time per byte than scanning, so one file that
    Spark takes for a single task would keep the other cores idle. For inputs that
    come in few partitions; large ones are better left as they are.
    """
    return docs.repartition(partitions)


def tasks_for(df: DataFrame, rows_per_task: int | None = None) -> int:
    """As many tasks as leave each ``rows_per_task`` rows of ``df``, one a core at least.

    Counts the rows: for tables at rest, whose files tell how many they have.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // (rows_per_task or ROWS_PER_TASK)))


def evened(docs: DataFrame, partitions: int) -> DataFrame:
    """``docs`` as they lie, if no part has over twice its share of ``partitions``, or over a
    quarter of what each core has to do; else dealt evenly.

    Counts the rows of each part, and spares moving the texts of tables in many row groups.
    """
    parts = docs.groupBy(F.spark_partition_id().alias("part")).count()
    largest, n = parts.agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs if largest <= max(2 * -(-n // partitions), n // (4 * cores)) else spread(docs, partitions)


def _joined(pages: DataFrame, by: list[str], order: str, text: str) -> DataFrame:
    """Texts of each group in ``order``, joined by page breaks."""
    ordered = F.array_sort(F.collect_list(F.struct(order, text)))
    return pages.groupBy(*by).agg(
        F.array_join(F.transform(ordered, lambda p: p[text]), PAGE_BREAK).alias(text)
    )


def assemble_documents(pages: DataFrame, pages_per_run: int = PAGES_PER_RUN) -> DataFrame:
    """Join ``(file, page_no, text)`` into ``(file, text)``, pages in order.

    A page without text counts as an empty page. Pages are joined in runs of
    ``pages_per_run`` first and the runs to documents then, so no task has to sort
    all pages of a huge document. The pages are dealt by file and run explicitly:
    a planner that knew them to lie together by file would skip that exchange.
    """
    require_columns(pages, ("file", "page_no", "text"), "the page frame")
    runs = pages.select(
        "file",
        "page_no",
        F.floor(F.col("page_no") / pages_per_run).alias("run"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).repartition("file", "run")
    return _joined(_joined(runs, ["file", "run"], "page_no", "text"), ["file"], "run", "text")
