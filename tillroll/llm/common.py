"""What the operators of this package share: words, storage, and checked broadcasts."""

from __future__ import annotations

import ctypes
import gc
import string
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.staging import new_folder

#: ASCII white space; words are the runs between it.
WHITE = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"


#: Rows that go to a Python worker at once, where the session does not say it.
ARROW_ROWS = "2000"
ARROW_BYTES = "16m"
#: What Spark has for the bytes where nobody set them.
SPARKS_BYTES = "67108864b"
_shipped: set[str] = set()


def give_back_memory() -> None:
    """Return what a Python worker has freed to the system, where the C library can."""
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(of_group: Callable) -> Callable:
    """A function of a group that gives its memory back before the next group comes."""

    def wrapped(table: pyarrow.Table) -> pyarrow.Table:
        give_back_memory()
        return of_group(table)

    return wrapped


def collect_garbage(spark: SparkSession) -> None:
    """Let the driver collect its garbage after a large step.

    Spark deletes the shuffle files of a finished job when the driver no longer knows its plan,
    which a driver with memory to spare finds out late. What has only just ended is still held
    by the listeners of Spark when it is collected first, so it is done twice."""
    for _ in range(2):
        gc.collect()
        spark._jvm.java.lang.System.gc()
        time.sleep(0.3)


def ship(spark: SparkSession) -> None:
    """Make the Python workers ready: send them this package's code, once for each
    application, and bound what they get at once, in rows and in bytes.

    Workers cannot import what only the driver's ``sys.path`` shows. Spark copies the archive
    to every executor, those that come later too.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) in (None, "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == SPARKS_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="tillroll-code-")) / "tillroll.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted((root / "tillroll").rglob("*.py")):
            packed.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_list(text: Column) -> Column:
    """The maximal runs of other than ASCII white space; an empty array for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, GAP))


def word_count(text: Column) -> Column:
    return F.size(word_list(text)).cast("long")


def id_bucket(identifier: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; the split that decides what is held out.

    A null id counts as the empty text."""
    return F.crc32(F.coalesce(identifier.cast("string"), F.lit("")).cast("binary")) % modulus


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder of the shared area and read it back, which cuts the lineage.

    The folder is one that every executor and the driver reach, see ``staging``; it goes when
    the application ends. What comes back does not depend on any executor staying alive.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, *stored: DataFrame) -> None:
    """Delete what ``store`` wrote, once nothing lazy reads it any more."""
    jvm = spark._jvm
    for df in stored:
        for file in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
            fs.delete(folder.getParent(), True)


def small(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows; reads no more than that many."""
    return df.select(F.lit(1)).limit(limit + 1).count() <= limit


def bounded_broadcast(df: DataFrame, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows, else as it is.

    Beyond the limit the join shuffles, and adaptive execution splits its hot keys.
    """
    return F.broadcast(df) if small(df, limit) else df


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the jobs started inside; names with ``__`` for the dots."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
