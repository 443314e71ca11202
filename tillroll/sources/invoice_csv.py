"""Raw invoice-line files in CSV."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas

MALFORMED = "_malformed"

# Words that spreadsheets and data frames write for a missing value.
MISSING_WORDS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_DIALECT = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"'}


class MissingColumnsError(ValueError):
    """An input file lacks required columns."""


def _key(file: str) -> str:
    """Spark writes the same file as ``file:///x`` or ``file:/x``, with escapes."""
    return re.sub(r"^(\w+):/+", r"\1:/", unquote(file))


def find_csv(spark: SparkSession, path: str) -> list[str]:
    """The CSV files at a path, folder or glob. Raises when there are none."""
    listing = spark.read.format("text").option("pathGlobFilter", "*.csv")
    try:
        found = listing.load(path).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = []
    if not found:
        raise FileNotFoundError(f"No CSV file found in {path}")
    return sorted(unquote(file) for file in found)


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """The column names in the header. Uses a reader of its own: one that was given a
    schema would answer with that instead."""
    return spark.read.options(**_DIALECT).csv(path).columns


def check_columns(columns: Sequence[str], source: str) -> None:
    missing = [name for name in schemas.RAW_COLUMNS if name not in columns]
    if missing:
        raise MissingColumnsError(f"Missing columns in {source}: {', '.join(missing)}")


# A line with closed fields: a quoted one ends at its quote, another may hold any quotes but
# at its start. The parts are possessive, so a line that does not fit fails at once.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",][^,]*+|)'
CLOSED_LINE = f"^{_FIELD}(?:,{_FIELD})*+$"
_QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|\s*$)'


def _kinds(spark: SparkSession, files: Sequence[str]) -> list[Row]:
    """The files by their first line and by whether a quoted field may cross a line end.

    One pass over the text, in parallel. A row per kind comes back; together they have the
    names of the files, which the driver listed in the first place.
    """
    line = F.col("value")
    place = F.struct(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    by_file = (
        spark.read.text(list(files))
        .select(F.col("_metadata.file_path").alias("file"), "value", place.alias("place"))
        .groupBy("file")
        .agg(
            F.min_by(line, F.col("place")).alias("header"),
            F.bool_or(~line.rlike(CLOSED_LINE)).alias("line_breaks"),
        )
    )
    return (
        by_file.groupBy("header", "line_breaks")
        .agg(F.sort_array(F.collect_list("file")).alias("files"))
        .orderBy(F.get("files", F.lit(0)))
        .collect()
    )


def _scan(
    spark: SparkSession, files: Sequence[str], multi_line: bool, missing: Sequence[str]
) -> DataFrame:
    """Lines of files with one header. A line with more fields than the header is left out,
    whatever they hold; the reader marks lines of another length, and only those are counted."""
    names = header_columns(spark, files[0])
    check_columns(names, files[0])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
    lines = (
        spark.read.schema(schema)
        .options(
            **_DIALECT,
            multiLine=multi_line,
            columnNameOfCorruptRecord=MALFORMED,
            # Else a query of few columns would not see that a line is too long.
            columnPruning=False,
        )
        .csv(list(files))
    )
    plain = F.regexp_replace(MALFORMED, _QUOTED, "$1")
    commas = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit("")))
    kept = lines.where(F.col(MALFORMED).isNull() | (commas < len(names)))
    # Spark refuses a query that reads the mark alone, as a count does: read a field as well.
    kept = kept.where(~F.col(f"`{names[0]}`").eqNullSafe(F.lit("\0")))
    # A quoted empty field is missing too, as an unquoted one is.
    words = ["", *missing]
    return kept.select(
        *(F.when(~F.col(f"`{n}`").isin(words), F.col(f"`{n}`")).alias(n) for n in names)
    )


def read_lines(
    spark: SparkSession,
    path: str,
    multi_line: bool | None = None,
    missing: Sequence[str] = (),
) -> DataFrame:
    """All lines as text. Lines with too many fields are left out; short ones get nulls.

    ``multi_line=None`` looks which files need the multi-line reader, which takes a whole
    file per task; all others are split among tasks however large they are. Fields that are
    one of the words in ``missing``, ``MISSING_WORDS`` for one, are null like empty ones.
    """
    files = {_key(file): file for file in find_csv(spark, path)}
    scans = []
    for kind in _kinds(spark, list(files.values())):
        whole = bool(kind.line_breaks) if multi_line is None else multi_line
        names = [files.get(_key(f), f) for f in kind.files]
        scans.append(_scan(spark, names, whole, missing))
    if not scans:  # files without any line
        return _scan(spark, list(files.values()), bool(multi_line), missing)
    return reduce(
        lambda one, other: one.unionByName(other, allowMissingColumns=True), scans
    )
