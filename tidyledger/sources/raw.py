"""CSV and JSON-lines extracts as all-text tables with a source position."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyledger.schemas import RAW_COLUMNS, SOURCE_ROW, raw_struct

_BAD_LINE = "_bad_line"
_PATH, _NUMBER = "_path", "_number"

#: Bits of a position: row number in the scan task, below it nothing, above it block and file.
ROW_BITS, POSITION_BITS = 33, 63

#: Bytes of file names that are broadcast to their scan; a longer list is joined as Spark sees fit.
NAMES_BYTES = 1 << 25


def _block_unit(spark: SparkSession) -> int:
    """No two blocks of a file begin within this many bytes: Spark does not cut files finer."""
    conf = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
    sizes = [spark.conf.get(f"spark.sql.files.{name}") for name in ("maxPartitionBytes", "openCostInBytes")]
    return max(1, min(conf.byteStringAsBytes(str(size)) for size in sizes))


def _files(df: DataFrame) -> list[str]:
    """The files of a scan by name, written as ``_metadata.file_path`` writes them: no empty host."""
    return sorted(re.sub(r"^([\w.+-]+):///", r"\1:/", f) for f in df.inputFiles())


def _stamp(df: DataFrame, files: Sequence[str] | None = None) -> DataFrame:
    """Add ``source_row``, one whole number: from the left, place of the file in ``files`` (all of ``df`` by default, by name),
    number of the block in the file, row in the scan task.

    It is unique and increases within a file and from file to file, also in compressed files that can be split, as a block is
    read by one task. Numbers of a file and a block are as wide as the number of files asks; a file too long for what
    is left fails the read. It must be called on the bare scan, before any shuffle, and the settings for cutting
    files must stay as they are until the rows are read.
    """
    spark = df.sparkSession
    files = _files(df) if files is None else files
    file_bits = max(0, len(files) - 1).bit_length()
    block_bits = POSITION_BITS - ROW_BITS - file_bits
    block = F.floor(F.col("_metadata.file_block_start") / F.lit(_block_unit(spark)))
    too_long = F.raise_error(F.concat(F.lit("file too long for its position: "), F.col("_metadata.file_path")))
    block = F.when(block >= 1 << block_bits, too_long).otherwise(block)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    within = F.shiftleft(block.cast("bigint"), ROW_BITS) + row
    if len(files) < 2:
        return df.withColumn(SOURCE_ROW, within)
    numbers = spark.createDataFrame(list(enumerate(files)), f"{_NUMBER} bigint, {_PATH} string")
    if sum(map(len, files)) <= NAMES_BYTES:
        numbers = F.broadcast(numbers)
    stamped = df.select("*", within.alias(SOURCE_ROW), F.col("_metadata.file_path").alias(_PATH)).join(numbers, _PATH, "left")
    number = F.coalesce(F.col(_NUMBER), F.raise_error(F.concat(F.lit("not in the list of files: "), F.col(_PATH))).cast("bigint"))
    whole = F.shiftleft(number, POSITION_BITS - file_bits) + F.col(SOURCE_ROW)
    return stamped.select(*df.columns, whole.alias(SOURCE_ROW))


def _literal_path(uri: str) -> str:
    """A file's URI as a path for a reader: decoded, its glob characters escaped."""
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", unquote(uri))


def _files_with_broken_lines(spark: SparkSession, path: str | list[str]) -> set[str]:
    """Files with a line that has an odd number of quotes, as the first line of a cell with a line break has."""
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return {r[0] for r in lines.filter(quotes % 2 == 1).select("_metadata.file_path").distinct().collect()}


def _scan_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool, files: Sequence[str] | None) -> DataFrame:
    raw = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(_BAD_LINE, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", _BAD_LINE)
        .csv(path)
    )
    bare = F.regexp_replace(F.col(_BAD_LINE), '"[^"]*"', "")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    too_long = F.raise_error(F.concat(F.lit("CSV row with too many cells: "), F.col(_BAD_LINE)))
    first, *rest = schema.names
    return _stamp(raw, files).select(
        F.when(cells > len(schema.names), too_long).otherwise(F.col(first)).cast("string").alias(first),
        *rest,
        SOURCE_ROW,
    )


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool | None = None
) -> DataFrame:
    """Header row, every column text. An empty cell is NULL; ``NA``, ``N/A`` and ``NULL`` stay text.

    Cells may contain line breaks. A file with such cells cannot be split between tasks, any other can; which is which is
    found by a look at all lines for one with an odd number of quotes. ``multi_line`` says it beforehand, without that
    look for True; if it is False, such a line is an error. A row with too few cells is filled with NULL, one with
    too many fails the read.
    """
    if multi_line:
        return _scan_csv(spark, path, schema, True, None)
    broken = _files_with_broken_lines(spark, path)
    if broken and multi_line is False:
        raise ValueError(f"unbalanced quote in {min(broken)}: read it with multi_line")
    files = _files(spark.read.text(path))
    apart = [f for f in files if f in broken]
    if not apart:
        return _scan_csv(spark, path, schema, False, files)
    whole = _scan_csv(spark, [_literal_path(f) for f in apart], schema, True, files)
    if len(apart) == len(files):
        return whole
    split = [_literal_path(f) for f in files if f not in broken]
    return _scan_csv(spark, split, schema, False, files).unionByName(whole)


def read_jsonl(spark: SparkSession, path: str | list[str], columns: tuple[str, ...]) -> DataFrame:
    """One JSON object per line, every listed key as text.

    Blank lines are skipped, a missing key or null is NULL, other keys are ignored. A malformed line fails the
    read.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return _stamp(spark.read.schema(schema).option("mode", "FAILFAST").json(path))


# File name of each raw table.
SOURCE_FILES = {
    "customers": "customers.csv",
    "products": "products.csv",
    "orders": "orders.csv",
    "payments": "payments.csv",
    "support_tickets": "support_tickets.jsonl",
}


def read_sources(
    spark: SparkSession, input_dir: str, files: Mapping[str, str] = SOURCE_FILES, multi_line: bool | None = None
) -> dict[str, DataFrame]:
    """Every raw table of a feed directory. A name may be a file, a directory of part files or a glob.

    ``multi_line`` as in ``read_csv``.
    """
    tables: dict[str, DataFrame] = {}
    for table, name in files.items():
        path = f"{input_dir.rstrip('/')}/{name}"
        if ".json" in name:
            tables[table] = read_jsonl(spark, path, RAW_COLUMNS[table])
        else:
            tables[table] = read_csv(spark, path, raw_struct(table), multi_line)
    return tables


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
