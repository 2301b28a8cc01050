"""CSV sources of the programme's raw files, typed by an explicit schema.

The files are RFC 4180 CSV: a quote inside a quoted field is doubled
(``"{""amount"": 1.5}"``), so the reader sets ``escape='"'`` -- Spark's
default escape character is a backslash, which would keep the quotes.
Columns are found by the header's names; cells that do not fit become nulls.

``CsvFiles`` keeps account of what did not fit: ``rejects`` has every row with
such a cell, or with too few or too many, with its file and text.  A file with line
breaks inside quotes is told by lines with an odd number of quotes; only such files
are read as a whole (one task each), all others are split.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from perkspark import schemas

RAW_FILES = {"customers": "customers.csv", "offers": "offers.csv", "events": "events.csv"}
_RAW_SCHEMAS = {"customers": schemas.RAW_CUSTOMERS, "offers": schemas.RAW_OFFERS, "events": schemas.RAW_EVENTS}


#: Names that the reader adds to a file's own columns.
_CORRUPT, _FILE = "_corrupt_record", "_source_file"
#: A null is an empty cell; an empty text is written the same way and so read as null.
_WRITTEN = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_DIALECT = {**_WRITTEN, "mode": "PERMISSIVE"}


def open_quotes(spark: SparkSession, path: str) -> DataFrame:
    """(file, lines) of the files with lines that leave a quote open."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), quotes.alias("n"))
    return lines.filter(F.col("n") % 2 == 1).groupBy("file").agg(F.count(F.lit(1)).alias("lines"))


def _read_text(spark: SparkSession, paths: str | list[str], names: list[str], multiline: bool) -> DataFrame:
    text = StructType([StructField(n, StringType()) for n in [*names, _CORRUPT]])
    reader = spark.read.schema(text).options(**_DIALECT, header=True, multiLine=multiline, enforceSchema=False, columnNameOfCorruptRecord=_CORRUPT)
    return reader.csv(paths).withColumn(_FILE, F.col("_metadata.file_path"))


def _header(spark: SparkSession, path: str, schema: StructType, multiline: bool) -> list[str]:
    names = spark.read.options(**_DIALECT, header=True, multiLine=multiline).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(names)}")
    return names


def _as_text(spark: SparkSession, path: str, schema: StructType, multiline: bool | None) -> DataFrame:
    """The file's columns by the names of its header, as text, with the text of odd records and the file.

    Every file of a folder must have the first one's header, or the read fails.
    """
    names = _header(spark, path, schema, bool(multiline))
    if multiline is not None:
        return _read_text(spark, path, names, multiline)
    broken = [r["file"] for r in open_quotes(spark, path).collect()]
    if not broken:
        return _read_text(spark, path, names, False)
    broken_rows = _read_text(spark, broken, names, True)
    others = sorted({r["file"] for r in spark.read.text(path).select(F.col("_metadata.file_path").alias("file")).distinct().collect()} - set(broken))
    return broken_rows.unionByName(_read_text(spark, others, names, False)) if others else broken_rows


def _typed(field: StructField) -> Column:
    """The field's cell in its type; ``4.0`` is the integer 4, what does not fit is null."""
    cell = F.col(f"`{field.name}`")
    if isinstance(field.dataType, IntegerType):
        number = F.trim(cell).try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int"))
    if isinstance(field.dataType, StringType):
        return cell
    return F.trim(cell).try_cast(field.dataType)


class CsvFiles:
    """The CSV files under ``path``: typed rows, and what did not fit.

    ``multiline`` forces reading fields with line breaks, each file in one task
    (True), or not (False); by default it is found out for each file.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, multiline: bool | None = None):
        self.schema = schema
        self.text = _as_text(spark, path, schema, multiline)

    def rows(self) -> DataFrame:
        """Columns of the schema, found by name, whatever their order in the file."""
        return self.text.select(*(_typed(f).alias(f.name) for f in self.schema.fields))

    def files(self) -> list[str]:
        """Their paths, as ``rejects`` gives them."""
        return sorted(re.sub("^file:/+", "file:/", f) for f in self.text.inputFiles())

    def _misfits(self) -> dict[str, Column]:
        return {f.name: F.col(f"`{f.name}`").isNotNull() & _typed(f).isNull() for f in self.schema.fields}

    def rejects(self) -> DataFrame:
        """(file, columns, line) of every row with cells that do not fit their type, or with a wrong number of cells.

        ``columns`` names those cells (none: only the number is wrong); ``line`` is the
        record's text as it stands if the number is wrong, else its cells as CSV.
        """
        bad = F.array_compact(F.array(*(F.when(misfit, F.lit(name)) for name, misfit in self._misfits().items())))
        cells = F.struct(*(F.col(f"`{c}`") for c in self.text.columns if c not in (_CORRUPT, _FILE)))
        line = F.coalesce(F.col(_CORRUPT), F.to_csv(cells, _WRITTEN))
        file = F.regexp_replace(_FILE, "^file:/+", "file:/")
        rows = self.text.select(file.alias("file"), bad.alias("columns"), line.alias("line"), F.col(_CORRUPT).isNotNull().alias("odd"))
        return rows.filter(F.col("odd") | (F.size("columns") > 0)).drop("odd")

    def bad_cells(self) -> DataFrame:
        """(column, bad) for each column: cells with text that does not fit the type, from one scan."""
        misfits = self._misfits()
        return self.text.agg(*(F.count_if(m).alias(n) for n, m in misfits.items())).unpivot([], list(misfits), "column", "bad")


def read_csv(spark: SparkSession, path: str, schema: StructType, multiline: bool | None = None) -> DataFrame:
    """The typed rows of ``CsvFiles``; a cell that does not fit its type is null."""
    return CsvFiles(spark, path, schema, multiline).rows()


def bad_cells(spark: SparkSession, path: str, schema: StructType, multiline: bool | None = None) -> DataFrame:
    return CsvFiles(spark, path, schema, multiline).bad_cells()


def csv_stream(reader: DataStreamReader, spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stream of the typed rows of CSV files; a file whose header differs from the first one's fails the stream."""
    names = _header(spark, path, schema, False)
    text = StructType([StructField(n, StringType()) for n in names])
    rows = reader.schema(text).options(**_DIALECT, header=True, enforceSchema=False).load(path)
    return rows.select(*(_typed(f).alias(f.name) for f in schema.fields))


def as_csv_lines(df: DataFrame) -> DataFrame:
    """(line): the rows of ``df`` as records of the dialect ``CsvFiles`` reads."""
    options = {**_WRITTEN, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    return df.select(F.to_csv(F.struct(*(F.col(f"`{c}`") for c in df.columns)), options).alias("line"))


def from_csv_lines(lines: DataFrame, schema: StructType) -> DataFrame:
    """Typed rows from records (line) in ``schema``'s column order, by the same rules as ``CsvFiles``."""
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    cells = lines.select(F.from_csv("line", text.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), _DIALECT).alias("c"))
    return cells.select("c.*").select(*(_typed(f).alias(f.name) for f in schema.fields))


def write_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` in the same dialect ``read_csv`` reads."""
    df.write.mode("overwrite").options(**_WRITTEN, header=True).csv(path)


def raw_csv_files(spark: SparkSession, folder: str, multiline: bool | None = None) -> dict[str, CsvFiles]:
    """``folder``/{customers,offers,events}.csv by name."""
    return {name: CsvFiles(spark, os.path.join(folder, file), _RAW_SCHEMAS[name], multiline) for name, file in RAW_FILES.items()}


def load_raw_csv(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(customers, offers, events) from ``folder``/{customers,offers,events}.csv."""
    files = raw_csv_files(spark, folder)
    return tuple(files[name].rows() for name in ("customers", "offers", "events"))
