"""Explicit-schema CSV scan of loan files, with the rejected lines kept.

Reader settings (never inferred, never changing session conf):

* header row, ``PERMISSIVE`` mode, ``dateFormat=MM/dd/yyyy``, the 53-column schema;
* a bad cell becomes null and the rest of the row is kept;
* ``escape='"'`` by default so RFC-4180 doubled quotes (``"JOE ""S"" PIZZA, INC"``) parse;
  pass ``escape='\\\\'`` for Spark's historical backslash escape;
* ``enforce_schema=False`` by default: each file's header line is compared with the schema's
  names before anything is read (:func:`check_headers`, the one step here that runs Python, on
  first lines only), so a file with reordered columns fails instead of loading shifted data;
* ``multiLine`` stays off so every file is split into tasks of ``spark.sql.files.maxPartitionBytes``
  (512 MB in this package's sessions); the scan is one map stage with no shuffle.

Rejected rows are additional: every line stays a row of the loans, with its bad cells null, and
with ``corrupt_column`` set a malformed line (bad cell, too few or too many cells) also keeps its
raw text there. Spark only fills that column when the *whole* row is parsed, so
:func:`read_loans_with_rejects` materialises one full parse before it is read twice; selecting only some columns before that would change which rows count as
malformed (the CSV reader prunes columns and only converts those it returns). The parse keeps each
line's file, block and place, so :func:`reject_cells` can tell which cell of which line failed.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from disclosure.schema import LOAN_SCHEMA, SOURCE_DATE_FORMAT
from disclosure.session import SCRATCH_WRITE_OPTIONS, compile_in_pieces, remove_folder, scratch_path
from disclosure.sources.names import joined_names

CORRUPT_COLUMN = "_corrupt_record"


def loan_reader(
    spark: SparkSession,
    schema: StructType = LOAN_SCHEMA,
    escape: str = '"',
    enforce_schema: bool = False,
    corrupt_column: str | None = None,
):
    """A configured ``DataFrameReader`` for loan CSV files."""
    compile_in_pieces(spark)
    if corrupt_column:
        schema = StructType(schema.fields + [StructField(corrupt_column, StringType(), True)])
    reader = (
        spark.read.format("csv")
        .schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("dateFormat", SOURCE_DATE_FORMAT)
        .option("escape", escape)
        .option("enforceSchema", enforce_schema)
        .option("multiLine", False)
    )
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader


def read_loans(
    spark: SparkSession,
    paths: str | Sequence[str],
    row_limit: int | None = None,
    **reader_options,
) -> DataFrame:
    """Loan records from one or several CSV files (a bag union; nothing is de-duplicated).

    Unless ``enforce_schema`` is set, the header line of every file is compared with the schema
    first (see :func:`check_headers`): Spark itself only checks the columns that a query reads, so
    a bare count over a file with reordered columns would pass.

    ``row_limit`` keeps any rows, with no ordering: a sample, not a deterministic subset.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    if not files:
        raise ValueError("No CSV files to read")
    if not reader_options.get("enforce_schema", False):
        schema = reader_options.get("schema", LOAN_SCHEMA)
        check_headers(spark, files, schema.names, escape=reader_options.get("escape", '"'))
    df = loan_reader(spark, **reader_options).load(files)
    return limit_rows(df, row_limit) if row_limit is not None else df


_PART, _AT = "_limit_part", "_limit_at"


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, any of them, without passing rows through one task.

    Every partition writes at most ``n`` of its rows to the shared checkpoint folder. The counts,
    one row per partition, are summed up from the first partition on: partitions before the one
    that reaches ``n`` keep all they wrote, that one keeps what is missing.
    """
    if n <= 0:
        return df.limit(0)
    spark = df.sparkSession
    path = scratch_path(spark, "limit")
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the row's number in its partition
    numbered = df.select("*", F.spark_partition_id().alias(_PART), inside.alias(_AT))
    numbered.filter(F.col(_AT) < n).write.options(**SCRATCH_WRITE_OPTIONS).parquet(path)
    staged = spark.read.schema(numbered.schema).parquet(path)
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    counts = staged.groupBy(_PART).agg(F.count(F.lit(1)).alias("rows"))
    reached = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).filter(F.col("before") < n)
    last = reached.agg(F.max(F.struct(_PART, "before")).alias("last")).first()["last"]
    if last is None:
        return staged.drop(_PART, _AT)
    keep = (F.col(_PART) < last[_PART]) | ((F.col(_PART) == last[_PART]) & (F.col(_AT) < n - last["before"]))
    return staged.filter(keep).drop(_PART, _AT)


@dataclass
class ParsedLoans:
    """One parse of source files: all ``loans``, and the ``rejects`` with their raw lines.

    Both read the same materialised copy; :meth:`close` removes it.
    """

    loans: DataFrame
    rejects: DataFrame
    parsed: DataFrame
    folder: str | None
    schema: StructType = LOAN_SCHEMA
    escape: str = '"'
    corrupt_column: str = CORRUPT_COLUMN

    def cells(self, keys: Sequence[str] = ("LoanNumber",)) -> DataFrame:
        """Where the rejected lines are and which of their cells failed: :func:`reject_cells`."""
        return reject_cells(self, keys)

    def close(self) -> None:
        if self.folder:
            remove_folder(self.parsed.sparkSession, self.folder)
        else:
            self.parsed.unpersist()


def read_loans_with_rejects(
    spark: SparkSession,
    paths: str | Sequence[str],
    corrupt_column: str = CORRUPT_COLUMN,
    materialize: str = "stage",
    **reader_options,
) -> ParsedLoans:
    """All loans and the rejected lines from ONE full parse of the files.

    ``loans`` has the source columns of every line; ``rejects`` holds the malformed lines again,
    with ``corrupt_column``. The parse must cover every column (see the module notes), so it is
    materialised once:

    * ``stage`` (default): written as Parquet to the shared checkpoint folder and read back (no
      shuffle, no sort); the rejects are a filter pushed to the scan, the loans a column-pruned
      read, and a lost executor never re-parses the CSV.
    * ``persist``: kept in executor memory, spilling to disk; a lost executor's blocks are
      re-parsed from the files.

    Call ``close()`` when both have been consumed.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    schema, escape = reader_options.get("schema", LOAN_SCHEMA), reader_options.get("escape", '"')
    if not reader_options.get("enforce_schema", False):
        check_headers(spark, files, schema.names, escape=escape)
    reader = loan_reader(spark, corrupt_column=corrupt_column, **reader_options)
    parsed = reader.load(files).select(
        "*",
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_BLOCK),
        F.monotonically_increasing_id().alias(_ROW),
    )
    folder = None
    if materialize == "persist":
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    elif materialize == "stage":
        folder = scratch_path(spark, "parsed")
        parsed.write.options(**SCRATCH_WRITE_OPTIONS).parquet(folder)
        parsed = spark.read.schema(parsed.schema).parquet(folder)
    else:
        raise ValueError(f"Unknown materialization: {materialize!r}")
    rejects = parsed.filter(F.col(corrupt_column).isNotNull()).drop(_FILE, _BLOCK, _ROW)
    loans = parsed.drop(corrupt_column, _FILE, _BLOCK, _ROW)
    return ParsedLoans(loans, rejects, parsed, folder, schema, escape, corrupt_column)


_FILE, _BLOCK, _ROW = "_source_file", "_source_block", "_source_row"


def _problem(kind) -> str:
    return f"not a date ({SOURCE_DATE_FORMAT})" if isinstance(kind, DateType) else f"not of type {kind.simpleString()}"


def reject_cells(parsed: ParsedLoans, keys: Sequence[str] = ("LoanNumber",)) -> DataFrame:
    """One row per failed cell of the rejected lines, from the parse that is there already.

    ``file``, ``block_start`` (byte at which the scanned block of the file begins), ``row_in_block`` (the
    line's number among the block's records, from 1; a file that is one block has its header
    before them), the ``keys`` of the line, ``column``, ``cell`` (its text) and ``problem``. The raw line is
    parsed again as text only; a cell failed where that parse has a text and the typed one null. A
    line with too many or too few cells has a row of its own, without a column.
    """
    bad, names = parsed.corrupt_column, parsed.schema.names
    text_schema = StructType([StructField(n, StringType()) for n in names] + [StructField("_count", StringType())])
    options = {"escape": parsed.escape, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_count"}
    rejects = parsed.parsed.filter(F.col(bad).isNotNull())
    rejects = rejects.withColumn("_text", F.from_csv(F.col(bad), text_schema.simpleString()[7:-1].replace(":", " "), options))
    cells = []
    for field in parsed.schema.fields:
        if not isinstance(field.dataType, StringType):
            cell = F.col("_text").getField(field.name)
            found = F.struct(F.lit(field.name).alias("column"), cell.alias("cell"), F.lit(_problem(field.dataType)).alias("problem"))
            cells.append(F.when(cell.isNotNull() & F.col(f"`{field.name}`").isNull(), found))
    nothing = F.lit(None).cast("string")
    count = F.struct(nothing.alias("column"), nothing.alias("cell"), F.lit("wrong number of cells").alias("problem"))
    cells.append(F.when(F.col("_text").getField("_count").isNotNull(), count))
    begins = parsed.parsed.groupBy(_FILE, _BLOCK).agg(F.min(_ROW).alias("_begin"))  # a block is read by one task, in order
    failed = rejects.withColumn("_cell", F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())))
    return failed.join(begins, [_FILE, _BLOCK]).select(
        F.col(_FILE).alias("file"),
        F.col(_BLOCK).alias("block_start"),
        (F.col(_ROW) - F.col("_begin") + 1).alias("row_in_block"),
        *keys,
        "_cell.column",
        "_cell.cell",
        "_cell.problem",
    )


# ---------------------------------------------------------------- header gate


class HeaderMismatch(ValueError):
    """Files whose header line is not the schema's; ``files`` is the DataFrame ``(file, header)`` of them."""

    def __init__(self, message: str, files: DataFrame):
        super().__init__(message)
        self.files = files


_NOT_BLANK = r"(?Us)^\x{FEFF}?+.*?[^\s\x1C-\x1F]"  # a character besides white space, after a byte order mark


def header_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``value, file``: the first line of every file that is not blank.

    Reads in a session of its own in which every block of a file is a task: the first line of a first
    block that is not blank is the one its task numbers 0. All others are dropped by Spark's own scan.
    """
    gate = spark.newSession()
    gate.conf.set("spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    gate.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    lines = gate.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    lines = lines.filter((F.col("start") == 0) & F.col("value").rlike(_NOT_BLANK))
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the row's number in its partition
    return lines.select("value", "file", inside.alias(_AT)).filter(F.col(_AT) == 0).drop(_AT)


def wrong_headers(spark: SparkSession, paths: Sequence[str], names: Sequence[str], escape: str = '"') -> DataFrame:
    """``file, header`` of the files whose first line does not name the columns, in order, any case.

    Python gets one line a file (:func:`header_lines`).
    """
    wanted = [n.lower() for n in names]
    quoting = {"doublequote": True} if escape == '"' else {"doublequote": False, "escapechar": escape}

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                line = row["value"].removeprefix("\ufeff")
                cells = [c.strip().lower() for c in next(csv.reader([line], **quoting), [])]
                if cells != wanted:
                    yield pa.RecordBatch.from_arrays([pa.array([row["file"]]), pa.array([line])], names=["file", "header"])

    return header_lines(spark, paths).mapInArrow(compared, "file string, header string")


def check_headers(spark: SparkSession, paths: Sequence[str], names: Sequence[str], escape: str = '"') -> None:
    """Raises :class:`HeaderMismatch` naming every file whose header is not the schema's."""
    wrong = wrong_headers(spark, paths, names, escape)
    if wrong.count():
        raise HeaderMismatch(f"The header does not match the schema in: {joined_names(wrong, 'file')}", wrong)


def write_loans_csv(
    df: DataFrame,
    path: str,
    files: int | None = None,
    escape: str = '"',
    mode: str = "error",
) -> None:
    """Write loan records in the published source layout (header, ``MM/dd/yyyy`` dates).

    Leading and trailing spaces are written as they are, so a read gives them back; an
    empty string and a null both become an empty cell and read back as null.
    """
    compile_in_pieces(df.sparkSession)
    out = df.repartition(files) if files else df
    (
        out.write.mode(mode)
        .option("header", True)
        .option("dateFormat", SOURCE_DATE_FORMAT)
        .option("escape", escape)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
