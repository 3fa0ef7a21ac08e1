"""CSV and Parquet scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..naming import ref, require_columns
from .csv_records import layout, lines_of, may_span_lines, records

# No CSV cell holds this text: an unquoted empty cell is read as null while a
# quoted one stays the empty text.
_NEVER = "\u0000"
_CELLS, _BAD = "__cells", "__bad_record"


def _locations(paths: str | list[str] | None, folder: str | None) -> list[str]:
    paths = [paths] if isinstance(paths, str) else list(paths or [])
    if not paths and not folder:
        raise ValueError("give paths or a folder")
    return [folder] if folder else paths


def _without(df: DataFrame, excluded: list[str] | None) -> DataFrame:
    """Leave out files by name; Spark skips them when it lists the files."""
    if not excluded:
        return df
    return df.filter(~F.col("_metadata.file_name").isin(list(excluded)))


def _without_names(lines: DataFrame, excluded: list[str] | None) -> DataFrame:
    return lines.filter(~F.col("file_name").isin(list(excluded))) if excluded else lines


def _sample(
    spark: SparkSession, locations: list[str], folder: str | None, pattern: str, excluded: list[str] | None
) -> list[str]:
    """Where to look up columns: for a folder with exclusions, its first kept file.

    Lists names only; no file is opened.
    """
    if not folder or not excluded:
        return locations
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    first = _without(listed, excluded).agg(F.min("path").alias("path")).first()["path"]
    if first is None:
        raise FileNotFoundError(f"no {pattern} file is left in {folder}")
    return [first]


def csv_options(sep: str, header: bool, mode: str) -> dict[str, str]:
    return {
        "sep": sep,
        "header": str(header).lower(),
        "mode": mode,
        "quote": '"',
        "escape": '"',
        "nullValue": _NEVER,
        "emptyValue": "",
        # With pruned columns the parser would not see that a row has too few or too many cells.
        "columnPruning": "false",
    }


def parsed(rows: DataFrame, schema: T.StructType, sep: str, mode: str, keep: list[Column]) -> DataFrame:
    """The cells of CSV records in the column ``value``, and the columns to keep."""
    options = csv_options(sep, False, mode) | {"multiLine": "true"}
    dropping = mode.upper() == "DROPMALFORMED"
    if dropping:
        # Text is parsed cell by cell; what does not fit leaves the record in a column of its own.
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
        schema = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    cells = rows.select(*keep, F.from_csv("value", schema.toDDL(), options).alias(_CELLS))
    if dropping:
        cells = cells.where(ref(_CELLS)[_BAD].isNull())
    return cells


def read_csv(
    spark: SparkSession,
    paths: str | list[str] | None = None,
    schema: T.StructType | str | None = None,
    columns: list[str] | None = None,
    sep: str = ",",
    header: bool = True,
    folder: str | None = None,
    exclude: list[str] | None = None,
    multiline: bool = True,
    mode: str = "FAILFAST",
    position: str | None = None,
    chunk: tuple[int, int] | None = None,
    nested: bool = False,
) -> DataFrame:
    """Scan CSV files: the listed ones, or all ``*.csv`` of a folder except some.

    ``schema`` gives column types by name; the order is the one of the file header,
    and columns it does not name are read as text. Without it every column is text
    (see ``infer_schema``). Dates are best read as text and converted afterwards.
    An empty cell is null, a quoted empty cell is empty text. A cell that does not
    fit its type fails the job unless ``mode`` is ``PERMISSIVE`` or ``DROPMALFORMED``.

    Cells may hold line breaks; many tasks read a file all the same. For that all files are
    looked through for lines that are no whole records when this is called, and if there are
    any the quotes of every split are counted (see ``csv_records``). ``multiline=False`` saves these scans; a record that spans lines then fails the
    job. So do, either way, quotes that are not doubled inside a cell, and another header.

    ``position`` names a column that sorts the rows as the files hold them, in the order
    of their paths, for keeping the first of duplicate rows as written. ``chunk=(part, size)`` reads the
    rows from ``part * size`` up to the next part in that order, and parses only splits of files that
    hold some of them. ``nested`` looks for files in folders below the paths as well.
    """
    locations = _locations(paths, folder)
    if chunk is not None and (chunk[0] < 0 or chunk[1] < 0):
        raise ValueError("part and size of a chunk must not be negative")
    if len(sep) != 1:
        raise ValueError(f"{sep!r} is not one character")
    sample = _sample(spark, locations, folder, "*.csv", exclude)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)

    def reader():
        found = spark.read.option("pathGlobFilter", "*.csv") if folder else spark.read
        return found.option("recursiveFileLookup", "true") if nested else found

    native = reader().options(**csv_options(sep, header, mode))
    kinds = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    if header or schema is None:
        # Reads one line of one file.
        names = native.csv(sample).columns
        absent = [n for n in kinds if n not in names]
        if absent:
            raise ValueError(f"the file has no columns {absent}; it has {names}")
        schema = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
    lines = _without_names(lines_of(reader(), locations), exclude)
    if chunk is None and multiline and not may_span_lines(lines):
        # Every line is a record, so Spark's own reader can cut the files.
        # It fails on a file whose header differs, rather than shift its columns.
        df = _without(native.schema(schema).option("enforceSchema", "false").csv(locations), exclude)
        # One block is read by one task, from top to bottom.
        place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    else:
        found = layout(lines, header) if multiline or chunk is not None else None
        places = (chunk[0] * chunk[1], (chunk[0] + 1) * chunk[1]) if chunk is not None else None
        rows = records(lines, found, schema.names if header else None, sep, places)
        df = parsed(rows, schema, sep, mode, [F.col(c).alias(f"__{c}") for c in ("file", "block", "row")])
        place = [F.col(f"__{c}") for c in ("file", "block", "row")]
        df = df.select("*", *[ref(_CELLS)[n].alias(n) for n in schema.names]).drop(_CELLS)
    kept = [ref(c) for c in (require_columns(df, columns) if columns else schema.names)]
    if position:
        names = ("file_path", "file_block_start", "row")
        kept.append(F.struct(*[c.alias(n) for c, n in zip(place, names)]).alias(position))
    return df.select(kept)


_WHOLE, _DECIMAL, _FLAG, _TEXT = 1, 2, 4, 8


def infer_schema(spark: SparkSession, paths: str | list[str], **options) -> T.StructType:
    """Types of CSV columns from all their values: long, double, boolean or text.

    Dates stay text. One aggregation over the files: the cells of a row are taken
    apart and the kinds of value seen in each column are combined in the map tasks.
    """
    text = read_csv(spark, paths, **options)
    cell = ref("cell")
    number_like = F.ascii(cell) <= ord("9")
    kind = (
        F.when(cell.isin("true", "false"), _FLAG)
        .when(number_like & cell.rlike(r"^[+-]?\d+$"), F.when(cell.try_cast("bigint").isNotNull(), _WHOLE).otherwise(_DECIMAL))
        .when(number_like & cell.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), _DECIMAL)
        .when(cell.isNotNull(), _TEXT)
    )
    cells = text.select(F.posexplode(F.array(*[ref(c) for c in text.columns])).alias("column", "cell"))
    kinds = cells.select("column", kind.alias("kind")).groupBy("column").agg(F.bit_or("kind").alias("kinds"))
    seen = {r["column"]: r["kinds"] for r in kinds.collect()}
    types = {_WHOLE: T.LongType(), _DECIMAL: T.DoubleType(), _WHOLE | _DECIMAL: T.DoubleType(), _FLAG: T.BooleanType()}
    return T.StructType(
        [T.StructField(c, types.get(seen.get(i), T.StringType())) for i, c in enumerate(text.columns)]
    )


def read_parquet(
    spark: SparkSession,
    paths: str | list[str] | None = None,
    columns: list[str] | None = None,
    folder: str | None = None,
    exclude: list[str] | None = None,
    position: str | None = None,
    chunk: tuple[int, int] | None = None,
    nested: bool = False,
) -> DataFrame:
    """Scan Parquet files: the listed ones, or all ``*.parquet`` of a folder except some.

    ``position`` names a column that sorts the rows as the files hold them, in the order
    of their paths (the path and the row's index in the file), for keeping the first
    of duplicate rows as written. ``chunk=(part, size)`` reads the rows from ``part * size``
    up to the next part in that order, and opens only the files that hold them. Their
    numbers of rows are taken from the footers when the plan is built. ``nested`` looks for files
    in folders below the paths as well.
    """
    locations = _locations(paths, folder)
    reader = spark.read.option("pathGlobFilter", "*.parquet") if folder else spark.read
    reader = reader.option("recursiveFileLookup", "true") if nested else reader
    if folder and exclude:
        sample = _sample(spark, locations, folder, "*.parquet", exclude)
        reader = reader.schema(spark.read.parquet(*sample).schema)
    df = _without(reader.parquet(*locations), exclude)
    kept = require_columns(df, columns) if columns else df.columns
    if chunk is not None:
        df = df.filter(_inside_chunk(df, *chunk))
    rows = [ref(c) for c in kept]
    if position:
        rows.append(F.struct("_metadata.file_path", "_metadata.row_index").alias(position))
    return df.select(rows)


def _inside_chunk(df: DataFrame, part: int, size: int) -> Column:
    """Whether a row is one of ``part * size`` up to the next part, by its file's path and
    its index there; Spark skips the files that the condition on the path leaves out."""
    path, index = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    sizes = df.select(path.alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    # One row for each file that is not empty.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("file", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    low, high = part * size, (part + 1) * size
    held = begins.filter((F.col("begin") < high) & (F.col("begin") + F.col("n") > low))
    ends = held.agg(F.min(F.struct("file", "begin")).alias("first"), F.max(F.struct("file", "begin")).alias("last")).first()
    if ends["first"] is None:
        return F.lit(False)
    (first, first_begin), (last, last_begin) = ends["first"], ends["last"]
    return (
        path.between(first, last)
        & ((path != first) | (index >= low - first_begin))
        & ((path != last) | (index < high - last_begin))
    )
