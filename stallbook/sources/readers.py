"""CSV files and reports as text columns; types are cast by the cleaning plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.functions import text
from stallbook.schemas import text_schema
from stallbook.sources import records

# Cell texts that mean "missing" in the exported files.
MISSING = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def _missing_to_null(df: DataFrame) -> DataFrame:
    def clean(name: str) -> Column:
        c = F.col(name)
        return F.when(~c.isin(*MISSING), c).alias(name)

    return df.select(*[clean(c) for c in df.columns])


#: Holds the text of a record whose number of cells is not the header's.
BROKEN = "_broken_record"


def _records(
    spark: SparkSession,
    path: str | list[str],
    names: Sequence[str],
    multi_line: bool,
    split_bytes: int | None = None,
) -> DataFrame:
    """Text columns by position, the broken records, and the file of each."""
    schema = text_schema(list(names)).add(BROKEN, "string")
    if multi_line:
        return _parsed(records.records(spark, path, 1, split_bytes), schema)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", BROKEN)
        # widths are compared only while all cells are parsed
        .option("columnPruning", False)
        .csv(path)
        .withColumn("file_path", F.col("_metadata.file_path"))
    )


def _parsed(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """The cells of each record's text. A generated row is parsed once; a column
    made from the text would be parsed again by every filter on a cell."""
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": BROKEN}
    cells = F.from_csv("value", F.lit(schema.simpleString()), options)
    out = texts.select(F.inline(F.array(cells)), "file_path", "value")
    if BROKEN in schema.names:
        unclosed = F.when(records.quotes("value") % 2 == 1, F.col("value"))
        out = out.withColumn(BROKEN, F.coalesce(BROKEN, unclosed))
    return out.drop("value")


def broken_records(
    spark: SparkSession, path: str | list[str], names: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """Files with records of another width than ``names``, and how many."""
    broken = _records(spark, path, names, multi_line).where(F.col(BROKEN).isNotNull())
    # Spark wants a column of the file besides the broken records.
    broken = broken.where(F.coalesce(F.col(names[0]), F.lit("")) >= "")
    return broken.groupBy(F.col("file_path").alias("_file")).agg(F.count(F.lit(1)).alias("records"))


def _whole(df: DataFrame) -> DataFrame:
    """Fails the job at the first broken record, and says where it stands."""
    message = F.concat(
        F.lit("record of another width than the header in "),
        F.col("file_path"),
        F.lit(", read with multi_line if cells hold line breaks: "),
        F.substring(F.col(BROKEN), 1, 200),
    )
    whole = F.when(F.col(BROKEN).isNull(), F.lit(True)).otherwise(F.raise_error(message))
    return df.where(whole).drop(BROKEN)


def _checked_width(found: dict[str, list[str]], width: int) -> None:
    for file, cells in found.items():
        if len(cells) != width:
            raise ValueError(f"{file}: expected {width} columns, file has {len(cells)}")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    names: Sequence[str],
    multi_line: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """Files whose header is ignored: columns are named by position, all text.
    The declared schema means no pass over the data to infer types, and codes
    with leading zeros stay as they are.

    The width of every file's header is compared with ``names`` before the scan,
    and a record of another width, in any file, fails the job instead of being
    moved or cut; ``broken_records`` counts them by file. A quoted line break is
    such a record unless ``multi_line`` is set, which costs a second pass that
    counts quotes. Files are split over tasks in both cases, with ``multi_line``
    at about every ``split_bytes`` (the session's size of a split).
    """
    _checked_width(records.headers(spark, path), len(names))
    raw = _records(spark, path, names, multi_line, split_bytes)
    return _missing_to_null(_whole(raw).drop("file_path"))


def read_csv_by_header(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> DataFrame:
    """Files whose header names the columns (normalised), all text. Every file's
    own header counts: files may have the columns in different orders, but must
    all have the same ones. A record of another width fails the job."""
    found = {
        file: [text.normalise_name(c) for c in cells]
        for file, cells in records.headers(spark, path).items()
    }
    names = found[min(found)] if found else []
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after normalising: {sorted(names)}")
    for file, cells in found.items():
        if sorted(cells) != sorted(names):
            raise ValueError(f"{file}: has columns {cells}, other files {names}")
    if all(cells == names for cells in found.values()):
        df = _whole(_records(spark, path, names, multi_line)).drop("file_path")
    else:
        cells = [f"_c{i}" for i in range(len(names))]
        raw = _whole(_records(spark, path, cells, multi_line))
        places = {file: [header.index(n) + 1 for n in names] for file, header in found.items()}
        df = records.by_names(spark, raw, cells, places, names).drop("file_path")
    return _missing_to_null(df)


def read_report(
    spark: SparkSession,
    path: str | list[str],
    names: Sequence[str],
    anchor: str = "company_name",
    header_row: int = 5,
    split_bytes: int | None = None,
) -> DataFrame:
    """Reports with title lines above the header, landed as CSV, by name.

    Row ``header_row`` of each file (blank lines do not count) names its columns
    after ``normalise_name``, whatever their number and order; the rows up to it
    are dropped, as are later rows without a value in ``anchor``. ``names`` are
    taken wherever they stand, other columns are left out, and a file that lacks
    one of them fails. Cells may hold line breaks; large files are split.
    """
    wanted, places, width = list(names), {}, 1
    for file, header in records.headers(spark, path, header_row).items():
        found = [text.normalise_name(c) for c in header]
        missing = [n for n in wanted if n not in found]
        if missing:
            raise ValueError(f"{file}: no column {', '.join(missing)} in row {header_row}")
        places[file] = [found.index(n) + 1 for n in wanted]
        width = max(width, len(found))
    cells = [f"_c{i}" for i in range(width)]
    texts = records.records(spark, path, header_row, split_bytes)
    raw = _parsed(texts, text_schema(cells))
    df = _missing_to_null(records.by_names(spark, raw, cells, places, wanted).drop("file_path"))
    return df.filter(F.col(anchor).isNotNull())
