"""Text sources: the three tables as CSV files with a header row.

Columns are found by their names in the header. Their types are declared,
never inferred: inference costs a full pass over the files and one bad cell
changes a column's type. Date and timestamp
columns are read as text and parsed by the clean step, which drops only
the rows that fail to parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens import schemas as S
from plantlens.tables import Tables

# Column with the whole line of a row that has another number of cells than
# the header.
MALFORMED = "_malformed"

# Written timestamps keep microseconds, so a CSV round trip is lossless.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _read(
    spark: SparkSession, path: str, schema: T.StructType, optional: tuple[str, ...] = ()
) -> DataFrame:
    """The columns of ``schema`` by their names in the header, in any order;
    other columns are ignored. All files of a folder must have the same
    header. Cells that do not parse become NULL."""
    text = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    _need(path, schema, text.columns, optional)
    return text.select(*[cell(f).alias(f.name) for f in schema if f.name in text.columns])


def _need(path: str, schema: T.StructType, header: list[str], optional: tuple[str, ...]) -> None:
    missing = [f.name for f in schema if f.name not in header and f.name not in optional]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")


def cell(field: T.StructField) -> Column:
    """Text as the declared type; whole numbers may be written as 45.0."""
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.IntegerType):
        return text.try_cast("double").try_cast("int")
    return text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)


def read_cells(
    spark: SparkSession, path: str, schema: T.StructType, optional: tuple[str, ...] = ()
) -> DataFrame:
    """The columns of ``schema`` by their names in the header, all as text
    just as it stands, and MALFORMED."""
    options = {"header": True, "enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    header = spark.read.options(**options).csv(path).columns
    _need(path, schema, header, optional)
    text = T.StructType([T.StructField(c, T.StringType()) for c in (*header, MALFORMED)])
    # Without pruning the parser sees all cells of a row, so that it can tell
    # their number.
    rows = spark.read.schema(text).options(**options, columnPruning=False).csv(path)
    return rows.select(*[F.col(f"`{f.name}`") for f in schema if f.name in header], MALFORMED)


SENSOR_COLUMNS = T.StructType([*S.SENSOR_CSV.fields, T.StructField(S.READING_ID, T.LongType())])


def read_sensors(spark: SparkSession, path: str) -> DataFrame:
    """Readings; a column reading_id is read where the file has one."""
    return _read(spark, path, SENSOR_COLUMNS, (S.READING_ID,))


def read_machines(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, S.MACHINE_CSV)


def read_maintenance(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, S.MAINTENANCE_CSV)


def read_tables(
    spark: SparkSession,
    sensors: str,
    machines: str,
    maintenance: str,
) -> Tables:
    """The raw (uncleaned) tables from three CSV paths (files or folders)."""
    return Tables(
        sensors=read_sensors(spark, sensors),
        machines=read_machines(spark, machines),
        maintenance=read_maintenance(spark, maintenance),
    )


def read_table_cells(
    spark: SparkSession,
    sensors: str,
    machines: str,
    maintenance: str,
) -> Tables:
    """The three tables as text cells, for ``operators.quarantine``."""
    return Tables(
        sensors=read_cells(spark, sensors, SENSOR_COLUMNS, (S.READING_ID,)),
        machines=read_cells(spark, machines, S.MACHINE_CSV),
        maintenance=read_cells(spark, maintenance, S.MAINTENANCE_CSV),
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` as CSV with a header, in the layout ``read_*`` expects."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("timestampFormat", TIMESTAMP_TEXT)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )
