"""CSV and Parquet scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# quotes inside a field are doubled, as most CSV tools write them, and blanks are kept
_CSV_DIALECT = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# what the parser puts in place of an unquoted empty field, and then takes for null; it
# has to differ from the empty text, which is written in quotes
_NULL_FIELD = "\u0001"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    *,
    header: bool = True,
    sep: str = ",",
    multi_line: bool = False,
    mode: str | None = None,
) -> DataFrame:
    """Scan CSV files.

    Give a ``schema`` whenever it is known: inference costs one more pass over the
    files and loses the leading zeros of codes. ``multi_line`` allows line breaks
    inside quoted fields, but then a file can no longer be split between tasks.

    With a schema a malformed value or a row of another length raises (``FAILFAST``).
    ``mode="PERMISSIVE"`` makes nulls of them; add a ``_corrupt_record string`` column to
    the schema to keep the text of such rows. A field that is exactly the control
    character U+0001 is read as null.
    """
    reader = spark.read.options(
        **_CSV_DIALECT, header=header, sep=sep, multiLine=multi_line, nullValue=_NULL_FIELD
    )
    reader = reader.option("mode", mode or ("FAILFAST" if schema is not None else "PERMISSIVE"))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(
    df: DataFrame, path: str, *, header: bool = True, sep: str = ",", mode: str = "overwrite"
) -> None:
    df.write.mode(mode).options(**_CSV_DIALECT, header=header, sep=sep).csv(path)


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def write_parquet(
    df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: tuple[str, ...] = ()
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def _statistics_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet reader answers min and max from file footers."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def _limits(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    named = [(f"{name}{i}", f(c)) for i, c in enumerate(columns) for name, f in (("low", F.min), ("high", F.max))]
    return table.agg(*(value.alias(name) for name, value in named))


def parquet_limits(spark: SparkSession, path: str, columns: Sequence[str]) -> list[tuple]:
    """Least and greatest value of each column of a Parquet table, from the statistics of its files.

    Only footers are read where the types allow it (numbers, booleans and dates). Files whose footers have no
    limits, as with NaN among the values, and columns of other types are read as usual. All files have
    the columns of the first in the same order, as files of one job do. Nulls do not count; without
    values both limits are None.
    """
    footers = _limits(_statistics_session(spark).read.parquet(path), columns)
    try:
        found = footers.first()
    except (PySparkException, Py4JJavaError):  # no statistics for a column of some file
        found = _limits(spark.read.parquet(path), columns).first()
    return [(found[f"low{i}"], found[f"high{i}"]) for i in range(len(columns))]


def to_pandas(df: DataFrame, max_rows: int = 100_000):
    """A small final result as a pandas table; larger ones are refused, never cut."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows; write the table instead of collecting it")
    return df.toPandas()
