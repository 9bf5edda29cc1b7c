"""Where the reports get their tables from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.functions.dates import day_start
from stockledger.sources.layout import in_months, month_column
from stockledger.sources.schema import TABLES, table_schema


class Catalog:
    """Binds table names to DataFrames with the declared columns and types.

    ``loader(name)`` returns the raw DataFrame of a table. Only declared columns are kept, so a
    report never reads more of a wide table than the schema lists, and Spark prunes the rest of
    what the report leaves unused. A column the source does not have is an error unless
    ``fill_missing`` is set, in which case it reads as NULL. Decimals and doubles of more digits than declared are
    an error too, when a value has such digits: nothing is rounded. ``workdir`` is a folder that all
    executors share; reports that read a result several times then write it there once. ``zone`` (such as
    ``+07:00`` or ``Europe/Berlin``) is the time zone of the reports' days, months, years and clock times; without
    it that is the session's. Columns of dates are the start of their day there.
    """

    def __init__(
        self,
        spark: SparkSession,
        loader: Callable[[str], DataFrame],
        fill_missing: bool = False,
        workdir: str | None = None,
        zone: str | None = None,
    ):
        self.spark = spark
        self.zone = zone
        self.workdir = workdir
        self._loader = loader
        self._fill_missing = fill_missing
        self._tables: dict[str, DataFrame] = {}
        self._raw: dict[str, DataFrame] = {}

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, **options) -> Catalog:
        """One Parquet file or folder per table: ``root/<Table>``."""
        return cls(spark, lambda name: spark.read.parquet(f"{root}/{name}"), **options)

    @classmethod
    def from_database(cls, spark: SparkSession, database: str, **options) -> Catalog:
        """Tables of a metastore database (any format Spark can read, JDBC tables included)."""
        return cls(spark, lambda name: spark.table(f"{database}.{name}"), **options)

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame], **options) -> Catalog:
        return cls(spark, frames.__getitem__, **options)

    def table(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(f"unknown table {name!r}")
        if name not in self._tables:
            self._tables[name] = self._declared(name, self._source(name))
        return self._tables[name]

    def between(self, name: str, time: str, low: Column | None = None, high: Column | None = None) -> DataFrame:
        """The rows of a table whose ``time`` is from low to high, both included; None leaves a side open.

        Of a table that ``write_by_month`` laid out by ``time`` only the months in question are read.
        Bounds may be constants or scalar subqueries; the latter prune when the query runs.
        """
        if name not in TABLES:
            raise KeyError(f"unknown table {name!r}")
        raw = self._source(name)
        if month_column(time).lower() in (c.lower() for c in raw.columns):
            raw = raw.filter(in_months(time, low, high))
        rows = self._declared(name, raw)
        if low is not None:
            rows = rows.filter(F.col(time) >= low)
        return rows if high is None else rows.filter(F.col(time) <= high)

    def _source(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self._loader(name)
        return self._raw[name]

    def _declared(self, name: str, raw: DataFrame) -> DataFrame:
        have = {c.lower(): t for c, t in raw.dtypes}
        columns = []
        for field in table_schema(name).fields:
            wanted = field.dataType
            if field.name.lower() not in have:
                if not self._fill_missing:
                    raise ValueError(f"table {name} has no column {field.name}")
                columns.append(F.lit(None).cast(wanted).alias(field.name))
            elif have[field.name.lower()] == wanted.simpleString():
                columns.append(F.col(field.name).alias(field.name))
            elif self.zone and have[field.name.lower()] == "date" and isinstance(wanted, T.TimestampType):
                columns.append(day_start(F.col(field.name), self.zone).alias(field.name))
            else:
                columns.append(_exact(F.col(field.name), have[field.name.lower()], wanted).alias(field.name))
        return raw.select(*columns)

    def aliased(self, name: str, alias: str, *columns: str) -> DataFrame:
        """The table with its columns renamed ``<alias>_<Column>``, so joins never clash."""
        df = self.table(name)
        chosen = columns or df.columns
        return df.select(*[F.col(c).alias(f"{alias}_{c}") for c in chosen])


def _exact(column: Column, have: str, wanted: T.DataType) -> Column:
    """A cast to the declared type that fails where it would drop digits of a number.

    A double or float is the decimal it is written as: its cast back must give it again, but for the
    last bits, in which sums and products of such numbers differ anyway.
    """
    narrowed = column.cast(wanted)
    if not isinstance(wanted, T.DecimalType):
        return narrowed
    if have in ("double", "float"):
        if have == "float":
            column = column.cast("string").cast("double")
        fits = F.abs(column.try_cast(wanted).cast("double") - column) <= F.abs(column) * 2.0**-50
    elif have.startswith("decimal"):
        precision, scale = map(int, have[len("decimal(") : -1].split(","))
        if scale <= wanted.scale and precision - scale <= wanted.precision - wanted.scale:
            return narrowed
        fits = column == column.try_cast(wanted)
    else:
        return narrowed
    fits = F.coalesce(fits, F.lit(False)) | column.isNull()
    return F.when(fits, column.try_cast(wanted)).otherwise(F.raise_error(F.concat(F.lit(f"not a {wanted.simpleString()}: "), column.cast("string"))).cast(wanted))
