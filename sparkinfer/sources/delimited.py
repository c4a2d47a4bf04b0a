"""Typed, header-aware reading of delimited text (plain or gzip).

Columns are matched by header name, in any order; expected columns that are absent
are reported and skipped, other columns are ignored. Everything is read as text and
cast, so that missing-value marks become NULL while any other unreadable value is an
error (``strict``) or is set aside with its row (``quarantine``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

# The sales file's columns, types, separator and quote.
SALES_SCHEMA = StructType([
    StructField("FECHA", TimestampType()),
    StructField("CANAL", StringType()),
    StructField("SKU", LongType()),
    StructField("PRODUCTO", StringType()),
    StructField("UNIDADES", IntegerType()),
    StructField("PORCENTAJE DESCUENTO", DoubleType()),
    StructField("MONTO APLICADO", DoubleType()),
    StructField("BOLETA", LongType()),
    StructField("LOCAL", IntegerType()),
    StructField("CODIGO CLIENTE", StringType()),
    StructField("RUN CLIENTE", StringType()),
    StructField("NOMBRES", StringType()),
    StructField("APELLIDOS", StringType()),
    StructField("FECHA NACIMIENTO", StringType()),
    StructField("GENERO", ByteType()),
])
ANALYTIC_COLUMNS = ("FECHA", "CANAL", "UNIDADES", "PORCENTAJE DESCUENTO", "MONTO APLICADO",
                    "LOCAL", "CODIGO CLIENTE", "FECHA NACIMIENTO", "GENERO")
SEPARATOR, QUOTE = ";", '"'
# Text that means "missing" in a delimited file.
MISSING_MARKS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                 "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

#: Column in which the reader leaves rows with a wrong number of fields, and the name they get.
CORRUPT, MALFORMED = "_malformed_row", "malformed row"


class DataReadError(RuntimeError):
    """A data file is absent, unreadable or holds values of the wrong type."""


@dataclass
class Scan:
    """A typed scan, the expected columns it lacks, and (quarantine mode) its bad rows."""

    data: DataFrame
    missing: tuple[str, ...]
    rejected: DataFrame | None = None


def header(spark: SparkSession, path: str, separator: str = SEPARATOR, quote: str = QUOTE) -> list[str]:
    """Column names in the file's own order."""
    try:
        return (spark.read.option("header", True).option("sep", separator).option("quote", quote)
                .option("escape", quote).csv(path).columns)
    except PySparkException as error:
        raise DataReadError(f"cannot read {path!r}: {error}") from error


def _typed(raw: Column, kind) -> Column:
    text = F.when(~raw.isin(*MISSING_MARKS), raw)
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, (ByteType, IntegerType, LongType)):
        # nullable integers are often written as 3.0: accepted when there is no fraction
        wide = F.coalesce(text.try_cast("long"),
                          F.when(text.try_cast("double") == F.floor(text.try_cast("double")),
                                 text.try_cast("double").try_cast("long")))
        return wide.try_cast(kind)
    return text.try_cast(kind)


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
         schema: StructType = SALES_SCHEMA, mode: str = "strict",
         separator: str = SEPARATOR, quote: str = QUOTE) -> Scan:
    """Read ``columns`` (default: all of ``schema``) with their declared types.

    ``strict`` fails the job on a value that does not fit its type; ``quarantine``
    returns those rows, as text with the names of the bad columns, in ``rejected``;
    ``coerce`` turns such values into NULL. A plain file is split into blocks of
    spark.sql.files.maxPartitionBytes; a gzip file is one task, see ``landing``.

    Rows with too few or too many fields do not fit either: they fail ``strict`` and are
    set aside by ``quarantine`` under the name MALFORMED. A line break ends a row, inside
    quotes too, so such rows are malformed. All files of a directory must have the same
    header; one in another order is an error, not read by position.
    """
    if mode not in ("strict", "quarantine", "coerce"):
        raise ValueError("mode must be 'strict', 'quarantine' or 'coerce'")
    present = header(spark, path, separator, quote)
    wanted = list(columns) if columns is not None else schema.fieldNames()
    kept = [c for c in wanted if c in present]
    text = StructType([StructField(c, StringType()) for c in [*present, CORRUPT]])
    raw = (spark.read.schema(text).option("header", True).option("enforceSchema", False).option("sep", separator)
           .option("quote", quote).option("escape", quote).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    missing = tuple(c for c in wanted if c not in present)
    data, rejected = parse(raw.select(*[F.col(f"`{c}`") for c in kept], CORRUPT), kept, schema, mode)
    return Scan(data, missing, rejected)


def parse(raw: DataFrame, columns: Sequence[str], schema: StructType = SALES_SCHEMA,
          mode: str = "strict") -> tuple[DataFrame, DataFrame | None]:
    """Typed rows from text columns and a column CORRUPT (null where a row is whole), and the rejected ones.

    This is what :func:`scan` does with the text of a file; ``mode`` is as there.
    """
    kept = list(columns)
    whole = F.col(CORRUPT).isNull()
    kinds = {f.name: f.dataType for f in schema.fields}
    values = {c: _typed(F.col(f"`{c}`"), kinds.get(c, StringType())) for c in kept}
    checks = {c: F.col(f"`{c}`").isNotNull() & ~F.col(f"`{c}`").isin(*MISSING_MARKS) & values[c].isNull()
              for c in kept if not isinstance(kinds.get(c, StringType()), StringType)}
    if mode == "strict":
        wrong = F.raise_error(F.concat(F.lit("malformed row: "), F.col(CORRUPT))).cast("boolean")
        sound = raw.where(F.when(whole, F.lit(True)).otherwise(wrong))
        return sound.select(*[
            (F.when(checks[c], F.raise_error(F.concat(F.lit(f"bad value in column {c}: "), F.col(f"`{c}`"))))
             .otherwise(values[c]) if c in checks else values[c]).alias(c) for c in kept]), None
    if mode == "coerce":
        return raw.select(*[values[c].alias(c) for c in kept]), None
    checks = {**checks, MALFORMED: ~whole}
    bad = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in checks.values()])
    named = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))
    rejected = raw.where(bad).withColumn("bad_columns", named).drop(CORRUPT)
    return raw.where(~bad).select(*[values[c].alias(c) for c in kept]), rejected


def run_or_raise(action, what: str = "the data"):
    """Run an action and turn a failed read into :class:`DataReadError`."""
    try:
        return action()
    except (PySparkException, Py4JJavaError) as error:
        raise DataReadError(f"reading {what} failed: {error}") from error
