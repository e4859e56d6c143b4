"""CSV ingest of the trip table and the zone lookup.

The source files carry a header and every field as text.  The header is read
and columns are bound **by name**: their order is free, further columns are
ignored, a missing one is an error.  Values are typed once with ``try_cast``, so
a bad one becomes NULL instead of failing the job under ANSI mode.  Rejected
are text that is no number, NaN and infinities, and money with more than two
decimals or too large for its type (nothing is rounded on the way in).
:func:`reject_counts` reports them per column, and the lines whose number of
fields differs from the header's; such a line stays a row, with NULL for what
it lacks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast.schema import TRIP_FIELDS, ZONE_FIELDS

CORRUPT = "_corrupt_record"


def read_text_table(spark: SparkSession, path: str, fields, whole_lines: bool = False) -> DataFrame:
    """Header CSV with every column read as text, and CORRUPT: the whole line
    where its number of fields is wrong, which takes ``whole_lines`` (no fields
    pruned while parsing) to be seen in every line.  All files must share one header
    (``enforceSchema=false`` fails on a file that does not)."""
    header = spark.read.option("header", "true").csv(path).columns
    missing = [n for n, _ in fields if n not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(header)}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*header, CORRUPT]])
    return (spark.read.options(header="true", enforceSchema="false", mode="PERMISSIVE",
                               columnNameOfCorruptRecord=CORRUPT,
                               columnPruning=str(not whole_lines).lower())
            .schema(schema).csv(path))


def _given(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def _typed(c: Column, dtype: T.DataType) -> Column:
    """The value as ``dtype``, NULL where it is not exactly one."""
    text = F.trim(c)
    value = text.try_cast(dtype)
    if isinstance(dtype, T.DecimalType):
        return F.when(value == text.try_cast(T.DecimalType(38, 18)), value)
    if isinstance(dtype, T.DoubleType):
        return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    return value


def type_columns(raw: DataFrame, fields) -> DataFrame:
    """Typed projection: every text column to its target type (None: as it is).
    Surrounding blanks are trimmed first; empty text becomes NULL."""
    return raw.select(*[F.col(n) if t is None or isinstance(t, T.StringType) else _typed(F.col(n), t).alias(n)
                        for n, t in fields])


def faults(fields) -> dict[str, Column]:
    """What a line can be rejected for: a column whose text does not type, or
    ``*malformed*``, a wrong number of fields."""
    bad = {n: _given(F.col(n)) & _typed(F.col(n), t).isNull() for n, t in fields if not isinstance(t, T.StringType)}
    bad["*malformed*"] = F.col(CORRUPT).isNotNull()
    return bad


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """Trip CSV -> typed trip table (see ``tripcast.schema.TRIP_FIELDS``)."""
    return type_columns(read_text_table(spark, path, TRIP_FIELDS), TRIP_FIELDS)


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV -> (LocationID int, Borough, Zone, service_zone).

    Names such as 'NA', 'N/A', 'NV' are ordinary text: no ``nullValue``
    option is set, only an empty field is NULL.
    """
    return type_columns(read_text_table(spark, path, ZONE_FIELDS), ZONE_FIELDS)


def reject_counts(spark: SparkSession, path: str, fields=TRIP_FIELDS) -> DataFrame:
    """Per typed column: how many non-empty values failed to type; a row
    ``*malformed*`` counting lines with too few or too many fields, and a row
    ``*any*`` counting lines with at least one of these faults.

    One pass over the file; counts are partial aggregates, so the cost is a
    scan plus a one-row shuffle.
    """
    raw = read_text_table(spark, path, fields, whole_lines=True)
    bad = faults(fields)
    any_bad = F.lit(False)
    for c in bad.values():
        any_bad = any_bad | c
    bad["*any*"] = any_bad
    wide = raw.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(bad.values())])
    stack = ", ".join(f"'{n}', c{i}" for i, n in enumerate(bad))
    return wide.selectExpr(f"stack({len(bad)}, {stack}) as (column, rejected)")
