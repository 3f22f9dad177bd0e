"""Raw trip files: scan (A1) and schema following across files (A3)."""

from __future__ import annotations

import contextlib
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S


class MissingColumnsError(ValueError):
    """A raw trip frame lacks columns the pipeline needs."""


def _resolve(df: DataFrame, name: str) -> str | None:
    """Find ``name`` among the columns case-insensitively (``vendorid`` == ``VendorID``)."""
    lowered = name.lower()
    for c in df.columns:
        if c.lower() == lowered:
            return c
    return None


# Conflicting footers reach Python as one or the other, depending on the Spark error class.
READ_ERRORS = (PySparkException, Py4JJavaError)
_EPOCH_NTZ = "1970-01-01 00:00:00"
NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def _at_micros(micros: Column) -> Column:
    """Microseconds since the epoch → ``timestamp_ntz`` in UTC, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", micros, F.lit(_EPOCH_NTZ).cast(T.TimestampNTZType()))


def conform_trips(df: DataFrame, epoch_nanos: bool = False) -> DataFrame:
    """Check the nine raw columns, give them their canonical names and zone-free times.

    Names are matched case-insensitively.  Numeric columns keep the type they were read
    with: the quality gate and the duplicate check judge the values as they are, and
    ``settle_types`` casts what is left.  String timestamps stay strings (parsing belongs
    to the cleaning step, so a bad string passes the gate and is dropped later, as in the
    original job).  A ``timestamp`` (with local time zone) becomes its UTC wall clock; with
    ``epoch_nanos`` a BIGINT timestamp column holds epoch nanoseconds (parquet
    ``TIMESTAMP(NANOS)`` read as long).  Every other column passes through unchanged.
    """
    found = {name: _resolve(df, name) for name in S.RAW_COLUMNS}
    missing = [n for n, c in found.items() if c is None]
    if missing:
        raise MissingColumnsError(f"raw trips lack columns: {missing}")
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for name in S.RAW_COLUMNS:
        src = found[name]
        col = F.col(f"`{src}`")
        if name in S.TIMESTAMP_COLUMNS:
            if isinstance(types[src], T.TimestampType):
                col = _at_micros(F.unix_micros(col))
            elif epoch_nanos and isinstance(types[src], T.LongType):
                col = _at_micros(F.expr(f"`{src}` div 1000"))
            elif not isinstance(types[src], (T.StringType, T.TimestampNTZType)):
                col = col.cast(T.TimestampNTZType())
        exprs[name] = col
    # withColumns replaces a column whose name matches case-insensitively, in place and
    # under the canonical spelling.
    return df.withColumns(exprs)


def settle_types(df: DataFrame, on_fraction: str = "fail") -> DataFrame:
    """Cast the numeric raw columns to their declared types, after gate and dedup.

    A value that a cast cannot represent becomes NULL.  A fraction in a whole-number column
    (9.5 passengers) fails the query with the column's name, or with
    ``on_fraction="null"`` becomes NULL; it is never cut off silently.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for name, target in S.RAW_TYPES.items():
        if name in S.TIMESTAMP_COLUMNS or types[name] == target:
            continue
        col = F.col(name)
        cast = col.try_cast(target)
        if isinstance(target, T.IntegralType) and not isinstance(types[name], T.IntegralType):
            number = col.try_cast(T.DoubleType())
            if on_fraction == "fail":
                bad = F.raise_error(F.concat(F.lit(f"{name} has a fraction: "), col.cast("string"))).cast(target)
            else:
                bad = F.lit(None).cast(target)
            cast = F.when(number != F.floor(number), bad).otherwise(number.try_cast(target))
        exprs[name] = cast
    return df.withColumns(exprs) if exprs else df


# ---------------------------------------------------------------------------
# Files of several schemas
# ---------------------------------------------------------------------------
@contextlib.contextmanager
def _nanos_as_long(spark: SparkSession):
    """Read nanosecond timestamps as BIGINT while a reader is built; the session's setting
    is put back."""
    before = spark.conf.get(NANOS_AS_LONG, "false")
    spark.conf.set(NANOS_AS_LONG, "true")
    try:
        yield
    finally:
        spark.conf.set(NANOS_AS_LONG, before)


def _reader(spark: SparkSession, base: str | None):
    reader = spark.read.option("mergeSchema", "true")
    return reader.option("basePath", base) if base else reader


def _stretches(spark: SparkSession, files: list[str], base: str | None) -> list[tuple[list[str], bool, T.StructType]]:
    """(files, whether their timestamps are epoch nanoseconds, schema) of each stretch of
    ``files`` (in name order) whose schemas merge.

    Footers are merged by Spark's own distributed job.  Only when they conflict is the list
    halved and each half tried again, so the number of tries follows the number of schema
    changes, not of files.  ``basePath`` keeps the columns of hive-style folders.
    """
    for nanos in (False, True):
        try:
            with _nanos_as_long(spark) if nanos else contextlib.nullcontext():
                return [(files, nanos, _reader(spark, base).parquet(*files).schema)]
        except READ_ERRORS as err:
            message = str(err)
            if "TIMESTAMP(NANOS" in message and not nanos:
                continue
            if "CANNOT_MERGE" not in message or len(files) == 1:
                raise
            break
    half = len(files) // 2
    return _stretches(spark, files[:half], base) + _stretches(spark, files[half:], base)


def _merged(spark: SparkSession, files: list[str], base: str | None) -> list[DataFrame]:
    """``files`` as one frame for each schema: stretches of equal schema are one read, so the
    plan has as many branches as there are schemas, however they alternate by name."""
    by_schema: dict[tuple[str, bool], tuple[T.StructType, list[str]]] = {}
    for own, nanos, schema in _stretches(spark, files, base):
        by_schema.setdefault((schema.json(), nanos), (schema, []))[1].extend(own)
    # The types are known now, so the scan needs no setting and no footer job.
    return [conform_trips(_reader(spark, base).schema(schema).parquet(*own), epoch_nanos=nanos)
            for (_, nanos), (schema, own) in by_schema.items()]


_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_REAL = (T.FloatType(), T.DoubleType())


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds every value of both: whole numbers the longer one, with floating
    numbers DOUBLE, a NULL-only column the other; anything else (text and time, say) STRING."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if a in (*_WHOLE, *_REAL) and b in (*_WHOLE, *_REAL):
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(min(38, whole + scale), scale)
    return T.StringType()


def wider_schema(schemas: list[T.StructType]) -> T.StructType:
    """Every column of ``schemas``, matched case-insensitively, in order of appearance, each
    in its wider type, nullable."""
    found: dict[str, T.StructField] = {}
    for field in (f for s in schemas for f in s.fields):
        known = found.setdefault(field.name.lower(), T.StructField(field.name, field.dataType))
        known.dataType = wider(known.dataType, field.dataType)
    return T.StructType(list(found.values()))


def with_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: cast where the type differs (text that
    is no number becomes NULL), NULL where ``df`` has none."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField) -> Column:
        own = _resolve(df, field.name)
        if own is None:
            return F.lit(None).cast(field.dataType)
        source = F.col(f"`{own}`")
        return source.try_cast(field.dataType) if isinstance(types[own], T.StringType) else source.cast(field.dataType)

    return df.select(*[column(f).alias(f.name) for f in schema.fields])


def union_conformed(parts: list[DataFrame]) -> DataFrame:
    """Union by name: a column that a part lacks reads as NULL, and a column of several types
    takes their wider type (BIGINT and DOUBLE: DOUBLE; text and time: text, which the
    cleaning step parses tolerantly after the gate; a raw number that is text in some parts:
    DOUBLE, and NULL, which fails the gate, where the text is no number)."""
    if len(parts) == 1:
        return parts[0]
    schema = wider_schema([p.schema for p in parts])
    for field in schema.fields:
        if field.name in S.RAW_TYPES and field.name not in S.TIMESTAMP_COLUMNS and isinstance(field.dataType, T.StringType):
            field.dataType = T.DoubleType()
    return reduce(DataFrame.union, [with_schema(p, schema) for p in parts])


def read_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """A1/A3: read every raw trip parquet file under ``paths`` as one frame.

    Schemas are merged across files: a column that a file lacks reads as NULL, columns added
    by newer files appear.  When files disagree on a type, the files of each schema are read
    on their own and the parts are unioned, types widened.  Nanosecond parquet timestamps,
    which Spark does not read, are read as epoch nanoseconds and become ``timestamp_ntz``
    microseconds.  No session setting is left changed.
    """
    parts = []
    for path in paths:
        try:
            parts.append(conform_trips(_reader(spark, None).parquet(path)))
        except READ_ERRORS as err:
            if not any(x in str(err) for x in ("CANNOT_MERGE", "TIMESTAMP(NANOS")):
                raise
            with _nanos_as_long(spark):
                files = sorted(spark.read.parquet(path).inputFiles())
            parts += _merged(spark, files, path)
    return union_conformed(parts)


def read_files(spark: SparkSession, files: list[str], base: str) -> DataFrame:
    """The given parquet files, all under ``base``, as one frame (as ``read_trips``)."""
    return union_conformed(_merged(spark, sorted(files), base))


def files_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of all parquet files under ``path``, each in its wider type; None if there
    is no file."""
    try:
        return _reader(spark, None).parquet(path).schema
    except READ_ERRORS as err:
        message = str(err)
        if any(x in message for x in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            return None
        if not any(x in message for x in ("CANNOT_MERGE", "TIMESTAMP(NANOS")):
            raise
    with _nanos_as_long(spark):
        files = sorted(spark.read.parquet(path).inputFiles())
    return wider_schema([schema for _, _, schema in _stretches(spark, files, path)])


def raw_trip_schema() -> T.StructType:
    """The declared schema of the nine raw columns (for streaming readers and fixtures)."""
    return T.StructType([T.StructField(n, t) for n, t in S.RAW_TYPES.items()])
