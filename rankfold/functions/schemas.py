"""Schema checks: what a stage accepts and what it declares to return."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Types whose keys may be compared with each other after a cast.
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)
# Types whose every value is a double.
_DOUBLES = _FRACTIONAL + (T.ByteType, T.ShortType, T.IntegerType)

# Types that Spark's sort accepts at the top level of a key.
_ORDERED = _INTEGRAL + _FRACTIONAL + (
    T.BinaryType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.DecimalType,
    T.DayTimeIntervalType,
    T.YearMonthIntervalType,
    T.TimeType,
)

# Decimal digits of the largest value, by integral type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def is_collated(data_type: T.DataType) -> bool:
    """Whether this is text with an order, and an equality, of its own."""
    return isinstance(data_type, T.StringType) and data_type != T.StringType()


def is_orderable(data_type: T.DataType, part: bool = False) -> bool:
    """Whether values of this type have one order: Spark's, for text that of its collation.

    Collated text inside of arrays and structs is not taken.
    """
    if isinstance(data_type, T.StringType):
        return not (part and is_collated(data_type))
    if isinstance(data_type, T.ArrayType):
        return is_orderable(data_type.elementType, part=True)
    if isinstance(data_type, T.StructType):
        return all(is_orderable(f.dataType, part=True) for f in data_type.fields)
    return isinstance(data_type, _ORDERED)


def common_key_type(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """The type in which two keys are compared, or None if they are not comparable."""
    if left == right:
        return left
    # An empty mapping that names no type.
    if isinstance(right, T.NullType):
        return left
    # Whether parts may be null is no difference between values.
    if _nullable(left) == _nullable(right):
        return _nullable(left)
    # Every cast keeps distinct keys distinct; a bigint as a double may not.
    if isinstance(left, _INTEGRAL) and isinstance(right, _INTEGRAL):
        return T.LongType()
    if isinstance(left, _DOUBLES) and isinstance(right, _DOUBLES):
        return T.DoubleType()
    digits = [_decimal(data_type) for data_type in (left, right)]
    if None in digits:
        return None
    whole = max(precision - scale for precision, scale in digits)
    scale = max(scale for _, scale in digits)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def _nullable(data_type: T.DataType) -> T.DataType:
    """The type with nulls allowed in every part."""
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_nullable(data_type.elementType), True)
    if isinstance(data_type, T.StructType):
        fields = data_type.fields
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in fields])
    return data_type


def _decimal(data_type: T.DataType) -> tuple[int, int] | None:
    """Precision and scale of the decimal that holds every value of the type."""
    if isinstance(data_type, T.DecimalType):
        return data_type.precision, data_type.scale
    digits = _DIGITS.get(type(data_type))
    return None if digits is None else (digits, 0)


def input_field(schema: T.StructType, name: str) -> T.StructField:
    """The top-level field with exactly this name."""
    for field in schema.fields:
        if field.name == name:
            return field
    raise ValueError(f"input column {name!r} is not one of {schema.names}")


def _same_name(spark: SparkSession | None, left: str, right: str) -> bool:
    spark = spark or SparkSession.getActiveSession()
    exact = spark is not None and spark.conf.get("spark.sql.caseSensitive") == "true"
    return left == right if exact else left.lower() == right.lower()


def with_field(
    schema: T.StructType, field: T.StructField, spark: SparkSession | None = None
) -> T.StructType:
    """``schema`` after ``withColumn``: replaced where the name matches, else appended."""
    fields = [field if _same_name(spark, f.name, field.name) else f for f in schema.fields]
    if all(f is not field for f in fields):
        fields.append(field)
    return T.StructType(fields)


def without_field(
    schema: T.StructType, name: str, spark: SparkSession | None = None
) -> T.StructType:
    """``schema`` after ``drop``: every field with a matching name is gone."""
    return T.StructType([f for f in schema.fields if not _same_name(spark, f.name, name)])


def chained_schema(stages: Iterable, schema: T.StructType) -> T.StructType:
    """The declared schema after all ``stages``, each checked against the one before."""
    for stage in stages:
        schema = stage.output_schema(schema)
    return schema
