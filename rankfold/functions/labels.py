"""Expressions over label columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfold.functions.schemas import is_collated

# Types whose Python values become Spark literals without any loss.
_EXACT_LITERALS = (
    T.StringType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.BooleanType,
)


def has_exact_literals(data_type: T.DataType) -> bool:
    return isinstance(data_type, _EXACT_LITERALS) and not is_collated(data_type)


def stored_bytes(column: Column, data_type: T.DataType) -> Column:
    """Bytes a value takes in a row, never too few; for size checks."""
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + 8
    if isinstance(data_type, T.StructType):
        # A word for each field and for the nulls of each 64, and what lies behind them.
        size = F.lit(8 * (len(data_type.fields) + 2 + len(data_type.fields) // 64)).cast("long")
        for field in data_type.fields:
            if not _is_fixed(field.dataType):
                size = size + stored_bytes(column.getField(field.name), field.dataType)
        return F.coalesce(size, F.lit(0).cast("long"))
    if isinstance(data_type, T.ArrayType):
        count = F.coalesce(F.size(column), F.lit(0)).cast("long")
        if _is_fixed(data_type.elementType):
            return F.lit(24).cast("long") + count * 17
        inner = F.aggregate(
            column,
            F.lit(24).cast("long"),
            lambda total, item: total + 17 + stored_bytes(item, data_type.elementType),
        )
        return F.coalesce(inner, F.lit(24).cast("long"))
    return F.lit(16).cast("long")


def _is_fixed(data_type: T.DataType) -> bool:
    """Whether a value fits the word a row has for it; decimals take two words more."""
    return not isinstance(
        data_type, (T.StringType, T.BinaryType, T.StructType, T.ArrayType, T.DecimalType)
    )


def steady_hash(column: Column, data_type: T.DataType) -> Column:
    """A hash that does not depend on which of several number types holds a value.

    Equal texts of a collation have different hashes: not for collated text.
    """
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType)):
        column = column.cast("long")
    elif isinstance(data_type, T.FloatType):
        column = column.cast("double")
    return F.xxhash64(column)


def literal_lookup(
    key: Column, pairs: list[tuple], key_type: T.DataType, index_type: T.DataType
) -> Column:
    """Look ``key`` up in a map literal; Spark scans it entry by entry, so keep it tiny."""
    if not pairs:
        return F.lit(None).cast(index_type)
    entries = [
        part
        for value, index in pairs
        for part in (F.lit(value).cast(key_type), F.lit(index).cast(index_type))
    ]
    return F.create_map(*entries)[key.cast(key_type)]
