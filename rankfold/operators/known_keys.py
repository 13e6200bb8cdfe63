"""Rows whose value a mapping does not know, told apart before any shuffle.

A bitmap of the hashes of a mapping's keys, sixteen bits a key, is dealt into rows of 4 KiB and
broadcast. A value whose bit is not set has no entry; of those without an entry about one in
sixteen has its bit set, and finds out by the join. The size follows from the counted number of
labels, so it is known before anything is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfold.functions.labels import steady_hash
from rankfold.functions.names import fresh
from rankfold.operators.mapping import Mapping

_BITS_A_KEY = 16
# Fixed: the bits of one bitmap of Spark's aggregate.
_BITS_A_ROW = 1 << 15


def bitmap_bits(labels: int) -> int:
    """The bits for so many labels, in whole rows."""
    return max(1, -(-labels * _BITS_A_KEY // _BITS_A_ROW)) * _BITS_A_ROW


def may_be_known(dataset: DataFrame, key: Column, key_type: T.DataType, mapping: Mapping, mark: str) -> DataFrame:
    """``dataset`` with a column ``mark``: false where ``key`` is null or surely has no entry."""
    bits = bitmap_bits(mapping.labels)
    slot_of = lambda c: F.pmod(steady_hash(c, key_type), F.lit(bits))
    row, bitmap, slot = fresh("row"), fresh("bitmap"), fresh("slot")
    entries = mapping.frame(dataset.sparkSession)
    bitmaps = (
        entries.select(slot_of(F.col("category").cast(key_type)).alias(slot))
        .groupBy(F.shiftright(slot, 15).alias(row))
        .agg(F.bitmap_construct_agg(F.col(slot).bitwiseAND(_BITS_A_ROW - 1)).alias(bitmap))
    )
    own = slot_of(key)
    place = own.bitwiseAND(_BITS_A_ROW - 1).cast("int")
    byte = F.substring(F.col(bitmap), F.shiftright(place, 3) + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.getbit(value, place.bitwiseAND(7)) == 1
    return (
        dataset.join(F.broadcast(bitmaps), F.shiftright(own, 15) == F.col(row), "left")
        .withColumn(mark, F.coalesce(key.isNotNull() & is_set, F.lit(False)))
        .drop(row, bitmap)
    )
