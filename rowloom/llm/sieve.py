"""A bit table of bounded size that keeps most rows out of an exchange.

It answers "surely not" or "perhaps" for 64-bit values. Its size is bounded: with more values than it is
made for it lets more rows pass, and the join behind it, which decides, has more to do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 20, 30  # of the table's size as a power of two; 128 MB at most
_SEGMENT = 15  # bits of Spark's bitmap aggregate: 4096 bytes


def bit_table(values: DataFrame, column: str):
    """The table as a broadcast, with 16 bits or more a value up to the largest size, built by Spark in pieces of 4 KB.

    ``values`` are counted and then read: give a written table.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * values.count()).bit_length()))
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    pieces = values.select(F.shiftright(place, _SEGMENT).alias("s"), place.bitwiseAND(F.lit((1 << _SEGMENT) - 1)).alias("p"))
    table = np.zeros(1 << (bits - 3), np.uint8)
    for row in pieces.groupBy("s").agg(F.bitmap_construct_agg("p").alias("bits")).toLocalIterator():
        at = row.s << (_SEGMENT - 3)
        table[at : at + (1 << (_SEGMENT - 3))] = np.frombuffer(row.bits, np.uint8)
    return values.sparkSession.sparkContext.broadcast(table)


def look_up(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = values.astype(np.int64) & (8 * len(table) - 1)
    return (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def perhaps(shared, value: Column) -> Column:
    def run(values: pa.Array) -> pa.Array:
        return pa.array(look_up(shared.value, values.to_numpy(zero_copy_only=False)))

    return F.arrow_udf(run, "boolean")(value)
