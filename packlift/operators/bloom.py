"""A Bloom filter as a column: rows of a large table that cannot join are
dropped where they are read, before the table is shuffled.

The filter is one array of 64-bit words, built by an aggregate over the keys
with map-side combining and used as a scalar subquery, so it is found when the
query runs. Its size is a parameter and does not grow with the keys: with more
keys than about a tenth of its bits it lets more rows through, never fewer. It
is a filter before an exact join, so results do not depend on it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 22      # half a megabyte
HASHES = 3


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits)) for seed in range(HASHES)]


def bloom_words(keys: DataFrame, key: str, bits: int = BITS) -> Column:
    """The filter of the values of ``key`` as a scalar subquery: bits / 64 words.

    NULL is hashed like any value; a filter on it would sink into ``keys`` and
    make it another plan than the one the caller may be running besides.
    """
    one = F.lit(1).cast("bigint")
    bit = F.col("place").bitwiseAND(F.lit(63)).cast("int")
    words = (keys
             .select(F.explode(F.array(*_places(F.col(key), bits))).alias("place"))
             .groupBy(F.shiftright("place", 6).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", one, bit)).alias("mask")))
    every = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "word")
    # bits / 64 rows in all, whatever the number of keys.
    rows = every.join(words, "word", "left").select(F.struct("word", F.coalesce("mask", F.lit(0)).alias("mask")).alias("w"))
    return rows.agg(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["mask"])).scalar()


def among(df: DataFrame, column: str, keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be a value of ``key`` in ``keys`` (those left out surely are not)."""
    # Named once, so that the subquery is planned once for all hashes.
    words = "_bloom_words"
    held = [F.getbit(F.get(F.col(words), F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1
            for place in _places(F.col(column), bits)]
    return (df.withColumn(words, bloom_words(keys, key, bits)).where(reduce(lambda a, b: a & b, held))
            .drop(words))
