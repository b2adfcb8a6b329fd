"""Rows with one of many keys told from all others, without moving the others and without a list of the keys.

The keys set bits of a bitmap at their hashes' places; its pages are broadcast and every row looks at its own bit. A row
with one of the keys is always marked, another only by chance (less than one in sixty-four while the bitmap may grow
with the keys, more often beyond), so whoever reads the marked rows joins them with the keys. A bitmap has at most
``MOST_BITS``, 32 MB, whatever the number of keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a page, as bitmap_construct_agg makes them; bits for each key, at least; bits in all, at most.
PAGE = 1 << 15
BITS_A_KEY = 64
MOST_BITS = 1 << 28


def marked(rows: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the boolean ``name``: true wherever column ``key`` is one of those in ``keys``, seldom elsewhere.

    ``keys`` is read twice; it should be written."""
    bits = min(MOST_BITS, max(PAGE, 1 << (BITS_A_KEY * keys.count()).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    parts = min(-(-bits // PAGE), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # A page is put together in one task: pages are dense, and a share of one is as large as the whole.
    set_bits = keys.select(F.shiftright(place, 15).alias("__page"), place.bitwiseAND(F.lit(PAGE - 1)).alias("__bit")).distinct().repartition(parts, "__page")
    pages = set_bits.groupBy("__page").agg(F.bitmap_construct_agg("__bit").alias("__bits"))
    placed = rows.withColumn("__place", place)
    placed = placed.withColumn("__page", F.shiftright("__place", 15)).withColumn("__bit", F.col("__place").bitwiseAND(F.lit(PAGE - 1)).cast("int")).drop("__place")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.shiftright("__bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    own = F.coalesce(F.getbit(byte, F.col("__bit") % 8) == 1, F.lit(False))
    return placed.join(F.broadcast(pages), "__page", "left").withColumn(name, own).drop("__page", "__bit", "__bits")
