"""J12 beyond broadcasts: a Bloom filter of a large, filtered dimension, applied in the fact scan.

Pruning by folders needs a fact table partitioned by the join key, and a broadcast a
dimension that fits. Otherwise both sides are shuffled, though most fact rows meet no
row of the filtered dimension. ``bloom_filter`` sets ``hashes`` bits per dimension key
in a field of ``bits`` bits: each key's words are combined in the map tasks
(``bit_or``), at most ``bits / 64`` of them are left, and they come back as one scalar
value, an array of longs. ``might_contain`` tests the bits in generated code before
the shuffle. Its size is the parameter ``bits`` and doesn't grow with the data: more
keys than about ``bits / 10`` only let more rows through. The join itself decides, so
false positives cost rows, never results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23  # 1 MB: one false positive in a hundred at 800,000 keys
HASHES = 5


def _positions(key: Column, bits: int, hashes: int) -> list[Column]:
    """Bits of a key, by double hashing."""
    first, step = F.pmod(F.xxhash64(key), F.lit(bits)), F.pmod(F.xxhash64(key, F.lit(1)), F.lit(bits))
    return [F.pmod(first + step * F.lit(k), F.lit(bits)) for k in range(hashes)]


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(position, F.lit(64)).cast("int"))


def bloom_filter(rows: DataFrame, key: str, bits: int = BITS, hashes: int = HASHES) -> Column:
    """The filter of the keys of ``rows`` as a scalar: ``bits / 64`` longs."""
    if bits < 64 or bits & (bits - 1):
        raise ValueError("bits must be a power of two, 64 or more")
    position = F.explode(F.array(*_positions(F.col(key), bits, hashes))).alias("p")
    set_bits = rows.filter(F.col(key).isNotNull()).select(position).groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(_bit(F.col("p"))).alias("set"))
    words = rows.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(set_bits, "word", "left")
    ordered = F.array_sort(F.collect_list(F.struct("word", F.coalesce("set", F.lit(0).cast("long")).alias("set"))))
    return words.agg(ordered["set"].alias("words")).scalar()


def might_contain(words: Column, key: Column, bits: int = BITS, hashes: int = HASHES) -> Column:
    """False only for keys that are not in the filter."""
    met = key.isNotNull()
    for p in _positions(key, bits, hashes):
        met = met & (F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0)
    return met


def bloom_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """``fact`` joined with ``dim`` (inner), fact rows tested before they are shuffled.
    Give ``dim`` with its filters; both keys must have the same type."""
    if fact.schema[fact_key].dataType != dim.schema[dim_key].dataType:
        raise ValueError("the keys' types differ, so would their hashes")
    passed = fact.filter(might_contain(bloom_filter(dim, dim_key, bits, hashes), F.col(fact_key), bits, hashes))
    return passed.join(dim, F.col(fact_key) == F.col(dim_key))
