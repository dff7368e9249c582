"""Joins (J1-J15).

Strategy is Catalyst's and AQE's to choose from statistics; operators only add
a hint where the caller asks for one:

* No operator runs a job to find out a size. A side is broadcast when Spark's
  statistics (file sizes, or the measured size of a finished stage under AQE)
  put it below the session's threshold, and shuffled otherwise.
* ``salted_join`` splits a hot key of the many side where AQE cannot.
* ``merge_join`` forces sort-merge by hint, not by a global setting.
* Join counts (J8) are computed from per-key counts of both sides, so a hot
  key costs ``n_left * n_right`` arithmetic, never that many output rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column, how: str = "inner") -> DataFrame:
    """Equi-join on a shared key name (merged) or on a condition."""
    return left.join(right, on=on, how=how)


def broadcast_join(big: DataFrame, small: DataFrame, on: str | Sequence[str] | Column, how: str = "inner") -> DataFrame:
    """A join with a small side. It is planned as a broadcast hash join while
    the statistics of ``small`` are below ``spark.sql.autoBroadcastJoinThreshold``;
    a small side that has grown is shuffled like any other."""
    return big.join(small, on=on, how=how)


def merge_join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column, how: str = "inner") -> DataFrame:
    """Sort-merge join requested by hint (both sides shuffled and sorted on the key)."""
    return left.hint("merge").join(right, on=on, how=how)


def one_value_per_key(dim: DataFrame, key: str, value: str) -> DataFrame:
    """A dimension with exactly one value per key (the smallest, if the input
    has several), so joining it can never multiply rows. Combined in the map
    tasks, so a key with many rows is no hot spot."""
    return dim.groupBy(key).agg(F.min(value).alias(value))


def lookup(df: DataFrame, code_col: str, table: DataFrame, key_col: str, value_col: str, out: str) -> DataFrame:
    """``dict.get(code)`` — value for the code, null when missing.

    The lookup table is reduced to one value per key so that the left side
    never multiplies, then joined left-outer.
    """
    dim = one_value_per_key(table.select(F.col(key_col).alias("__lk"), F.col(value_col).alias(out)), "__lk", out)
    return broadcast_join(df, dim, F.col(code_col) == F.col("__lk"), "left").drop("__lk")


def join_row_counts(
    lists: dict[str, DataFrame],
    pairs: Sequence[tuple[str, str, str]],
    key: str = "id",
) -> DataFrame:
    """Number of rows each join would return, one row per (pair, join_type).

    Each list is reduced to (key, n) first (partial aggregation absorbs skew);
    a full outer join of two count tables then yields inner / left / right /
    full counts exactly: matched keys contribute n_l * n_r, unmatched keys
    (null keys included, which never match) contribute their own n.
    """
    counted = {
        name: df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        for name, df in lists.items()
    }
    parts = []
    for left_name, right_name, how in pairs:
        lc = counted[left_name].withColumnRenamed("n", "nl")
        rc = counted[right_name].withColumnRenamed("n", "nr")
        # plain '=': null keys never match, so they fall into the unmatched
        # counts, and the join reuses the aggregates' hash partitioning on k
        both = lc.join(rc, lc["k"] == rc["k"], "full")
        matched = F.col("nl").isNotNull() & F.col("nr").isNotNull()
        contribution = {
            "inner": F.when(matched, F.col("nl") * F.col("nr")),
            "left": F.when(matched, F.col("nl") * F.col("nr")).when(F.col("nl").isNotNull(), F.col("nl")),
            "right": F.when(matched, F.col("nl") * F.col("nr")).when(F.col("nr").isNotNull(), F.col("nr")),
            "full": F.coalesce(F.col("nl") * F.col("nr"), F.col("nl"), F.col("nr")),
        }[_canonical_how(how)]
        parts.append(
            both.agg(F.coalesce(F.sum(contribution), F.lit(0)).cast("long").alias("rows")).select(
                F.lit(f"{left_name}-{right_name}").alias("pair"), F.lit(how).alias("join_type"), "rows"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _canonical_how(how: str) -> str:
    h = how.lower().replace("_", "")
    return {"inner": "inner", "left": "left", "leftouter": "left", "right": "right", "rightouter": "right",
            "full": "full", "outer": "full", "fullouter": "full"}[h]


def ids_to_map(df: DataFrame, ids_col: str, dim: DataFrame, dim_key: str, dim_value: str, out: str, lists_of: DataFrame | None = None) -> DataFrame:
    """array<id> + dimension(id, name) -> map<id, name> per row, in place of the array.

    Null and unknown ids are dropped (the reference raised KeyError); a null or empty
    list gives an empty map. Only the *distinct* lists are looked up: they are told
    apart first (combined in the map tasks, so a list that a third of the rows carry
    is one row per task), exploded, joined with the dimension and put together again,
    a group being one list. The rows then fetch their list's map, whole rows are
    neither exploded nor regrouped, and may repeat. ``lists_of``: rows that hold all
    lists of ``df`` and are cheaper to read, such as the input of a costly ``df``.

    Rows without a list, which may be many, are dealt out by a hash of the row; a list
    that very many rows carry is a partition that Spark can split (AQE skew join)."""
    lists = (df if lists_of is None else lists_of).filter(F.size(ids_col) > 0).select(F.col(ids_col).alias("__ids")).distinct()
    d = one_value_per_key(dim.select(F.col(dim_key).alias("__id"), F.col(dim_value).alias("__name")), "__id", "__name")
    named = broadcast_join(lists.select("__ids", F.explode(F.array_distinct("__ids")).alias("__id")), d, "__id", "left")
    entry = F.when(F.col("__name").isNotNull(), F.struct(F.col("__id").alias("key"), F.col("__name").alias("value")))
    maps = named.groupBy("__ids").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("__map"))
    kinds = dict(d.dtypes)
    empty = F.map_from_arrays(F.array(), F.array()).cast(f"map<{kinds['__id']},{kinds['__name']}>")
    row = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]  # those have no hash
    dealt = df.withColumn("__deal", F.when(F.size(ids_col) > 0, F.xxhash64(ids_col)).otherwise(F.xxhash64(*row)))
    maps = maps.withColumn("__at", F.xxhash64("__ids"))
    joined = dealt.join(maps, (F.col(ids_col) == F.col("__ids")) & (F.col("__deal") == F.col("__at")), "left")
    return joined.withColumn(out, F.coalesce("__map", empty)).drop("__ids", "__map", "__deal", "__at", ids_col)


SALT = "__salt"


def salt_many_side(df: DataFrame, buckets: int, spread: Sequence[str] | None = None) -> DataFrame:
    """Give each row of the many side a salt in [0, buckets), from a hash of
    its own columns (deterministic, so a recomputed task salts the same way)."""
    cols = list(spread) if spread else df.columns
    return df.withColumn(SALT, F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(buckets)).cast("int"))


def replicate_one_side(df: DataFrame, buckets: int) -> DataFrame:
    """Copy each row of the one side once per salt value."""
    return df.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))


def salted_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    buckets: int,
    how: str = "inner",
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Equi-join where one key may hold a large share of ``many``'s rows.

    ``many`` rows of a key are spread over ``buckets`` salts; ``one`` is
    replicated per salt and the join runs on (keys, salt), so a hot key is
    handled by ``buckets`` tasks. Same result as ``many.join(one, keys, how)``
    for ``how`` in inner / left (rows of ``one`` without a match in a right /
    full join would be repeated per salt, so those are not offered).
    """
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("salted_join supports inner and left joins")
    salted = salt_many_side(many, buckets, spread)
    return salted.join(replicate_one_side(one, buckets), [*keys, SALT], how).drop(SALT)
