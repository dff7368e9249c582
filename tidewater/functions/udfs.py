"""Python UDF surface.

The reference's row-at-a-time ``udf`` pickles every row. Here the same
functions are Arrow-batched pandas UDFs (one call per batch of rows) and also
exist as built-in expressions, which Catalyst can optimise and codegen.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

PREFIX = "prefix_"  # fixed value of the reference's add_prefix


@F.pandas_udf(StringType())
def add_prefix_udf(names: pd.Series) -> pd.Series:
    # null in -> null out (the reference raised on None)
    return PREFIX + names


@F.arrow_udf(LongType())
def cube_udf(values: pa.Array) -> pa.Array:
    # on Arrow integers: nulls stay nulls, digits stay exact, an overflow is an error
    whole = values.cast(pa.int64())
    return pc.multiply_checked(pc.multiply_checked(whole, whole), whole)


def add_prefix_expr(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(PREFIX), c)


def cube_expr(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return (c.cast("long") * c.cast("long") * c.cast("long")).cast("long")


def register_sql_udfs(spark: SparkSession) -> None:
    """Make the UDFs callable from SQL as ``add_prefix(x)`` and ``cube(x)``."""
    spark.udf.register("add_prefix", add_prefix_udf)
    spark.udf.register("cube", cube_udf)
