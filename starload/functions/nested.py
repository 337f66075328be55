"""Apply a string function to every string inside nested columns (structs, arrays, map values)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_strings(c: Column, dtype: T.DataType, fn: Callable[[Column], Column]) -> Column:
    """Rebuild ``c`` with ``fn`` applied to each string leaf, following the declared type."""
    if isinstance(dtype, T.StringType):
        return fn(c)
    if isinstance(dtype, T.StructType):
        return F.when(
            c.isNotNull(),
            F.struct(*[map_strings(c.getField(f.name), f.dataType, fn).alias(f.name) for f in dtype.fields]),
        )
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: map_strings(x, dtype.elementType, fn))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda _k, v: map_strings(v, dtype.valueType, fn))  # keys stay
    return c


def map_all_strings(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    return df.select(*[map_strings(F.col(f.name), f.dataType, fn).alias(f.name) for f in df.schema.fields])
