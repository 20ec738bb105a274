"""Measured sizes: what may be sent whole to every task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

ROW_OVERHEAD = 64
FIXED_BYTES = 16


def _value_bytes(name: str, dtype: T.DataType) -> Column:
    column = F.col(name)
    if isinstance(dtype, T.StringType):
        size = F.octet_length(column)
    elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.StringType, T.StructType)):
        size = F.octet_length(F.to_json(column))
    elif isinstance(dtype, T.ArrayType):
        size = F.size(column) * 8
    else:
        size = F.lit(0)
    return F.coalesce(size, F.lit(0)).cast("long") + FIXED_BYTES


def row_bytes(df: DataFrame) -> Column:
    """An upper estimate of a row's size in memory."""
    return sum((_value_bytes(f.name, f.dataType) for f in df.schema.fields), F.lit(ROW_OVERHEAD).cast("long"))


def measured_bytes(df: DataFrame) -> int:
    """An upper estimate of the rows' size in memory; one aggregate job."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("n")).first()["n"]


def fits(df: DataFrame, limit: int) -> bool:
    return measured_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int) -> DataFrame:
    """Hint a broadcast only for a side measured to be within the limit."""
    return F.broadcast(df) if fits(df, limit) else df
