"""Silver operators: type standardisation, latest-row dedup and upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from strata.functions.timestamps import parse_iso
from strata.operators.sizing import broadcast_if_small, measured_bytes


# Which version of a row is the latest: by batch, publication time, then place in the source.
ROW_ORDER = ("_batch_id", "published_timestamp", "_source_file", "_source_row")


def standardize(
    df: DataFrame,
    longs: Sequence[str] = ("views",),
    doubles: Sequence[str] = ("rating",),
    timestamps: Sequence[str] = ("published_timestamp",),
) -> DataFrame:
    """Cast the columns to their silver types; an unreadable value becomes null."""
    casts = {c: F.col(c).try_cast("bigint") for c in longs}
    casts |= {c: F.col(c).try_cast("double") for c in doubles}
    casts |= {c: parse_iso(F.col(c)) for c in timestamps}
    return df.withColumns(casts)


def dedup_latest(df: DataFrame, key: str, order_by: Sequence[str] = ("_ingested_at",)) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by the other columns.

    ``max`` over a struct combines on the map side, so a key that holds a third
    of the rows sends one row per task instead of meeting in one window group.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    latest = F.max(F.struct(*order_by, *rest)).alias("_latest")
    grouped = df.groupBy(key).agg(latest)
    return grouped.select(*[F.col(c) if c == key else F.col(f"_latest.{c}").alias(c) for c in df.columns])


def latest_rows(df: DataFrame, key: str, order_by: Sequence[str], broadcast_bytes: int = 64 << 20) -> DataFrame:
    """As ``dedup_latest``, for a stored table: only rows whose key comes more than once are shuffled.

    Their keys are counted first; where they are too many to broadcast, all rows go the plain way.
    """
    counted = df.groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("n"))
    again = counted.where("n > 1").select("_again")
    size = measured_bytes(again)
    if not size:
        return df
    if size > broadcast_bytes:
        return dedup_latest(df, key, order_by)
    same = F.col(key).eqNullSafe(F.col("_again"))
    alone = df.join(F.broadcast(again), same, "left_anti")
    return alone.unionByName(dedup_latest(df.join(F.broadcast(again), same, "left_semi"), key, order_by))


def upsert(
    target: DataFrame, source: DataFrame, key: str, broadcast_bytes: int = 64 << 20, order_by: Sequence[str] = ()
) -> DataFrame:
    """Target with the source merged in: matched keys replaced, new keys added.

    With ``order_by`` a matched row is replaced only by one of an equal or later
    order, so a replay of an old batch brings no old row back.

    Source keys must be unique (``dedup_latest``). A null key matches nothing:
    both null-key rows stay. When the source keys are measured to be small they
    are broadcast and the target is not shuffled; else both sides meet by key.
    ``source`` is read up to three times: give a stored table.
    """
    known = source.where(F.col(key).isNotNull())
    if not order_by:
        keys = broadcast_if_small(known.select(key), broadcast_bytes)
        return target.join(keys, key, "left_anti").select(*target.columns).unionByName(source)
    keys = broadcast_if_small(known.select(key, F.struct(*order_by).alias("_order")), broadcast_bytes)
    met = target.join(keys, key, "left")
    later = F.struct(*order_by) > F.col("_order")
    kept = met.where(F.col("_order").isNull() | later).select(*target.columns)
    beaten = met.where(F.col("_order").isNotNull() & later).select(key)
    added = source.join(broadcast_if_small(beaten, broadcast_bytes), key, "left_anti").select(*source.columns)
    return kept.unionByName(added)
