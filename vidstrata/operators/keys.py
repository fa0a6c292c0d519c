"""Key operators: first per key, unseen keys, and a join that holds up under hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidstrata.session import estimated_bytes

# A key is hot when it holds more than 1/HOT_SHARE of the rows, so there are at most HOT_SHARE hot
# keys, and cutting each into pieces of that size copies at most 2 * HOT_SHARE rows of the other
# side (times its rows per key). Both bounds are independent of the data's size.
HOT_SHARE = 2000


def first_by_key(df: DataFrame, keys: list[str], order: list[str], keep: list[str] | None = None) -> DataFrame:
    """The first row per key by ``order``, all columns of it or the keys and those to ``keep``.

    An aggregate, not a window: every task first reduces its own rows to one per key, so a key
    that holds a third of all rows sends one row per task through the shuffle. Columns of the order that are not
    kept are sorted and shuffled once, not twice.
    """
    columns = [name for name in df.columns if keep is None or name in keys or name in keep]
    rest = [name for name in columns if name not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    picked = df.groupBy(*keys).agg(first).select(*keys, "_first.*")
    return picked.select(*columns)


def unseen(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source`` whose key ``target`` does not hold; ``source`` has one row per key.

    The target's keys are first cut down to those the source brings. When the source is an increment
    AQE broadcasts its keys and the large target is never shuffled; when both are large the two
    joins use one partitioning. Keys the target repeats are folded before the second join.
    """
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    return source.join(known, keys, "left_anti")


def broadcast_limit(df: DataFrame) -> int:
    try:
        conf = df.sparkSession._jsparkSession.sessionState().conf()
        return int(conf.autoBroadcastJoinThreshold())
    except AttributeError:
        return -1


def fits_broadcast(df: DataFrame, size: int | None = None) -> bool:
    size = estimated_bytes(df) if size is None else size
    return size is not None and size <= broadcast_limit(df)


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """Hot keys with the number of pieces each is cut into; at most ``share`` rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("total")).scalar()  # from the same counts
    return counts.where(
        F.col(key).isNotNull() & (F.col("_n") * share > total)
    ).select(key, F.ceil(F.col("_n") * share / total).cast("int").alias("_pieces"))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_by: str,
    share: int = HOT_SHARE,
    right_bytes: int | None = None,
) -> DataFrame:
    """Inner equi-join of a large ``left`` whose keys may be hot; many-to-many allowed.

    A right side under the session's broadcast limit is broadcast; its size is the optimizer's
    estimate, or ``right_bytes`` where the caller knows better. Otherwise rows of hot keys get a
    piece number (from ``spread_by``, a column that differs between them) and the matching right
    rows are repeated once per piece.
    """
    if fits_broadcast(right, right_bytes):
        return left.join(F.broadcast(right), F.col(left_key) == F.col(right_key), "inner")
    hot = hot_keys(left.select(left_key), left_key, share)
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    hot_left = F.broadcast(hot.withColumnRenamed(left_key, "_hot"))
    spread = (
        left.join(hot_left, F.col(left_key) == F.col("_hot"), "left")
        .withColumn("_piece", F.pmod(F.xxhash64(spread_by), pieces).cast("int"))
        .drop("_hot", "_pieces")
    )
    repeated = (
        right.join(hot_left, F.col(right_key) == F.col("_hot"), "left")
        .withColumn("_right_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_hot", "_pieces")
    )
    matched = (F.col(left_key) == F.col(right_key)) & (F.col("_piece") == F.col("_right_piece"))
    return spread.join(repeated, matched, "inner").drop("_piece", "_right_piece")

