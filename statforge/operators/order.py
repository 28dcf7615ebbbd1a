"""Ordering, partitioning and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statforge.sources.position import POSITION, has_position, placed_rank, rank

# The default break points of the first-character range
# partitioner, and its default number of partitions.
DEFAULT_BREAK_POINTS = ("F", "K", "P", "U")
DEFAULT_RANGE_PARTITIONS = 5
# Partitions that the keys of one range bucket are split over by default.
DEFAULT_PARTS_PER_BUCKET = 8


def sorted_partitions(df: DataFrame, key: str, num_partitions: int | None = None) -> DataFrame:
    """Every partition sorted by ``key`` (O1): the layout of a reducer's output
    files, each part in key order (byte order for strings), parts not ordered
    among themselves.

    The output of a grouped aggregation is already hash-partitioned by its
    key, so by default only the local sort is added (no exchange). With
    ``num_partitions`` the frame is first hash-partitioned into that many
    parts.
    """
    out = df.repartition(num_partitions, key) if num_partitions else df
    return out.sortWithinPartitions(key)


def first_char_bucket(
    key: Column | str,
    break_points: Sequence[str] = DEFAULT_BREAK_POINTS,
    num_partitions: int = DEFAULT_RANGE_PARTITIONS,
) -> Column:
    """Range bucket of a key by its first character (O2).

    Walk the break points in order and count those the first character is not
    below, stopping at the first it is below; the count modulo
    ``num_partitions`` is the bucket. An empty key goes to bucket 0.
    """
    k = F.col(key) if isinstance(key, str) else key
    if num_partitions == 0:
        return F.lit(0)
    first = F.substring(k, 1, 1)
    expr = None
    for i, bp in enumerate(break_points):
        cond = first < F.lit(bp)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    count = F.lit(len(break_points)) if expr is None else expr.otherwise(F.lit(len(break_points)))
    return F.when(first == "", F.lit(0)).otherwise(count % F.lit(num_partitions)).cast("int")


def range_partitioned(
    df: DataFrame,
    key: str,
    break_points: Sequence[str] = DEFAULT_BREAK_POINTS,
    num_partitions: int = DEFAULT_RANGE_PARTITIONS,
    bucket: str = "bucket",
    parts_per_bucket: int = DEFAULT_PARTS_PER_BUCKET,
) -> DataFrame:
    """Place rows by first-character bucket, each partition sorted by key (O2 + O1).

    One initial letter can hold a large share of all keys, so each bucket is
    split over several consecutive partitions: a range partitioning on
    ``(bucket, key)`` into ``num_partitions * parts_per_bucket`` parts, whatever
    the session's shuffle settings. Reading the partitions in order gives buckets in order
    and keys sorted within each bucket. The range bounds are sampled from the
    aggregated rows, whose shuffle output is reused, so the input is not
    scanned again.

    ``parts_per_bucket=1`` gives the exact reducer layout instead: bucket b is
    partition b (``repartitionById``; hash or range repartitioning could merge
    two buckets). Either way run it after the aggregation, so only one row per
    key crosses this exchange.
    """
    if parts_per_bucket < 1:
        raise ValueError("parts_per_bucket must be at least 1")
    with_bucket = df.withColumn(bucket, first_char_bucket(key, break_points, num_partitions))
    if parts_per_bucket > 1:
        n = max(num_partitions, 1) * parts_per_bucket
        return with_bucket.repartitionByRange(n, bucket, key).sortWithinPartitions(bucket, key)
    return with_bucket.repartitionById(max(num_partitions, 1), bucket).sortWithinPartitions(key)


def sample_k(df: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """Exactly ``k`` rows (fewer if the input is smaller), each set of k rows equally likely (O3).

    A row's rank is a hash of ``seed`` and of its position, never of what it holds: a
    line that makes up most of the input is drawn as often as it stands there. With the
    positions ``file`` and ``line_no`` (see ``statforge.sources.position``) a sample is the same
    however the input is split; a frame without them is ranked by partition and row
    number, which repeats for one layout. The k least ranks are a bottom-k sketch:
    ``orderBy + limit`` keeps k rows a task and merges these.
    """
    if has_position(df):
        return df.orderBy(rank(seed), *POSITION).limit(k)
    place = F.monotonically_increasing_id()
    ranked = df.withColumn("_place", place).withColumn("_rank", placed_rank(F.col("_place"), seed))
    return ranked.orderBy("_rank", "_place").limit(k).drop("_rank", "_place")
